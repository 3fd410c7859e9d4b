"""Data checks, rejects and the run log."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.schema import MAJOR, RUN_LOG, TIMING


def duplicates(df: DataFrame, keys: Sequence[str] = ("shop", "id", "date")) -> DataFrame:
    """Keys that occur more than once, with their count. A check only: the data stays as it is."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def first_reason(checks: Sequence[tuple[Column, str]]) -> Column:
    """Text of the first check that fails, null if the record is fine."""
    return F.coalesce(*[F.when(failed, F.lit(text)) for failed, text in checks], F.lit(None).cast("string"))


def log_rows(df: DataFrame, level: Column | str, message: Column, url: str = "url") -> DataFrame:
    """Rejected rows in the layout of the run log."""
    level = F.lit(level) if isinstance(level, str) else level
    return df.select(
        F.current_timestamp().alias("ts"), level.alias("level"), "shop", message.alias("message"), F.col(url).alias("url")
    )


def log_counts(log: DataFrame) -> DataFrame:
    """Log lines per shop and level."""
    return log.groupBy("shop", "level").agg(F.count("*").alias("n"))


def log_of_shop(log: DataFrame, shop: str) -> DataFrame:
    return log.where(F.col("shop") == shop)


def log_of_level(log: DataFrame, level: str) -> DataFrame:
    """Log of one level; this view has no message."""
    return log.where(F.col("level") == level).drop("message")


def run_isolated(spark: SparkSession, jobs: dict[str, Callable[[], None]]) -> DataFrame:
    """Run one job per shop; a failing shop is logged and does not stop the others."""
    rows = []

    def now() -> datetime.datetime:
        return datetime.datetime.now(datetime.timezone.utc)

    for shop, job in jobs.items():
        rows.append((now(), TIMING, shop, "start", None))
        try:
            job()
            rows.append((now(), TIMING, shop, "end", None))
        except Exception as ex:  # any failure of one shop is that shop's own
            rows.append((now(), MAJOR, shop, str(ex), None))
    return spark.createDataFrame(rows, RUN_LOG)
