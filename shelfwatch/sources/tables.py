"""Sinks: snapshots, combined table, cohort result, run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.sources import versions


def write_partitioned(df: DataFrame, path: str, *partition_by: str, fmt: str = "parquet", **options) -> None:
    """Overwrite only the partitions present in ``df``.

    ``rebalance`` lets AQE merge small partitions and split large ones (a shop or day may hold a
    third of the rows), so files come out evenly sized without one task per shop.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


SNAPSHOT_KEYS = ("snapshot_date", "shop")


def snapshot_scope(captures: DataFrame) -> DataFrame:
    """The days and shops that a run over these captures is about."""
    return captures.select(F.col("captured_at").cast("date").alias("snapshot_date"), "shop").distinct()


def stage_snapshot(df: DataFrame, path: str, version: str) -> DataFrame:
    """Rows of one run by day and shop, not yet visible. Used for the raw rows and for the cleaned rows."""
    return versions.stage(df.withColumn("snapshot_date", F.col("date").cast("date")), path, version, SNAPSHOT_KEYS)


def commit_snapshot(staged: DataFrame, path: str, version: str, scope: DataFrame) -> None:
    """Replace the days and shops of ``scope`` by the staged rows."""
    versions.commit(staged, path, version, SNAPSHOT_KEYS, scope)


def write_aggregate(df: DataFrame, path: str, version: str, shops: Sequence[str]) -> None:
    """Combined table, by shop: the run replaces ``shops`` and reads of one shop open that shop's folder only."""
    scope = df.sparkSession.createDataFrame([(s,) for s in shops], "shop string")
    versions.replace(df, path, version, ["shop"], scope)


def write_cohort(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_log(df: DataFrame, path: str, run: str, also: Sequence[str] = ()) -> None:
    """Log or ledger rows of one run; they replace those of an earlier run of that name, or of the names ``also``."""
    named = df.withColumn("run", F.lit(run))
    scope = named.sparkSession.createDataFrame([(r,) for r in (run, *also)], "run string")
    versions.replace(named, path, run, ["run"], scope)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Snapshots, combined table, log or ledger as of the last run."""
    return versions.current(spark, path)


def write_snapshot_csv(df: DataFrame, root: str, before_clean: bool = False) -> None:
    """Snapshot files in the landing layout, ``{SHOP}_{y}-{m}-{d}[_before_clean].csv``.

    ``df`` has the columns to write plus ``src_shop`` and ``date``.
    """
    tail = "_before_clean.csv" if before_clean else ".csv"
    day = F.col("date").cast("date")
    name = F.concat(
        F.col("src_shop"), F.lit("_"), F.year(day), F.lit("-"), F.month(day), F.lit("-"), F.dayofmonth(day), F.lit(tail)
    )
    (
        df.withColumn("snapshot_file", name)
        .drop("src_shop")
        .hint("rebalance", "snapshot_file")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")  # a file written again replaces itself
        .options(header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
        .partitionBy("snapshot_file")
        .csv(root)
    )
