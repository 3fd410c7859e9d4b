"""Captures that arrive between runs.

The tracked jobs run once a day. A file stream with an ``availableNow`` trigger does the same for
what came in since the last run: each batch is stored once under its own number, and the days it
touches are collected again from all their stored captures. Ranking, ownership and
de-duplication need a whole day, and so see one; a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwatch.plans import collect
from shelfwatch.schema import CAPTURE
from shelfwatch.sources import tables


def capture_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(CAPTURE).format(fmt).load(path)


def collect_new(captures: DataFrame, store: str, raw_path: str, clean_path: str, log_path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop. ``store`` keeps the captures by day and batch."""

    def step(batch: DataFrame, number: int) -> None:
        kept = batch.withColumns({"day": F.col("captured_at").cast("date"), "batch": F.lit(number)})
        tables.write_partitioned(kept, store, "day", "batch")
        days = [r[0] for r in batch.select(F.col("captured_at").cast("date")).distinct().collect()]
        if days:
            known = batch.sparkSession.read.parquet(store).where(F.col("day").isin(days))
            collect.run(known.drop("day", "batch"), raw_path, clean_path, log_path)

    return (
        captures.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
