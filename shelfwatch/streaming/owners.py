"""Owners of products over batches: the first category that lists a product keeps it.

The state is a stored table of one row per shop, product and day. A batch is reduced to its own
winners, which meet the stored winners of the same days, and those days are replaced. The better
row wins whatever the order of batches, so late and repeated batches give what one run over
everything gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwatch.config.ladders import CATEGORY_LADDERS
from shelfwatch.operators.dedup import first_category_wins
from shelfwatch.session import stored
from shelfwatch.sources import versions

KEYS = ("shop", "id", "day")


def merge_owners(listings: DataFrame, path: str, name: str, ladders: dict = CATEGORY_LADDERS) -> None:
    """Let ``listings`` (a product's columns with ``day``) compete with the stored owners of their days."""
    spark = listings.sparkSession
    fresh = stored(first_category_wins(listings, ladders, KEYS), "owners")
    days = [r[0] for r in fresh.select("day").distinct().collect()]  # of one batch
    if not days:
        return
    best = fresh
    if versions.owners(spark, path) is not None:
        known = versions.current(spark, path).where(F.col("day").isin(days))
        best = first_category_wins(fresh.unionByName(known), ladders, KEYS)
    versions.replace(best, path, name, ["day"], fresh.select("day").distinct())


def owners(spark: SparkSession, path: str) -> DataFrame:
    """The owner of each product and day so far."""
    return versions.current(spark, path)


def own_new(listings: DataFrame, path: str, checkpoint: str, ladders: dict = CATEGORY_LADDERS) -> StreamingQuery:
    """Merge what a stream has brought since the last run, batch by batch, and stop."""
    return (
        listings.writeStream.foreachBatch(lambda batch, number: merge_owners(batch, path, f"batch{number}", ladders))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
