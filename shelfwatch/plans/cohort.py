"""Old and new products per day: from the combined table, or kept up to date day by day.

The kept form stores one row per product and day, and the counts of each day, both by day. New rows
touch only their days: those are merged, first row by ``seq``, and counted again against the
products of the first day. Only rows of the first day, or of an earlier one, change which products
are old; then all days are counted again from the stored products.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions.text import day_of
from shelfwatch.operators.cohort import NODE, classified, cohort_counts, in_stock_days
from shelfwatch.session import stored
from shelfwatch.sources import tables, versions


def day_column(df: DataFrame, name: str = "date"):
    """Day of a text or timestamp column."""
    kind = df.schema[name].dataType.typeName()
    return day_of(F.col(name)) if kind == "string" else F.col(name).cast("date")


def old_new_counts(aggregate: DataFrame, until: datetime.date | None = None) -> DataFrame:
    return cohort_counts(in_stock_days(aggregate, day_column(aggregate)), until=until)


def run(spark: SparkSession, aggregate_path: str, out: str, until: datetime.date | None = None) -> None:
    tables.write_cohort(old_new_counts(tables.read_table(spark, aggregate_path), until), out)


def _products(rows: DataFrame) -> DataFrame:
    """One row per product and day, the first by ``seq``, which stays."""
    node = F.struct("seq", *NODE)
    return rows.groupBy("new_id", "d").agg(F.min(node).alias("n")).select("new_id", "d", "n.*")


def _folders(path: str) -> tuple[str, str]:
    return f"{path}/products", f"{path}/counts"


def merge_days(stocked: DataFrame, path: str, name: str) -> list[datetime.date]:
    """Add in-stock rows (``in_stock_days``) to the state at ``path``; returns the days counted again.

    Rows may be of new days or late ones of any day. A product that fills a third of a batch is
    reduced on the map side. The same rows again change nothing.
    """
    spark, (products, counts) = stocked.sparkSession, _folders(path)
    fresh = stored(_products(stocked.where("d is not null")), "cohort")
    days = sorted(r[0] for r in fresh.select("d").distinct().collect())  # of one batch
    if not days:
        return []
    owned = versions.owners(spark, products)
    before = owned.agg(F.min("d")).first()[0] if owned is not None else None
    touched = fresh.select("d").distinct()
    if before is not None:
        known = versions.current(spark, products).where(F.col("d").isin(days))
        fresh = _products(fresh.unionByName(known))
    versions.replace(fresh, products, name, ["d"], touched)
    daily = versions.current(spark, products)
    start = min(days[0], before or days[0])
    again = daily if before is None or days[0] <= before else daily.where(F.col("d").isin(days))
    old = daily.where(F.col("d") == F.lit(start)).select("new_id", F.lit(True).alias("_old"))
    new = F.col("_old").isNull()
    counted = (
        classified(again.join(old, "new_id", "left"), NODE)
        .groupBy("d", *NODE)
        .agg(
            F.sum(F.when(new, 1)).alias("item_not_present_day1"),
            F.sum(F.when(~new, 1)).alias("item_present_day1"),
        )
    )
    versions.replace(counted, counts, name, ["d"], again.select("d").distinct())
    return days if again is not daily else sorted(r[0] for r in versions.owners(spark, products).select("d").collect())


def stored_counts(spark: SparkSession, path: str, until: datetime.date | None = None) -> DataFrame:
    """The counts of the state at ``path``, in the layout of ``old_new_counts``."""
    folder = _folders(path)[1]
    counts, start = versions.current(spark, folder), versions.owners(spark, folder).agg(F.min("d")).first()[0]
    total = counts.where(F.col("d") == F.lit(start)).select(*NODE, F.col("item_present_day1").alias("Total_item_day_1"))
    last = F.current_date() if until is None else F.lit(until)
    return (
        counts.where((F.col("d") > F.lit(start)) & (F.col("d") <= last))
        .join(total, list(NODE), "left")
        .select(F.col("d").alias("date"), *NODE, "item_not_present_day1", "item_present_day1", "Total_item_day_1")
    )
