"""Day-1 cohort counts.

A product is *old* if it was in stock on the first day of the whole table, else *new*.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions.text import product_key

NODE = ("shop", "taxo1", "taxo2", "taxo3")


def in_stock_days(
    df: DataFrame, day: Column, stock: str = "inStock", levels: Sequence[str] = NODE[1:], seq: str = "seq"
) -> DataFrame:
    """In-stock rows as (new_id, d, node, seq)."""
    return df.where(F.col(stock)).select(
        product_key(F.col("shop"), F.col("id")).alias("new_id"),
        day.alias("d"),
        "shop",
        *levels,
        F.col(seq).alias("seq"),
    )


def first_day(stocked: DataFrame) -> Column:
    """Smallest day of the table as a scalar subquery; null days are ignored."""
    return stocked.agg(F.min("d")).scalar()


def daily_products(stocked: DataFrame, levels: Sequence[str] = NODE[1:]) -> DataFrame:
    """One row per product and day; the first row by ``seq`` decides the node.

    A grouped minimum combines on the map side, so a product that fills a third of the table
    ships one row per task and day.
    """
    node = F.struct("seq", "shop", *levels)
    return (
        stocked.where(F.col("d").isNotNull())
        .groupBy("new_id", "d")
        .agg(F.min(node).alias("n"))
        .select("new_id", "d", "n.shop", *[F.col(f"n.{c}") for c in levels])
    )


def classified(df: DataFrame, columns: Sequence[str] = NODE) -> DataFrame:
    """Rows whose node has no null or empty level."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull() & (F.col(c) != "")
    return df.where(keep)


def day1_ids(stocked: DataFrame) -> DataFrame:
    """Distinct products of the first day."""
    return stocked.where(F.col("d") == first_day(stocked)).select("new_id").distinct()


def day1_totals(stocked: DataFrame, levels: Sequence[str] = NODE[1:]) -> DataFrame:
    """Products per node on the first day."""
    day1 = stocked.where(F.col("d") == first_day(stocked))
    return (
        classified(daily_products(day1, levels), ("shop", *levels))
        .groupBy("shop", *levels)
        .agg(F.count("*").alias("Total_item_day_1"))
    )


def with_first(stocked: DataFrame, levels: Sequence[str] = NODE[1:], until: Column | None = None) -> DataFrame:
    """Product days with ``_first``, the product's first day, and ``_start``, that of the table.

    Rows are reduced to products and days before the window, which sees one row per day at most.
    The table's first day is read from the same reduced rows, whose exchange is planned once.
    """
    days = stocked if until is None else stocked.where(F.col("d") <= until)
    daily = daily_products(days, levels)
    start = daily.agg(F.min(F.struct("d", "new_id", "shop", *levels)).alias("least")).select("least.d").scalar()
    return daily.withColumns({"_first": F.min("d").over(Window.partitionBy("new_id")), "_start": start})


def cohort_counts(
    stocked: DataFrame, levels: Sequence[str] = NODE[1:], until: datetime.date | Column | None = None
) -> DataFrame:
    """New and old products per day and node next to the day-1 total of the node.

    Days run from the day after the first one to ``until`` (today if not given). Counts are null,
    not 0, where a node has no such product; the same holds for the total, which is the old count
    of the first day and picked from the counted nodes.
    """
    until = F.current_date() if until is None else (until if isinstance(until, Column) else F.lit(until))
    node = ("shop", *levels)
    counts = (
        classified(with_first(stocked, levels, until), node)
        .groupBy("d", "_start", *node)
        .agg(
            F.sum(F.when(F.col("_first") > F.col("_start"), 1)).alias("item_not_present_day1"),
            F.sum(F.when(F.col("_first") == F.col("_start"), 1)).alias("item_present_day1"),
        )
    )
    total = F.max(F.when(F.col("d") == F.col("_start"), F.col("item_present_day1")))
    return (
        counts.withColumn("Total_item_day_1", total.over(Window.partitionBy(*node)))
        .where(F.col("d") > F.col("_start"))
        .select(
            F.col("d").alias("date"),
            *node,
            "item_not_present_day1",
            "item_present_day1",
            "Total_item_day_1",
        )
    )


def split_by_day1(stocked: DataFrame, levels: Sequence[str] = NODE[1:]) -> tuple[DataFrame, DataFrame]:
    """(old, new) product days after the first day: a product is old if its own first day is that day."""
    later = with_first(stocked, levels).where(F.col("d") > F.col("_start"))
    kept = ["new_id", "d", "shop", *levels]
    return (
        later.where(F.col("_first") == F.col("_start")).select(*kept),
        later.where(F.col("_first") > F.col("_start")).select(*kept),
    )


def cohort_outer(stocked: DataFrame, levels: Sequence[str] = NODE[1:]) -> DataFrame:
    """New next to old counts on day and node, null where there is none.

    Both are counted in one pass, which a full outer join of two counts would do in two.
    """
    node = ("shop", *levels)
    rows = classified(with_first(stocked, levels), node).where(F.col("d") > F.col("_start"))
    return rows.groupBy("d", *node).agg(
        F.sum(F.when(F.col("_first") > F.col("_start"), 1)).alias("item_not_present_day1"),
        F.sum(F.when(F.col("_first") == F.col("_start"), 1)).alias("item_present_day1"),
    )
