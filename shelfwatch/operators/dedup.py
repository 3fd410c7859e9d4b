"""Keep-first operators.

``row_number() == 1`` is planned with a group limit on both sides of the exchange, so each map
task ships at most one row per key: a key that holds a third of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions.conditions import by_shop, rank_of
from shelfwatch.schema import TAXO

LISTING_KEY = ("shop", "id", "reference", "name")


def nulls_last(columns: Sequence[str | Column]) -> list[Column]:
    """Ascending, nulls at the end; columns that already carry an order are kept as they are."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key (null equals null). ``order`` must settle all ties."""
    w = Window.partitionBy(*keys).orderBy(*nulls_last(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_rank(df: DataFrame, ladders: dict, out: str = "rank", shop: str = "shop") -> DataFrame:
    """Rank by each shop's ladder; shops without one get 0. Nothing is dropped or moved."""
    rank = by_shop({s: rank_of(l) for s, l in ladders.items()}, F.lit(0), shop)
    return df.withColumn(out, rank)


def priority_dedup(
    df: DataFrame,
    ladders: dict,
    keys: Sequence[str] = LISTING_KEY,
    levels: Sequence[str] = TAXO,
    seq: Sequence[str] = ("seq",),
) -> DataFrame:
    """Best-classified listing per product: lowest rank, then level texts, then source order."""
    ranked = with_rank(df, ladders, "_rank")
    return keep_first(ranked, keys, ["_rank", *levels, *seq]).drop("_rank")


def default_dedup(
    df: DataFrame,
    keys: Sequence[str] = LISTING_KEY,
    levels: Sequence[str] = TAXO[:3],
    seq: Sequence[str] = ("seq",),
) -> DataFrame:
    """Listing with the smallest level texts per product."""
    return keep_first(df, keys, [*levels, *seq])


def first_category_wins(
    df: DataFrame,
    ladders: dict,
    keys: Sequence[str] = ("shop", "id"),
    levels: Sequence[str] = TAXO,
    url: str = "url",
    link_pos: str = "link_pos",
    seq: Sequence[str] = ("seq",),
) -> DataFrame:
    """A product belongs to the first category that lists it.

    Categories are visited by rank, then level texts, then URL; the links of one category are
    visited from the last to the first. The levels are those of the *category*.
    """
    ranked = with_rank(df, ladders, "_rank")
    order = ["_rank", *levels, url, F.col(link_pos).desc_nulls_last(), *seq]
    return keep_first(ranked, keys, order).drop("_rank")
