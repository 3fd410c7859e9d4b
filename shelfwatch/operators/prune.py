"""Category list pruning by comparing each row with the next one.

One window over a whole list would run in one task, and splitting by host or first path segment
still puts a large host into one task. ``with_next`` keeps the exact global order instead: rows
are range-partitioned, each range looks up its own next rows, and only the first and last row of
every range (two rows per range) meet in one small group to join the ranges up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.operators.dedup import keep_first


def with_next(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Value of the next row in ``order`` within ``group``; null on the last row of the group.

    (group, order) must be unique per row, else equal rows would pile up in one range.
    """
    by = [F.col(c).asc_nulls_last() for c in (*group, *order)]
    ranged = df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id())
    here = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)], F.col(value).alias("v"))
    inside = Window.partitionBy("_range").orderBy(*by)
    marked = ranged.withColumns(
        {"_next": F.lead(here).over(inside), "_has_prev": F.lag(F.lit(1)).over(inside)}
    ).withColumn("_edge", F.col("_next").isNull() | F.col("_has_prev").isNull())
    seams = Window.partitionBy(F.when(F.col("_edge"), F.lit(-1)).otherwise(F.col("_range"))).orderBy(*by)
    joined = marked.withColumn("_next", F.coalesce("_next", F.lead(here).over(seams)))
    same = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(f"_next.g{i}").eqNullSafe(F.col(c))
    return joined.withColumn(out, F.when(same, F.col("_next.v"))).drop(
        "_range", "_next", "_has_prev", "_edge"
    )


def drop_covered(df: DataFrame, url: str = "url", group: Sequence[str] = ("shop",), seq: str = "seq") -> DataFrame:
    """Drop a category whose URL is part of the next URL in URL order: its children cover it.

    Of equal URLs the last one stays (each is part of the next), found before sorting so that
    copies never travel together.
    """
    unique = keep_first(df, [*group, url], [F.col(seq).desc_nulls_last()])
    nxt = with_next(unique, group, [url], url, "_url_next")
    covered = F.coalesce(F.contains(F.col("_url_next"), F.col(url)), F.lit(False))
    return nxt.where(~covered).drop("_url_next")


def drop_prefix_of_next(
    df: DataFrame,
    url: str = "url",
    group: Sequence[str] = ("shop",),
    seq: str = "seq",
    suffix_len: int = 5,
    drop_last: bool = True,
) -> DataFrame:
    """In list order, drop a category if the next URL starts with it (less its ``.html``).

    The last URL of a list is dropped as well unless ``drop_last`` is off. ``seq`` must be unique.
    """
    nxt = with_next(df, group, [seq], url, "_url_next")
    stem = F.substring(F.col(url), F.lit(1), F.greatest(F.length(url) - suffix_len, F.lit(0)))
    keep = F.when(F.col("_url_next").isNull(), F.lit(not drop_last)).otherwise(
        ~F.startswith(F.col("_url_next"), stem)
    )
    return nxt.where(keep).drop("_url_next")
