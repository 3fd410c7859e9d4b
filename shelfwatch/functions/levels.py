"""Category levels: from URLs, paths and codes to ``taxo1 .. taxo4``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.text import split_plain, strip


def pick(parts: Column, positions: Sequence[int]) -> list[Column]:
    """Entries of an array by position from 0, null out of range."""
    return [F.get(parts, F.lit(p)) for p in positions]


def compact_levels(levels: Sequence[Column], leaf: Column | None = None, width: int = 4) -> list[Column]:
    """Close the gaps null levels leave, append the leaf, return ``width`` levels."""
    return pick(level_array(levels, leaf), range(width))


def level_array(levels: Sequence[Column], leaf: Column | None = None) -> Column:
    """The same as one array; positions past its end read as null with ``get``."""
    parts = F.array_compact(F.array(*levels))
    return parts if leaf is None else F.array_append(parts, leaf)


def url_parts(col: Column, prefix: str = "", sep: str = "/", drop: str | None = None, drop_last: int = 0) -> Column:
    """Parts of a URL or path after removing ``prefix``; parts equal to ``drop`` and the last
    ``drop_last`` parts are left out."""
    text = F.replace(col, F.lit(prefix), F.lit("")) if prefix else col
    parts = split_plain(text, sep)
    if drop is not None:
        parts = F.filter(parts, lambda p: p != F.lit(drop))
    if drop_last:
        parts = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - drop_last, F.lit(0)))
    return parts


def url_levels(
    col: Column,
    positions: Sequence[int],
    prefix: str = "",
    sep: str = "/",
    drop: str | None = None,
    drop_last: int = 0,
) -> list[Column]:
    return pick(url_parts(col, prefix, sep, drop, drop_last), positions)


def code_levels(col: Column, count: int = 6) -> list[Column]:
    """Levels of a pipe code: the part before the first pipe is skipped, at most ``count`` splits."""
    return pick(split_plain(col, "|", count + 1), range(1, count + 1))


def tracking_levels(col: Column) -> list[Column]:
    """Levels 2, 3 and 4 of a tracking text."""
    return pick(tracking_parts(col), (1, 2, 3))


def tracking_parts(col: Column) -> Column:
    """Last pipe part of a tracking text, split at colons, trimmed."""
    last = F.element_at(split_plain(col, "|"), -1)
    return F.transform(split_plain(last, ":"), strip)


def fallback_level(level: Column, below: Column, vague: str = "department") -> Column:
    """The level below where this one is missing or says nothing."""
    return F.when(level.isNull() | (level == vague), below).otherwise(level)


def map_values(col: Column, mapping: dict[str, str]) -> Column:
    """Replace known values, keep all others."""
    return F.coalesce(lookup(col, mapping), col) if mapping else col


def lookup(col: Column, mapping: dict[str, str]) -> Column:
    """Value for a known key, else null. The constant map keeps the generated code small."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def below_root(root: str) -> Column:
    """Rows listed below an extra root level; null is not below any."""
    return F.col("taxo1").eqNullSafe(F.lit(root))


def shift_levels(df: DataFrame, hit: Column) -> DataFrame:
    """Rows of ``hit`` lose their first level: taxo1 <- taxo2 <- taxo3 <- null."""
    return df.withColumns(
        {
            "taxo1": F.when(hit, F.col("taxo2")).otherwise(F.col("taxo1")),
            "taxo2": F.when(hit, F.col("taxo3")).otherwise(F.col("taxo2")),
            "taxo3": F.when(~hit, F.col("taxo3")),
        }
    )
