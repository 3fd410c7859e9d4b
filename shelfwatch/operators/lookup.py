"""Lookups from products to sub-categories, and menu trees to category paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.session import stored


def lookup_with_fallback(
    products: DataFrame,
    lookup: DataFrame,
    own: str,
    linked: str,
    key: str,
    value: str,
    out: str,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Value for the product's own id, else for the linked id, else null.

    ``lookup`` holds one row per (scope, key). An own entry settles the case even if its value is
    null.
    """
    scope = list(scope)
    own_side = lookup.select(
        *scope, F.col(key).alias(own), F.col(value).alias("_own"), F.lit(True).alias("_found")
    )
    link_side = lookup.select(
        *scope, F.col(key).alias("_link"), F.lit(0).cast("bigint").alias("_salt"), F.col(value).alias("_linked")
    )
    first = products.join(own_side, [*scope, own], "left")
    # Rows that need no second lookup get no key, and a salt of their own: none of them match, and
    # they don't gather in the task of the null key.
    needs = F.col("_found").isNull() & F.col(linked).isNotNull()
    keyed = first.withColumns(
        {
            "_link": F.when(needs, F.col(linked)),
            "_salt": F.when(needs, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*products.columns)),
        }
    )
    joined = keyed.join(link_side, [*scope, "_link", "_salt"], "left")
    picked = F.when(F.col("_found"), F.col("_own")).otherwise(F.col("_linked"))
    return joined.withColumn(out, picked).select(*products.columns, out)


def ancestor_lines(nodes: DataFrame, scope: Sequence[str], node: str, parent: str, name: str) -> DataFrame:
    """(scope, _parent, _line): for each node that is a parent, the names from its root down to itself.

    Parents are a small part of a menu. Each round doubles the part of the line that is known, so
    rounds are the logarithm of the depth; the lines are written between rounds.
    """
    above = nodes.select(*scope, F.col(parent).alias("_parent")).where("_parent is not null").distinct()
    inner = nodes.select(*scope, F.col(node).alias("_parent"), F.col(parent).alias("_up"), F.array(F.col(name)).alias("_line"))
    lines = stored(inner.join(above, [*scope, "_parent"], "left_semi"), "menu")
    rounds = max(lines.count(), 1).bit_length()  # more only if a node were its own ancestor
    for _ in range(rounds):
        if lines.where("_up is not null").isEmpty():
            break
        upper = lines.select(*scope, F.col("_parent").alias("_up"), F.col("_up").alias("_next"), F.col("_line").alias("_head"))
        joined = lines.join(upper, [*scope, "_up"], "left")
        lines = stored(
            joined.select(
                *scope, "_parent", F.col("_next").alias("_up"),
                F.when(F.col("_head").isNull(), F.col("_line")).otherwise(F.concat("_head", "_line")).alias("_line"),
            ),
            "menu",
        )
    return lines.select(*scope, "_parent", "_line")


def tree_paths(
    nodes: DataFrame,
    node: str = "node",
    parent: str = "parent",
    name: str = "name",
    scope: Sequence[str] = (),
    width: int = 4,
) -> DataFrame:
    """All category paths of menu trees, at most ``width`` levels each.

    The menu walk enters every descendant at each level, so a node yields one path per
    sub-sequence of its ancestors followed by itself (C, A/C, B/C, A/B/C). Only the first ``width``
    levels are recorded; of sub-sequences that agree in them one path is kept. Nodes are unique per
    ``scope`` (a page, say), and trees of different scopes don't touch.
    """
    scope = list(scope)
    lines = ancestor_lines(nodes, scope, node, parent, name)
    placed = nodes.join(lines.withColumnRenamed("_parent", parent), [*scope, parent], "left")
    above = f"""aggregate(coalesce(_line, cast(array() as array<string>)), array(cast(array() as array<string>)),
        (found, level) -> concat(found, transform(filter(found, p -> size(p) < {width}), p -> array_append(p, level))))"""
    own = f"explode(transform({above}, p -> if(size(p) < {width}, array_append(p, `{name}`), p))) AS path"
    levels = [f"get(path, {i}) AS taxo{i + 1}" for i in range(width)]
    return placed.selectExpr(*nodes.columns, own).selectExpr(*nodes.columns, *levels, "path")
