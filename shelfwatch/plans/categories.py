"""Category lists per shop: stored pages, sitemaps and menus to (shop, taxo1..4, url, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.config.ladders import CATEGORY_LADDERS
from shelfwatch.functions.conditions import member, not_member
from shelfwatch.functions.levels import code_levels, fallback_level, pick, url_levels
from shelfwatch.operators.dedup import keep_first, with_rank
from shelfwatch.operators.lookup import tree_paths
from shelfwatch.operators.prune import drop_covered, drop_prefix_of_next
from shelfwatch.schema import TAXO
from shelfwatch.sources.payloads import find_key, text_at

# --- fixed values ---------------------------------------------------------------------------

ASOS_HOME = "https://www.asos.com/"
ASOS_DENIED_LINKS = (
    "View all", "Face + Body", "New in", "Back in stock", "Body care", "Fragrances", "Hair care",
    "Makeup", "Shaving & Beard", "Skin care", "Living + Gifts", "Bestsellers", "Gifts",
    "New in: Clothing", "New in: Shoes & Accessories", "Trending now",
)
GAP_HOME = "https://www.gap.co.uk/gap/"
GAP_ROOTS = ("gap/men", "gap/women", "gap/boys", "gap/girls")
HM_HOME = "https://www2.hm.com/en_gb/"
HM_ROOTS = ("/men/shop-by-product/", "/ladies/shop-by-product/", "/kids/shop-by-product/")
JOHN_LEWIS_HOME = "https://www.johnlewis.com/"
JOHN_LEWIS_ROOTS = ("/browse/men/", "/browse/women/", "/browse/baby-child/")
MS_HOME = "https://www.marksandspencer.com/"
MS_ROOTS = ("/l/men/", "/l/women/", "/l/kids/", "/l/lingerie/")
NEWLOOK_ROOTS = ("womens", "mens", "teens")
NEWLOOK_LEVEL2 = (
    "accessories", "clothing", "footwear", "bagsaccessories", "backtoschool", "essentials",
    "curves", "goingout", "maternity", "petite", "tall",
)
NEWLOOK_DENIED_LEVEL3 = ("collections", "collection", "image", "new", "newin", "oc")
PRIMARK_ROOTS = ("men", "women", "kids")
TKMAXX_HOME = "https://www.tkmaxx.com/uk/en/"
TKMAXX_SITEMAP = "Category-en-GBP"
TKMAXX_DENIED_LEVEL2 = (
    "beauty", "formal-wear", "biggest-savings", "last-chance", "big-brand-delivery", "leather-shop",
)
ZARA_ROOTS = ("WOMAN", "MAN", "KIDS")


def _any(make, values) -> Column:
    out = F.lit(False)
    for v in values:
        out = out | F.coalesce(make(v), F.lit(False))
    return out


def has_any(col: Column, values) -> Column:
    return _any(lambda v: F.contains(col, F.lit(v)), values)


def starts_any(col: Column, values) -> Column:
    return _any(lambda v: F.startswith(col, F.lit(v)), values)


def categories(
    df: DataFrame, levels: list[Column], url: Column, seq: str = "seq", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The common layout; missing levels are null."""
    levels = levels + [F.lit(None).cast("string")] * (4 - len(levels))
    return df.select("shop", *keep, *[c.alias(n) for c, n in zip(levels, TAXO)], url.alias("url"), F.col(seq).alias("seq"))


def asos(links: DataFrame) -> DataFrame:
    """``links``: (shop, href, text, seq) of the product sections of the home page."""
    kept = links.where(not_member(F.col("text"), ASOS_DENIED_LINKS)).withColumn(
        "href", F.substring_index("href", "&", 1)
    )
    return categories(kept, url_levels(F.col("href"), (0, 1), ASOS_HOME) + [F.col("text")], F.col("href"))


def gap(locs: DataFrame) -> DataFrame:
    """``locs``: (shop, loc, seq). Leaf categories with their visiting rank."""
    kept = locs.where(has_any(F.col("loc"), GAP_ROOTS))
    leaves = drop_covered(categories(kept, url_levels(F.col("loc"), range(4), GAP_HOME), F.col("loc")))
    return with_rank(leaves, CATEGORY_LADDERS)


def hm(locs: DataFrame) -> DataFrame:
    loc = F.col("loc")
    kept = locs.where(has_any(loc, HM_ROOTS) & F.endswith(loc, F.lit(".html")) & ~F.contains(loc, F.lit("view-all")))
    leaves = drop_prefix_of_next(kept, url="loc")
    stem = F.expr("left(loc, length(loc) - 5)")
    return categories(leaves, url_levels(stem, (0, 2, 3), HM_HOME), loc)


def john_lewis(links: DataFrame) -> DataFrame:
    kept = links.where(starts_any(F.col("href"), JOHN_LEWIS_ROOTS))
    listed = categories(
        kept, url_levels(F.col("href"), (2, 3, 4), drop="_"), F.concat(F.lit(JOHN_LEWIS_HOME), "href")
    )
    return distinct_categories(listed)


def ms(links: DataFrame) -> DataFrame:
    kept = links.where(
        starts_any(F.col("href"), MS_ROOTS) & ~F.contains(F.col("href"), F.lit("new-in"))
    ).withColumn("href", F.substring_index("href", "?", 1))
    return distinct_categories(categories(kept, url_levels(F.col("href"), (2, 3, 4)), F.concat(F.lit(MS_HOME), "href")))


def newlook(menus: DataFrame) -> DataFrame:
    """``menus``: (shop, body, seq) with the stored menu JSON."""
    link = F.try_parse_json("_link")
    found = (
        menus.select("shop", "seq", F.posexplode(find_key(F.col("body"), "link")).alias("pos", "_link"))
        .select("shop", F.struct("seq", "pos").alias("seq"), text_at(link, "$.trackerCode").alias("code"),
                text_at(link, "$.url").alias("path"))
        .where(F.col("code").isNotNull() & F.col("path").isNotNull())
    )
    levels = code_levels(F.col("code"))
    listed = found.withColumns({f"_l{i}": c for i, c in enumerate(levels)}).where(
        member(F.col("_l0"), NEWLOOK_ROOTS) & member(F.col("_l1"), NEWLOOK_LEVEL2)
    )
    listed = listed.withColumn("_l2", fallback_level(F.col("_l2"), F.col("_l3"))).where(
        not_member(F.col("_l2"), NEWLOOK_DENIED_LEVEL3)
    )
    return categories(listed, [F.col(f"_l{i}") for i in range(4)], F.col("path"))


def primark(menu: DataFrame) -> DataFrame:
    """``menu``: (shop, category, seq), the comma code of each menu entry."""
    listed = categories(menu, pick(F.split("category", ","), range(3)), F.col("category"))
    return distinct_categories(listed).where(member(F.col("taxo1"), PRIMARK_ROOTS))


def zara(nodes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``nodes``: (shop, page, node, parent, name, url, seq) of the menus; nodes are numbered per page.

    ``page`` may be absent if there is one menu per shop. ``keep`` names further columns to carry.
    """
    scope = [c for c in ("shop", "page") if c in nodes.columns]
    paths = tree_paths(nodes, scope=scope).where(member(F.col("taxo1"), ZARA_ROOTS))
    named = paths.withColumn("taxo2", F.coalesce("taxo2", F.lit("None")))
    ranked = with_rank(named, CATEGORY_LADDERS, "_rank")
    first = keep_first(ranked, [*scope, "url"], ["_rank", *TAXO, "seq"])
    return categories(first, [F.col(c) for c in TAXO], F.col("url"), keep=keep)


def tkmaxx(locs: DataFrame) -> DataFrame:
    levels = url_levels(F.col("loc"), range(4), TKMAXX_HOME, drop_last=2)
    listed = categories(locs, levels, F.col("loc"))
    level1, level2 = F.lower("taxo1"), F.lower("taxo2")
    vague = starts_any(level2, ("new-in-", "gold-label-", "mod-box-")) | F.endswith(level2, F.lit("-holiday-shop"))
    return listed.where(
        has_any(level1, ("men", "women", "kids"))
        & F.col("taxo2").isNotNull()
        & ~vague
        & not_member(F.col("taxo2"), TKMAXX_DENIED_LEVEL2)
        & (level2 != "fragrance+grooming")
    )


def distinct_categories(listed: DataFrame) -> DataFrame:
    """Distinct rows, each with its first place in the list."""
    return listed.groupBy("shop", *TAXO, "url").agg(F.min("seq").alias("seq"))
