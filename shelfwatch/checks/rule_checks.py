"""Conditions, ranking and keep-first queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwatch.checks.registry import ladder_sql, query, ranks_sql, rules_sql
from shelfwatch.checks.views import LISTING_SQL, listing, table
from shelfwatch.config import ladders as L
from shelfwatch.functions.conditions import IS_NUMBER, Test, is_number, matches, member, not_member
from shelfwatch.operators import dedup
from shelfwatch.operators.quality import duplicates
from shelfwatch.plans.aggregate import with_needed_name
from shelfwatch.plans.categories import distinct_categories

RULE_SETS = {
    "asos_clear": L.ASOS_CLEAR,
    "asos_vague": L.ASOS_VAGUE,
    "asos_banner": L.ASOS_BANNER,
    "hm_special": L.HM_SPECIAL,
    "hm_broad": L.HM_BROAD,
    "newlook_vague": L.NEWLOOK_VAGUE,
    "newlook_root": L.NEWLOOK_ROOT,
    "zara_campaign": L.ZARA_CAMPAIGN,
    "zara_view_all": L.ZARA_VIEW_ALL,
    "zara_category": L.ZARA_CATEGORY,
    "tkmaxx_vague": L.TKMAXX_VAGUE,
    "gap_sale": L.GAP_SALE,
    "gap_new": L.GAP_NEW,
    # a number test settles the answer; what follows it is not looked at
    "number_first": (Test("taxo2", "EQUAL", ("c",)), Test("taxo3", IS_NUMBER), Test("taxo1", "EQUAL", ("men",))),
}


@query(
    "rule_predicate",
    "SELECT seq, " + ", ".join(f"{rules_sql(r)} AS {n}" for n, r in RULE_SETS.items()) + " FROM listing",
    (LISTING_SQL,),
)
def rule_predicate(spark, sf):
    return listing(spark, sf).select("seq", *[matches(r).alias(n) for n, r in RULE_SETS.items()])


_NUMBER_TEXT = "CASE WHEN l_linenumber = 1 THEN cast(l_partkey as string) WHEN l_linenumber = 2 THEN cast(l_tax as string) WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 4 THEN concat('-', cast(l_partkey as string)) WHEN l_linenumber = 5 THEN l_returnflag ELSE cast(l_suppkey as string) END"


@query(
    "rule_number",
    f"SELECT l_orderkey, l_linenumber, code, regexp_full_match(code, '[0-9]+') AS is_number FROM (SELECT l_orderkey, l_linenumber, {_NUMBER_TEXT} AS code FROM lineitem)",
)
def rule_number(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .selectExpr("l_orderkey", "l_linenumber", f"{_NUMBER_TEXT} AS code")
        .withColumn("is_number", is_number(F.col("code")))
    )


@query("priority_rank", f"SELECT seq, shop, {ranks_sql(L.PRODUCT_LADDERS)} AS rank FROM listing", (LISTING_SQL,))
def priority_rank(spark, sf):
    return dedup.with_rank(listing(spark, sf), L.PRODUCT_LADDERS).select("seq", "shop", "rank")


@query(
    "category_rank",
    f"SELECT seq, {ladder_sql(L.CATEGORY_LADDERS['GAP'])} AS gap_rank, {ladder_sql(L.CATEGORY_LADDERS['ZARA'])} AS zara_rank FROM listing",
    (LISTING_SQL,),
)
def category_rank(spark, sf):
    from shelfwatch.functions.conditions import rank_of

    ranks = {n: rank_of(L.CATEGORY_LADDERS[s]) for n, s in (("gap_rank", "GAP"), ("zara_rank", "ZARA"))}
    return listing(spark, sf).select("seq", *[c.alias(n) for n, c in ranks.items()])


DEDUP_SHOPS = ("ASOS", "NEWLOOK", "TKMAXX", "ZARA")
PLAIN_SHOPS = ("GAP", "JOHN_LEWIS", "MS", "PRIMARK")
_LEVELS = "taxo1 NULLS LAST, taxo2 NULLS LAST, taxo3 NULLS LAST"
_FIRST = "SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM {src} WHERE {where}) WHERE n = 1"
_OUT = ("shop", "id", "reference", "name", "taxo1", "taxo2", "taxo3", "taxo4", "seq")


@query(
    "priority_dedup",
    _FIRST.format(
        cols=", ".join(_OUT), keys="shop, id, reference, name", src="listing",
        order=f"{ranks_sql(L.PRODUCT_LADDERS)}, {_LEVELS}, taxo4 NULLS LAST, seq", where=f"shop IN {DEDUP_SHOPS}",
    ),
    (LISTING_SQL,),
)
def priority_dedup(spark, sf):
    rows = listing(spark, sf).where(F.col("shop").isin(list(DEDUP_SHOPS)))
    return dedup.priority_dedup(rows.select(*_OUT), L.PRODUCT_LADDERS)


@query(
    "default_dedup",
    _FIRST.format(
        cols=", ".join(_OUT), keys="shop, id, reference, name", order=f"{_LEVELS}, seq", src="listing",
        where=f"shop IN {PLAIN_SHOPS}",
    ),
    (LISTING_SQL,),
)
def default_dedup(spark, sf):
    rows = listing(spark, sf).where(F.col("shop").isin(list(PLAIN_SHOPS)))
    return dedup.default_dedup(rows.select(*_OUT))


@query(
    "first_per_key",
    _FIRST.format(
        cols="l_partkey, l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate", keys="l_partkey", src="lineitem",
        order="l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice, l_quantity", where="true",
    ),
)
def first_per_key(spark, sf):
    cols = ["l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    return dedup.keep_first(
        table(spark, sf, "lineitem").select(*cols),
        ["l_partkey"],
        ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"],
    )


@query(
    "distinct_rows",
    "SELECT shop, taxo1, taxo2, taxo3, taxo4, URL AS url, min(seq) AS seq FROM listing GROUP BY ALL",
    (LISTING_SQL,),
)
def distinct_rows(spark, sf):
    rows = listing(spark, sf).select("shop", "taxo1", "taxo2", "taxo3", "taxo4", F.col("URL").alias("url"), "seq")
    return distinct_categories(rows)


@query(
    "first_category_wins",
    _FIRST.format(
        cols="shop, id, taxo1, taxo2, taxo3, taxo4, url, link_pos, seq", keys="shop, id",
        src="(SELECT shop, id, taxo1, taxo2, taxo3, taxo4, concat('/c/', cast(page % 5 as string)) AS url, seq % 4 AS link_pos, seq FROM listing)",
        order=f"{ranks_sql({'GAP': L.CATEGORY_LADDERS['GAP']})}, {_LEVELS}, taxo4 NULLS LAST, url, link_pos DESC, seq",
        where="true",
    ),
    (LISTING_SQL,),
)
def first_category_wins(spark, sf):
    rows = listing(spark, sf).selectExpr(
        "shop", "id", "taxo1", "taxo2", "taxo3", "taxo4", "concat('/c/', cast(page % 5 as string)) AS url",
        "seq % 4 AS link_pos", "seq",
    )
    return dedup.first_category_wins(rows, {"GAP": L.CATEGORY_LADDERS["GAP"]})


@query(
    "dup_check",
    "SELECT shop, id, cast(date AS DATE) AS date, count(*) AS n FROM listing GROUP BY ALL HAVING count(*) > 1",
    (LISTING_SQL,),
)
def dup_check(spark, sf):
    return duplicates(listing(spark, sf).select("shop", "id", F.col("date").cast("date").alias("date")))


@query(
    "not_null",
    "SELECT seq, shop, name FROM listing WHERE name IS NOT NULL OR shop NOT IN ('PRIMARK', 'ZARA')",
    (LISTING_SQL,),
)
def not_null(spark, sf):
    return with_needed_name(listing(spark, sf).withColumn("src_shop", F.col("shop"))).select("seq", "shop", "name")


_ROOTS = ("women", "men", "kids")
_DENIED = ("sale", "homeware", "clearance")


@query("membership", f"SELECT seq, taxo1 FROM listing WHERE taxo1 IN {_ROOTS}", (LISTING_SQL,))
def membership(spark, sf):
    return listing(spark, sf).select("seq", "taxo1").where(member(F.col("taxo1"), _ROOTS))


@query(
    "anti_membership",
    f"SELECT seq, taxo1 FROM listing WHERE taxo1 NOT IN {_DENIED} OR taxo1 IS NULL",
    (LISTING_SQL,),
)
def anti_membership(spark, sf):
    return listing(spark, sf).select("seq", "taxo1").where(not_member(F.col("taxo1"), _DENIED))


@query(
    "union_by_name",
    """SELECT shop, id, taxo1, taxo2, taxo3, URL, cast(NULL AS VARCHAR) AS url_old FROM listing WHERE seq % 2 = 0
       UNION ALL SELECT shop, id, taxo1, NULL, NULL, NULL, url_old FROM listing WHERE seq % 2 = 1""",
    (LISTING_SQL,),
)
def union_by_name(spark, sf):
    rows = listing(spark, sf)
    newer = rows.where("seq % 2 = 0").select("shop", "id", "taxo1", "taxo2", "taxo3", "URL")
    older = rows.where("seq % 2 = 1").select("url_old", "taxo1", "id", "shop")
    return newer.unionByName(older, allowMissingColumns=True)
