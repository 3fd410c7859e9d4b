"""Classification and shop pipelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.checks.registry import PARENT_SQL, class_sql, query, text
from shelfwatch.checks.views import LISTING_SQL, listing
from shelfwatch.config import classes as C
from shelfwatch.config.shops import AGGREGATED
from shelfwatch.functions.levels import below_root, map_values, shift_levels
from shelfwatch.operators.classify import class_of, parent_of, with_name_lc
from shelfwatch.plans.aggregate import clean_shops, link, unit_price

MEN, WOMEN = C.men_words(), C.women_words()


@query(
    "classify_keywords",
    f"SELECT seq, name, {class_sql(MEN)} AS men_class, {class_sql(WOMEN)} AS women_class FROM listing",
    (LISTING_SQL,),
)
def classify_keywords(spark, sf):
    return with_name_lc(listing(spark, sf)).select(
        "seq", "name", class_of(MEN).alias("men_class"), class_of(WOMEN).alias("women_class")
    )


_EXACT = {
    "asos_men": C.ASOS_MEN, "asos_women": C.ASOS_WOMEN, "hm_men": C.HM_MEN, "hm_women": C.HM_WOMEN,
    "primark_men": C.PRIMARK_MEN,
}


@query(
    "classify_exact",
    "SELECT seq, " + ", ".join(f"{class_sql(r)} AS {n}" for n, r in _EXACT.items()) + " FROM listing",
    (LISTING_SQL,),
)
def classify_exact(spark, sf):
    return with_name_lc(listing(spark, sf)).select("seq", *[class_of(r).alias(n) for n, r in _EXACT.items()])


@query(
    "classify_mixed",
    f"SELECT seq, name, taxo2, {class_sql(C.PRIMARK_WOMEN)} AS women_class FROM listing",
    (LISTING_SQL,),
)
def classify_mixed(spark, sf):
    return with_name_lc(listing(spark, sf)).select(
        "seq", "name", "taxo2", class_of(C.PRIMARK_WOMEN).alias("women_class")
    )


@query(
    "parent_class",
    f"SELECT seq, label, {PARENT_SQL.format('label')} AS parent FROM (SELECT seq, {class_sql(WOMEN)} AS label FROM listing)",
    (LISTING_SQL,),
)
def parent_class(spark, sf):
    return (
        with_name_lc(listing(spark, sf))
        .select("seq", class_of(WOMEN).alias("label"))
        .withColumn("parent", parent_of(F.col("label")))
    )


def _gender_sql(genders: dict[str, str], col: str = "taxo1") -> str:
    if not genders:
        return col
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in genders.items())
    return f"CASE {col} {whens} ELSE {col} END"


@query(
    "gender_map",
    "SELECT seq, " + ", ".join(f"{_gender_sql(s.genders)} AS {s.name.lower()}" for s in AGGREGATED) + " FROM listing",
    (LISTING_SQL,),
)
def gender_map(spark, sf):
    return listing(spark, sf).select(
        "seq", *[map_values(F.col("taxo1"), s.genders).alias(s.name.lower()) for s in AGGREGATED]
    )


@query(
    "level_shift",
    """SELECT seq, taxo2 AS taxo1, taxo3 AS taxo2, NULL::VARCHAR AS taxo3 FROM listing WHERE taxo1 = 'gap'
       UNION ALL SELECT seq, taxo1, taxo2, taxo3 FROM listing WHERE taxo1 IS DISTINCT FROM 'gap'""",
    (LISTING_SQL,),
)
def level_shift(spark, sf):
    return shift_levels(listing(spark, sf).select("seq", "taxo1", "taxo2", "taxo3"), below_root("gap"))


@query(
    "url_coalesce",
    "SELECT seq, CASE WHEN url_old IS NULL THEN URL ELSE url_old END AS url FROM listing",
    (LISTING_SQL,),
)
def url_coalesce(spark, sf):
    return listing(spark, sf).select("seq", link().alias("url"))


@query(
    "price_units",
    "SELECT seq, shop, CASE WHEN shop IN ('PRIMARK', 'ZARA') THEN price / 100 ELSE price END AS price FROM listing",
    (LISTING_SQL,),
)
def price_units(spark, sf):
    rows = listing(spark, sf).withColumn("src_shop", F.col("shop"))
    return rows.select("seq", "shop", unit_price().alias("price"))


def clean_sql(shop) -> str:
    """One shop's rows, step by step, gender halves apart: a form of its own, not the CASE plan."""
    src = f"(SELECT * FROM listing WHERE shop = {text(shop.name)})"
    if shop.shift_root:
        root = text(shop.shift_root)
        src = (
            f"(SELECT * REPLACE (taxo2 AS taxo1, taxo3 AS taxo2, cast(NULL AS VARCHAR) AS taxo3) FROM {src} WHERE taxo1 = {root} "
            f"UNION ALL SELECT * FROM {src} WHERE taxo1 IS DISTINCT FROM {root})"
        )
    src = f"(SELECT * REPLACE ({_gender_sql(shop.genders)} AS taxo1) FROM {src})"
    keep = "true"
    if shop.needs_name:
        keep += " AND name IS NOT NULL"
    price = f"price / {shop.price_divisor}" if shop.price_divisor != 1 else "price"
    halves = " UNION ALL ".join(
        f"SELECT *, {class_sql(rules)} AS label FROM {src} WHERE taxo1 = {text(g)} AND {keep}"
        for g, rules in (("MAN", shop.men), ("WOMAN", shop.women))
    )
    return (
        f"SELECT shop, id, reference, name, {price} AS price, inStock, taxo1, {PARENT_SQL.format('label')} AS taxo2, "
        f"label AS taxo3, taxo4, coalesce(url_old, URL) AS URL, date FROM ({halves})"
    )


@query("clean_shop", " UNION ALL ".join(f"({clean_sql(s)})" for s in AGGREGATED), (LISTING_SQL,))
def clean_shop(spark, sf):
    """Each shop by itself, as the jobs run when one of them fails."""
    rows = listing(spark, sf).withColumn("src_shop", F.col("shop"))
    return reduce(DataFrame.unionAll, [clean_shops(rows, [s]).drop("seq") for s in AGGREGATED])


@query("aggregate_all", " UNION ALL ".join(f"({clean_sql(s)})" for s in AGGREGATED), (LISTING_SQL,))
def aggregate_all(spark, sf):
    return clean_shops(listing(spark, sf).withColumn("src_shop", F.col("shop"))).drop("seq")
