"""Joins of categories and pages, sitemap files, rules as tables, and state kept over batches."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from shelfwatch.checks import category_checks as CC
from shelfwatch.checks import cohort_checks
from shelfwatch.checks.class_checks import MEN, WOMEN
from shelfwatch.checks.registry import ORACLES, class_sql, query, ranks_sql, text
from shelfwatch.checks.views import DUCK, LISTING_SQL, SPARK, listing, table
from shelfwatch.config import classes
from shelfwatch.config import ladders as L
from shelfwatch.operators.rule_tables import classify_by_table, rule_table
from shelfwatch.plans import categories as C
from shelfwatch.plans import cohort
from shelfwatch.plans import collect as plan
from shelfwatch.session import scratch_dir
from shelfwatch.sources import payloads, sitemaps
from shelfwatch.streaming import owners

# --- categories and pages -----------------------------------------------------------------------

# Every order is a page of its customer's category; one category has every third page besides its
# own, and some pages belong to no category.
_PAGE_KEY = "case when o_orderkey % 3 = 0 then 1 when o_orderkey % 50 = 7 then -1 else o_custkey end"


def _page_url(dialect: str) -> str:
    href = CC.joined("asos", dialect)
    cut = "substring_index({0}, '&', 1)" if dialect == SPARK else "split_part({0}, '&', 1)"
    return f"case when c_custkey < 0 then 'https://www.asos.com/none' else {cut.format(href)} end"


_ASOS = f"asos AS ({ORACLES['asos_categories']})"
_PAGES = (
    f"bare AS (SELECT o_orderkey, {_page_url(DUCK)} AS url FROM (SELECT o_orderkey, {_PAGE_KEY} AS c_custkey FROM orders))"
)
_LISTED = "listed AS (SELECT DISTINCT upper(shop) AS shop, taxo1, taxo2, taxo3, url FROM asos)"
_LEVELS = "list_filter([taxo1, taxo2, taxo3], lambda x: x IS NOT NULL)"


def _category_pages(spark, sf):
    body = F.format_string(
        '{"itemCount":1,"products":[{"id":"%d","productCode":"c","name":"n","price":{"current":{"value":1.5}},"url":"p/%d"}]}',
        F.col("o_orderkey"), F.col("o_orderkey"),
    )
    pages = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_PAGE_KEY} AS c_custkey").select(
        F.lit("ASOS").alias("shop"), F.expr(_page_url(SPARK)).alias("url"), F.lit(None).cast("string").alias("leaf"),
        F.lit(0).cast("long").alias("link_pos"), F.col("o_orderkey").cast("long").alias("page_seq"), body.alias("body"),
        F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("captured_at"),
    )
    return C.asos(CC.links(spark, sf, "asos", "href")).withColumn("shop", F.upper("shop")), pages


@query(
    "collect_from_categories",
    f"""SELECT l.shop, cast(o_orderkey AS VARCHAR) AS id, ({_LEVELS})[1] AS taxo1, ({_LEVELS})[2] AS taxo2, ({_LEVELS})[3] AS taxo3,
          cast(NULL AS VARCHAR) AS taxo4, l.url, 'https://www.asos.com/p/' || o_orderkey AS product_url
        FROM bare JOIN listed l ON bare.url = l.url""",
    (CC.source("asos"), _ASOS, _LISTED, _PAGES),
)
def collect_from_categories(spark, sf):
    captures, _ = plan.captures_of(*_category_pages(spark, sf))
    good = payloads.with_levels(payloads.good_rows(payloads.flatten(captures)))
    return good.select("shop", "id", "taxo1", "taxo2", "taxo3", "taxo4", "url", "product_url")


@query(
    "category_gaps",
    f"""SELECT 'MEDIUM' AS level, 'ASOS' AS shop, {text(plan.NO_CATEGORY)} AS message, url
          FROM (SELECT DISTINCT url FROM bare) WHERE url NOT IN (SELECT url FROM listed)
        UNION ALL SELECT 'MEDIUM', 'ASOS', {text(plan.NO_PAGE)}, url FROM (SELECT DISTINCT url FROM listed) WHERE url NOT IN (SELECT url FROM bare)""",
    (CC.source("asos"), _ASOS, _LISTED, _PAGES),
)
def category_gaps(spark, sf):
    return plan.captures_of(*_category_pages(spark, sf))[1].drop("ts")


# --- sitemap files --------------------------------------------------------------------------------


@query(
    "sitemap_two_levels",
    "SELECT 'Category-en-GBP-' || (page_id // 100) || '.xml' AS file, url AS loc FROM pages WHERE page_id // 100 = (SELECT min(page_id // 100) FROM pages)",
)
def sitemap_two_levels(spark, sf):
    """An index of one sitemap per 100 pages, its first category one wanted; odd files are cut short, every entry on a line of its own or not."""
    root = scratch_dir(spark, "sitemaps")
    pages = table(spark, sf, "pages").selectExpr("page_id", "url", "page_id div 100 as block")
    name = F.format_string("Category-en-GBP-%d.xml", "block")
    loc = F.concat(F.lit("<url><loc>\n "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc><image:image><image:loc>i</image:loc></image:image></url>"))
    glue = F.when(F.col("page_id") % 2 == 0, "\n").otherwise("")
    blocks = pages.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("page_id", F.concat(loc, glue).alias("e")))).alias("es"))
    head = F.lit('<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="http://i">')
    body = F.concat(head, F.array_join("es.e", ""), F.when(F.col("block") % 2 == 0, "</urlset>\n").otherwise(""))
    blocks.select(name.alias("name"), body.alias("value")).write.partitionBy("name").text(f"{root}/files")
    entry = F.format_string("<sitemap><loc>https://shop.example/maps/%s</loc></sitemap>", name)
    listed = blocks.select("block", entry.alias("e")).union(spark.range(1).select(F.lit(-1).cast("long"), F.lit("<sitemap><loc>https://shop.example/maps/Product.xml</loc></sitemap>")))
    index = listed.agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", "e")))["e"], "\n").alias("es"))
    index.select(F.concat(F.lit("<sitemapindex>"), "es", F.lit("</sitemapindex>"))).write.text(f"{root}/index")
    entries, _ = sitemaps.two_levels(spark, f"{root}/index", f"{root}/files", C.TKMAXX_SITEMAP)
    return entries.select(F.regexp_extract("file", "(Category[^/]*)", 1).alias("file"), "loc")


# --- rules as tables ------------------------------------------------------------------------------

_WITH_LEVELS = {"men": MEN, "women": WOMEN, "primark_women": classes.PRIMARK_WOMEN, "hm_men": classes.HM_MEN}


@query(
    "classify_by_table",
    "SELECT seq, " + ", ".join(f"{class_sql(r)} AS {n}" for n, r in _WITH_LEVELS.items()) + " FROM listing",
    (LISTING_SQL,),
)
def classify_by_table_(spark, sf):
    rows = listing(spark, sf).select("seq", "name", "taxo2", "taxo3")
    for column, rules in _WITH_LEVELS.items():
        rows = classify_by_table(rows, rule_table(spark, rules), out=column)
    return rows.drop("name", "taxo2", "taxo3")


# --- state over batches ---------------------------------------------------------------------------


@query("cohort_incremental", ORACLES["cohort_new_old"])
def cohort_incremental(spark, sf):
    """Three batches: the first weeks without some late rows, the last days, and then the late rows of all days."""
    path = scratch_dir(spark, "cohort")
    rows = cohort_checks.stocked(spark, sf)
    late, last = F.col("seq") % 40 == 7, F.col("d") >= F.lit(datetime.date(2024, 1, 20))
    for name, part in (("base", rows.where(~late & ~last)), ("days", rows.where(~late & last)), ("late", rows.where(late))):
        cohort.merge_days(part, path, name)
    return cohort.stored_counts(spark, path, datetime.date.max)


_OWNED = "shop, id, cast(date AS DATE)"


@query(
    "owners_across_batches",
    f"""SELECT shop, id, day, taxo1, taxo2, taxo3, taxo4, url, link_pos, seq FROM (SELECT *, row_number() OVER (PARTITION BY {_OWNED}
          ORDER BY {ranks_sql({'GAP': L.CATEGORY_LADDERS['GAP']})}, taxo1 NULLS LAST, taxo2 NULLS LAST, taxo3 NULLS LAST, taxo4 NULLS LAST, url, link_pos DESC, seq) AS n
        FROM (SELECT shop, id, date, cast(date AS DATE) AS day, taxo1, taxo2, taxo3, taxo4, concat('/c/', cast(page % 5 as string)) AS url, seq % 4 AS link_pos, seq FROM listing))
        WHERE n = 1""",
    (LISTING_SQL,),
)
def owners_across_batches(spark, sf):
    """Three micro-batches, each with listings of every day."""
    root = scratch_dir(spark, "owners")
    rows = listing(spark, sf).selectExpr(
        "shop", "id", "taxo1", "taxo2", "taxo3", "taxo4", "concat('/c/', cast(page % 5 as string)) AS url",
        "seq % 4 AS link_pos", "seq", "cast(date as date) AS day",
    )
    for i in range(3):
        rows.where(F.col("seq") % 3 == i).coalesce(1).write.mode("append").parquet(f"{root}/inbox")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/inbox")
    ladders = {"GAP": L.CATEGORY_LADDERS["GAP"]}
    owners.own_new(stream, f"{root}/owners", f"{root}/state", ladders).awaitTermination()
    return owners.owners(spark, f"{root}/owners")
