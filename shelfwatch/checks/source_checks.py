"""Stored bodies, pages, files and trees."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwatch.checks import views as V
from shelfwatch.checks.class_checks import clean_sql
from shelfwatch.checks.cohort_checks import STOCKED, VIEWS as COHORT_VIEWS
from shelfwatch.checks.registry import ORACLES, ladder_sql, query, text
from shelfwatch.checks.views import LISTING_SQL, captures, listing, table
from shelfwatch.config import ladders as L
from shelfwatch.config.shops import AGGREGATED
from shelfwatch.operators.dedup import keep_first
from shelfwatch.operators.lookup import lookup_with_fallback, tree_paths
from shelfwatch.operators.quality import log_counts
from shelfwatch.functions.conditions import by_shop
from shelfwatch.plans import aggregate, categories, cohort
from shelfwatch.plans import collect as plan
from shelfwatch.schema import SHOPS
from shelfwatch.session import scratch_dir
from shelfwatch.sources import pages as P
from shelfwatch.sources import payloads, sitemaps, snapshots, tables

# --- captures ---------------------------------------------------------------------------------

JSON_SHOPS = tuple(payloads.PAYLOADS)
NUMBERED = (
    "numbered AS (SELECT *, row_number() OVER (PARTITION BY shop, page ORDER BY seq) - 1 AS pos, "
    + ", ".join(f"{e} AS {n}" for n, e in V.capture_columns(V.DUCK).items() if n != "url")
    + f", {V.capture_columns(V.DUCK)['url']} AS capture_url FROM listing)"
)
NAME = V.SAFE_NAME
NO_PRICE = "(shop = 'ZARA' AND seq % 2 = 1 AND seq % 11 = 0)"
SHORT = "list_filter([c1, c2, c3], lambda x: x IS NOT NULL) || [leaf]"
FIELDS = f"""
  shop, id,
  CASE shop WHEN 'ASOS' THEN 'c' || id WHEN 'GAP' THEN 'u-' || id WHEN 'PRIMARK' THEN 'k' || id WHEN 'ZARA' THEN 'r' || id END AS reference,
  CASE shop WHEN 'ASOS' THEN CASE WHEN seq % 2 = 0 THEN {NAME} ELSE 'n ' || {NAME} END
    WHEN 'ZARA' THEN CASE WHEN seq % 2 = 0 THEN {NAME} ELSE 'set ' || {NAME} END
    WHEN 'JOHN_LEWIS' THEN {NAME} || ' & co' ELSE trim({NAME}) END AS name,
  CASE WHEN shop IN ('PRIMARK', 'ZARA') THEN cast(pence AS DOUBLE)
    WHEN shop = 'GAP' THEN cast(least({V.PRICE_TEXT}, '9.00') AS DOUBLE)
    WHEN shop = 'JOHN_LEWIS' THEN least(cast(pence AS DOUBLE) / 100, 45.0)
    ELSE cast(pence AS DOUBLE) / 100 END AS price,
  CASE WHEN shop IN ('HM', 'TKMAXX', 'NEWLOOK') THEN inStock ELSE true END AS "inStock",
  CASE shop WHEN 'HM' THEN c1 WHEN 'PRIMARK' THEN c1 WHEN 'TKMAXX' THEN (list_filter([c1, c2, c3, c3], lambda x: x IS NOT NULL) || [leaf])[1] ELSE ({SHORT})[1] END AS taxo1,
  CASE shop WHEN 'HM' THEN trim(split_part(split_part({V.TRACKING}, '|', 2), ':', 2)) WHEN 'PRIMARK' THEN c2
    WHEN 'TKMAXX' THEN (list_filter([c1, c2, c3, c3], lambda x: x IS NOT NULL) || [leaf])[2] ELSE ({SHORT})[2] END AS taxo2,
  CASE shop WHEN 'HM' THEN trim(string_split(split_part({V.TRACKING}, '|', 2), ':')[3]) WHEN 'PRIMARK' THEN c3
    WHEN 'TKMAXX' THEN (list_filter([c1, c2, c3, c3], lambda x: x IS NOT NULL) || [leaf])[3] ELSE ({SHORT})[3] END AS taxo3,
  CASE shop WHEN 'HM' THEN NULL WHEN 'PRIMARK' THEN NULL
    WHEN 'TKMAXX' THEN (list_filter([c1, c2, c3, c3], lambda x: x IS NOT NULL) || [leaf])[4] ELSE ({SHORT})[4] END AS taxo4,
  CASE shop WHEN 'ASOS' THEN 'https://www.asos.com/p/' || id WHEN 'NEWLOOK' THEN 'https://www.newlook.com/p/' || id
    WHEN 'HM' THEN 'https://www2.hm.com/p/' || id WHEN 'TKMAXX' THEN 'https://www.tkmaxx.com/uk/p/' || id
    WHEN 'PRIMARK' THEN '' WHEN 'ZARA' THEN '' WHEN 'JOHN_LEWIS' THEN 'https://www.johnlewis.com/p/' || id || '?a=1&b=2'
    WHEN 'MS' THEN 'https://www.marksandspencer.com//shop/p/' || id || '?x=1&y=2' END AS "URL",
  page AS page_seq, pos
"""
VALID = (
    f"valid AS (SELECT {FIELDS}, min(date) OVER (PARTITION BY shop, page) AS date, c1, c2, c3, capture_url, "
    f"(shop = 'HM' AND seq % 50 = 6) AS denied, ({V.NO_ID}) AS no_id, {NO_PRICE} AS no_price, (shop = 'JOHN_LEWIS' AND seq % 13 = 5) AS bad_price "
    f"FROM numbered WHERE NOT ({V.BAD_PAGE}))"
)
GOOD = "good AS (SELECT * FROM valid WHERE NOT no_id AND NOT no_price AND NOT bad_price AND NOT denied)"
CAPTURED = (LISTING_SQL, NUMBERED, VALID, GOOD)
_BASE = 'shop, id, reference, name, price, "inStock", taxo1, taxo2, taxo3, taxo4, "URL", page_seq, pos'


@query(
    "json_flatten",
    f"SELECT {_BASE} FROM good WHERE shop IN {JSON_SHOPS}",
    CAPTURED,
)
def json_flatten(spark, sf):
    good = payloads.with_levels(payloads.good_rows(payloads.flatten(captures(spark, sf))))
    return good.select(
        "shop", "id", "reference", "name", "price", "inStock", "taxo1", "taxo2", "taxo3", "taxo4",
        F.col("product_url").alias("URL"), "page_seq", F.col("pos").cast("bigint").alias("pos"),
    )


REJECT_SQL = f"""SELECT shop, level, message, count(*) AS n FROM (
          SELECT DISTINCT shop, page, 'MEDIUM' AS level, CASE WHEN shop IN {JSON_SHOPS} THEN 'not JSON' ELSE 'no product cards' END AS message
          FROM listing WHERE {V.BAD_PAGE}
        ) GROUP BY ALL
        UNION ALL
        SELECT shop, CASE WHEN no_price THEN 'INFORMATION' ELSE 'MINOR' END,
          CASE WHEN no_price THEN 'no price/name' WHEN bad_price AND NOT no_id THEN 'price is not a number' ELSE 'missing ' || CASE shop WHEN 'NEWLOOK' THEN '$.code' WHEN 'TKMAXX' THEN '$.code'
            WHEN 'PRIMARK' THEN '$.BusinessId' WHEN 'HM' THEN '$.articleCode' WHEN 'MS' THEN 'id' WHEN 'JOHN_LEWIS' THEN 'id' ELSE '$.id' END END, count(*)
        FROM valid WHERE no_id OR no_price OR bad_price GROUP BY ALL"""


@query("reject_log", REJECT_SQL, CAPTURED)
def reject_log(spark, sf):
    _, bad = plan.collect(captures(spark, sf))
    return bad.groupBy("shop", "level", "message").agg(F.count("*").alias("n"))


@query(
    "log_counts",
    f"""SELECT shop, level, count(*) AS n FROM (
          SELECT DISTINCT shop, page, 'MEDIUM' AS level FROM listing WHERE {V.BAD_PAGE}
          UNION ALL SELECT shop, NULL, CASE WHEN no_price THEN 'INFORMATION' ELSE 'MINOR' END FROM valid WHERE no_id OR no_price OR bad_price)
        GROUP BY ALL""",
    CAPTURED,
)
def log_counts_(spark, sf):
    return log_counts(plan.collect(captures(spark, sf))[1])


@query(
    "card_fields",
    "SELECT shop, id, name, price, \"URL\" AS url, page_seq, pos FROM good WHERE shop IN ('JOHN_LEWIS', 'MS')",
    CAPTURED,
)
def card_fields(spark, sf):
    cards = P.product_cards(captures(spark, sf).select("shop", "page_seq", "body"), P.CARDS, "body")
    good = cards.where("id is not null and not bad_price").drop("bad_price")
    return good.withColumn("pos", F.col("pos").cast("bigint"))


_GAP_RANK = ladder_sql(L.CATEGORY_LADDERS["GAP"]).replace("taxo1", "c1").replace("taxo2", "c2").replace("taxo3", "c3")
OWNED = f"""owned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN shop = 'GAP' THEN id ELSE concat(shop, '/', page_seq, '/', pos) END,
    CASE WHEN shop = 'GAP' THEN cast(date AS DATE) END
    ORDER BY {_GAP_RANK}, c1 NULLS LAST, c2 NULLS LAST, c3 NULLS LAST, capture_url, page_seq, pos) AS own FROM good) WHERE own = 1)"""


@query(
    "canonical_record",
    f'SELECT {_BASE.replace(", page_seq, pos", "")}, date FROM owned',
    (*CAPTURED, OWNED),
)
def canonical_record(spark, sf):
    return plan.collect(captures(spark, sf))[0].drop("seq")


_NAMED = "CASE WHEN shop = 'ASOS' THEN coalesce(taxo3, 'None') ELSE taxo3 END"


def _clean_rank() -> str:
    whens = " ".join(f"WHEN shop = {text(s)} THEN {ladder_sql(l)}" for s, l in L.PRODUCT_LADDERS.items())
    return f"CASE {whens} ELSE 0 END"


CLEAN_SQL = f"""SELECT {_BASE.replace(", page_seq, pos", "")}, date FROM (
          SELECT *, row_number() OVER (PARTITION BY cast(date AS DATE), shop, id, reference, name, CASE WHEN shop = 'HM' THEN concat(page_seq, '/', pos) END
            ORDER BY {_clean_rank()}, taxo1 NULLS LAST, taxo2 NULLS LAST, taxo3 NULLS LAST,
              CASE WHEN shop IN ('ASOS', 'HM', 'NEWLOOK', 'TKMAXX', 'ZARA') THEN taxo4 END NULLS LAST, page_seq, pos) AS n
          FROM (SELECT * REPLACE ({_NAMED} AS taxo3) FROM owned)) WHERE n = 1"""


@query("collect_clean", CLEAN_SQL, (*CAPTURED, OWNED))
def collect_clean(spark, sf):
    return plan.clean(plan.collect(captures(spark, sf))[0]).drop("seq")


def _collected(spark, sf) -> str:
    """Folder of the tables that the whole job has written."""
    root = scratch_dir(spark, "collect")
    plan.run(captures(spark, sf), *(f"{root}/{t}" for t in ("raw", "clean", "log")), ledger_path=f"{root}/ledger", run="all")
    return root


@query("collect_job", f"SELECT *, cast(date AS DATE) AS snapshot_date FROM ({CLEAN_SQL})", (*CAPTURED, OWNED))
def collect_job(spark, sf):
    return tables.read_table(spark, f"{_collected(spark, sf)}/clean").drop("seq")


# a start and an end of every shop, besides the rejects
_TIMED_SHOPS = f"unnest([{', '.join(text(s) for s in SHOPS)}]) AS s(shop)"


@query(
    "log_job",
    f"{REJECT_SQL} UNION ALL SELECT shop, 'TIMING', event, 1 FROM {_TIMED_SHOPS}, unnest(['start', 'end']) AS e(event)",
    CAPTURED,
)
def log_job(spark, sf):
    log = tables.read_table(spark, f"{_collected(spark, sf)}/log")
    return log.groupBy("shop", "level", "message").agg(F.count("*").alias("n"))


@query(
    "run_ledger",
    f"""SELECT 'all' AS run, shop, true AS in_order, coalesce(r.n, 0) AS raw_rows, coalesce(c.n, 0) AS clean_rows, coalesce(b.n, 0)::BIGINT AS rejects
        FROM {_TIMED_SHOPS} LEFT JOIN (SELECT shop, count(*) AS n FROM owned GROUP BY shop) r USING (shop)
        LEFT JOIN (SELECT shop, count(*) AS n FROM ({CLEAN_SQL}) GROUP BY shop) c USING (shop)
        LEFT JOIN (SELECT shop, sum(n) AS n FROM ({REJECT_SQL}) GROUP BY shop) b USING (shop)""",
    (*CAPTURED, OWNED),
)
def run_ledger(spark, sf):
    """Start, end and row counts of each shop, taken while the one plan of all shops ran."""
    ledger = tables.read_table(spark, f"{_collected(spark, sf)}/ledger")
    return ledger.select("run", "shop", (F.col("started") <= F.col("ended")).alias("in_order"), "raw_rows", "clean_rows", "rejects")


@query(
    "snapshot_versions",
    """SELECT shop, id, name, price, date, seq, cast(date AS DATE) AS snapshot_date FROM listing
       WHERE shop NOT IN ('ASOS', 'HM') OR (shop = 'HM' AND seq % 2 = 0)""",
    (LISTING_SQL,),
)
def snapshot_versions(spark, sf):
    """All shops; then two of them again, of which one has half its rows and one none; then a run that is never committed."""
    path = f"{scratch_dir(spark, 'versions')}/raw"
    rows = listing(spark, sf).select("shop", "id", "name", "price", "date", "seq")
    scope = rows.select(F.col("date").cast("date").alias("snapshot_date"), "shop").distinct()
    tables.commit_snapshot(tables.stage_snapshot(rows, path, "first"), path, "first", scope)
    again = tables.stage_snapshot(rows.where("shop = 'HM' and seq % 2 = 0"), path, "again")
    tables.commit_snapshot(again, path, "again", scope.where("shop in ('ASOS', 'HM')"))
    tables.stage_snapshot(rows.where("shop = 'MS'"), path, "killed")
    return tables.read_table(spark, path)


# --- snapshot files ---------------------------------------------------------------------------


def landing(spark, listed) -> str:
    """Daily files of the listed rows in three header versions, and raw files to be skipped."""
    root = scratch_dir(spark, "landing")
    cols = list(snapshots.COLUMNS)
    rows = listed.withColumn("src_shop", F.col("shop"))
    day = F.dayofmonth("date")
    newer = rows.where(day % 3 == 0).select(*cols, "src_shop")
    bare = rows.where(day % 3 == 1).select(*[c for c in cols if c != "taxo4"], "src_shop")
    older = rows.where(day % 3 == 2).select(*[c for c in cols if c != "URL"], F.col("url_old").alias("url"), "src_shop")
    for part in (newer, bare, older):
        tables.write_snapshot_csv(part, root)
    tables.write_snapshot_csv(rows.where(day == 1).select(*cols, "src_shop"), root, before_clean=True)
    return root


_DAY = "day(date)"
SCANNED = f"""scanned AS (SELECT shop, shop AS src_shop, id, reference, name, price, "inStock", taxo1, nullif(taxo2, '') AS taxo2,
    nullif(nullif(taxo3, ''), 'nan') AS taxo3, CASE WHEN {_DAY} % 3 <> 1 THEN nullif(nullif(taxo4, ''), 'nan') END AS taxo4,
    CASE WHEN {_DAY} % 3 <> 2 THEN "URL" END AS "URL", CASE WHEN {_DAY} % 3 = 2 THEN url_old END AS url_old, date, seq FROM listing)"""


@query(
    "snapshot_scan",
    'SELECT shop, id, reference, name, price, "inStock", taxo1, taxo2, taxo3, taxo4, "URL", url_old, src_shop, date FROM scanned',
    (LISTING_SQL, SCANNED),
)
def snapshot_scan(spark, sf):
    raw = snapshots.typed_snapshots(snapshots.read_snapshots(spark, landing(spark, listing(spark, sf))))
    return raw.withColumn("date", F.col("date").cast("timestamp_ntz")).drop("seq")


_CLEANED = " UNION ALL ".join(f"({clean_sql(s)})" for s in AGGREGATED)


@query("aggregate_job", _CLEANED.replace("FROM listing", "FROM scanned"), (LISTING_SQL, SCANNED))
def aggregate_job(spark, sf):
    """Snapshot files to the written combined table, read back."""
    out = f"{scratch_dir(spark, 'combined')}/table"
    aggregate.run(spark, landing(spark, listing(spark, sf)), out)
    return tables.read_table(spark, out).withColumn("date", F.col("date").cast("timestamp_ntz")).drop("seq")


# one row per product and day, as rows of a file have no order that SQL could know
_ONCE = "row_number() OVER (PARTITION BY shop, id, cast(date AS DATE) ORDER BY seq) AS once"


@query(
    "cohort_job",
    "SELECT d AS date" + ORACLES["cohort_new_old"].split("SELECT d AS date", 1)[1],  # without its views
    (
        LISTING_SQL,
        SCANNED.replace("FROM listing)", f"FROM (SELECT *, {_ONCE} FROM listing) WHERE once = 1)"),
        f"cleaned AS ({_CLEANED.replace('FROM listing', 'FROM scanned')})",
        STOCKED.replace("seq FROM snap WHERE in_stock", '0 AS seq FROM cleaned WHERE "inStock"'),
        *COHORT_VIEWS[2:],
    ),
)
def cohort_job(spark, sf):
    """Snapshot files to the combined table, and that to the written counts, read back."""
    first = Window.partitionBy("shop", "id", F.col("date").cast("date")).orderBy("seq")
    once = listing(spark, sf).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    root = scratch_dir(spark, "cohorts")
    aggregate.run(spark, landing(spark, once), f"{root}/combined")
    cohort.run(spark, f"{root}/combined", f"{root}/counts", datetime.date.max)
    return spark.read.parquet(f"{root}/counts")


# --- sitemaps and pages -----------------------------------------------------------------------


def _sitemaps(spark, sf):
    """Two bodies per block of 50 pages: a sitemap with image locations, every second one with a namespace, and a broken one."""
    loc = F.concat(F.lit("<url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc>"))
    entry = F.concat(loc, F.lit("<image:image><image:loc>https://img.example/1</image:loc></image:image><x>1</x></url>"))
    spaces = ' xmlns:image="http://www.google.com/schemas/sitemap-image/1.1"'
    opening = F.when(F.col("block") % 2 == 0, f"<urlset{spaces}>").otherwise(
        f'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"{spaces}>'
    )
    blocks = (
        table(spark, sf, "pages")
        .select(F.expr("page_id div 50").alias("block"), "page_id", entry.alias("entry"))
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("page_id", "entry"))).alias("e"))
    )
    good = F.concat(opening, F.array_join("e.entry", ""), F.lit("</urlset>"))
    bodies = F.array(good, F.substring(good, F.lit(1), F.length(good) - 12))
    return blocks.select("block", F.posexplode(bodies).alias("part", "body")).select(
        F.lit("S").alias("shop"), F.concat_ws("/", "block", "part").alias("url"), "block", "body"
    )


@query(
    "sitemap_urls",
    "SELECT page_id // 50 AS block, cast(row_number() OVER (PARTITION BY page_id // 50 ORDER BY page_id) - 1 AS INTEGER) AS pos, url AS loc FROM pages",
)
def sitemap_urls(spark, sf):
    return sitemaps.sitemap_urls(_sitemaps(spark, sf)).select("block", "pos", "loc")


@query(
    "sitemap_rejects",
    "SELECT DISTINCT 'MEDIUM' AS level, 'S' AS shop, 'not a sitemap' AS message, concat(page_id // 50, '/1') AS url FROM pages",
)
def sitemap_rejects(spark, sf):
    return sitemaps.sitemap_rejects(_sitemaps(spark, sf)).drop("ts")


# links in the forms pages have, besides those of the stored pages
_EXTRA_LINKS = (
    "<A HREF=/x class=q>Plain<b>B</b></A><a title=\"a>b\" href='/caf&eacute;/men&#8217;s'>&#x20AC;5 &ndash; Men&rsquo;s &bogus; R&D</a>",
    "<a class=\"n\" href='/c?a=1&amp;b=2'>Shaving &amp; Beard </a><a\nhref=\"/d\"><i>I</i>t</a><a name=\"none\">no link</a>",
)
_LINKS_SQL = f"concat(html, {text(_EXTRA_LINKS[0])}, CASE WHEN page_id % 2 = 0 THEN {text(_EXTRA_LINKS[1])} ELSE '' END)"
_HREF = text(P.attribute_pattern("href"))
_INSIDE = r"""(?:[^>"''=]+|=\s*(?:"[^"]*"|''[^'']*'')?|["''])*"""
_OPEN = rf"regexp_extract(tag, '(?is)^<a\s{_INSIDE}>')"
_LINK_TEXT = rf"nullif(trim(regexp_extract(tag, '(?is)^<a\s{_INSIDE}>([^<]*)', 1), chr(9) || chr(10) || chr(13) || ' '), '')"
_LINK_TAGS = rf"regexp_extract_all({_LINKS_SQL}, '(?is)<a\s{_INSIDE}>.*?</a>')"
# the references that the pages have
_REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&#x27;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&pound;": "£",
    "&#163;": "£", "&eacute;": "é", "&#8217;": "’", "&rsquo;": "’", "&#x20AC;": "€", "&ndash;": "–", "&amp;": "&",
}


def _decoded(sql: str) -> str:
    for reference, plain in _REFERENCES.items():
        sql = f"replace({sql}, {text(reference)}, {text(plain)})"
    return sql


@query(
    "page_links",
    f"""SELECT page_id, cast(i - 1 AS INTEGER) AS pos,
          CASE WHEN regexp_matches({_OPEN}, {_HREF}) THEN {_decoded(" || ".join(f"regexp_extract({_OPEN}, {_HREF}, {g})" for g in (1, 2, 3)))} END AS href,
          {_decoded(_LINK_TEXT)} AS text
        FROM (SELECT page_id, i, tags[i] AS tag FROM (SELECT page_id, tags, unnest(range(1, len(tags) + 1)) AS i FROM (
          SELECT page_id, {_LINK_TAGS} AS tags FROM pages)))""",
)
def page_links(spark, sf):
    more = F.when(F.col("page_id") % 2 == 0, F.lit(_EXTRA_LINKS[1])).otherwise(F.lit(""))
    html = F.concat("html", F.lit(_EXTRA_LINKS[0]), more)
    return P.page_links(table(spark, sf, "pages").select("page_id", html.alias("html")))


_GROUP = "case when page_id % 9 = 0 then '{\"other\":1}' else concat('{\"productGroups\":[{\"products\":[{\"id\":', cast(page_id as string), '},{\"id\":', cast(page_id * 2 as string), '}]},{\"products\":[{\"id\":-1}]}]}') end"


@query(
    "embedded_json",
    """SELECT page_id, cast(i AS INTEGER) AS pos, page_id * (i + 1) AS id FROM pages, unnest([0, 1]) AS u(i) WHERE page_id % 9 <> 0 AND page_id % 11 <> 0""",
)
def embedded_json(spark, sf):
    script = F.concat(
        F.lit("<script>var x=1;window.zara.dataLayer = "), F.expr(_GROUP),
        F.lit(";window.zara.viewPayload = window.zara.dataLayer;</script>"),
    )
    html = F.when(F.col("page_id") % 11 == 0, F.col("html")).otherwise(F.concat("html", script))
    items = F.try_variant_get("doc", "$.productGroups[0].products", "array<variant>")
    return (
        table(spark, sf, "pages")
        .select("page_id", P.embedded_json(html).alias("doc"))
        .select("page_id", F.posexplode(items).alias("pos", "item"))
        .select("page_id", "pos", F.try_variant_get("item", "$.id", "bigint").alias("id"))
    )


_FACET = [
    ";:relevance:markDownIndicator:false:category:uk-mens&#34;",
    ";:relevance:category:uk womens&#34;",
    ";:relevance:markDownIndicator:false:styleCodes:Slim-1&#34;",
    ";:relevance:styleCodes:Wide&#34;",
]
_FACET_HTML = "concat(html, " + ", ".join(
    f"case when cast(floor(page_id / {2**i}) as bigint) % 2 = 1 then '{f} x {f.replace('false:', 'false:')}' else '' end" for i, f in enumerate(_FACET)
) + ")"


@query(
    "facet_ladder",
    """SELECT page_id, cast(CASE WHEN leaf IS NOT NULL THEN i END AS INTEGER) AS pos, leaf FROM (
         SELECT page_id, CASE WHEN page_id % 2 = 1 THEN 'category:uk-mens' WHEN (page_id // 2) % 2 = 1 THEN 'category:uk womens'
           WHEN (page_id // 4) % 2 = 1 THEN 'styleCodes:Slim-1' WHEN (page_id // 8) % 2 = 1 THEN 'styleCodes:Wide' END AS leaf FROM pages),
       unnest([0, 1]) AS u(i) WHERE leaf IS NOT NULL OR i = 0""",
)
def facet_ladder(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.expr(_FACET_HTML).alias("html"))
    return P.facets(pages)


_NESTED = """to_json(named_struct('a', named_struct('link', concat('A', cast(o_orderkey as string)), 'z', 1),
    'list', array(array(named_struct('link', concat('L', cast(o_custkey as string)), 'b', cast(null as struct<link: string>))),
                  array(named_struct('link', cast(null as string), 'b', named_struct('link', o_orderstatus)))),
    'link', concat('T', cast(o_orderkey as string))))"""


@query(
    "json_find_key",
    """SELECT o_orderkey, cast(i - 1 AS INTEGER) AS pos, v[i] AS value FROM (SELECT o_orderkey, unnest([1, 2, 3, 4]) AS i,
         ['"A' || o_orderkey || '"', '"L' || o_custkey || '"', '"' || o_orderstatus || '"', '"T' || o_orderkey || '"'] AS v FROM orders
         WHERE o_orderkey % 11 <> 0)""",
)
def json_find_key(spark, sf):
    """Bodies of up to 3,000 levels below their own; some are cut short."""
    levels = F.when(F.col("o_orderkey") % 500 == 1, 3000).otherwise(F.col("o_orderkey") % 7).cast("int")
    deep = F.concat(F.repeat(F.lit('{"up": '), levels), F.expr(_NESTED), F.repeat(F.lit("}"), levels))
    cut = F.substring(deep, F.lit(1), F.length(deep) - F.when(F.col("o_orderkey") % 11 == 0, 1).otherwise(0))
    bodies = table(spark, sf, "orders").select("o_orderkey", cut.alias("body"))
    return bodies.select("o_orderkey", F.posexplode(payloads.find_key(F.col("body"), "link")).alias("pos", "value"))


# --- lookups and trees ------------------------------------------------------------------------


@query(
    "lookup_fallback",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN o.user_id IS NOT NULL THEN o.event_type ELSE k.event_type END AS leaf
       FROM lineitem LEFT JOIN first_event o ON l_partkey = o.user_id LEFT JOIN first_event k ON l_suppkey = k.user_id""",
    ("first_event AS (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n = 1)",),
)
def lookup_fallback(spark, sf):
    entries = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    lookup = keep_first(entries, ["user_id"], ["event_id"]).select("user_id", "event_type")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookup_with_fallback(rows, lookup, "l_partkey", "l_suppkey", "user_id", "event_type", "leaf")


_NODES = """
  SELECT concat('r', cast(r_regionkey as string)) AS node, cast(null as string) AS parent, r_name AS name FROM region
  UNION ALL SELECT concat('n', cast(n_nationkey as string)), concat('r', cast(n_regionkey as string)), n_name FROM nation
  UNION ALL SELECT concat('c', cast(c_custkey as string)), concat('n', cast(c_nationkey as string)), c_name FROM customer
  UNION ALL SELECT concat('s', cast(c_custkey as string)), concat('c', cast(c_custkey as string)), c_mktsegment FROM customer
  UNION ALL SELECT concat('t', cast(c_custkey as string)), concat('s', cast(c_custkey as string)), cast(c_nationkey as string) FROM customer
  UNION ALL SELECT concat('u', cast(c_custkey as string)), concat('t', cast(c_custkey as string)), c_mktsegment FROM customer"""


@query(
    "tree_paths",
    """SELECT menu, node, p[1] AS taxo1, p[2] AS taxo2, p[3] AS taxo3, p[4] AS taxo4 FROM (
         SELECT DISTINCT menu, node, list_distinct_id, (list_transform(list_filter(range(1, len(line) + 1), lambda i: (m // cast(pow(2, i - 1) AS BIGINT)) % 2 = 1),
             lambda i: line[i]) || [name])[1:4] AS p,
           (list_filter(range(1, len(line) + 1), lambda i: (m // cast(pow(2, i - 1) AS BIGINT)) % 2 = 1) || [99])[1:4] AS chosen
         FROM (SELECT *, 0 AS list_distinct_id FROM up), unnest(range(32)) AS u(m) WHERE m < pow(2, len(line)))""",
    (
        f"nodes AS (SELECT s.menu, n.* REPLACE (concat(name, ' ', s.menu) AS name) FROM ({_NODES}) n, (SELECT unnest(['A', 'B']) AS menu) s)",
        """up AS (SELECT a.menu, a.node, a.name, list_filter([f.name, e.name, d.name, c.name, b.name], lambda x: x IS NOT NULL) AS line FROM nodes a
           LEFT JOIN nodes b ON a.parent = b.node AND a.menu = b.menu LEFT JOIN nodes c ON b.parent = c.node AND b.menu = c.menu
           LEFT JOIN nodes d ON c.parent = d.node AND c.menu = d.menu LEFT JOIN nodes e ON d.parent = e.node AND d.menu = e.menu
           LEFT JOIN nodes f ON e.parent = f.node AND e.menu = f.menu)""",
    ),
)
def tree_paths_(spark, sf):
    """Two menus with the same node numbers, up to six levels deep."""

    def level(name, key, label, prefix, parent=None, above=""):
        up = F.concat(F.lit(above), F.col(parent).cast("string")) if parent else F.lit(None).cast("string")
        return table(spark, sf, name).select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("node"), up.alias("parent"), F.col(label).cast("string").alias("name")
        )

    nodes = (
        level("region", "r_regionkey", "r_name", "r")
        .unionByName(level("nation", "n_nationkey", "n_name", "n", "n_regionkey", "r"))
        .unionByName(level("customer", "c_custkey", "c_name", "c", "c_nationkey", "n"))
        .unionByName(level("customer", "c_custkey", "c_mktsegment", "s", "c_custkey", "c"))
        .unionByName(level("customer", "c_custkey", "c_nationkey", "t", "c_custkey", "s"))
        .unionByName(level("customer", "c_custkey", "c_mktsegment", "u", "c_custkey", "t"))
    )
    menus = nodes.select(F.explode(F.array(F.lit("A"), F.lit("B"))).alias("menu"), "node", "parent", "name")
    named = menus.withColumn("name", F.concat_ws(" ", "name", "menu"))
    return tree_paths(named, scope=["menu"]).select("menu", "node", "taxo1", "taxo2", "taxo3", "taxo4")


# --- menus of pages -----------------------------------------------------------------------------

_MENU = {
    "root": (("MAN", "WOMAN", "KIDS", "HOME"), "page % 4"),
    "second": (("JEANS", "NEW IN", "SHOES ", "T-SHIRTS", "X & Y"), "c_custkey % 5"),
    "third": (("DRESSES", "BASIC", "COATS"), "c_custkey % 3"),
}


def _menu_sql() -> tuple[str, str, str]:
    columns = ", ".join(f"{V.pick(values, index, V.DUCK)} AS {name}" for name, (values, index) in _MENU.items())
    rows = f"menus AS (SELECT *, {columns} FROM (SELECT c_custkey, c_custkey // 20 AS page FROM customer))"
    paths = """paths AS (
      SELECT DISTINCT page, concat('/r/', page) AS url, root AS taxo1, 'None' AS taxo2, cast(NULL AS VARCHAR) AS taxo3, -1 AS k FROM menus
      UNION ALL SELECT page, concat('/c/', c_custkey), root, second, NULL, c_custkey FROM menus
      UNION ALL SELECT page, concat('/n/', c_custkey), root, third, NULL, c_custkey FROM menus
      UNION ALL SELECT page, concat('/n/', c_custkey), root, second, third, c_custkey FROM menus)"""
    rank = ladder_sql(L.CATEGORY_LADDERS["ZARA"])
    return (
        f"""SELECT page, taxo1, taxo2, taxo3, url FROM (SELECT *, row_number() OVER (PARTITION BY page, url
              ORDER BY {rank}, taxo1 NULLS LAST, taxo2 NULLS LAST, taxo3 NULLS LAST) AS n FROM paths WHERE taxo1 <> 'HOME') WHERE n = 1""",
        rows,
        paths,
    )


@query("zara_categories", _menu_sql()[0], _menu_sql()[1:])
def zara_categories(spark, sf):
    """Menus of 20 customers each, with the same entries over and over: only the page keeps them apart."""
    rows = table(spark, sf, "customer").selectExpr("c_custkey", "c_custkey div 20 AS page")
    rows = rows.withColumns({n: F.expr(V.pick(values, index, V.SPARK)) for n, (values, index) in _MENU.items()})
    entry = F.format_string(
        "<LI class='e' data-name='%s'><a data-href=/c/%d>x</a><ul><li data-name=\"%s\"><a href='/n/%d'>n</a><p>a<br></li></ul></LI>",
        F.replace("second", F.lit("&"), F.lit("&amp;")), F.col("c_custkey"), F.col("third"), F.col("c_custkey"),
    )
    pages = rows.groupBy("page", "root").agg(F.array_sort(F.collect_list(F.struct("c_custkey", entry.alias("e")))).alias("es"))
    html = F.concat(
        F.lit("<nav></li><!-- <li data-name='NO'> --><script>var t = '<li>';</script><ul><li data-name='"), "root", F.lit("'><a href=\"/r/"),
        F.col("page").cast("string"), F.lit("\">r</a><ul><li><span>no entry</span><ul>"), F.array_join("es.e", ""), F.lit("</ul></li></ul></li></ul></nav>"),
    )
    menus = P.menu_tree(pages.select(F.lit("ZARA").alias("shop"), "page", html.alias("html")))
    listed = categories.zara(menus.withColumn("seq", F.col("node")), keep=("page",))
    return listed.select("page", "taxo1", "taxo2", "taxo3", "url")


# --- filter blocks ------------------------------------------------------------------------------

_BLOCK_SHOPS = ("ASOS", "JOHN_LEWIS", "MS")
_BLOCKS = {
    "ASOS": "<div class='x bybwbES'><div class=\"_3lFxFJi\"> {0} </div><div class=\"_2h_c2tR\"><input value=\"{2}\"><label> {1} </label></div></div>",
    "JOHN_LEWIS": "<DIV class=\"faceted-filters-accordion\"><h3> {0} </h3><div><ul><li><a href='{2}'>{1}</a></li></ul></div></DIV>",
    "MS": "<li class=\"accordion__item big\"><input><label><h3>{0}</h3></label><div><ul><li><input><span><a href='{2}'>{1} (3)</a></span></li></ul></div></li>",
}


def _block(shop: str, title: str, label: str, value: str):
    parts = _BLOCKS[shop].replace("{0}", title).replace("{2}", value).split("{1}")
    return F.concat(F.lit(parts[0]), F.col(label), F.lit(parts[1]))


@query(
    "titled_facets",
    f"""SELECT p_partkey, shop, cast(CASE WHEN leaf IS NOT NULL THEN i END AS INTEGER) AS pos, leaf, CASE WHEN leaf IS NOT NULL THEN CASE i WHEN 0 THEN '/1' ELSE '/2' END END AS value
        FROM (SELECT p_partkey, shop, i, CASE
            WHEN p_partkey % 2 = 0 THEN CASE i WHEN 0 THEN p_brand ELSE p_type END
            WHEN shop = 'MS' AND p_partkey % 5 < 3 AND i = 0 THEN p_type END AS leaf
          FROM (SELECT *, {V.pick(_BLOCK_SHOPS, "p_partkey % 3", V.DUCK)} AS shop FROM part), unnest([0, 1]) AS u(i))
        WHERE leaf IS NOT NULL OR (i = 0)""",
)
def titled_facets(spark, sf):
    """Every second page has two blocks of the first title; others one of a later step, or only look-alikes."""
    rows = table(spark, sf, "part").withColumn("shop", F.expr(V.pick(_BLOCK_SHOPS, "p_partkey % 3", V.SPARK)))
    html = by_shop(
        {
            shop: F.concat(
                F.lit("<html><ul>"), _block(shop, "Brand", "p_brand", "/0"), _block(shop, "Free Style", "p_brand", "/0"),
                F.when(F.col("p_partkey") % 2 == 0, F.concat(_block(shop, "Product Type", "p_brand", "/1"), _block(shop, "Product Type", "p_type", "/2")))
                .when(F.col("p_partkey") % 5 < 2, F.concat(_block(shop, "Style", "p_brand", "/3"), _block(shop, "Category", "p_type", "/1")))
                .when(F.col("p_partkey") % 5 == 2, _block(shop, "Style", "p_type", "/1")).otherwise(F.lit("")),
                F.lit("</ul></html>"),
            )
            for shop in _BLOCK_SHOPS
        }
    )
    return P.titled_facets(rows.select("p_partkey", "shop", html.alias("html")))


@query(
    "json_facets",
    """SELECT p_partkey, cast(CASE WHEN leaf IS NOT NULL THEN i END AS INTEGER) AS pos, leaf FROM (
         SELECT p_partkey, i, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 THEN CASE i WHEN 0 THEN p_brand ELSE p_type END END AS leaf
         FROM part, unnest([0, 1]) AS u(i)) WHERE leaf IS NOT NULL OR i = 0""",
)
def json_facets(spark, sf):
    """Styles are listed only where fewer than four levels are known: the third level counts twice."""
    body = F.when(F.col("p_partkey") % 4 == 0, F.lit('{"facets":[{"code":"size","values":[{"code":"s"}]}]}')).otherwise(
        F.concat(F.lit('{"facets":[{"code":"style","values":[{"code":"'), "p_brand", F.lit('"},{"code":"'), "p_type", F.lit('"}]}]}'))
    )
    pages = table(spark, sf, "part").select(
        "p_partkey", F.lit("men").alias("taxo1"), F.lit("tops").alias("taxo2"),
        F.when(F.col("p_partkey") % 3 == 0, "slim").alias("taxo3"), body.alias("body"),
    )
    return payloads.style_facets(pages).select("p_partkey", "pos", "leaf")
