"""Category levels, text fields and pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwatch.checks.registry import query
from shelfwatch.checks.views import (
    CATEGORY_URLS_SQL,
    CLEAN_URL,
    LISTING_SQL,
    category_urls,
    listing,
    table,
)
from shelfwatch.functions import levels as V
from shelfwatch.functions.conditions import member
from shelfwatch.functions.text import (
    item_count,
    min_price_number,
    min_price_text,
    page_count,
    price_in_text,
    strip,
)
from shelfwatch.operators.prune import drop_covered, drop_prefix_of_next
from shelfwatch.plans.categories import starts_any


@query(
    "taxonomy_levels",
    """SELECT seq, l[1] AS level1, l[2] AS level2, l[3] AS level3, l[4] AS level4 FROM (
         SELECT seq, list_filter([taxo1, taxo2, taxo3], lambda x: x IS NOT NULL) || [taxo4] AS l FROM listing)""",
    (LISTING_SQL,),
)
def taxonomy_levels(spark, sf):
    out = V.compact_levels([F.col("taxo1"), F.col("taxo2"), F.col("taxo3")], F.col("taxo4"))
    return listing(spark, sf).select("seq", *[c.alias(f"level{i + 1}") for i, c in enumerate(out)])


_PATH = f"regexp_replace({CLEAN_URL}, '^https?://', '')"


@query(
    "url_taxonomy",
    f"""SELECT page_id, p[1] AS host, p[2] AS first_level, p[3] AS second_level, m[1] AS kept1, m[2] AS kept2,
          CASE WHEN len(p) > 1 THEN p[1] END AS parent1, CASE WHEN len(p) > 2 THEN p[2] END AS parent2
        FROM (SELECT page_id, string_split({_PATH}, '/') AS p,
              list_filter(string_split(replace({CLEAN_URL}, 'https://', ''), '/'), lambda x: x <> 'en') AS m FROM pages)""",
)
def url_taxonomy(spark, sf):
    pages = table(spark, sf, "pages").selectExpr("page_id", f"{CLEAN_URL} AS url", f"{_PATH} AS path")
    path = F.col("path")
    host, first, second = V.url_levels(path, (0, 1, 2))
    kept1, kept2 = V.url_levels(F.col("url"), (0, 1), prefix="https://", drop="en")
    parent1, parent2 = V.url_levels(path, (0, 1), drop_last=1)
    return pages.select(
        "page_id", host.alias("host"), first.alias("first_level"), second.alias("second_level"),
        kept1.alias("kept1"), kept2.alias("kept2"), parent1.alias("parent1"), parent2.alias("parent2"),
    )


_CODE = "concat_ws('|', 'nav', taxo1, taxo2, taxo3, taxo4, shop, id, 'tail', 'more')"
_TRACK = "concat('x|', coalesce(taxo2, ''), '|', shop, ':  ', coalesce(taxo3, ''), ' :', coalesce(taxo4, 'none'), case when seq % 3 = 0 then ': last ' else '' end)"


@query(
    "tracker_levels",
    f"""SELECT seq, c[2] AS code1, c[3] AS code2, c[4] AS code3, c[5] AS code4, c[6] AS code5,
          CASE WHEN len(c) >= 7 THEN array_to_string(c[7:], '|') END AS code6,
          trim(t[2]) AS tracked2, trim(t[3]) AS tracked3, trim(t[4]) AS tracked4
        FROM (SELECT seq, string_split({_CODE}, '|') AS c,
              string_split(string_split({_TRACK}, '|')[-1], ':') AS t FROM listing)""",
    (LISTING_SQL,),
)
def tracker_levels(spark, sf):
    rows = listing(spark, sf).selectExpr("seq", f"{_CODE} AS code", f"{_TRACK} AS track")
    codes = V.code_levels(F.col("code"))
    tracked = V.tracking_levels(F.col("track"))
    return rows.select(
        "seq",
        *[c.alias(f"code{i + 1}") for i, c in enumerate(codes)],
        *[c.alias(f"tracked{i + 2}") for i, c in enumerate(tracked)],
    )


@query(
    "level_fallback",
    "SELECT seq, CASE WHEN taxo3 IS NULL OR taxo3 = 'department' THEN taxo4 ELSE taxo3 END AS taxo3 FROM listing",
    (LISTING_SQL,),
)
def level_fallback(spark, sf):
    return listing(spark, sf).select("seq", V.fallback_level(F.col("taxo3"), F.col("taxo4")).alias("taxo3"))


_PRICE_TEXT = (
    "case o_orderkey % 6 when 0 then concat('£', cast(cast(floor(o_totalprice) as bigint) as string), '.50') "
    "when 1 then concat(cast(o_custkey as string), '.00') when 2 then concat('Now £', cast(o_custkey as string)) "
    "when 3 then '£1,299.00' when 4 then 'from' else o_orderpriority end"
)


@query(
    "price_text",
    f"""SELECT o_orderkey, try_cast(nullif(regexp_extract(t, '.([0-9.]+\\.?[0-9]*)', 1), '') AS DOUBLE) AS price,
          try_cast(nullif(regexp_extract(replace(t, ',', ''), '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS full_price
        FROM (SELECT o_orderkey, {_PRICE_TEXT} AS t FROM orders)""",
)
def price_text(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_PRICE_TEXT} AS t")
    return rows.select(
        "o_orderkey",
        price_in_text(F.col("t")).alias("price"),
        price_in_text(F.col("t"), thousands=True).alias("full_price"),
    )


_PRICES = (
    "concat('£', cast(o_custkey as string), '.00')",
    "case when o_orderkey % 3 = 0 then cast(null as string) else concat('£', cast(o_orderkey % 97 as string), '.99') end",
    "concat('£', cast(o_orderkey % 13 as string), '.5')",
)


@query(
    "min_price_text",
    f"SELECT o_orderkey, list_min(list_transform(list_filter([{', '.join(_PRICES)}], lambda p: p IS NOT NULL), lambda p: p[2:])) AS price FROM orders",
)
def min_price_text_(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", f"array({', '.join(_PRICES)}) AS prices")
    return rows.select("o_orderkey", min_price_text(F.col("prices")).alias("price"))


@query(
    "min_price_num",
    f"SELECT o_orderkey, list_min(list_transform([{', '.join(_PRICES)}], lambda p: cast(p[2:] AS DOUBLE))) AS price FROM orders",
)
def min_price_num(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", f"array({', '.join(_PRICES)}) AS prices")
    return rows.select("o_orderkey", min_price_number(F.col("prices")).alias("price"))


_COUNTS = "concat(text, ' Showing ', cast(doc_id % 7 as string), ' OF ', cast(doc_id as string), ' pages, ', cast(doc_id * 3 as string), ' Items')"


@query(
    "page_counts",
    f"""SELECT doc_id, try_cast(nullif(regexp_extract(t, '(?i)[0-9]+ of ([0-9]+)', 1), '') AS INTEGER) AS pages,
          try_cast(nullif(regexp_extract(t, '(?i)([0-9]+) item', 1), '') AS INTEGER) AS items
        FROM (SELECT doc_id, {_COUNTS} AS t FROM documents)""",
)
def page_counts(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_COUNTS} AS t")
    return rows.select("doc_id", page_count(F.col("t")).alias("pages"), item_count(F.col("t")).alias("items"))


@query(
    "strip_text",
    "SELECT doc_id, regexp_replace(concat('  \n\t', text, '\r\n '), '^\\s+|\\s+$', '', 'g') AS text FROM documents",
)
def strip_text(spark, sf):
    padded = F.concat(F.lit("  \n\t"), "text", F.lit("\r\n "))
    return table(spark, sf, "documents").select("doc_id", strip(padded).alias("text"))


@query(
    "stock_flag",
    "SELECT seq, shop, CASE WHEN shop IN ('HM', 'TKMAXX', 'NEWLOOK') THEN inStock ELSE true END AS in_stock FROM listing",
    (LISTING_SQL,),
)
def stock_flag(spark, sf):
    from shelfwatch.sources.payloads import PAYLOADS, Record

    stocked = {s: p for s, p in PAYLOADS.items() if p.stock}
    body = (
        """to_json(named_struct('outOfStockText', if(inStock, '', 'Sold out'),
        'stockLevelStatus', if(inStock, 'inStock', 'outOfStock'),
        'stock', named_struct('stockLevelStatus', named_struct('code', if(inStock, 'lowStock', 'outOfStock')))))"""
    )
    record = Record(stocked)
    rows = listing(spark, sf).selectExpr("seq", "shop", f"parse_json({body}) AS doc")
    return record.open(rows, "doc").select("seq", "shop", F.expr(record.in_stock()).alias("in_stock"))


@query(
    "field_choice",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN NULL ELSE event_type END AS label FROM events""",
)
def field_choice(spark, sf):
    """Title if the record has one, be it null, else the name; records are the events' own JSON."""
    from shelfwatch.sources.payloads import choose_field

    rest = F.expr(
        "case event_id % 3 when 0 then concat('{\"title\":', substring(props, 7)) "
        "when 1 then concat('{\"title\":null,\"name\":\"', event_type, '\"}') "
        "else concat('{\"name\":\"', event_type, '\"}') end"
    )
    doc = F.parse_json(rest)
    return table(spark, sf, "events").select("event_id", choose_field(doc, "$.title", "$.name").alias("label"))


@query(
    "url_filter",
    """SELECT page_id, url FROM pages WHERE (starts_with(url, 'https://www.') OR starts_with(url, 'https://blog.'))
       AND strpos(url, 'utm_') = 0 AND NOT ends_with(url, '/') AND regexp_extract(url, '^https?://[^/]*/([^/?#]*)', 1) IN ('en', 'fr')""",
)
def url_filter(spark, sf):
    url = F.col("url")
    return (
        table(spark, sf, "pages")
        .select("page_id", "url")
        .where(
            starts_any(url, ("https://www.", "https://blog."))
            & ~F.contains(url, F.lit("utm_"))
            & ~F.endswith(url, F.lit("/"))
            & member(F.regexp_extract(url, "^https?://[^/]*/([^/?#]*)", 1), ("en", "fr"))
        )
    )


@query(
    "leaf_categories",
    """SELECT shop, url, seq FROM (SELECT *, lead(url) OVER (PARTITION BY shop ORDER BY url) AS nxt FROM (
         SELECT shop, url, max(seq) AS seq FROM category_urls GROUP BY shop, url))
       WHERE nxt IS NULL OR strpos(nxt, url) = 0""",
    (CATEGORY_URLS_SQL,),
)
def leaf_categories(spark, sf):
    return drop_covered(category_urls(spark, sf))


@query(
    "leaf_prefix",
    """SELECT shop, url, seq FROM (SELECT *, lead(url) OVER (PARTITION BY shop ORDER BY seq) AS nxt FROM category_urls)
       WHERE nxt IS NOT NULL AND NOT starts_with(nxt, left(url, greatest(length(url) - 5, 0)))""",
    (CATEGORY_URLS_SQL,),
)
def leaf_prefix(spark, sf):
    return drop_prefix_of_next(category_urls(spark, sf))
