"""Inputs of the registered queries, derived row by row from the given tables.

Each view is written once as portable SQL expressions: Spark evaluates them with ``selectExpr``,
and the same text is the source of the checking SQL. All views grow with the tables they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.config import classes, ladders
from shelfwatch.config.shops import AGGREGATED
from shelfwatch.schema import SHOPS

SPARK, DUCK = "spark", "duck"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def quote(value: str | None) -> str:
    return "cast(null as string)" if value is None else "'" + value.replace("'", "''") + "'"


def pick(values, index: str, dialect: str) -> str:
    """Entry of a constant list by an index expression from 0."""
    items = ", ".join(quote(v) for v in values)
    if dialect == SPARK:
        return f"element_at(array({items}), cast(1 + ({index}) as int))"
    return f"([{items}])[1 + ({index})]"


def idiv(a: str, n: int) -> str:
    return f"cast(floor(({a}) / {n}) as bigint)"


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


# --- snap: one shop per event type ------------------------------------------------------------

SNAP = {
    "shop": "upper(event_type)",
    "id": "cast(user_id as string)",
    "reference": "p_brand",
    "name": "p_name",
    "price": "value",
    "in_stock": "event_id % 7 <> 0",
    "taxo1": "case user_id % 3 when 0 then 'men' when 1 then 'women' else 'kids' end",
    "taxo2": "p_type",
    "taxo3": "case when event_id % 5 = 0 then cast(null as string) else concat('lvl_', cast(event_id % 4 as string)) end",
    "date": "ts",
    "seq": "event_id",
}
FROM_EVENTS = "FROM events JOIN part ON user_id = p_partkey"


def _events_with_part(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").join(table(spark, sf, "part"), F.expr("user_id = p_partkey"))


def snap(spark: SparkSession, sf: str) -> DataFrame:
    return _events_with_part(spark, sf).selectExpr(*select_list(SNAP))


SNAP_SQL = f"snap AS (SELECT {', '.join(select_list(SNAP))} {FROM_EVENTS})"

# --- listing: nine shops with their own words, every word the rules know occurs ---------------

GARMENTS = (
    " t-shirt", " t shirt", " Shirt", " polo shirt", " Jacket", " waistcoat", " waiscoat", " Coat",
    " Sweatshirt", " sweater", " hoodie", " hoody", " jeans", " blouse", " skirt", " Dress",
    " shirt dress", " socks", "",
)


def _values(column: str) -> list[str]:
    out = []
    for group in (ladders.PRODUCT_LADDERS, ladders.CATEGORY_LADDERS):
        for ladder in group.values():
            for bucket in ladder.buckets:
                for test in bucket.rules:
                    if test.column == column:
                        out.extend(test.values)
    for rules in (
        classes.ASOS_MEN, classes.ASOS_WOMEN, classes.HM_MEN, classes.HM_WOMEN,
        classes.PRIMARK_MEN, classes.PRIMARK_WOMEN,
    ):
        for rule in rules:
            if column == "taxo2" and rule.taxo2:
                out.append(rule.taxo2)
            if column == "taxo3":
                out.extend(rule.taxo3)
    return sorted(set(out))


ROOTS = sorted({g for s in AGGREGATED for g in s.genders} | {"homeware", "clearance", "sale", "KIDS"})
TAXO1 = [*ROOTS, "MAN", "WOMAN", "gap", "men", "women", None]
TAXO2 = [*_values("taxo2"), "men", "women", "Winter Coats", "up-to-50", None]
TAXO3 = [*_values("taxo3"), "polo", "42", "007", "4.2", "last-chance-x", None]
TAXO4 = [*_values("taxo4"), "deep", None]


def listing_columns(dialect: str) -> dict[str, str]:
    shop = pick(SHOPS, "event_id % 9", dialect)
    garment = pick(GARMENTS, f"user_id % {len(GARMENTS)}", dialect)
    step = idiv("event_id", 9)
    pence = "(event_id * 37 % 9000 + 100)"
    return {
        "shop": shop,
        "id": "cast(user_id as string)",
        "reference": "case when user_id % 4 = 0 then cast(null as string) else p_brand end",
        "name": f"case when user_id % 23 = 0 then cast(null as string) else concat(p_name, {garment}) end",
        "price": f"case when event_id % 9 in (4, 6) then cast({pence} as double) else cast({pence} as double) / 100 end",
        "pence": pence,
        "inStock": "event_id % 7 <> 0",
        "taxo1": pick(TAXO1, f"({step} + user_id) % {len(TAXO1)}", dialect),
        "taxo2": pick(TAXO2, f"({step} * 31 + user_id) % {len(TAXO2)}", dialect),
        "taxo3": pick(TAXO3, f"({step} * 17 + user_id) % {len(TAXO3)}", dialect),
        "taxo4": pick(TAXO4, f"({step} * 7) % {len(TAXO4)}", dialect),
        "URL": "case when event_id % 3 = 0 then cast(null as string) else concat('/p/', cast(user_id as string)) end",
        "url_old": "case when event_id % 2 = 0 then cast(null as string) else concat('/old/', cast(user_id as string)) end",
        "date": "ts",
        "seq": "event_id",
        "page": idiv("event_id", 180),
    }


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return _events_with_part(spark, sf).selectExpr(*select_list(listing_columns(SPARK)))


LISTING_SQL = f"listing AS (SELECT {', '.join(select_list(listing_columns(DUCK)))} {FROM_EVENTS})"

# --- category URLs: each page, its parent and the site it is on ---------------------------------

CLEAN_URL = "regexp_extract(url, '^(https?://[^?#]*)', 1)"
PARENT_URL = f"regexp_replace({CLEAN_URL}, '/[^/]*$', '')"
SITE_URL = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"
URL_SHOP = "concat('S', cast(page_id % 3 as string))"


def category_urls(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "pages")
        .selectExpr(f"{URL_SHOP} AS shop", "page_id", f"posexplode(array({CLEAN_URL}, {PARENT_URL}, {SITE_URL})) AS (pos, u)")
        .selectExpr("shop", "u AS url", "page_id * 3 + pos AS seq")
    )


CATEGORY_URLS_SQL = (
    f"category_urls AS (SELECT shop, u[i] AS url, page_id * 3 + i - 1 AS seq FROM ("
    f"SELECT {URL_SHOP} AS shop, page_id, [{CLEAN_URL}, {PARENT_URL}, {SITE_URL}] AS u, "
    f"unnest([1, 2, 3]) AS i FROM pages))"
)

# --- captures: pages of up to 20 listings per shop, as JSON or HTML bodies ----------------------

BAD_PAGE = "page % 31 = 7"
NO_ID = "seq % 97 = 0"
CAPTURE_LEVELS = {
    "c1": (("men", "women", "kids"), "page % 3"),
    "c2": (("tops", None, "jeans"), f"{idiv('page', 3)} % 3"),
    "c3": ((None, "slim"), f"{idiv('page', 9)} % 2"),
    "leaf": (("Facet A", None), f"{idiv('page', 2)} % 2"),
}


def capture_columns(dialect: str) -> dict[str, str]:
    out = {name: pick(values, index, dialect) for name, (values, index) in CAPTURE_LEVELS.items()}
    out["url"] = "concat('https://shop.example/', shop, '/', cast(page as string))"
    return out


PRICE_TEXT = f"concat(cast({idiv('pence', 100)} as string), '.', lpad(cast(pence % 100 as string), 2, '0'))"
TRACKING = (
    "case when seq % 50 = 6 then 'a|b:BASICS_BASICS' "
    "else concat('a|b: ', coalesce(reference, 'none'), ' : v', cast(seq % 5 as string)) end"
)
SAFE_NAME = "coalesce(name, 'unnamed')"
# Item texts per shop, filled in by position: 1 id entry, 2 id, 3 name, 4 price, 5 pounds, 6 pence,
# 7 stock word, 8 tracking text, 9 price in pence.
KIND = (
    "case when shop = 'ASOS' then concat('ASOS', cast(seq % 2 as string)) "
    "when shop = 'JOHN_LEWIS' and seq % 13 = 5 then 'JOHN_LEWIS1' "
    "when shop = 'ZARA' then case when seq % 2 = 0 then 'ZARA0' when seq % 11 = 0 then 'ZARA2' else 'ZARA1' end else shop end"
)
ID_ENTRIES = {
    "ASOS": '"id":"%s",', "GAP": '"id":"%s",', "NEWLOOK": '"code":"%s",', "PRIMARK": '"BusinessId":"%s",',
    "HM": '"articleCode":"%s",', "TKMAXX": '"code":"%s",', "ZARA": '"id":"%s",',
    "JOHN_LEWIS": ' data-product-id="%s"', "MS": "%s",
}
_ASOS = '{%1$s"productCode":"c%2$s",TITLE"name":"n %3$s","price":{"current":{"value":%4$s}},"url":"p/%2$s"}'
# names in either case, values without quotes, several class names, entities; a price without a number
_JOHN_LEWIS = (
    '<SECTION class="product-card product-card--wide"%1$s><img src="i.png"><div><a class=x href="p/%2$s?a=1&amp;b=2"><h2> %3$s &amp; co</h2>'
    '<span class="product-card__price">£%4$s</span><span class="product-card__price was">WAS</span></a></div></SECTION>'
    '<section class=product-card-list></section>'
)
ITEMS = {
    "ASOS0": _ASOS.replace("TITLE", '"title":"%3$s",'),
    "ASOS1": _ASOS.replace("TITLE", ""),
    "GAP": '{%1$s"uuid":"u-%2$s","name":"%3$s","prices":[{"value":"£%4$s"},{"value":"£9.00"},{}]}',
    "NEWLOOK": '{%1$s"name":"%3$s","price":{"value":%4$s},"stock":{"stockLevelStatus":{"code":"%7$s"}},"url":"p/%2$s"}',
    "PRIMARK": '{%1$s"Sku":"k%2$s","Title":"%3$s","PriceInteger":"%5$s","PriceDecimal":"%6$s"}',
    "HM": '{%1$s"title":"%3$s","price":"£%4$s","outOfStockText":"%7$s","favouritesTracking":"%8$s",'
          '"swatches":[{"articleLink":"p/%2$s"}]}',
    "TKMAXX": '{%1$s"label":"%3$s","price":{"value":%4$s},"stockLevelStatus":"%7$s","url":"p/%2$s"}',
    "ZARA0": '{%1$s"detail":{"reference":"r%2$s"},"name":"%3$s","price":%9$s}',
    "ZARA1": '{%1$s"detail":{"reference":"r%2$s"},"bundleProductSummaries":[{"name":"set %3$s","price":%9$s}]}',
    "ZARA2": '{%1$s"detail":{"reference":"r%2$s"},"bundleProductSummaries":[]}',
    "JOHN_LEWIS": _JOHN_LEWIS.replace("WAS", "£45.00"),
    "JOHN_LEWIS1": _JOHN_LEWIS.replace("WAS", "?"),
    "MS": '<A href="/shop/p/%1$s?x=1&amp;y=2" class="x product"><h3 class="product__title"> %3$s </h3>'
          '<p class="product__price big"><b><i></i>£%4$s</b></p></A>',
}
BODIES = {
    "ASOS": ('{"itemCount":1,"products":[', "]}"),
    "GAP": ('{"productHits":[', "]}"),
    "NEWLOOK": ('{"data":{"pagination":{"numberOfPages":1},"results":[', "]}}"),
    "PRIMARK": ('{"Products":[', "]}"),
    "HM": ('{"products":[', "]}"),
    "TKMAXX": ('{"pagination":{"numberOfPages":1},"results":[', "]}"),
    "ZARA": (
        '<html><body><p>x<script>var a={};window.zara.dataLayer = {"productGroups":[{"products":[',
        "]}]};window.zara.viewPayload = window.zara.dataLayer</script></html>",
    ),
    "JOHN_LEWIS": ("<html><body><p>12 items", "</html>"),
    "MS": ("<html><body><p>page 1 of 9", "</html>"),
}


def item_text():
    entry = F.when(F.expr(NO_ID), "").otherwise(F.expr(f"format_string({_map(ID_ENTRIES)}[shop], id)"))
    stock = "if(inStock, if(shop = 'HM', '', 'inStock'), if(shop = 'HM', 'Sold out', 'outOfStock'))"
    values = [
        "_entry", "id", SAFE_NAME, PRICE_TEXT, f"cast({idiv('pence', 100)} as string)",
        "lpad(cast(pence % 100 as string), 2, '0')", stock, TRACKING, "cast(pence as string)",
    ]
    return entry, F.expr(f"format_string({_map(ITEMS)}[{KIND}], {', '.join(values)})")


def _map(values: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{quote(k)}, {quote(v)}" for k, v in values.items()) + ")"


def _page_partitions(spark: SparkSession) -> int:
    """Partitions of pages: some for every core.

    Adaptive execution merges those it may merge by their bytes, but reading a page costs far more
    than its bytes say: a few tasks would read all cards while other cores wait.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def captures(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies of the listing view; some pages are unreadable and some items lack their id."""
    entry, item = item_text()
    pages = (
        listing(spark, sf)
        .withColumn("_entry", entry)
        .select("shop", "page", "seq", "date", item.alias("item"))
        .repartition(_page_partitions(spark), "shop", "page")
        .groupBy("shop", "page")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "item"))).alias("items"), F.min("date").alias("captured_at"))
    )
    is_page = F.col("shop").isin("JOHN_LEWIS", "MS")
    script = "<script>window.zara.dataLayer = {oops};window.zara.viewPayload = window.zara.dataLayer</script>"
    broken = F.when(is_page, "<html>").when(F.col("shop") == "ZARA", script).otherwise("oops")
    heads = F.expr(_map({s: b[0] for s, b in BODIES.items()}) + "[shop]")
    tails = F.expr(_map({s: b[1] for s, b in BODIES.items()}) + "[shop]")
    whole = F.concat(heads, F.when(is_page, F.concat_ws(" ", "items.item")).otherwise(F.concat_ws(",", "items.item")), tails)
    out = pages.withColumn("body", F.when(F.expr(BAD_PAGE), broken).otherwise(whole))
    levels = {k: F.expr(v) for k, v in capture_columns(SPARK).items()}
    return out.withColumns(levels).select(
        "shop", F.col("c1").alias("taxo1"), F.col("c2").alias("taxo2"), F.col("c3").alias("taxo3"),
        F.lit(None).cast("string").alias("taxo4"), "leaf", "url", F.lit(0).cast("bigint").alias("link_pos"),
        F.col("page").alias("page_seq"), "body", "captured_at",
    )
