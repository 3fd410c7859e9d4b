"""Category lists per shop, over links and locations that customers' keys spell out, and notices of category pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwatch.checks.registry import query, text, texts
from shelfwatch.checks.views import DUCK, SPARK, pick, table
from shelfwatch.plans import categories as C
from shelfwatch.sources import pages as P

KEY = "c_custkey"


def step(n: int) -> str:
    return f"cast(floor({KEY} / {n}) as bigint)"


# pieces of a link: constant texts, and lists from which the key picks
LINKS = {
    "asos": (
        C.ASOS_HOME, (("men", "women", "x"), f"{KEY} % 3"), "/", (("jeans", "tops", "sale", "a b"), f"{step(3)} % 4"),
        "/cat/?cid=", f"cast({KEY} % 50 as string)", "&nlid=", f"cast({KEY} as string)",
    ),
    "john_lewis": (
        "/browse/", (("men", "women", "baby-child", "home"), f"{KEY} % 4"), "/", (("jeans", "_", "tops"), f"{step(4)} % 3"),
        "/", (("_", "N-1", "slim"), f"{step(12)} % 3"),
    ),
    "ms": (
        "/l/", (("men", "women", "kids", "lingerie", "home"), f"{KEY} % 5"), "/", (("jeans", "new-in", "bras"), f"{step(5)} % 3"),
        (("", "/slim"), f"{step(15)} % 2"), "?x=", f"cast({KEY} % 7 as string)",
    ),
    "primark": (
        (("men", "women", "kids", "home"), f"{KEY} % 4"), (("", ",Jeans", ",Tops"), f"{step(4)} % 3"), (("", ",Slim", ",Wide,More"), f"{step(12)} % 3"),
    ),
    "tkmaxx": (
        C.TKMAXX_HOME, (("men", "womens-gold-label", "Kids", "home"), f"{KEY} % 4"),
        (("", "/jeans", "/new-in-tops", "/beauty", "/x-holiday-shop", "/Fragrance+Grooming", "/formal-wear"), f"{step(4)} % 7"),
        (("", "/slim"), f"{step(28)} % 2"), "/c/", f"cast({KEY} as string)",
    ),
}
LABELS = (("Jeans", "New in", "View all", "Shaving & Beard", None), f"{step(7)} % 5")


def joined(name: str, dialect: str) -> str:
    parts = []
    for part in LINKS[name]:
        if isinstance(part, tuple):
            parts.append(pick(part[0], part[1], dialect))
        else:
            parts.append(part if part.startswith("cast(") else text(part))
    return f"concat({', '.join(parts)})"


def links(spark, sf, name: str, column: str):
    return table(spark, sf, "customer").selectExpr(
        f"'{name}' AS shop", f"{joined(name, SPARK)} AS {column}", f"{pick(*LABELS, SPARK)} AS text", f"{KEY} AS seq"
    )


def source(name: str) -> str:
    return f"links AS (SELECT '{name}' AS shop, {joined(name, DUCK)} AS href, {pick(*LABELS, DUCK)} AS text, {KEY} AS seq FROM customer)"


NOTHING = "cast(NULL AS VARCHAR)"


@query(
    "asos_categories",
    f"""SELECT shop, split_part(path, '/', 1) AS taxo1, split_part(path, '/', 2) AS taxo2, text AS taxo3, {NOTHING} AS taxo4, url, seq
        FROM (SELECT *, replace(url, {text(C.ASOS_HOME)}, '') AS path FROM (SELECT *, split_part(href, '&', 1) AS url FROM links))
        WHERE text IS NULL OR text NOT IN ({texts(C.ASOS_DENIED_LINKS)})""",
    (source("asos"),),
)
def asos_categories(spark, sf):
    return C.asos(links(spark, sf, "asos", "href"))


def _browsed(home: str, where: str, parts: str, name: str) -> tuple[str, str]:
    return (
        f"""SELECT shop, p[3] AS taxo1, p[4] AS taxo2, p[5] AS taxo3, {NOTHING} AS taxo4, url, min(seq) AS seq
            FROM (SELECT shop, seq, {parts} AS p, concat({text(home)}, href) AS url FROM ({where})) GROUP BY ALL""",
        source(name),
    )


_JL = _browsed(
    C.JOHN_LEWIS_HOME, "SELECT * FROM links WHERE split_part(href, '/', 3) IN ('men', 'women', 'baby-child')",
    "list_filter(string_split(href, '/'), lambda x: x <> '_')", "john_lewis",
)


@query("john_lewis_categories", _JL[0], _JL[1:])
def john_lewis_categories(spark, sf):
    return C.john_lewis(links(spark, sf, "john_lewis", "href"))


_MS = _browsed(
    C.MS_HOME,
    "SELECT * REPLACE (split_part(href, '?', 1) AS href) FROM links WHERE split_part(href, '/', 3) IN ('men', 'women', 'kids', 'lingerie') AND strpos(href, 'new-in') = 0",
    "string_split(href, '/')", "ms",
)


@query("ms_categories", _MS[0], _MS[1:])
def ms_categories(spark, sf):
    return C.ms(links(spark, sf, "ms", "href"))


@query(
    "primark_categories",
    f"""SELECT shop, p[1] AS taxo1, p[2] AS taxo2, p[3] AS taxo3, {NOTHING} AS taxo4, href AS url, min(seq) AS seq
        FROM (SELECT *, string_split(href, ',') AS p FROM links) WHERE p[1] IN ('men', 'women', 'kids') GROUP BY ALL""",
    (source("primark"),),
)
def primark_categories(spark, sf):
    return C.primark(links(spark, sf, "primark", "category"))


@query(
    "tkmaxx_categories",
    f"""SELECT shop, p[1] AS taxo1, p[2] AS taxo2, p[3] AS taxo3, p[4] AS taxo4, href AS url, seq
        FROM (SELECT shop, seq, href, string_split(replace(href, {text(C.TKMAXX_HOME)}, ''), '/') AS q, q[1:len(q) - 2] AS p FROM links)
        WHERE lower(p[1]) <> 'home' AND p[2] IS NOT NULL AND p[2] NOT IN ({texts(C.TKMAXX_DENIED_LEVEL2)})
          AND lower(p[2]) NOT IN ('new-in-tops', 'x-holiday-shop', 'fragrance+grooming')""",
    (source("tkmaxx"),),
)
def tkmaxx_categories(spark, sf):
    return C.tkmaxx(links(spark, sf, "tkmaxx", "loc"))


# --- notices of category pages ------------------------------------------------------------------

_EXTRA = {
    "GAP": "<a class=''x category-name'' href=''/c''>C</a>",
    "HM": "<form class=\"js-product-filter-form\" data-filtered-products-url=\"/p\"></form>",
    "ZARA": "<script>x={\"catGroupId\":12,}</script>",
}
_SHOP = (tuple(_EXTRA), "page_id % 3")


@query(
    "page_notices",
    f"""SELECT page_id, 'INFORMATION' AS level, shop, message FROM (
          SELECT page_id, shop, CASE
            WHEN shop = 'GAP' AND times = 3 THEN 'error 404' WHEN shop = 'GAP' AND times = 0 THEN 'empty page'
            WHEN shop = 'HM' AND times <> 1 THEN CASE WHEN times IN (0, 3) THEN 'empty node' ELSE 'more than one node' END
            WHEN shop = 'ZARA' AND times IN (0, 3) THEN 'No sub category' END AS message
          FROM (SELECT page_id, {pick(*_SHOP, DUCK)} AS shop, cast(floor(page_id / 3) AS BIGINT) % 4 AS times FROM pages))
        WHERE message IS NOT NULL""",
)
def page_notices(spark, sf):
    extra = F.expr("case shop " + " ".join(f"when '{s}' then {text(e.replace(chr(39) * 2, chr(39)))}" for s, e in _EXTRA.items()) + " end")
    rows = table(spark, sf, "pages").selectExpr("page_id", "html", f"{pick(*_SHOP, SPARK)} AS shop", "cast(floor(page_id / 3) as bigint) % 4 AS times")
    body = F.when(F.col("times") < 3, F.concat("html", F.repeat(extra, F.col("times").cast("int"))))
    found = P.page_notices(rows.select("page_id", "shop", F.col("page_id").cast("string").alias("url"), body.alias("html")))
    return found.select(F.col("url").cast("bigint").alias("page_id"), "level", "shop", "message")
