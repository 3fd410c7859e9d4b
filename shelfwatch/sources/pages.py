"""Stored HTML pages: links, product cards, filter facets, menus, embedded JSON.

Pages are not well-formed, so all extraction is by pattern (``xpath`` would abort the job): names
in any case, attributes in double, single or no quotes (a ``>`` inside them ends no tag), all
character references decoded. Patterns are parameters;
the page-specific ones of the tracked shops are defaults.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions.conditions import by_shop
from shelfwatch.functions.text import first_group, min_price_number, price_in_text, strip
from shelfwatch.operators.quality import log_rows
from shelfwatch.schema import INFORMATION

#: the rest of a tag up to its end: a ``>`` in a quoted value is no end
INSIDE = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
#: the attributes before the one that a pattern goes on with
BEFORE = r"""(?:\s+[^\s>"'=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']*))?)*?"""
LINK = rf"(?is)<a\s{INSIDE}>.*?</a>"
LINK_OPEN = rf"(?is)^<a\s{INSIDE}>"
LINK_TEXT = rf"(?is)^<a\s{INSIDE}>([^<]*)"
TAG = rf"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|</?[a-z]{INSIDE}>"
#: a character reference at the start of what follows an ampersand
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*)(;?)"
#: names that pages use most come first, as a constant map is searched in its order
COMMON = ("amp", "nbsp", "pound", "quot", "apos", "lt", "gt", "rsquo", "eacute", "euro")


def _names() -> Column:
    """The named references of HTML and the texts they stand for."""
    names = {n[:-1]: text for n, text in html5.items() if n.endswith(";")}
    ordered = {n: names[n] for n in COMMON} | names
    listed = "\x01".join(f"{n}\x02{plain}" for n, plain in ordered.items())
    return F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))  # one constant for the optimizer to fold


def _character(code: Column) -> Column:
    """The character of a code point; the replacement character if there is none."""
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def unescape(col: Column) -> Column:
    """All character references decoded, once: by name (with ``;``), by decimal and by hexadecimal code.

    What is no reference stays as it is.
    """
    names = _names()

    def decoded(part: Column) -> Column:
        ref, end = F.regexp_extract(part, REFERENCE, 1), F.regexp_extract(part, REFERENCE, 2)
        plain = (
            F.when(ref.rlike("^#[xX]"), _character(F.conv(F.substring(ref, 3, 6), 16, 10).cast("long")))
            .when(F.startswith(ref, F.lit("#")), _character(F.substring(ref, 2, 7).try_cast("long")))
            .when(end == ";", F.element_at(names, ref))
        )
        rest = F.substr(part, F.length(ref) + F.length(end) + 1)
        return F.coalesce(F.concat(plain, rest), F.concat(F.lit("&"), part))

    parts = F.split(col, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))), decoded)
    return F.when(F.contains(col, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(col)


def attribute_pattern(name: str) -> str:
    """An attribute with its value in group 1, 2 or 3: double quotes, single quotes, none."""
    return rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name as it is written; null if there is none."""
    found = F.get(F.regexp_extract_all(tag, F.lit(attribute_pattern(name)), F.lit(0)), F.lit(0))  # the only search
    return F.regexp_replace(found, r"""^[^=]+=\s*["']?|["']\z""", "")


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of the first attribute of that name in a tag or fragment; null if there is none."""
    return unescape(raw_attribute(tag, name))


def has_class(token: str) -> str:
    """Pattern of a class attribute that has ``token`` among its names."""
    return rf"""\sclass\s*=\s*(?:"(?:[^"]*\s)?{token}(?:\s[^"]*)?"|'(?:[^']*\s)?{token}(?:\s[^']*)?'|{token}(?=[\s>]))"""


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """All links of each page in order: (pos, href, text).

    ``text`` is what stands before the link's first child, null if nothing does.
    """
    tags = F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(0))
    exploded = pages.select(*[c for c in pages.columns if c != html], F.posexplode(tags).alias("pos", "_tag"))
    opening = F.regexp_extract("_tag", LINK_OPEN, 0)
    return exploded.withColumns(
        {"href": attribute(opening, "href"), "text": unescape(F.nullif(strip(F.regexp_extract("_tag", LINK_TEXT, 1)), F.lit("")))}
    ).drop("_tag")


# fixed values: the page variable that carries the products of one shop
DATA_LAYER = (
    r"(?s)window\.zara\.dataLayer\s+=\s+(\{.*?\});window\.zara\.viewPayload = window\.zara\.dataLayer"
)
CATEGORY_GROUP = r'"catGroupId":[0-9]+,'


def embedded_json(html: Column, pattern: str = DATA_LAYER) -> Column:
    """Object assigned in a page script, as VARIANT; null if absent or not JSON."""
    return F.try_parse_json(first_group(html, pattern))


@dataclass(frozen=True)
class Card:
    """Patterns for one kind of product card. ``price`` may match several times per card."""

    card: str
    id: str  # attribute of the card's own tag, or with ``id_in_link`` a pattern on the link
    name: str
    price: str
    base_url: str = ""
    id_in_link: bool = False
    smallest_price: bool = True  # else the last one


# fixed values: card markup of the two shops that are read from HTML
CARDS = {
    "JOHN_LEWIS": Card(
        card=rf"(?is)<section\b(?={BEFORE}{has_class('product-card')}).*?</section>",
        id="data-product-id",
        name=rf"(?is)<h2{INSIDE}>([^<]*)",
        price=rf"""(?is)\sclass\s*=\s*(?:"product-card__price[^"]*"|'product-card__price[^']*'|product-card__price[^\s>]*){INSIDE}>([^<]*)<""",
        base_url="https://www.johnlewis.com/",
    ),
    "MS": Card(
        card=rf"(?is)<a\b(?={BEFORE}{has_class('product')}).*?</a>",
        id=r"(?i)/p/([a-zA-Z0-9]+)",
        name=rf"(?is){has_class('product__title')}{INSIDE}>([^<]*)",
        price=rf"(?is){has_class('product__price')}{INSIDE}>(?:<{INSIDE}>)*([^<]*)<",
        base_url="https://www.marksandspencer.com/",
        id_in_link=True,
        smallest_price=False,
    ),
}
NO_CARDS = "no product cards"
CARD_FIELDS = ("url", "id", "name", "price", "bad_price")


def product_cards(pages: DataFrame, specs: dict[str, Card] = CARDS, html: str = "html") -> DataFrame:
    """One row per card: (pos, id, name, price, url, bad_price). The row's shop selects the patterns.

    ``bad_price`` says that a price text of the card has no number. A page without cards keeps one
    row with a null ``pos``.
    """

    def each(make) -> Column:
        return by_shop({shop: make(spec) for shop, spec in specs.items()})

    cards = each(lambda s: F.regexp_extract_all(F.col(html), F.lit(s.card), F.lit(0)))
    mine = pages.where(F.col("shop").isin(list(specs)))
    kept = [c for c in pages.columns if c != html and c.lower() not in CARD_FIELDS]
    out = mine.select(*kept, F.posexplode_outer(cards).alias("pos", "_card"))
    # A tag, a raw value or a decoded one is used several times by what follows: each is a column of its own.
    out = out.withColumn("_own", F.regexp_extract("_card", rf"(?is)^<{INSIDE}>", 0))
    link = F.when(F.col("_own").rlike(r"(?i)^<a\s"), F.col("_own")).otherwise(F.regexp_extract("_card", rf"(?is)<a\s{INSIDE}>", 0))
    out = out.withColumn("_link", link).withColumns(
        {
            "_href": raw_attribute(F.col("_link"), "href"),
            "_entry": each(lambda s: F.lit(None).cast("string") if s.id_in_link else raw_attribute(F.col("_own"), s.id)),
            "_name": strip(each(lambda s: F.regexp_extract("_card", s.name, 1))),
            "_prices": each(lambda s: F.regexp_extract_all(F.col("_card"), F.lit(s.price), F.lit(1))),
        }
    )
    out = out.withColumn("_url", F.concat(each(lambda s: F.lit(s.base_url)), unescape(F.col("_href"))))
    last = F.slice("_prices", F.greatest(F.size("_prices"), F.lit(1)), F.lit(1))
    fields = {
        "url": F.col("_url"),
        "id": each(lambda s: first_group(F.col("_url"), s.id) if s.id_in_link else F.nullif(unescape(F.col("_entry")), F.lit(""))),
        "name": unescape(F.col("_name")),
        "price": min_price_number(each(lambda s: F.col("_prices") if s.smallest_price else last)),
        "bad_price": F.exists("_prices", lambda t: price_in_text(t).isNull()),
    }
    # One generated row per card: a filter on a field stays above this step. Pushed below, it would
    # repeat the search for the field in the card once per use of the field.
    return out.select(*kept, "pos", F.inline(F.array(F.struct(*[fields[c].alias(c) for c in CARD_FIELDS]))))


# fixed values: facet families of one shop's category page, best first
FACETS = (
    r";:relevance:markDownIndicator:false:(category:[A-Za-z0-9 -]+)&#34;",
    r";:relevance:(category:[A-Za-z0-9 -]+)&#34;",
    r";:relevance:markDownIndicator:false:(styleCodes:[A-Za-z0-9 -]+)&#34;",
    r";:relevance:(styleCodes:[A-Za-z0-9 -]+)&#34;",
)


def facet_ladder(html: Column, patterns: Sequence[str] = FACETS) -> Column:
    """Matches of the first pattern that has any; null if none has."""
    found = []
    for p in patterns:
        hits = F.regexp_extract_all(html, F.lit(p), F.lit(1))
        found.append(F.when(F.size(hits) > 0, hits))
    return F.coalesce(*found)


def facets(pages: DataFrame, html: str = "html", patterns: Sequence[str] = FACETS, out: str = "leaf") -> DataFrame:
    """One row per facet of the page; a page without any keeps one row with a null facet."""
    return pages.select(
        *[c for c in pages.columns if c != html],
        F.posexplode_outer(facet_ladder(F.col(html), patterns)).alias("pos", out),
    )


@dataclass(frozen=True)
class Facets:
    """Markup of one shop's filter blocks.

    A block runs from a match of ``block`` to the next one. ``heading`` gives its title, ``items``
    the part with its entries (the whole block if empty), ``label`` and ``value`` what they hold;
    ``titles`` are tried in order, several names of one step together.
    """

    block: str
    heading: str
    label: str
    titles: tuple[tuple[str, ...], ...]
    value: str = ""
    items: str = ""
    counted: bool = False  # labels like "Jeans (12)"


# fixed values: filter blocks and their titles
FACET_BLOCKS = {
    "ASOS": Facets(
        block=rf"(?is)<div\b(?={BEFORE}{has_class('bybwbES')}){INSIDE}>",
        heading=rf"(?is)<div\b(?={BEFORE}{has_class('_3lFxFJi')}){INSIDE}>([^<]*)",
        label=rf"(?is)<div\b(?={BEFORE}{has_class('_2h_c2tR')}){INSIDE}>\s*<{INSIDE}>(?:\s*</{INSIDE}>)?\s*<{INSIDE}>([^<]*)",
        value=rf"""(?is)<div\b(?={BEFORE}{has_class('_2h_c2tR')}){INSIDE}>\s*<[^\s>]+{BEFORE}\svalue\s*=\s*["']?([^"'\s>]*)""",
        titles=(("Product Type",),),
    ),
    "JOHN_LEWIS": Facets(
        block=rf"(?is)<div\b(?={BEFORE}{has_class('faceted-filters-accordion')}){INSIDE}>",
        heading=rf"(?is)^\s*<{INSIDE}>([^<]*)",
        items=r"(?is)<ul\b.*?</ul>",
        label=rf"(?is)<a\s{INSIDE}>([^<]*)",
        value=rf"""(?is)<a{BEFORE}\shref\s*=\s*["']?([^"'\s>]*)""",
        titles=(("Product Type",),),
    ),
    "MS": Facets(
        block=rf"(?is)<li\b(?={BEFORE}{has_class('accordion__item')}){INSIDE}>",
        heading=rf"(?is)<h[1-6]{INSIDE}>\s*(?:<{INSIDE}>)?([^<]*)",
        items=r"(?is)<ul\b.*?</ul>",
        label=rf"(?is)<a\s{INSIDE}>([^<]*)",
        value=rf"""(?is)<a{BEFORE}\shref\s*=\s*["']?([^"'\s>]*)""",
        titles=(("Product Type",), ("Categories", "Category"), ("Style",)),
        counted=True,
    ),
}


def titled_entries(html: Column, spec: Facets, titles: Sequence[str]) -> Column:
    """(label, value) of all entries of all blocks with one of these titles, in page order; null if none.

    The stripped heading has to be the title itself, not only to have it in it.
    """
    parts = F.split(html, spec.block)
    blocks = F.filter(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))),
        lambda b: unescape(strip(F.regexp_extract(b, spec.heading, 1))).isin(list(titles)),
    )

    def entries(block: Column) -> Column:
        part = F.regexp_extract(block, spec.items, 0) if spec.items else block
        labels = F.regexp_extract_all(part, F.lit(spec.label), F.lit(1))
        values = F.regexp_extract_all(part, F.lit(spec.value), F.lit(1))
        return F.zip_with(
            labels, values,
            lambda a, b: F.struct(
                (label_without_count(unescape(a)) if spec.counted else strip(unescape(a))).alias("label"), unescape(b).alias("value")
            ),
        )

    found = F.filter(F.flatten(F.transform(blocks, entries)), lambda e: e["label"].isNotNull())
    return F.when(F.size(found) > 0, found)


def titled_facets(pages: DataFrame, specs: dict[str, Facets] = FACET_BLOCKS, html: str = "html") -> DataFrame:
    """One row per filter entry of a category page: (pos, leaf, value).

    Of a shop's title ladder the first step with any entry counts. A page without entries keeps
    one row with a null leaf, for the category is then listed as a whole.
    """
    ladders = {
        shop: F.coalesce(*[titled_entries(F.col(html), spec, step) for step in spec.titles]) for shop, spec in specs.items()
    }
    mine = pages.where(F.col("shop").isin(list(specs)))
    kept = [c for c in pages.columns if c != html]
    out = mine.select(*kept, F.posexplode_outer(by_shop(ladders)).alias("pos", "_e"))
    return out.select(*kept, "pos", F.col("_e.label").alias("leaf"), F.col("_e.value").alias("value"))


def label_without_count(col: Column) -> Column:
    """``Jeans`` of a filter label like ``Jeans (12)``; null without a count."""
    return first_group(strip(col), r"(.*).\(.*\)")


# fixed values: what a category page of a shop should have, once, and the notice if it has not
LISTED = {
    "GAP": rf"(?is)<a\b(?={BEFORE}{has_class('category-name')}){INSIDE}>",
    "HM": rf"(?is)<form\b(?={BEFORE}{has_class('js-product-filter-form')}){INSIDE}>",
    "ZARA": CATEGORY_GROUP,
}


def page_notices(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Category pages that list nothing, or not what they should, as log rows; a null page was not found."""
    found = F.coalesce(by_shop({s: F.size(F.regexp_extract_all(F.col(html), F.lit(p), F.lit(0))) for s, p in LISTED.items()}), F.lit(0))
    gap = F.when(F.col(html).isNull(), "error 404").when(found == 0, "empty page")
    hm = F.when(found == 0, "empty node").when(found > 1, "more than one node")
    message = by_shop({"GAP": gap, "HM": hm, "ZARA": F.when(found == 0, "No sub category")})
    noted = pages.where(F.col("shop").isin(list(LISTED))).withColumn("_message", message)
    return log_rows(noted.where(F.col("_message").isNotNull()), INFORMATION, F.col("_message"), url)


def attribute_values(pages: DataFrame, name: str, html: str = "html", out: str = "value") -> DataFrame:
    """One row per tag with the attribute, in page order, such as the menu codes of a page."""
    tags = F.filter(F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0)), lambda t: t.rlike(attribute_pattern(name)))
    values = F.transform(tags, lambda t: attribute(t, name))
    return pages.select(*[c for c in pages.columns if c != html], F.posexplode(values).alias("pos", out))


def menu_tree(pages: DataFrame, html: str = "html") -> DataFrame:
    """Nested menu entries (``li`` with ``data-name``) as (node, parent, name, url) rows, per page.

    A page is split into its tags; the running number of open ``li`` is the depth of each. An entry
    takes its link from its first child. One without name or link is no level of its own: what is
    below it belongs to the entry above. Nodes are numbered from 0 in each page, so callers keep
    them apart by the page's own columns.
    """
    kept = [c for c in pages.columns if c != html]
    tags = F.filter(
        F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0)), lambda t: t.rlike(r"(?i)^</?[a-z]") & ~t.rlike(r"(?i)^<(script|style)\b")
    )
    rows = pages.withColumn("_page", F.monotonically_increasing_id()).select(*kept, "_page", F.posexplode(tags).alias("_pos", "_tag"))
    order = Window.partitionBy("_page").orderBy("_pos")
    opens, closes = F.col("_tag").rlike(r"(?i)^<li[\s>/]"), F.col("_tag").rlike(r"(?i)^</li[\s>]")
    child = F.lead("_tag").over(order)
    link = F.when(~F.startswith(child, F.lit("</")), F.coalesce(attribute(child, "href"), attribute(child, "data-href")))
    marked = rows.withColumns({"_open": opens, "_name": attribute(F.col("_tag"), "data-name"), "_url": link}).where(opens | closes)
    marked = _depth(marked.withColumn("_step", F.when(F.col("_open"), 1).otherwise(-1)), "_all")
    # a close belongs to the last open of its depth
    level = Window.partitionBy("_page", "_all").orderBy("_pos")
    entry = F.when(F.col("_open"), F.col("_name").isNotNull() & F.col("_url").isNotNull())
    marked = marked.withColumn("_entry", F.last(entry, ignorenulls=True).over(level)).where("_entry")
    marked = _depth(marked, "_level")
    opened = marked.where("_open").withColumn("_node", F.row_number().over(order) - 1)
    # the parent is the last entry one level up that came before
    both = opened.withColumn("_role", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_key", F.col("_level") + F.col("_role"))
    near = Window.partitionBy("_page", "_key").orderBy("_pos")
    parent = F.last(F.when(F.col("_role") == 1, F.col("_node")), ignorenulls=True).over(near)
    return both.withColumn("_parent", parent).where("_role = 0").select(
        *kept, F.col("_node").alias("node"), F.col("_parent").alias("parent"), F.col("_name").alias("name"), F.col("_url").alias("url")
    )


def _depth(marked: DataFrame, out: str) -> DataFrame:
    """Running depth of opens and closes; an open and its close have the same one. Stray closes leave."""
    upto = Window.partitionBy("_page").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = marked.withColumn("_sum", F.sum("_step").over(upto))
    floor = summed.withColumn("_floor", F.least(F.min("_sum").over(upto), F.lit(0)))
    stray = (F.col("_step") < 0) & (F.col("_sum") == F.col("_floor")) & (
        F.coalesce(F.lag("_floor").over(Window.partitionBy("_page").orderBy("_pos")), F.lit(0)) > F.col("_floor")
    )
    depth = F.col("_sum") - F.col("_floor") + F.when(F.col("_step") < 0, 1).otherwise(0)
    return floor.withColumns({"_stray": stray, out: depth}).where("not _stray").drop("_sum", "_floor", "_stray")
