"""Stored JSON bodies to product rows.

Each shop's body shape is a :class:`Payload`, plain data. All shops are flattened in one plan:
the shop column selects the paths, the body is parsed once to VARIANT, and one explode yields the
items. Records that lack a required entry leave with a reason instead of failing the run. Missing
and null differ: a JSON null is an entry, a missing key is not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.conditions import by_shop, member
from shelfwatch.functions.levels import level_array, tracking_parts
from shelfwatch.operators.dedup import keep_first
from shelfwatch.operators.lookup import lookup_with_fallback
from shelfwatch.operators.quality import log_rows
from shelfwatch.schema import INFORMATION, MEDIUM, MINOR, TAXO
from shelfwatch.sources.pages import DATA_LAYER

# How a price is written: a number or number text; a text with one sign in front; a list of such
# texts of which the smallest counts; two whole numbers.
NUMBER, SIGNED, SMALLEST, PARTS = "number", "signed", "smallest", "parts"


@dataclass(frozen=True)
class Payload:
    """Paths of one shop's body.

    ``entries`` must be present (null is fine), ``texts`` must also not be null, ``page_entries``
    must be present in the body itself. Where the entry ``switch`` is absent, ``name_else`` and
    ``price_else`` are read in place of ``name`` and ``price``.
    """

    items: str
    id: str
    name: str
    price: str
    price_kind: str = NUMBER
    price_pence: str | None = None
    reference: str | None = None
    url: str | None = None
    url_prefix: str | None = None
    switch: str | None = None
    name_else: str | None = None
    price_else: str | None = None
    stock: str | None = None
    stock_is: str | None = None  # in stock if the text at ``stock`` is this
    stock_not: str | None = None  # in stock unless it is this
    page_entries: Sequence[str] = ()
    entries: Sequence[str] = ()
    texts: Sequence[str] = ()
    else_entries: Sequence[str] = ()  # needed where ``switch`` is absent
    else_note: str | None = None  # reason if the first of them is missing
    items_optional: bool = False
    script: str | None = None  # the body is a page; the object is assigned in a script
    group: str | None = None  # a body without this entry is noted as having no elements


NO_ELEMENTS = "no elements"
NO_PRICE = "no price/name"

# Body shapes and link prefixes.
PAYLOADS = {
    "ASOS": Payload(
        items="$.products", id="$.id", reference="$.productCode",
        name="$.title", switch="$.title", name_else="$.name",
        price="$.price.current.value", price_else="$.price.current.value",
        url="$.url", url_prefix="https://www.asos.com/", page_entries=("$.itemCount",),
        entries=("$.id", "$.productCode", "$.price.current.value"), texts=("$.url",),
        else_entries=("$.name",),
    ),
    "GAP": Payload(
        items="$.productHits", id="$.id", reference="$.uuid", name="$.name",
        price="$.prices", price_kind=SMALLEST,
        entries=("$.id", "$.uuid", "$.name"), texts=("$.prices",),
    ),
    "NEWLOOK": Payload(
        items="$.data.results", id="$.code", name="$.name", price="$.price.value",
        url="$.url", url_prefix="https://www.newlook.com/",
        stock="$.stock.stockLevelStatus.code", stock_not="outOfStock",
        page_entries=("$.data.pagination.numberOfPages",),
        entries=("$.code", "$.name", "$.price.value", "$.stock.stockLevelStatus.code"),
        texts=("$.url",),
    ),
    "PRIMARK": Payload(
        items="$.Products", id="$.BusinessId", reference="$.Sku", name="$.Title",
        price="$.PriceInteger", price_kind=PARTS, price_pence="$.PriceDecimal", url_prefix="",
        entries=("$.BusinessId", "$.Sku", "$.Title"), texts=("$.PriceInteger", "$.PriceDecimal"),
    ),
    "HM": Payload(
        items="$.products", id="$.articleCode", name="$.title", price="$.price", price_kind=SIGNED,
        url="$.swatches[0].articleLink", url_prefix="https://www2.hm.com/",
        stock="$.outOfStockText", stock_is="",
        entries=("$.articleCode", "$.title", "$.outOfStockText"),
        texts=("$.favouritesTracking", "$.price", "$.swatches[0].articleLink"),
    ),
    "TKMAXX": Payload(
        items="$.results", id="$.code", name="$.label", price="$.price.value",
        url="$.url", url_prefix="https://www.tkmaxx.com/uk/",
        stock="$.stockLevelStatus", stock_is="inStock",
        page_entries=("$.pagination.numberOfPages",),
        entries=("$.code", "$.label", "$.price.value", "$.stockLevelStatus"), texts=("$.url",),
        items_optional=True,
    ),
    "ZARA": Payload(
        items="$.productGroups[0].products", id="$.id", reference="$.detail.reference",
        name="$.name", price="$.price", switch="$.price",
        name_else="$.bundleProductSummaries[0].name", price_else="$.bundleProductSummaries[0].price",
        url_prefix="", entries=("$.id", "$.detail.reference"),
        else_entries=(
            "$.bundleProductSummaries[0]", "$.bundleProductSummaries[0].name",
            "$.bundleProductSummaries[0].price",
        ),
        else_note=NO_PRICE, script=DATA_LAYER, group="$.productGroups",
    ),
}
HM_DENIED_LEVEL2 = ("BASICS_BASICS",)
HM_DENIED_LEVEL3 = (" BASICS_VIEW_ALL", "BEST BASICS_VIEW_ALL", "BESTBASICS")
HM_TRACKING = "$.favouritesTracking"
ZARA_LINK = "$.marketingMetaInfo.mappingInfo[0].regions[0].link.id"


def text_at(doc: Column, path: str | Column) -> Column:
    return F.try_variant_get(doc, path, "string")


def has(doc: Column, path: str | Column) -> Column:
    """The entry exists, be it null or not."""
    return F.try_variant_get(doc, path, "variant").isNotNull()


def choose_field(doc: Column, path: str, other: str) -> Column:
    """Entry at ``path`` if it exists (even if null), else the entry at ``other``."""
    return F.when(has(doc, path), text_at(doc, path)).otherwise(text_at(doc, other))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(branches: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    if not branches:
        return otherwise
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + f" ELSE {otherwise} END"


def _shops(names: Sequence[str]) -> str:
    return f"shop IN ({', '.join(map(_text, names))})" if names else "false"


class Record:
    """SQL expressions over one opened item: every path a shop uses, read once, as a column.

    All paths are constants, so none is parsed per row; a path is read only for the shops that use
    it, and later expressions refer to plain columns.
    """

    def __init__(self, payloads: dict[str, Payload]):
        self.payloads = payloads
        self.users: dict[str, list[str]] = {HM_TRACKING: ["HM"], ZARA_LINK: ["ZARA"]}
        for shop, p in payloads.items():
            single = (p.id, p.name, p.price, p.price_pence, p.reference, p.url, p.switch, p.name_else, p.price_else, p.stock)
            used = dict.fromkeys([*(x for x in single if x), *p.entries, *p.texts, *p.else_entries])
            for path in used:
                shops = self.users.setdefault(path, [])
                shops.extend({shop} - set(shops))
        self.slots = {path: f"_e{i}" for i, path in enumerate(self.users)}

    def open(self, items: DataFrame, item: str) -> DataFrame:
        read = [
            f"IF({_shops(self.users[path])}, try_variant_get({item}, '{path}', 'variant'), NULL) AS {slot}"
            for path, slot in self.slots.items()
        ]
        return items.selectExpr(*[c for c in items.columns if c != item], *read)

    def has(self, path: str) -> str:
        """The entry exists, be it null or not."""
        return f"{self.slots[path]} IS NOT NULL"

    def lacks_value(self, path: str) -> str:
        return f"({self.slots[path]} IS NULL OR is_variant_null({self.slots[path]}))"

    def text(self, path: str) -> str:
        return f"try_cast({self.slots[path]} AS STRING)"

    def pick(self, trait: Callable[[Payload], str | None], make: Callable[[str], str]) -> str:
        """``make`` of the path each shop has for a trait; shops with the same path share a branch."""
        groups: dict[str, list[str]] = {}
        for shop, p in self.payloads.items():
            if trait(p) is not None:
                groups.setdefault(trait(p), []).append(shop)
        return _case([(_shops(shops), make(path)) for path, shops in groups.items()])

    def price(self, plain: str) -> str:
        """Price by the way each shop writes it; ``plain`` is the text at the price path."""
        pence = self.pick(lambda p: p.price_pence, self.text)
        listed = self.pick(
            lambda p: p.price if p.price_kind == SMALLEST else None,
            lambda path: f"transform(try_cast({self.slots[path]} AS ARRAY<VARIANT>), n -> try_variant_get(n, '$.value', 'string'))",
        )
        kinds = {
            SMALLEST: f"array_min(transform(filter({listed}, t -> t IS NOT NULL), t -> substring(t, 2)))",
            PARTS: f"try_cast({plain} AS INT) * 100 + try_cast({pence} AS INT)",
            SIGNED: f"substring({plain}, 2)",
        }
        branches = []
        for kind, value in kinds.items():
            shops = [s for s, p in self.payloads.items() if p.price_kind == kind]
            if shops:
                branches.append((_shops(shops), f"try_cast({value} AS DOUBLE)"))
        return _case(branches, f"try_cast({plain} AS DOUBLE)")

    def in_stock(self) -> str:
        """In stock or not; shops whose lists hold available products only say true."""
        branches = []
        for shop, p in self.payloads.items():
            if p.stock_is is not None:
                flag = f"coalesce({self.text(p.stock)} = {_text(p.stock_is)}, false)"
                branches.append((_shops([shop]), flag))
            elif p.stock_not is not None:
                branches.append((_shops([shop]), f"NOT ({self.text(p.stock)} <=> {_text(p.stock_not)})"))
        return _case(branches, "true")

    def reason(self, switched: str, price: str) -> str:
        """Why a record is refused, null if it is fine. ``switched``: the other entries are read."""
        branches = []
        for shop, p in self.payloads.items():
            checks = []
            if p.else_note:
                checks.append((f"{switched} AND NOT {self.has(p.else_entries[0])}", p.else_note))
                checks.append((f"NOT {switched} AND NOT {self.has(p.name)}", f"missing {p.name}"))
            checks += [(f"NOT {self.has(x)}", f"missing {x}") for x in p.entries]
            checks += [(self.lacks_value(x), f"missing {x}") for x in p.texts]
            checks += [(f"{switched} AND NOT {self.has(x)}", f"missing {x}") for x in p.else_entries]
            if p.price_kind == PARTS:
                checks.append((f"{price} IS NULL", "price is not a number"))
            branches.append((_shops([shop]), _case([(test, _text(note)) for test, note in checks])))
        return _case(branches)


def _array(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "array<variant>")


def parse_bodies(captures: DataFrame, payloads: dict = PAYLOADS, body: str = "body") -> DataFrame:
    """Items of each body and, for an unreadable page, ``page_reason``.

    A page without the script that should carry the object has neither.
    """
    scripts = {s: F.regexp_extract(body, p.script, 1) for s, p in payloads.items() if p.script}
    bad, items = [], []
    for shop, p in payloads.items():
        lacks = lambda path: f"try_variant_get(_doc, '{path}', 'variant') IS NULL"
        checks = [("_doc IS NULL", "not JSON")]
        checks += [(lacks(p.group), NO_ELEMENTS)] if p.group else []
        checks += [(lacks(x), f"missing {x}") for x in p.page_entries]
        checks += [] if p.items_optional else [("_items IS NULL", f"missing {p.items}")]
        bad.append((_shops([shop]), _case([(test, _text(note)) for test, note in checks])))
        items.append((_shops([shop]), f"try_variant_get(_doc, '{p.items}', 'array<variant>')"))
    no_script = f"({_shops(list(scripts))} AND _found = '')"
    return (
        captures.where(_shops(list(payloads)))
        .withColumn("_found", F.coalesce(by_shop(scripts, F.col(body)), F.lit("")))
        .withColumn("_doc", F.try_parse_json("_found"))
        .withColumn("_items", F.expr(_case(items)))
        .withColumn("page_reason", F.expr(_case([(f"NOT {no_script}", _case(bad))])))
        .drop(body, "_found", "_doc")
    )


def flatten(captures: DataFrame, payloads: dict = PAYLOADS, body: str = "body") -> DataFrame:
    """One row per item with ``reason`` (null if the record is good), and one row with ``page_lost``
    per unreadable page."""
    pages = parse_bodies(captures, payloads, body)
    kept = [c for c in pages.columns if c not in ("_items", "page_reason")]
    items = pages.selectExpr(
        *kept, "page_reason", "posexplode_outer(IF(page_reason IS NULL, _items, NULL)) AS (pos, _item)"
    ).where("_item IS NOT NULL OR page_reason IS NOT NULL")
    rec = Record(payloads)
    switch = rec.pick(lambda p: p.switch, lambda path: f"NOT {rec.has(path)}")
    opened = rec.open(items, "_item").selectExpr("*", f"coalesce({switch}, false) AS _else")

    def either(first, other) -> str:
        return f"IF(_else, {rec.pick(other, rec.text)}, {rec.pick(first, rec.text)})"

    prefix, linked = rec.pick(lambda p: p.url_prefix, _text), rec.pick(lambda p: p.url, rec.text)
    has_url = _shops([s for s, p in payloads.items() if p.url])
    priced = opened.selectExpr("*", f"{rec.price(either(lambda p: p.price, lambda p: p.price_else))} AS _price")
    fields = {
        "id": rec.pick(lambda p: p.id, rec.text),
        "reference": rec.pick(lambda p: p.reference, rec.text),
        "name": either(lambda p: p.name, lambda p: p.name_else),
        "price": "_price",
        "inStock": rec.in_stock(),
        "product_url": f"IF({has_url}, concat({prefix}, {linked}), {prefix})",
        "tracking": rec.text(HM_TRACKING),
        "link_id": rec.text(ZARA_LINK),
        "reason": f"coalesce(page_reason, {rec.reason('_else', '_price')})",
        "page_lost": "page_reason IS NOT NULL",
    }
    row = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    # One generated row per item: a filter on a generated column stays above this step. Pushed
    # below, it would repeat the parsing and reading of the body once per use of an entry.
    return priced.selectExpr(*kept, "pos", f"inline(array(named_struct({row})))")


def good_rows(flat: DataFrame) -> DataFrame:
    """Valid products, without the listings one shop marks as collections of basics.

    ``tracked`` holds the parts of that shop's tracking text.
    """
    good = flat.where(F.col("reason").isNull()).withColumn(
        "tracked", F.when(F.col("shop") == "HM", tracking_parts(F.col("tracking")))
    )
    denied = member(F.get("tracked", F.lit(1)), HM_DENIED_LEVEL2) | member(F.get("tracked", F.lit(2)), HM_DENIED_LEVEL3)
    return good.where(~denied)


def rejects(flat: DataFrame, url: str = "url") -> DataFrame:
    """(level, shop, message, url) of bad records and unreadable pages."""
    level = (
        F.when(F.col("reason").isin(NO_ELEMENTS, NO_PRICE), INFORMATION)
        .when(F.col("page_lost"), MEDIUM)
        .otherwise(MINOR)
    )
    return log_rows(flat.where(F.col("reason").isNotNull()), level, F.col("reason"), url)


def with_levels(rows: DataFrame) -> DataFrame:
    """taxo1..taxo4 of a product from its category and the leaf (facet) it was listed under."""
    t1, t2, t3, t4, leaf = (F.col(c) for c in (*TAXO, "leaf"))
    parts = by_shop(
        {
            "HM": F.concat(F.array(t1), F.slice("tracked", 2, 3)),
            "GAP": level_array([t1, t2, t3, t4], leaf),
            "TKMAXX": level_array([t1, t2, t3, t3], leaf),
            "PRIMARK": F.array(t1, t2, t3),
        },
        level_array([t1, t2, t3], leaf),
    )
    placed = rows.withColumn("_levels", parts)
    return placed.withColumns({c: F.get("_levels", F.lit(i)) for i, c in enumerate(TAXO)}).drop("_levels")


def facet_codes(body: Column, facet: str = "style") -> Column:
    """Codes of one facet of a stored JSON body, null if it has none.

    The category is then listed once per code, or as a whole.
    """
    groups = F.filter(_array(F.try_parse_json(body), "$.facets"), lambda g: text_at(g, "$.code") == facet)
    codes = F.flatten(
        F.transform(
            groups,
            lambda g: F.transform(
                F.coalesce(_array(g, "$.values"), F.array().cast("array<variant>")), lambda v: text_at(v, "$.code")
            ),
        )
    )
    return F.when(F.size(codes) > 0, codes)


def style_facets(pages: DataFrame, body: str = "body", facet: str = "style", out: str = "leaf") -> DataFrame:
    """One row per code of the facet: (pos, leaf); one row with nulls if there is none.

    Only categories with fewer than four known levels are split; the third level counts twice, as
    it fills the fourth.
    """
    known = F.size(F.array_compact(F.array(*[F.col(c) for c in (*TAXO[:3], TAXO[2])])))
    codes = F.when(known < 4, facet_codes(F.col(body), facet))
    return pages.select(*[c for c in pages.columns if c != body], F.posexplode_outer(codes).alias("pos", out))


def sub_categories(filters: DataFrame, body: str = "body") -> DataFrame:
    """(shop, url, product_id, category) from the stored filter bodies of category pages.

    Of several sub-categories of a product the first one listed counts.
    """
    doc = F.try_parse_json(body)
    groups = filters.select("shop", "url", "page_seq", F.posexplode(_array(doc, "$.filters")).alias("p1", "g"))
    values = groups.where(text_at(F.col("g"), "$.id") == "features").select(
        "shop", "url", "page_seq", "p1", F.posexplode(_array(F.col("g"), "$.value")).alias("p2", "v")
    )
    entries = values.select(
        "shop", "url", "page_seq", "p1", "p2",
        text_at(F.col("v"), "$.value").alias("category"),
        F.posexplode(_array(F.col("v"), "$.catentries")).alias("p3", "e"),
    ).withColumn("product_id", F.col("e").try_cast("string"))
    return keep_first(entries, ["shop", "url", "product_id"], ["page_seq", "p1", "p2", "p3"]).select(
        "shop", "url", "product_id", "category"
    )


def with_sub_category(rows: DataFrame, lookup: DataFrame, shop: str = "ZARA") -> DataFrame:
    """Leaf of one shop's products from its sub-categories: own id first, then the linked id."""
    mine = rows.where(F.col("shop") == shop).drop("leaf")
    found = lookup_with_fallback(mine, lookup, "id", "link_id", "product_id", "category", "leaf", ("shop", "url"))
    return rows.where(~F.col("shop").eqNullSafe(F.lit(shop))).unionByName(found)


def find_key(body: Column, key: str) -> Column:
    """Every value under ``key`` at any depth, arrays in arrays included, as JSON texts, nested matches first.

    Built-in functions can't follow an object of unknown depth in one pass, so an Arrow-batched
    function parses each body and walks it with a stack of its own. Bodies too deep for the
    parser are read token by token instead, so depth is bounded by the body alone. Bodies that are
    not a JSON object give null. The function is self-contained, so workers need nothing but pandas.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def walk(bodies: pd.Series) -> pd.Series:
        import json
        import re

        encode = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode
        other = object()

        def refuse(name: str):
            raise ValueError(name)

        def found(text: str | None) -> list | None:
            try:
                doc = json.loads(text or "", parse_constant=refuse)
                return hits_of(doc) if isinstance(doc, dict) else None
            except RecursionError:
                return found_by_token(text)
            except ValueError:
                return None

        def hits_of(doc: dict) -> list:
            hits, stack = [], [(other, iter(doc.items()))]  # a value to note when done, and what it holds
            while stack:
                noted, entries = stack[-1]
                for name, value in entries:
                    hit = value if name == key else other
                    if isinstance(value, dict):
                        stack.append((hit, iter(value.items())))
                        break
                    if isinstance(value, list):
                        stack.append((hit, ((None, v) for v in value)))
                        break
                    if hit is not other:
                        hits.append(encode(hit))
                else:
                    stack.pop()
                    if noted is not other:
                        hits.append(encode(noted))
            return hits

        token = re.compile(r'\s*(?:("(?:[^"\\\x00-\x1f]|\\.)*")|([{}\[\],:])|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null))')
        # what may follow in an object or array: its first entry, a further one, or what comes after an entry
        value, name, colon, after, closed = range(5)

        def found_by_token(text: str) -> list | None:
            out: list[str] = []  # the body again, without blanks
            hits, stack = [], []  # stack: closing sign, place of the matching value or None
            state, at, start, may_close = value, 0, None, False
            end = len(text.rstrip())
            while at < end:
                m = token.match(text, at)
                if not m or state == closed:
                    return None
                at = m.end()
                string, sign, plain = m.groups()
                if state == name:
                    if string is not None:
                        try:
                            wanted = json.loads(string) == key
                        except ValueError:
                            return None
                        out.append(string)
                        start, state = (len(out) + 1 if wanted else None), colon
                        continue
                    if sign != "}" or not may_close:
                        return None
                elif state == colon:
                    if sign != ":":
                        return None
                    out.append(":")
                    state = value
                    continue
                elif state == after:
                    if sign == ",":
                        out.append(",")
                        state, may_close, start = (name if stack[-1][0] == "}" else value), False, None
                        continue
                    if sign != stack[-1][0]:
                        return None
                elif sign in ("{", "["):
                    if not stack and sign == "[":
                        return None
                    stack.append(("}" if sign == "{" else "]", start))
                    out.append(sign)
                    state, start, may_close = (name if sign == "{" else value), None, True
                    continue
                elif sign is not None and not (sign == "]" and may_close and stack and stack[-1][0] == "]"):
                    return None
                if sign in ("}", "]"):
                    out.append(sign)
                    start = stack.pop()[1]
                elif not stack:
                    return None
                else:
                    out.append(encode(json.loads(string)) if string is not None else encode(json.loads(plain)))
                if start is not None:
                    hits.append((start, len(out)))
                state, start, may_close = (after if stack else closed), None, False
            return ["".join(out[i:j]) for i, j in hits] if state == closed else None

        return bodies.map(found, na_action="ignore")

    return walk(body)
