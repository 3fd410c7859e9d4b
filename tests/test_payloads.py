import datetime
import json

from pyspark.sql import functions as F

from shelfwatch.plans import collect
from shelfwatch.schema import CAPTURE
from shelfwatch.sources import payloads

NOW = datetime.datetime(2018, 9, 1, 7, 12, 3)


def capture(spark, *pages):
    rows = []
    for i, p in enumerate(pages):
        shop, body = p[0], p[1]
        levels = p[2] if len(p) > 2 else ("men", "tops", None, None)
        leaf = p[3] if len(p) > 3 else None
        rows.append((shop, *levels, leaf, f"https://c/{i}", 0, i, body if isinstance(body, (str, type(None))) else json.dumps(body), NOW))
    return spark.createDataFrame(rows, CAPTURE)


def raw(spark, *pages, filters=None):
    good, bad = collect.collect(capture(spark, *pages), filters)
    return good.orderBy("seq").collect(), sorted((r.level, r.shop, r.message) for r in bad.collect())


def test_asos(spark):
    body = {"itemCount": 4, "products": [
        {"id": 7, "productCode": "c", "title": "T", "name": "N", "price": {"current": {"value": 12.5}}, "url": "p/7"},
        {"id": 8, "productCode": None, "name": "N", "price": {"current": {"value": None}}, "url": "p/8"},
        {"id": 9, "productCode": "c", "title": None, "name": "N", "price": {"current": {"value": "3"}}, "url": "p/9"},
        {"id": 10, "productCode": "c", "title": "T", "price": None, "url": "p"},
        {"id": 11, "productCode": "c", "price": {"current": {"value": 1}}, "url": "p"},
        {"id": 12, "productCode": "c", "title": "T", "price": {"current": {"value": 1}}, "url": None},
    ]}
    rows, bad = raw(spark, ("ASOS", body, ("men", None, "jeans", None), "Slim"))
    assert [(r.id, r.reference, r.name, r.price, r.URL) for r in rows] == [
        ("7", "c", "T", 12.5, "https://www.asos.com/p/7"),
        ("8", None, "N", None, "https://www.asos.com/p/8"),
        ("9", "c", None, 3.0, "https://www.asos.com/p/9"),
    ]
    assert (rows[0].taxo1, rows[0].taxo2, rows[0].taxo3, rows[0].taxo4) == ("men", "jeans", "Slim", None)
    assert bad == [
        ("MINOR", "ASOS", "missing $.name"),
        ("MINOR", "ASOS", "missing $.price.current.value"),
        ("MINOR", "ASOS", "missing $.url"),
    ]


def test_gap_smallest_price_is_by_text(spark):
    body = {"productHits": [
        {"id": "1", "uuid": "u", "name": "n", "prices": [{"value": "£9.00"}, {"value": "£10.00"}, {}]},
        {"id": "2", "uuid": "u", "name": "n", "prices": []},
        {"id": "3", "uuid": "u", "name": "n"},
    ]}
    rows, bad = raw(spark, ("GAP", body))
    assert [(r.id, r.price, r.URL) for r in rows] == [("1", 10.0, None), ("2", None, None)]
    assert bad == [("MINOR", "GAP", "missing $.prices")]


def test_newlook_tkmaxx_stock(spark):
    def item(status):
        return {"code": "1", "name": "n", "price": {"value": 1.0}, "stock": {"stockLevelStatus": {"code": status}}, "url": "u"}

    page = {"data": {"pagination": {"numberOfPages": 1}, "results": [item("outOfStock"), item("lowStock")]}}
    tk = {"pagination": {"numberOfPages": 1}, "results": [
        {"code": "1", "label": "l", "price": {"value": 2}, "stockLevelStatus": s, "url": "u"} for s in ("inStock", "lowStock")
    ]}
    rows, bad = raw(spark, ("NEWLOOK", page), ("TKMAXX", tk, ("men", "a", "b", None), "Z"), ("TKMAXX", {"pagination": {"numberOfPages": 1}}))
    assert [r.inStock for r in rows] == [False, True, True, False]
    assert (rows[2].taxo3, rows[2].taxo4) == ("b", "b")  # level 3 fills the fourth place
    assert bad == []


def test_primark_and_hm(spark):
    primark = {"Products": [
        {"BusinessId": "1", "Sku": "s", "Title": "t", "PriceInteger": "12", "PriceDecimal": "05"},
        {"BusinessId": "2", "Sku": "s", "Title": "t", "PriceInteger": "x", "PriceDecimal": "05"},
    ]}
    def hm(code, track, stock="", price="£9.99"):
        return {"articleCode": code, "title": "t", "price": price, "outOfStockText": stock,
                "favouritesTracking": track, "swatches": [{"articleLink": "a"}]}

    page = {"products": [
        hm("1", "x|y: Shirts :  Polo"), hm("2", "x|y:BASICS_BASICS"), hm("3", "x|y:a:BESTBASICS"),
        hm("4", "y: BASICS : BASICS_VIEW_ALL", "Sold out"), hm("5", None), hm("6", "x", price=None),
    ]}
    rows, bad = raw(spark, ("PRIMARK", primark, ("men", "Jeans", "x", "y")), ("HM", page))
    assert [(r.shop, r.id, r.price, r.inStock, r.taxo2, r.taxo3, r.taxo4, r.URL) for r in rows] == [
        ("PRIMARK", "1", 1205.0, True, "Jeans", "x", None, ""),
        ("HM", "1", 9.99, True, "Shirts", "Polo", None, "https://www2.hm.com/a"),
        ("HM", "4", 9.99, False, "BASICS", "BASICS_VIEW_ALL", None, "https://www2.hm.com/a"),
    ]
    assert bad == [
        ("MINOR", "HM", "missing $.favouritesTracking"),
        ("MINOR", "HM", "missing $.price"),
        ("MINOR", "PRIMARK", "price is not a number"),
    ]


def zara_page(obj):
    text = obj if isinstance(obj, str) else json.dumps(obj)
    return f"<html><p>x<script>a;window.zara.dataLayer = {text};window.zara.viewPayload = window.zara.dataLayer;</script>"


def test_zara(spark):
    def item(i, **more):
        return {"id": i, "detail": {"reference": f"r{i}"}, **more}

    link = {"mappingInfo": [{"regions": [{"link": {"id": 99}}]}]}
    products = [
        item(1, name="a", price=1999), item(2, bundleProductSummaries=[{"name": "b", "price": 500}]),
        item(3, bundleProductSummaries=[]), item(4, price=1), item(5, name="e", price=2, marketingMetaInfo=link),
        {"id": 6, "name": "f", "price": 2}, item(7, name="g", price=3, marketingMetaInfo=link),
    ]
    pages = [
        ("ZARA", zara_page({"productGroups": [{"products": products}, {"products": [item(8, name="z", price=1)]}]}), ("MAN", "JEANS", None, None)),
        ("ZARA", zara_page({"other": 1})),
        ("ZARA", zara_page("{oops}")),
        ("ZARA", "<html>no script</html>"),
    ]
    body = {"filters": [
        {"id": "colour", "value": [{"value": "red", "catentries": [1]}]},
        {"id": "features", "value": [{"value": "Slim", "catentries": [1, 7]}, {"value": "Wide", "catentries": [1, 99]}]},
    ]}
    filters = spark.createDataFrame([("ZARA", "https://c/0", 0, json.dumps(body))], "shop string, url string, page_seq bigint, body string")
    rows, bad = raw(spark, *pages, filters=filters)
    assert [(r.id, r.reference, r.name, r.price, r.taxo3) for r in rows] == [
        ("1", "r1", "a", 1999.0, "Slim"), ("2", "r2", "b", 500.0, None),
        ("5", "r5", "e", 2.0, "Wide"), ("7", "r7", "g", 3.0, "Slim"),
    ]
    assert bad == [
        ("INFORMATION", "ZARA", "no elements"), ("INFORMATION", "ZARA", "no price/name"),
        ("MEDIUM", "ZARA", "not JSON"), ("MINOR", "ZARA", "missing $.detail.reference"),
        ("MINOR", "ZARA", "missing $.name"),
    ]


def test_unreadable_pages(spark):
    rows, bad = raw(
        spark, ("ASOS", "oops"), ("ASOS", {"products": []}), ("GAP", {"productHits": 3}), ("HM", None),
        ("NEWLOOK", {"data": {"results": []}}), ("PRIMARK", {"Products": []}),
    )
    assert rows == []
    assert bad == [
        ("MEDIUM", "ASOS", "missing $.itemCount"), ("MEDIUM", "ASOS", "not JSON"),
        ("MEDIUM", "GAP", "missing $.productHits"), ("MEDIUM", "HM", "not JSON"),
        ("MEDIUM", "NEWLOOK", "missing $.data.pagination.numberOfPages"),
    ]


def test_find_key(spark):
    docs = [
        {"link": {"a": 1, "link": "deep"}, "x": [{"link": [1]}, "text", 3], "y": {"z": {"link": None}}},
        [1], {"none": 1},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(3, "oops"), (4, None)], "i int, b string")
    got = {r.i: r.v for r in df.select("i", payloads.find_key(F.col("b"), "link").alias("v")).collect()}
    assert got == {0: ['"deep"', '{"a":1,"link":"deep"}', "[1]", "null"], 1: None, 2: [], 3: None, 4: None}


def test_gap_product_belongs_to_first_category(spark):
    def page(*ids):
        return {"productHits": [{"id": i, "uuid": "u", "name": "n", "prices": []} for i in ids]}

    rows, _ = raw(
        spark, ("GAP", page("1", "2"), ("sale", "x", None, None)), ("GAP", page("2", "3"), ("men", "jeans", None, None)),
        ("GAP", page("3"), ("men", "coats", None, None)),
    )
    assert sorted((r.id, r.taxo1, r.taxo2) for r in rows) == [("1", "sale", "x"), ("2", "men", "jeans"), ("3", "men", "coats")]


def test_clean_keeps_all_hm_listings(spark):
    def hm(track):
        return {"articleCode": "1", "title": "t", "price": "£1", "outOfStockText": "", "favouritesTracking": track, "swatches": [{"articleLink": "a"}]}

    def asos(i):
        return {"id": i, "productCode": "c", "name": "n", "price": {"current": {"value": 1}}, "url": "p"}

    rows, _ = collect.collect(capture(
        spark, ("HM", {"products": [hm("x|a: s"), hm("x|a: s")]}),
        ("ASOS", {"itemCount": 1, "products": [asos(1)]}, ("men", "outlet", None, None)),
        ("ASOS", {"itemCount": 1, "products": [asos(1)]}, ("men", "jeans", None, None)),
    ))
    got = sorted((r.shop, r.taxo2, r.taxo3) for r in collect.clean(rows).collect())
    assert got == [("ASOS", "jeans", "None"), ("HM", "s", None), ("HM", "s", None)]
    assert collect.clean(rows, hm_dedup=True).count() == 2
