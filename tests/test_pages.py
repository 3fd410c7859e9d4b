from pyspark.sql import functions as F

from shelfwatch.functions import levels as V
from shelfwatch.functions.text import first_group, item_count, min_price_number, min_price_text, page_count, price_in_text, strip
from shelfwatch.operators.lookup import tree_paths
from shelfwatch.sources import pages as P
from shelfwatch.sources import sitemaps


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(col(F.col("v"))).head()[0]


def test_prices(spark):
    cases = {"£35.00": 35.0, "35.00": 5.0, "£1,299.00": 1.0, "Now £12": 12.0, "from": None, "": None, None: None}
    for text, price in cases.items():
        assert one(spark, price_in_text, text) == price, text
    full = {"£1,299.00": 1299.0, "35.00": 35.0, "from": None}
    for text, price in full.items():
        assert one(spark, lambda c: price_in_text(c, thousands=True), text) == price
    texts = ["£9.00", None, "£10.00"]
    assert one(spark, min_price_text, texts, "array<string>") == "10.00"
    assert one(spark, min_price_number, texts, "array<string>") == 9.0
    assert one(spark, min_price_text, [], "array<string>") is None


def test_text(spark):
    assert one(spark, strip, "  \t a b \n") == "a b"
    assert one(spark, page_count, "<span>Page 1 of 12</span>") == 12
    assert one(spark, item_count, "305 Items, 2 items") == 305
    assert one(spark, lambda c: first_group(c, "x(.)"), "ab") is None


def test_links(spark):
    html = '<a href="/a">A</a><p><a class="x" href="/b"><b>B</b></a><a>none</a><abbr href="/no">n</abbr><a\nhref="/c"> C </a>'
    got = P.page_links(spark.createDataFrame([(1, html), (2, "")], "id int, html string")).orderBy("pos").collect()
    assert [(r.href, r.text) for r in got] == [("/a", "A"), ("/b", None), ("/c", "C")]
    html = "<A HREF='/c?a=1&amp;b=2' data-href=x>Shaving &amp; Beard</A><a class=q href=/d>T<b>B</b></a><a name='n'>N</a>"
    got = P.page_links(spark.createDataFrame([(1, html)], "id int, html string")).orderBy("pos").collect()
    assert [(r.href, r.text) for r in got] == [("/c?a=1&b=2", "Shaving & Beard"), ("/d", "T"), (None, "N")]


def test_references_are_decoded(spark):
    import html

    texts = ["&eacute;&#8217;&#x20AC;&#X41;", "a & b &amp;lt; &bogus; &", "&#0;&#xD800;&#1114112;&#x1F600;", "&#65x&#66;", "&&amp;&", "&notin;&NotEqualTilde;", "", "plain"]
    for t in texts:
        want = html.unescape(t) if "&#0;" not in t else "\ufffd\ufffd\ufffd\U0001f600"
        assert one(spark, P.unescape, t) == want, t
    assert one(spark, P.unescape, "?a=1&copy=2&lt") == "?a=1&copy=2&lt"  # names need their semicolon
    assert one(spark, P.unescape, None) is None


def test_quoted_signs_end_no_tag(spark):
    html = """<a title="a>b" href='/x>y'>T</a><a data-n=it's href=/z alt='q'>U</a><a href="/w" title='"'>V</a>""" + "<a href='/long' title='" + "x>" * 20000 + "'>W</a>"
    got = P.page_links(spark.createDataFrame([(1, html)], "id int, html string")).orderBy("pos").collect()
    assert [(r.href, r.text) for r in got] == [("/x>y", "T"), ("/z", "U"), ("/w", "V"), ("/long", "W")]
    card = """<section title="1 > 0" class="product-card" data-product-id="7"><a title='>' href="p/7"><h2 id="a>b">Caf&eacute;</h2>
      <span class="product-card__price now" title=">">&pound;12.00 £3.00</span></a></section>"""
    got = P.product_cards(spark.createDataFrame([("JOHN_LEWIS", card)], "shop string, html string")).collect()
    assert [(r.id, r.name, r.url) for r in got] == [("7", "Café", "https://www.johnlewis.com/p/7")]
    menu = "<ul><li title='<li>' data-name='A>B'><a href='/a'>x</a></li></ul>"
    got = P.menu_tree(spark.createDataFrame([(1, menu)], "id int, html string")).collect()
    assert [(r.name, r.url) for r in got] == [("A>B", "/a")]


def test_large_sitemap_files(spark, tmp_path):
    """One line, no line breaks, several tasks; a file cut short; a namespace; two levels."""
    entries = "".join(f"<url><loc>https://s.example/{i}?a=1&amp;b=2</loc><image:image><image:loc>no</image:loc></image:image></url>" for i in range(30_000))
    spaces = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="http://i"'
    maps = tmp_path / "maps"
    maps.mkdir()
    (maps / "Category-1.xml").write_text(f'<?xml version="1.0"?><urlset {spaces}>{entries}</urlset>')
    (maps / "Category-2.xml").write_text(f"<urlset {spaces}>{entries[:200]}")
    (maps / "empty.xml").write_text(f"<urlset {spaces}></urlset>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        found, cut = sitemaps.sitemap_entries(spark, str(maps))
        assert found.rdd.getNumPartitions() > 3
        got = [r["loc"] for r in found.orderBy("seq").collect()]
        assert got == [f"https://s.example/{i}?a=1&b=2" for i in range(30_000)]
        assert [r["file"].rsplit("/", 1)[1] for r in cut.collect()] == ["Category-2.xml"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    index = "".join(f"<sitemap><loc> https://s.example/m/{n} </loc></sitemap>\n" for n in ("Product-1.xml", "Category-1.xml", "Category-2.xml"))
    (tmp_path / "index.xml").write_text(f"<sitemapindex>{index}</sitemapindex>")
    found, cut = sitemaps.two_levels(spark, str(tmp_path / "index.xml"), str(maps), "Category")
    assert found.count() == 30_000 and cut.count() == 1


def test_cards(spark):
    jl = """<div><section data-product-id="7" class="product-card product-card--x"><img/><div><a href="p/7"><h2 class="t">Tea &amp; co</h2>
      <span class="product-card__price">£12.00</span><span class="product-card__price--now">£9.50</span></a></div></section>
      <section class="product-card" data-product-id="8"><a href="p/8"><h2>B</h2></a></section></div>"""
    ms = '<a href="/p/P60?x=1" class="product"><h3 class="product__title"> Polo </h3><p class="product__price"><b><i></i>£35.00</b></p></a>'
    df = spark.createDataFrame([("JOHN_LEWIS", jl), ("MS", ms), ("HM", ms)], "shop string, html string")
    cards = P.product_cards(df)
    assert cards.count() == 3
    got = cards.where("shop = 'JOHN_LEWIS'").orderBy("pos").collect()
    assert [(r.id, r.name, r.price, r.url) for r in got] == [
        ("7", "Tea & co", 9.5, "https://www.johnlewis.com/p/7"), ("8", "B", None, "https://www.johnlewis.com/p/8"),
    ]
    got = cards.where("shop = 'MS'").collect()
    assert [(r.id, r.name, r.price, r.url) for r in got] == [("P60", "Polo", 35.0, "https://www.marksandspencer.com//p/P60?x=1")]
    odd = """<SECTION class='a product-card' data-product-id=9><a href='p/9?a=1&amp;b=2'><h2>C</h2><i class="product-card__price">on request</i></a></SECTION>
      <section class="product-card__list" data-product-id="no"></section>"""
    df = spark.createDataFrame([("JOHN_LEWIS", odd), ("MS", "<html>")], "shop string, html string")
    got = {r.shop: r for r in P.product_cards(df).collect()}
    jl = got["JOHN_LEWIS"]
    assert (jl.id, jl.price, jl.bad_price, jl.url) == ("9", None, True, "https://www.johnlewis.com/p/9?a=1&b=2")
    assert got["MS"].pos is None and got["MS"].id is None


def test_facets(spark):
    mark, plain, style = (
        ";:relevance:markDownIndicator:false:category:uk-mens&#34;", ";:relevance:category:a b&#34;", ";:relevance:styleCodes:S-1&#34;",
    )
    df = spark.createDataFrame([(1, plain + mark + mark), (2, plain + style), (3, style), (4, "none")], "id int, html string")
    got = sorted(((r.id, r.pos, r.leaf) for r in P.facets(df).collect()), key=str)
    assert got == [(1, 0, "category:uk-mens"), (1, 1, "category:uk-mens"), (2, 0, "category:a b"), (3, 0, "styleCodes:S-1"), (4, None, None)]


def test_titled_blocks(spark):
    def li(title, *labels):
        items = "".join(f"<li><span><a href='/{x}'>{x} (4)</a></span></li>" for x in labels)
        return f'<li class="accordion__item"><label><h3> {title} </h3></label><div><ul>{items}</ul></div></li>'

    def found(shop, html):
        df = spark.createDataFrame([(shop, html)], "shop string, html string")
        return [(r.pos, r.leaf, r.value) for r in P.titled_facets(df).orderBy("pos").collect()]

    # the heading has to be the title, and all blocks of one step count
    assert found("MS", li("Brand", "X") + li("Free Style", "Y") + li("Style", "Slim")) == [(0, "Slim", "/Slim")]
    assert found("MS", li("Category", "A") + li("Style", "S") + li("Categories", "B")) == [(0, "A", "/A"), (1, "B", "/B")]
    assert found("MS", li("Product Type") + li("Style", "S")) == [(0, "S", "/S")]
    assert found("MS", "<div></div>") == [(None, None, None)]
    jl = '<div class="faceted-filters-accordion"><h3>Product Type</h3><div><ul><li><a href="/t">T &amp; U</a></li></ul></div></div><a href="/no">no</a>'
    assert found("JOHN_LEWIS", jl) == [(0, "T & U", "/t")]
    asos = '<div class="bybwbES"><div class="_3lFxFJi">Product Type</div><div class="_2h_c2tR"><input value="77"><label>Jeans</label></div></div>'
    assert found("ASOS", asos) == [(0, "Jeans", "77")]


def test_sitemaps(spark):
    plain = "<urlset><url><loc>https://a/1</loc><x>y</x></url><url><loc>https://a/2?b=1&amp;c=2</loc></url></urlset>"
    spaced = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://b/1</loc></url></urlset>'
    df = spark.createDataFrame([("s", "https://m/1", plain), ("s", "https://m/2-Category-en-GBP", spaced)], "shop string, url string, body string")
    got = sorted((r.url, r.pos, r.loc) for r in sitemaps.sitemap_urls(df).collect())
    assert got == [("https://m/1", 0, "https://a/1"), ("https://m/1", 1, "https://a/2?b=1&c=2"), ("https://m/2-Category-en-GBP", 0, "https://b/1")]
    image = '<urlset xmlns:i="x"><url><loc>https://c/1</loc><i:image><i:loc>https://img/1</i:loc></i:image></url></urlset>'
    mixed = spark.createDataFrame([("s", "u1", image), ("s", "u2", "<urlset><url><loc>cut"), ("s", "u3", None)], "shop string, url string, body string")
    assert [(r.url, r.loc) for r in sitemaps.sitemap_urls(mixed).collect()] == [("u1", "https://c/1")]
    assert sorted(r.url for r in sitemaps.sitemap_rejects(mixed).collect()) == ["u2", "u3"]
    index = spark.createDataFrame(
        [("s", "<i><sitemap><loc>https://m/1</loc></sitemap><sitemap><loc>https://m/2-Category-en-GBP</loc></sitemap></i>")], "shop string, body string"
    )
    assert [r.loc for r in sitemaps.sitemap_of_index(index, df, "Category-en-GBP").collect()] == ["https://b/1"]


def test_levels(spark):
    df = spark.createDataFrame([("https://s/uk/_/men/jeans/c/12", "n|men|a|b|c|d|e|f")], "u string, c string")
    row = df.select(
        F.array(*V.url_levels(F.col("u"), range(4), "https://s/uk/", drop="_", drop_last=2)),
        F.array(*V.code_levels(F.col("c"))),
    ).head()
    assert row[0] == ["men", "jeans", None, None]
    assert row[1] == ["men", "a", "b", "c", "d", "e|f"]


def test_tree_paths(spark):
    nodes = [("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("x", None, "X")]
    df = spark.createDataFrame(nodes, "node string, parent string, name string")
    got = sorted(tuple(r.path) for r in tree_paths(df).collect())
    assert got == sorted([("A",), ("B",), ("A", "B"), ("C",), ("A", "C"), ("B", "C"), ("A", "B", "C"), ("X",)])


def test_deep_trees_keep_their_first_levels(spark):
    nodes = [(str(i), str(i - 1) if i else None, f"n{i}") for i in range(6)]
    df = spark.createDataFrame(nodes, "node string, parent string, name string")
    got = tree_paths(df).collect()
    last = [tuple(r.path) for r in got if r.node == "5"]
    lines = {tuple(c for k, c in enumerate(("n0", "n1", "n2", "n3", "n4")) if m >> k & 1) + ("n5",) for m in range(32)}
    assert len(last) == len(set(last)) and set(last) == {line[:4] for line in lines}
    assert {(r.taxo1, r.taxo4) for r in got if tuple(r.path) == ("n0", "n1", "n2", "n3") and r.node == "5"} == {("n0", "n3")}
    chain = [(i, i - 1 if i else None, "n") for i in range(40)]
    assert tree_paths(spark.createDataFrame(chain, "node int, parent int, name string")).where("node = 3").count() == 8


def test_trees_of_two_pages_stay_apart(spark):
    from shelfwatch.plans import categories

    def page(root):
        return f'<nav><ul><li data-name="{root}"><a href="/{root}">x</a><ul><li data-name="JEANS"><a href="/{root}/j">j</a></li></ul></li></ul></nav>'

    pages = spark.createDataFrame([("ZARA", 1, page("MAN")), ("ZARA", 2, page("WOMAN"))], "shop string, page int, html string")
    nodes = P.menu_tree(pages)
    assert sorted((r.page, r.node) for r in nodes.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    listed = categories.zara(nodes.withColumn("seq", F.col("node")))
    assert {(r.taxo1, r.taxo2, r.url) for r in listed.collect() if r.url.endswith("/j")} == {("MAN", "JEANS", "/MAN/j"), ("WOMAN", "JEANS", "/WOMAN/j")}


def test_labels_and_attributes(spark):
    assert one(spark, P.label_without_count, " Jeans (12) ") == "Jeans"
    assert one(spark, P.label_without_count, "Jeans") is None
    html = '<li data-category="men,Jeans"><a data-category="women,Coats &amp; Jackets">'
    got = P.attribute_values(spark.createDataFrame([("P", html)], "shop string, html string"), "data-category").orderBy("pos")
    assert [r.value for r in got.collect()] == ["men,Jeans", "women,Coats & Jackets"]


def test_menu_tree(spark):
    html = """<nav id="menu"><ul><li data-name="MAN"><a href="/m">M</a><ul>
        <li><span>x</span><ul><li data-name="JEANS"><a data-href="/j">J</a></li></ul></li>
        <li data-name="NOLINK"><b>x</b><ul><li data-name="SHIRTS"><a href="/s">S</a><p>x<br></li></ul></li></ul></li>
        <li data-name="KIDS"><a href="/k">K</a></li></ul></nav>"""
    got = P.menu_tree(spark.createDataFrame([("ZARA", html), ("ZARA", None)], "shop string, html string")).collect()
    names = {r.node: r.name for r in got}
    assert [(r.name, names.get(r.parent), r.url) for r in sorted(got, key=lambda r: r.node)] == [
        ("MAN", None, "/m"), ("JEANS", "MAN", "/j"), ("SHIRTS", "MAN", "/s"), ("KIDS", None, "/k"),
    ]


def test_menus_of_untidy_pages(spark):
    html = """</li></ul><!-- <li data-name="NO"><a href="/no"> --><script>'<li data-name="NO">'</script>
        <LI data-name='A &amp; B'><A HREF='/a?x=1&amp;y=2'>a</A><ul><li><p>none</p></li><li data-name=C><a href=/c>c</a></li></ul></LI></li>
        <li data-name="D"><a href="/d">d</a></li>"""
    got = sorted(P.menu_tree(spark.createDataFrame([(1, html), (2, "")], "page int, html string")).collect(), key=lambda r: r.node)
    assert [(r.node, r.parent, r.name, r.url) for r in got] == [(0, None, "A & B", "/a?x=1&y=2"), (1, 0, "C", "/c"), (2, None, "D", "/d")]


def test_json_facets(spark):
    from shelfwatch.sources.payloads import facet_codes

    body = '{"facets":[{"code":"size","values":[{"code":"s"}]},{"code":"style","values":[{"code":"Slim"},{"code":"Wide"}]},{"code":"style"}]}'
    assert one(spark, facet_codes, body) == ["Slim", "Wide"]
    assert one(spark, facet_codes, '{"facets":[]}') is None
    assert one(spark, facet_codes, "oops") is None
