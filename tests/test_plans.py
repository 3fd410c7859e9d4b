"""Properties of the physical plans that decide how the queries behave on large and skewed data."""

import re

import pytest

from shelfwatch.checks import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON = {"json_find_key"}
KEEP_FIRST = ("priority_dedup", "default_dedup", "first_per_key", "first_category_wins", "lookup_fallback", "collect_clean")


def plan(spark, name):
    """As planned for large inputs: no side is small enough to be broadcast."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_slow_or_unbounded_operators(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name in PYTHON)
    # a window never gathers a whole table in one task
    for block in re.findall(r"Window [^\n]*\n(?:[^\n]*\n){0,3}", text):
        assert "Exchange SinglePartition" not in block


@pytest.mark.parametrize("name", KEEP_FIRST)
def test_keep_first_limits_groups_before_the_exchange(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text


def test_cohort_combines_before_the_exchange_and_reads_only_what_it_needs(spark):
    text = plan(spark, "cohort_new_old")
    assert "partial_min" in text and "partial_sum" in text
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    events = [s for s in scans if "event_id" in s]
    assert events and all("props" not in s and "value" not in s for s in events)


def test_cohorts_read_each_table_once(spark):
    for name in ("cohort_new_old", "cohort_outer"):
        text = plan(spark, name)
        # the first day is read from the same exchange, which is planned once
        assert text.count("FileScan") == 2 * (1 + text.count("Subquery scalar")) or "ReusedExchange" in text


def test_settled_rows_share_no_key_in_the_second_lookup(spark):
    from shelfwatch.operators.lookup import lookup_with_fallback

    rows = spark.createDataFrame([(i, "a" if i % 2 else "z", None if i % 3 else "b") for i in range(90)], "i int, own string, link string")
    entries = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, v string")
    out = lookup_with_fallback(rows, entries, "own", "link", "k", "v", "leaf")
    assert all(r.leaf == ("A" if r.i % 2 else None if r.i % 3 else "B") for r in out.collect()) and out.count() == 90
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text and "xxhash64" in text


def test_filters_reach_the_scan(spark):
    text = plan(spark, "json_flatten") + plan(spark, "not_null")
    assert "PushedFilters: [IsNotNull" in text


def test_bodies_are_parsed_once(spark, tmp_path):
    from shelfwatch.checks.views import captures
    from shelfwatch.sources import payloads

    captures(spark, SF).write.parquet(str(tmp_path / "c"))
    good = payloads.good_rows(payloads.flatten(spark.read.parquet(str(tmp_path / "c"))))
    text = good._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson") == 1
    assert "PushedFilters: [In(shop" in text


def test_fields_of_a_card_are_searched_once(spark, tmp_path):
    from shelfwatch.plans import collect
    from shelfwatch.schema import CAPTURE
    from shelfwatch.sources import pages

    rows = [("MS", *[None] * 5, "u", 0, 0, '<a href="/p/1" class=product><p class=product__price>£4.00</p></a>', None)]
    spark.createDataFrame(rows, CAPTURE).write.parquet(str(tmp_path / "c"))
    good = collect.card_products(collect.card_rows(spark.read.parquet(str(tmp_path / "c"))))
    text = good._jdf.queryExecution().executedPlan().toString()
    for spec in pages.CARDS.values():
        assert text.count(spec.card) == 1 and text.count(spec.price) == 1 and text.count(spec.name) == 1
    assert [(r.id, r.price, r.URL) for r in good.collect()] == [("1", 4.0, "https://www.marksandspencer.com//p/1")]


def test_an_attribute_is_searched_once(spark, tmp_path):
    from shelfwatch.sources import pages

    tags = ["<a href=\"x'y\">", "<a HREF = 'p?a=\"1\"'>", "<a href=p=1&amp;q>", "<a href=\"\">", "<a b>", None, "<a b='1' href=\n'\"z'>"]
    spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, tag string").write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    got = read.select("i", pages.raw_attribute(read.tag, "href").alias("v"), pages.attribute(read.tag, "href").alias("d"))
    rows = sorted(got.collect())
    assert [r.v for r in rows] == ["x'y", 'p?a="1"', "p=1&amp;q", "", None, None, '"z']
    assert [r.d for r in rows] == ["x'y", 'p?a="1"', "p=1&q", "", None, None, '"z']
    raw = read.select(pages.raw_attribute(read.tag, "href").alias("v"))._jdf.queryExecution().executedPlan().toString()
    assert raw.count(pages.attribute_pattern("href")) == 1


def test_pages_are_read_by_all_cores(spark, tmp_path):
    from shelfwatch.checks.views import captures

    part = "id AS p_partkey, 'b' AS p_brand, 'n' AS p_name, 't' AS p_type"
    spark.range(50).selectExpr(*part.split(", ")).write.parquet(str(tmp_path / "part.parquet"))
    event = "id AS event_id, timestamp'2024-01-01' AS ts, id % 50 AS user_id, 'view' AS event_type, 1.0D AS value"
    spark.range(2000).selectExpr(*event.split(", ")).write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for wanted, made in (("7", 7), ("1000", 4 * spark.sparkContext.defaultParallelism)):
            spark.conf.set("spark.sql.shuffle.partitions", wanted)
            assert captures(spark, str(tmp_path)).rdd.getNumPartitions() == made
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
