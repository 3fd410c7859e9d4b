import random

import pytest
from pyspark.sql import functions as F

from shelfwatch.config import ladders as L
from shelfwatch.functions.conditions import (
    EQUAL,
    IN,
    IS_NUMBER,
    START_WITH,
    Test as Rule,
    contains_any,
    is_number,
    matches,
    member,
    not_member,
    rank_of,
)

SCHEMA = "n int, taxo1 string, taxo2 string, taxo3 string, taxo4 string"


def expected(row, rules, null_text="None"):
    """Plain reading of a rule set, one value at a time."""
    for r in rules:
        raw = row[r.column]
        raw = null_text if raw is None else raw
        if r.op == IS_NUMBER:
            return raw.isdigit()
        for v in r.values:
            a, b = raw.lower(), v.lower()
            if (r.op == EQUAL and a == b) or (r.op == IN and b in a) or (r.op == START_WITH and a.startswith(b)):
                return True
    return False


def test_unknown_operator_is_refused():
    with pytest.raises(ValueError):
        Rule("taxo1", "LIKE", ("x",))


def test_all_rule_sets_equal_a_plain_reading(spark):
    sets = {n: v for n, v in vars(L).items() if n.isupper() and isinstance(v, tuple) and v and isinstance(v[0], Rule)}
    assert len(sets) >= 13
    rnd = random.Random(3)
    words = sorted({v for s in sets.values() for r in s for v in r.values})
    pool = [*words, *[w.upper() for w in words], *[f"x {w} y" for w in words], None, "", "12", "4.5", "none", "None"]
    rows = [(i, *[rnd.choice(pool) for _ in range(4)]) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = df.select("*", *[matches(r).alias(n) for n, r in sets.items()]).collect()
    for row in got:
        for n, r in sets.items():
            assert row[n] == expected(row, r), (row, n)


def test_number_test_settles_the_answer(spark):
    df = spark.createDataFrame([(1, "men", None, "x", None), (2, "men", None, "7", None)], SCHEMA)
    rules = (Rule("taxo3", IS_NUMBER), Rule("taxo1", EQUAL, ("men",)))
    assert [r[0] for r in df.orderBy("n").select(matches(rules)).collect()] == [False, True]


def test_numbers(spark):
    texts = ["12", "", "-3", "1.5", "²", "٣", "12\n", "a1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.n for r in df.select("t", is_number(F.col("t")).alias("n")).collect()}
    assert got == {t: (t is not None and t.isdigit()) for t in texts}


def test_null_text_is_a_choice(spark):
    df = spark.createDataFrame([(1, "a", "b", "c", None)], SCHEMA)
    rules = (Rule("taxo4", EQUAL, ("nan",)),)
    assert not df.select(matches(rules)).head()[0]
    assert df.select(matches(rules, null_text="nan")).head()[0]


def test_contains_any_quotes_its_values(spark):
    df = spark.createDataFrame([("a.b",), ("axb",), ("c|d",), ("(",)], "t string")
    got = [r[0] for r in df.select(contains_any(F.col("t"), ["a.b", "|", "(", "["])).collect()]
    assert got == [True, False, True, True]


def test_membership_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    got = df.select(member(F.col("t"), ["a"]), not_member(F.col("t"), ["a"])).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, True)]


@pytest.mark.parametrize(
    "shop,levels,rank",
    [
        ("ASOS", ("men", "jeans", "x", None), 0),
        ("ASOS", ("men", "other", "x", None), 1),
        ("ASOS", ("men", "outlet", "x", None), 2),
        ("ASOS", ("men", "ctas", "x", None), 3),
        ("ASOS", ("men", "other", None, None), 2),
        ("HM", ("men", "shirts", "x", None), 0),
        ("HM", ("men", "BOTTOMS", "x", None), 1),
        ("HM", ("men", "bottom", "VIEWALL_VIEW_ALL", None), 2),
        ("NEWLOOK", ("mens", "clothing", "jeans", "category:uk-mens-clothing"), 2),
        ("NEWLOOK", ("mens", "clothing", "jeans", "category:uk-womens-clothing"), 1),
        ("NEWLOOK", ("mens", "clothing", "jeans", "slim"), 0),
        ("NEWLOOK", ("mens", "clothing", "", "slim"), 1),
        ("ZARA", ("MAN", None, "x", None), 2),
        ("ZARA", ("MAN", "JEANS", "view all", None), 1),
        ("ZARA", ("MAN", "JEANS", "slim", None), 0),
        ("TKMAXX", ("men", "clothing", "jeans", None), 1),
        ("TKMAXX", ("men", "x", "0123", None), 2),
        ("TKMAXX", ("men", "x", "jeans", None), 0),
    ],
)
def test_ladders(spark, shop, levels, rank):
    df = spark.createDataFrame([(1, *levels)], SCHEMA)
    assert df.select(rank_of(L.PRODUCT_LADDERS[shop])).head()[0] == rank
