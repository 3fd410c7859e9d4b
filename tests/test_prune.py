import random

import pytest

from shelfwatch.operators.prune import drop_covered, drop_prefix_of_next, with_next

SCHEMA = "shop string, url string, seq bigint"


def urls(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        shop = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b"])
        parts = [rnd.choice(["men", "mens", "women", "x", "y-z"]) for _ in range(rnd.randint(1, 4))]
        out.append((shop, "https://s/" + "/".join(parts) + rnd.choice(["", ".html", "-x"]), i))
    return out


def covered(rows):
    keep = []
    for shop in {r[0] for r in rows}:
        mine = sorted({u: s for _, u, s in [r for r in sorted(rows, key=lambda r: r[2]) if r[0] == shop]}.items())
        for (u, s), nxt in zip(mine, [*mine[1:], None]):
            if nxt is None or u not in nxt[0]:
                keep.append((shop, u, s))
    return sorted(keep)


def prefixes(rows, drop_last):
    keep = []
    for shop in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == shop], key=lambda r: r[2])
        for r, nxt in zip(mine, [*mine[1:], None]):
            if (nxt is None and not drop_last) or (nxt is not None and not nxt[1].startswith(r[1][:-5])):
                keep.append(r)
    return sorted(keep)


@pytest.fixture(params=["true", "false"])
def aqe(spark, request):
    """Without AQE every range stays a partition of its own, so all seams are exercised."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("n", [1, 3, 400])
def test_covered_categories(spark, aqe, n):
    rows = urls(n, n)
    got = drop_covered(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(tuple(r) for r in got.select("shop", "url", "seq").collect()) == covered(rows)


@pytest.mark.parametrize("drop_last", [True, False])
def test_prefix_of_next(spark, aqe, drop_last):
    rows = urls(9, 300)
    got = drop_prefix_of_next(spark.createDataFrame(rows, SCHEMA).repartition(5), drop_last=drop_last)
    assert sorted(tuple(r) for r in got.select("shop", "url", "seq").collect()) == prefixes(rows, drop_last)


def test_next_row_over_all_seams(spark, aqe):
    df = spark.range(1000).selectExpr("'s' as shop", "id", "concat('v', id) as v").repartition(7)
    got = with_next(df, ["shop"], ["id"], "v", "nxt").collect()
    assert {r.id: r.nxt for r in got} == {i: (f"v{i + 1}" if i < 999 else None) for i in range(1000)}
