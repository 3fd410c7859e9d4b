import random

import pandas as pd

from shelfwatch.config.ladders import CATEGORY_LADDERS, PRODUCT_LADDERS
from shelfwatch.operators import dedup
from shelfwatch.operators.quality import duplicates

SCHEMA = "shop string, id string, reference string, name string, taxo1 string, taxo2 string, taxo3 string, taxo4 string, seq bigint"


def rows(n, seed, shops=("ASOS", "NEWLOOK", "TKMAXX", "ZARA")):
    rnd = random.Random(seed)
    l2 = ["tops", "sale", "ctas", "goingout", "c", "FROM X", "JEANS", None]
    l3 = ["12", "View All", "brands", "x", None]
    out = []
    for i in range(n):
        hot = rnd.random() < 0.34  # a third of all rows are one product
        pid = "hot" if hot else rnd.choice(["1", "2", "3", None])
        out.append((
            "ASOS" if hot else rnd.choice(shops), pid, None if hot else rnd.choice(["r", None]), "n",
            rnd.choice(["men", "women", None]), rnd.choice(l2), rnd.choice(l3), rnd.choice(["nan", "a", None]), i,
        ))
    rnd.shuffle(out)
    return out


def test_priority_dedup_equals_bucketing(spark):
    data = rows(3000, 1)
    df = spark.createDataFrame(data, SCHEMA)
    ranked = dedup.with_rank(df, PRODUCT_LADDERS).toPandas()
    frames = []
    for _, shop in ranked.groupby("shop"):
        shop = shop.sort_values("seq")
        for rank in sorted(shop["rank"].unique()):
            frames.append(
                shop[shop["rank"] == rank].sort_values(["taxo1", "taxo2", "taxo3", "taxo4"], kind="stable")
            )
    want = pd.concat(frames).drop_duplicates(["shop", "id", "reference", "name"], keep="first")
    got = dedup.priority_dedup(df.repartition(7), PRODUCT_LADDERS).toPandas()
    assert sorted(got["seq"]) == sorted(want["seq"])


def test_default_dedup_smallest_levels_nulls_last(spark):
    data = [
        ("MS", "1", None, "a", None, "a", "a", None, 0),
        ("MS", "1", None, "a", "men", None, "a", None, 1),
        ("MS", "1", None, "a", "men", "b", None, None, 2),
        ("MS", "1", None, "a", "men", "b", None, "x", 3),
        ("MS", "1", "r", "a", "z", "b", None, "x", 4),
    ]
    got = dedup.default_dedup(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted(r.seq for r in got) == [2, 4]


def test_result_does_not_depend_on_input_order(spark):
    data = rows(800, 2)
    a = dedup.default_dedup(spark.createDataFrame(data, SCHEMA)).collect()
    b = dedup.default_dedup(spark.createDataFrame(data[::-1], SCHEMA).repartition(5, "taxo2")).collect()
    assert sorted(r.seq for r in a) == sorted(r.seq for r in b)
    assert len({(r.shop, r.id, r.reference, r.name) for r in a}) == len(a)


def test_first_category_wins(spark):
    schema = "shop string, id string, taxo1 string, taxo2 string, taxo3 string, taxo4 string, url string, link_pos bigint, seq bigint"
    data = [
        ("GAP", "1", "sale", "x", None, None, "/s", 0, 0),
        ("GAP", "1", "men", "new-and-now-x", None, None, "/n", 0, 1),
        ("GAP", "1", "men", "jeans", None, None, "/j", 0, 2),
        ("GAP", "1", "men", "jeans", None, None, "/j", 3, 3),
        ("GAP", "2", "sale", "x", None, None, "/s", 0, 4),
        ("GAP", "3", "men", "jeans", "b", None, "/j", 0, 5),
        ("GAP", "3", "men", "jeans", None, None, "/a", 0, 6),
    ]
    got = dedup.first_category_wins(spark.createDataFrame(data, schema), CATEGORY_LADDERS).collect()
    assert {r.id: r.seq for r in got} == {"1": 3, "2": 4, "3": 5}


def test_duplicates_only_reports(spark):
    df = spark.createDataFrame([("A", "1", 1), ("A", "1", 1), ("A", None, 1), ("A", None, 1), ("B", "1", 1)], "shop string, id string, date int")
    assert {(r.shop, r.id): r.n for r in duplicates(df).collect()} == {("A", "1"): 2, ("A", None): 2}
