import random

from pyspark.sql import functions as F

from shelfwatch.config import classes as C
from shelfwatch.config.shops import AGGREGATED
from shelfwatch.operators.classify import class_of, parent_of, with_name_lc


def replay(rules, name, taxo2, taxo3):
    """Rules applied one after the other, each overwriting the label."""
    label, low = "", (name or "").lower()
    for r in rules:
        ok = not r.words or (name is not None and any(w in low for w in r.words))
        ok = ok and not any(w in low for w in r.without)
        ok = ok and (r.taxo2 is None or taxo2 == r.taxo2)
        ok = ok and (not r.taxo3 or taxo3 in r.taxo3)
        ok = ok and (r.taxo3_not is None or taxo3 != r.taxo3_not)
        label = r.label if ok else label
    return label


def test_known_names(spark):
    names = {
        "Red t shirt": ("SHIRT", "SHIRT"),
        "Blue t-shirt": ("TSHIRT", "SHIRT"),
        "T-shirt blue": ("", ""),
        "Wool waistcoat": ("JACKET/COAT", "JACKET/COAT"),
        "Polo shirt": ("", "SHIRT"),
        "Shirt dress": ("", "DRESS"),
        "Denim skirt": ("", "SKIRTS"),
        "Hoodie": ("SWEATSHIRT", "SWEATSHIRT"),
        "Wool waiscoat": ("", ""),
        None: ("", ""),
    }
    df = spark.createDataFrame([(n, None, None) for n in names], "name string, taxo2 string, taxo3 string")
    got = with_name_lc(df).select("name", class_of(C.men_words()).alias("m"), class_of(C.women_words()).alias("w"))
    assert {r.name: (r.m, r.w) for r in got.collect()} == names


def test_fixed_rules(spark):
    df = spark.createDataFrame(
        [("Red t shirt", None, None), ("Wool waistcoat", None, None)], "name string, taxo2 string, taxo3 string"
    )
    fixed = C.men_words(fix_exclusion=True, fix_waistcoat=True)
    assert [r[0] for r in with_name_lc(df).select(class_of(fixed)).collect()] == ["TSHIRT", ""]


def test_every_rule_list_equals_its_replay(spark):
    lists = {f"{s.name}_{g}": r for s in AGGREGATED for g, r in (("m", s.men), ("w", s.women))}
    words = sorted({w for r in lists.values() for x in r for w in (*x.words, *x.without)})
    level2 = sorted({x.taxo2 for r in lists.values() for x in r if x.taxo2}) + [None, "", "JEANS"]
    level3 = sorted({v for r in lists.values() for x in r for v in x.taxo3}) + [None, "polo", "x"]
    rnd = random.Random(5)
    rows = []
    for _ in range(2500):
        name = None if rnd.random() < 0.03 else "".join(rnd.choice([*words, "X", " "]) for _ in range(rnd.randint(0, 4)))
        rows.append((name, rnd.choice(level2), rnd.choice(level3)))
    df = spark.createDataFrame(rows, "name string, taxo2 string, taxo3 string")
    got = with_name_lc(df).select("name", "taxo2", "taxo3", *[class_of(r).alias(n) for n, r in lists.items()])
    for row in got.collect():
        for n, r in lists.items():
            assert row[n] == replay(r, row["name"], row["taxo2"], row["taxo3"]), (row, n)


def test_parents(spark):
    df = spark.createDataFrame([(x,) for x in [*C.PARENT, "", None, "KID"]], "t string")
    got = {r.t: r.p for r in df.select("t", parent_of(F.col("t")).alias("p")).collect()}
    assert got == {**C.PARENT, "": "", None: "", "KID": ""}
