import random

from shelfwatch.config import classes
from shelfwatch.operators import rule_tables as R
from shelfwatch.operators.classify import class_of, with_name_lc


def listing(spark, n=400, seed=3):
    rng = random.Random(seed)
    words = ["red", " t-shirt", " shirt", "polo", "coat", "waiscoat", "jeans", "hoody", "skirt", "dress", " blouse", "tops", "a", "ü"]
    rows = [
        (i, None if i % 17 == 0 else "".join(rng.choice(words) for _ in range(rng.randint(0, 3))).title(),
         rng.choice(["Tops", "Jeans", "tops", None]), rng.choice(["T-Shirts", "polo", "jeans", "Jeans", None]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows + rows[:20], "seq int, name string, taxo2 string, taxo3 string")


def test_equals_the_compiled_rules(spark):
    rows = listing(spark)
    for rules in (classes.men_words(), classes.women_words(), classes.ASOS_WOMEN, classes.HM_MEN, classes.PRIMARK_WOMEN):
        got = R.classify_by_table(rows, R.rule_table(spark, rules))
        want = with_name_lc(rows).withColumn("label", class_of(rules)).drop("name_lc")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_ten_thousand_rules(spark):
    rng = random.Random(1)
    letters = "abcdefgh"
    rules = [
        classes.ClassRule(f"L{i}", tuple("".join(rng.choice(letters) for _ in range(rng.randint(1, 6) if i < 20 else 6)) for _ in range(2)), ("zz",) if i % 3 == 0 else ())
        for i in range(10_000)
    ]
    names = ["".join(rng.choice(letters + " z") for _ in range(rng.randint(0, 30))) for _ in range(200)] + ["abcabc"] * 300
    rows = spark.createDataFrame([(i, n, None, None) for i, n in enumerate(names)], "seq int, name string, taxo2 string, taxo3 string")
    got = {r.seq: r.label for r in R.classify_by_table(rows, R.rule_table(spark, rules)).collect()}
    for i, n in enumerate(names):
        hits = [r.label for r in rules if any(w in n for w in r.words) and not any(w in n for w in r.without)]
        assert got[i] == (hits[-1] if hits else "")
