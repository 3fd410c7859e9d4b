import datetime
import random

from pyspark.sql import functions as F

from shelfwatch.functions.text import day_of
from shelfwatch.operators import cohort as C
from shelfwatch.plans.cohort import old_new_counts

SCHEMA = "shop string, id string, inStock boolean, taxo1 string, taxo2 string, taxo3 string, date string, seq bigint"
UNTIL = datetime.date(2018, 12, 31)


def brute_force(rows, until):
    stocked = []
    for shop, pid, stock, t1, t2, t3, text, seq in sorted(rows, key=lambda r: r[-1]):
        try:
            day = datetime.datetime.strptime(text.split(" ")[0], "%Y-%m-%d").date() if text else None
        except ValueError:
            day = None
        if stock:
            stocked.append((f"{shop}_{pid if pid is not None else 'nan'}_", day, (shop, t1, t2, t3)))
    days = [d for _, d, _ in stocked if d]
    if not days:
        return {}
    start = min(days)
    day1 = {k for k, d, _ in stocked if d == start}
    first = {}
    for k, d, node in stocked:
        if d:
            first.setdefault((k, d), node)
    counts, totals = {}, {}
    for (k, d), node in first.items():
        if None in node or "" in node:
            continue
        if d == start:
            totals[node] = totals.get(node, 0) + 1
        elif d <= until:
            new, old = counts.get((d, *node), (0, 0))
            counts[(d, *node)] = (new, old + 1) if k in day1 else (new + 1, old)
    return {k: (n or None, o or None, totals.get(k[1:])) for k, (n, o) in counts.items()}


def as_dict(df):
    return {
        (r.date, r.shop, r.taxo1, r.taxo2, r.taxo3): (r.item_not_present_day1, r.item_present_day1, r.Total_item_day_1)
        for r in df.collect()
    }


def random_rows(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = rnd.random() < 0.34
        day = rnd.choice(["2018-9-1", "2018-09-02", "2018-9-4", "2019-01-02", "bad", "2018-02-30"])
        out.append((
            "A" if hot else rnd.choice(["A", "B"]), "hot" if hot else str(rnd.randint(0, 30)), rnd.random() < 0.8,
            rnd.choice(["MAN", "WOMAN"]), rnd.choice(["TOP", ""]), rnd.choice(["SHIRT", "", None, "JEANS"]),
            None if rnd.random() < 0.02 else f"{day} 07:12:03.1", i,
        ))
    return out


def test_counts_equal_brute_force(spark):
    rows = random_rows(4, 3000)
    got = as_dict(old_new_counts(spark.createDataFrame(rows, SCHEMA).repartition(5), UNTIL))
    want = brute_force(rows, UNTIL)
    assert got == want and len(want) > 10


def test_small_cases(spark):
    rows = [
        ("A", "1", True, "MAN", "TOP", "SHIRT", "2018-09-01 1:0", 0),
        ("A", "2", False, "MAN", "TOP", "SHIRT", "2018-09-01 1:0", 1),  # not in stock on day 1
        ("A", "3", True, "MAN", "", "", "2018-09-01 1:0", 2),  # unclassified on day 1
        ("A", "1", True, "MAN", "TOP", "SHIRT", "2018-09-03 1:0", 3),
        ("A", "2", True, "MAN", "TOP", "SHIRT", "2018-09-03 1:0", 4),
        ("A", "3", True, "MAN", "", "", "2018-09-03 1:0", 5),  # first row of the day is unclassified
        ("A", "3", True, "MAN", "TOP", "SHIRT", "2018-09-03 1:0", 6),
        ("B", "9", True, "MAN", "TOP", "SHIRT", "2018-09-03 1:0", 7),  # shop starts late
    ]
    got = as_dict(old_new_counts(spark.createDataFrame(rows, SCHEMA), UNTIL))
    day = datetime.date(2018, 9, 3)
    assert got == {
        (day, "A", "MAN", "TOP", "SHIRT"): (1, 1, 1),
        (day, "B", "MAN", "TOP", "SHIRT"): (1, None, None),
    }


def test_nothing_in_stock(spark):
    rows = [("A", "1", False, "MAN", "TOP", "SHIRT", "2018-09-01", 0)]
    assert old_new_counts(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_join_forms_agree(spark):
    df = spark.createDataFrame(random_rows(6, 1500), SCHEMA)
    stocked = C.in_stock_days(df, day_of(F.col("date")))
    wide = {
        (r.date, r.shop, r.taxo1, r.taxo2, r.taxo3): (r.item_not_present_day1, r.item_present_day1)
        for r in C.cohort_counts(stocked).collect()
    }
    outer = {
        (r.d, r.shop, r.taxo1, r.taxo2, r.taxo3): (r.item_not_present_day1, r.item_present_day1)
        for r in C.cohort_outer(stocked).collect()
    }
    assert wide == outer
    totals = {tuple(r[:4]): r[4] for r in C.day1_totals(stocked).collect()}
    seen = {tuple(r[1:5]): r[7] for r in C.cohort_counts(stocked).collect() if r[7] is not None}
    assert all(totals[k] == v for k, v in seen.items())


def test_days(spark):
    texts = {
        "2018-9-1 07:12": datetime.date(2018, 9, 1),
        "2018-09-01": datetime.date(2018, 9, 1),
        "2018-02-30 1": None,
        "18-9-1": None,
        "2018/9/1": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.d for r in df.select("t", day_of(F.col("t")).alias("d")).collect()} == texts


def test_bound_inside_the_data(spark):
    rows = [("A", str(i), True, "MAN", "TOP", "SHIRT", f"2018-09-0{1 + i}", i) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    for until, days in ((datetime.date(2018, 9, 4), 3), (datetime.date.max, 5)):
        got = as_dict(old_new_counts(df, until))
        assert got == brute_force(rows, until) and len(got) == days


def test_days_merged_one_by_one(spark, tmp_path):
    """Ten appended days, with late rows of any day, give the counts of one run over everything."""
    from shelfwatch.plans import cohort

    rng = random.Random(11)
    start = datetime.date(2018, 9, 1)
    schema = "new_id string, d date, shop string, taxo1 string, taxo2 string, taxo3 string, seq long"
    rows = []
    for seq in range(1500):
        day = start + datetime.timedelta(days=rng.randint(0, 11))
        node = ("ASOS", "men", rng.choice(["a", "b", None]), rng.choice(["x", "y", ""]))
        rows.append((f"p{rng.randint(0, 60)}", day if seq % 50 else None, *node, seq))
    days = sorted({r[1] for r in rows if r[1]})
    batches = [[r for r in rows if r[1] == d and r[-1] % 10] for d in days[2:]]  # the first days are late
    batches += [[r for r in rows if r[1] == days[1] and r[-1] % 10], [r for r in rows if r[-1] % 10 == 0], [r for r in rows if r[1] == days[0]], []]
    path = str(tmp_path / "state")
    again = [cohort.merge_days(spark.createDataFrame(b, schema), path, f"b{i}") for i, b in enumerate(batches)]
    assert again[1] == [days[3]] and again[-2] == days and again[-1] == []
    want = as_dict(C.cohort_counts(spark.createDataFrame(rows, schema), until=UNTIL))
    assert want and as_dict(cohort.stored_counts(spark, path, UNTIL)) == want
    cohort.merge_days(spark.createDataFrame(batches[3], schema), path, "again")  # the same rows again
    assert as_dict(cohort.stored_counts(spark, path, UNTIL)) == want
