import datetime
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfwatch.operators import quality
from shelfwatch.plans import aggregate, cohort, collect
from shelfwatch.schema import CAPTURE, SHOPS
from shelfwatch.session import scratch_dir
from shelfwatch.sources import snapshots, tables, versions
from shelfwatch.streaming import ingest


def captures(spark, day, ids, shop="ASOS", text=None):
    items = [{"id": i, "productCode": "c", "name": f"n{i}", "price": {"current": {"value": 1.5}}, "url": "p"} for i in ids]
    body = text or json.dumps({"itemCount": len(items), "products": [*items, {"id": "bad"}]})
    at = datetime.datetime(2018, 9, day, 7, 0)
    rows = [(shop, "men", t2, None, None, None, f"u{k}", 0, k, body, at) for k, t2 in enumerate(["outlet", "jeans"])]
    return spark.createDataFrame(rows, CAPTURE)


def test_collect_job(spark, tmp_path):
    raw, clean, log = (str(tmp_path / n) for n in ("raw", "clean", "log"))
    collect.run(captures(spark, 1, [1, 2]), raw, clean, log)
    collect.run(captures(spark, 2, [2, 3, 4]), raw, clean, log)
    collect.run(captures(spark, 2, [2, 3]), raw, clean, log)  # the day is written again, the other one stays
    by_day = lambda p: {str(r[0]): r[1] for r in tables.read_table(spark, p).groupBy("snapshot_date").count().collect()}
    assert by_day(raw) == {"2018-09-01": 4, "2018-09-02": 4}
    assert by_day(clean) == {"2018-09-01": 2, "2018-09-02": 2}
    assert {r.taxo2 for r in tables.read_table(spark, clean).collect()} == {"jeans"}
    found = tables.read_table(spark, log)  # of the two runs that are left, each with a start and an end of every shop
    counts = {(r.shop, r.level): r.n for r in quality.log_counts(found).collect()}
    assert counts == {("ASOS", "MINOR"): 4, **{(s, "TIMING"): 4 for s in SHOPS}}
    assert quality.log_of_shop(found, "ASOS").count() == 8 and quality.log_of_shop(found, "HM").count() == 4
    assert "message" not in quality.log_of_level(found, "MINOR").columns


def test_aggregate_and_cohort_jobs(spark, tmp_path):
    rows = []
    for day, ids in ((1, "ab"), (2, "abc"), (3, "bd")):
        for i, pid in enumerate(ids):
            rows.append(("ASOS", pid, "c", f"n {pid}", 10.0, True, "men", "jeans", "x", None, "u", datetime.datetime(2018, 9, day, 7, i), "ASOS"))
    columns = ", ".join(f"{c} {t}" for c, t in zip(snapshots.COLUMNS, ["string"] * 4 + ["double", "boolean"] + ["string"] * 5 + ["timestamp_ntz"]))
    df = spark.createDataFrame(rows, columns + ", src_shop string")
    landing, out, result = (str(tmp_path / n) for n in ("landing", "agg", "cohort"))
    tables.write_snapshot_csv(df, landing)
    tables.write_snapshot_csv(df, landing, before_clean=True)
    dups = aggregate.run(spark, landing, out)
    assert dups.count() == 0
    assert tables.read_table(spark, out).count() == 7
    cohort.run(spark, out, result, datetime.date(2018, 9, 30))
    got = sorted((str(r.date), r.taxo3, r.item_not_present_day1, r.item_present_day1, r.Total_item_day_1) for r in spark.read.parquet(result).collect())
    assert got == [("2018-09-02", "JEANS", 1, 2, 2), ("2018-09-03", "JEANS", 1, 1, 2)]


def test_shops_fail_alone(spark):
    done = []

    def broken():
        raise RuntimeError("no page")

    log = quality.run_isolated(spark, {"ASOS": lambda: done.append("ASOS"), "HM": broken, "MS": lambda: done.append("MS")})
    assert done == ["ASOS", "MS"]
    assert [(r.shop, r.message) for r in log.where("level = 'MAJOR'").collect()] == [("HM", "no page")]
    assert log.count() == 6


def test_each_body_is_parsed_once(spark, tmp_path, monkeypatch):
    from shelfwatch.sources import payloads

    calls, plans = [], []
    flatten, write = payloads.flatten, tables.stage_snapshot
    monkeypatch.setattr(payloads, "flatten", lambda *a, **k: calls.append(1) or flatten(*a, **k))
    monkeypatch.setattr(tables, "stage_snapshot", lambda df, *a: plans.append(df._jdf.queryExecution().toString()) or write(df, *a))
    collect.run(captures(spark, 1, [1, 2]), *(str(tmp_path / n) for n in ("raw", "clean", "log")))
    assert len(calls) == 1 and len(plans) == 2
    assert all("parse_json" not in p.lower() and "parsejson" not in p.lower() for p in plans)


def test_one_shop_fails_and_eight_are_written(spark, tmp_path):
    from functools import reduce

    def all_captures():
        parts = [captures(spark, 1, [1, 2]).withColumn("shop", F.lit(s)) for s in SHOPS]
        fails = F.when(F.col("shop") == "HM", F.raise_error(F.lit("bad page"))).otherwise(F.col("body"))
        return reduce(lambda a, b: a.unionByName(b), parts).withColumn("body", fails)

    paths = [str(tmp_path / n) for n in ("raw", "clean", "log")]
    for _ in range(2):  # a rerun gives the same rows
        collect.run(all_captures(), *paths)
        raw = tables.read_table(spark, paths[0])
        assert {r.shop: r.n for r in raw.groupBy("shop").agg(F.count("*").alias("n")).collect()} == {"ASOS": 4}
    log = tables.read_table(spark, paths[2])
    failed = log.where("level = 'MAJOR'").collect()
    assert {r.shop for r in failed} == {"HM"} and all("bad page" in r.message for r in failed)
    assert {r.shop for r in log.where("level = 'TIMING' and message = 'end'").collect()} == set(SHOPS) - {"HM"}
    assert {"MS", "JOHN_LEWIS"} <= {r.shop for r in log.where("message = 'no product cards'").collect()}


def test_a_rerun_without_rows_leaves_none(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("raw", "clean", "log")]
    collect.run(captures(spark, 1, [1, 2]), *paths)
    collect.run(captures(spark, 2, [1]), *paths)
    collect.run(captures(spark, 1, [], text='{"itemCount": 0, "products": []}'), *paths)
    for p in paths[:2]:
        assert {str(r.snapshot_date) for r in tables.read_table(spark, p).collect()} == {"2018-09-02"}


def test_a_run_that_fails_before_its_end_changes_nothing(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / n) for n in ("raw", "clean", "log")]
    collect.run(captures(spark, 1, [1, 2]), *paths)
    before = [sorted(map(str, tables.read_table(spark, p).collect())) for p in paths]

    class Killed(BaseException):
        pass

    def killed(*_):
        raise Killed

    monkeypatch.setattr(tables, "commit_snapshot", killed)
    with pytest.raises(Killed):
        collect.run(captures(spark, 1, [3]), *paths)
    assert [sorted(map(str, tables.read_table(spark, p).collect())) for p in paths] == before


def test_ledger_of_good_runs(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("raw", "clean", "log", "ledger")]

    def ledger():
        rows = tables.read_table(spark, paths[3]).collect()
        assert all(r.started <= r.ended for r in rows)
        return {(r.run, r.shop): (r.raw_rows, r.clean_rows, r.rejects) for r in rows}

    for _ in range(2):
        collect.run(captures(spark, 1, [1, 2]), *paths[:3], ledger_path=paths[3], run="day 1")
        want = {("day 1", s): (0, 0, 0) for s in SHOPS} | {("day 1", "ASOS"): (4, 2, 2)}
        assert ledger() == want


def test_ledger_after_a_shop_failed(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("raw", "clean", "log", "ledger")]

    def both(fails):
        rows = captures(spark, 1, [1, 2]).unionByName(captures(spark, 1, [5], shop="NEWLOOK"))
        bad = F.when((F.col("shop") == "NEWLOOK") & F.lit(fails), F.raise_error(F.lit("bad page"))).otherwise(F.col("body"))
        return rows.withColumn("body", bad)

    def runs():
        return sorted((r.run, r.shop) for r in tables.read_table(spark, paths[3]).collect())

    collect.run(both(True), *paths[:3], ledger_path=paths[3], run="r")
    assert runs() == sorted((f"r-{s}", s) for s in SHOPS if s != "NEWLOOK")
    collect.run(both(False), *paths[:3], ledger_path=paths[3], run="r")  # replaces what single shops left
    assert runs() == sorted(("r", s) for s in SHOPS)
    assert tables.read_table(spark, paths[2]).where("level = 'MAJOR'").count() == 0


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")

    def frame(rows):
        return spark.createDataFrame(rows, "day date, shop string, x int")

    def scope(*pairs):
        return spark.createDataFrame([(datetime.date(2020, 1, d), s) for d, s in pairs], "day date, shop string")

    d1, d2 = datetime.date(2020, 1, 1), datetime.date(2020, 1, 2)
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path)
    versions.replace(frame([(d1, "7", 1), (d1, None, 2), (d2, "B", 3)]), path, "v9", ["day", "shop"], scope((1, "7")))
    assert {r.x for r in versions.current(spark, path).collect()} == {1, 2, 3}
    staged = versions.stage(frame([(d1, "7", 4)]), path, "v1", ["day", "shop"])
    assert {r.x for r in versions.current(spark, path).collect()} == {1, 2, 3}  # not committed
    versions.commit(staged, path, "v1", ["day", "shop"], scope((1, "7"), (2, "B")))
    assert {r.x for r in versions.current(spark, path).collect()} == {4, 2}
    versions.replace(frame([(d1, "7", 5)]), path, "v1", ["day", "shop"], scope((1, "7")))  # again under that name
    assert {r.x for r in versions.current(spark, path).collect()} == {5, 2}
    versions.replace(frame([]), path, "v2", ["day", "shop"], scope((1, "7"), (1, None), (2, "B")))
    assert versions.current(spark, path).count() == 0
    assert sorted(r.version[:2] for r in versions.dead_versions(spark, path).collect()) == ["v1", "v1", "v9"]
    with pytest.raises(AnalysisException):
        versions.stage(frame([(d1, "7", 6)]), path, "v1", ["day", "shop"])  # no fresh one


def test_csv_files_are_replaced(spark, tmp_path):
    row = ("ASOS", "1", "c", "n", 10.0, True, "men", "jeans", "x", None, "u", datetime.datetime(2018, 9, 1, 7, 0), "ASOS")
    columns = ", ".join(f"{c} {t}" for c, t in zip(snapshots.COLUMNS, ["string"] * 4 + ["double", "boolean"] + ["string"] * 5 + ["timestamp_ntz"]))
    for _ in range(2):
        tables.write_snapshot_csv(spark.createDataFrame([row], columns + ", src_shop string"), str(tmp_path))
    assert snapshots.read_snapshots(spark, str(tmp_path)).count() == 1


def test_stream_gives_what_the_job_gives(spark, tmp_path):
    inbox, store, raw, clean, log, state = (str(tmp_path / n) for n in ("inbox", "store", "raw", "clean", "log", "state"))

    def follow():
        ingest.collect_new(ingest.capture_stream(spark, inbox), store, raw, clean, log, state).awaitTermination()

    captures(spark, 1, [1, 2]).write.parquet(inbox)
    follow()
    assert tables.read_table(spark, raw).count() == 4
    captures(spark, 2, [3]).write.mode("append").parquet(inbox)
    follow()
    captures(spark, 2, [3, 4], shop="ASOS").write.mode("append").parquet(inbox)  # more of the same day
    follow()
    follow()  # nothing new
    paths = [str(tmp_path / n) for n in ("raw2", "clean2", "log2")]
    collect.run(spark.read.schema(CAPTURE).parquet(inbox), *paths)
    for mine, theirs in ((raw, paths[0]), (clean, paths[1])):
        a, b = (tables.read_table(spark, p).drop("seq") for p in (mine, theirs))
        assert a.count() == b.count() > 0 and a.exceptAll(b.select(a.columns)).count() == 0


def test_scratch_folders_are_new_and_shared(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or a.startswith(named)


def test_files_of_a_hot_shop_are_split(spark, tmp_path):
    df = spark.range(1000).select(F.lit("ASOS").alias("shop"), "id")
    tables.write_partitioned(df, str(tmp_path / "t"), "shop")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_owners_over_micro_batches(spark, tmp_path):
    import random

    from shelfwatch.config.ladders import CATEGORY_LADDERS
    from shelfwatch.operators.dedup import first_category_wins
    from shelfwatch.streaming import owners

    rng, schema = random.Random(6), "shop string, id string, day date, taxo1 string, taxo2 string, taxo3 string, taxo4 string, url string, link_pos long, seq long"
    ladders = {"GAP": CATEGORY_LADDERS["GAP"]}
    rows = [
        ("GAP", str(rng.randint(0, 30)), datetime.date(2018, 9, rng.randint(1, 3)), rng.choice(["men", "sale", None]), rng.choice(["jeans", "last-chance"]),
         None, None, f"/c/{rng.randint(0, 3)}", rng.randint(0, 2), i)
        for i in range(400)
    ]
    parts = [rows[i::3] for i in range(3)]
    inbox, path, state = (str(tmp_path / n) for n in ("inbox", "owners", "state"))
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        owners.own_new(stream, path, state, ladders).awaitTermination()
    owners.merge_owners(spark.createDataFrame(parts[0], schema), path, "again", ladders)  # a repeated batch
    want = first_category_wins(spark.createDataFrame(rows, schema), ladders, owners.KEYS)
    assert sorted(map(str, owners.owners(spark, path).collect())) == sorted(map(str, want.collect()))


def test_pages_join_their_categories(spark):
    """Shared URLs, null URLs and levels, pages and categories without partner, a hot category."""
    listed = [("GAP", "men", "a", None, None, "u1"), ("GAP", "men", "b", None, None, "u1"), ("GAP", "men", "c", None, None, "u2"), ("GAP", "x", None, None, None, None)]
    categories = spark.createDataFrame(listed + listed[:1], "shop string, taxo1 string, taxo2 string, taxo3 string, taxo4 string, url string")
    pages = [("GAP", "u1", i) for i in range(50)] + [("GAP", "u9", 90), ("HM", "u1", 91), ("GAP", None, 92)]
    pages = spark.createDataFrame(pages, "shop string, url string, page_seq long").selectExpr(
        "*", "null as leaf", "0L as link_pos", "'{}' as body", "timestamp_ntz'2018-09-01 00:00:00' as captured_at"
    )
    got, log = collect.captures_of(categories, pages)
    assert got.columns == CAPTURE.names and sorted((r.page_seq, r.taxo2) for r in got.collect()) == sorted((i, t) for i in range(50) for t in "ab")
    said = sorted((r.message, r.shop, r.url or "") for r in log.collect())
    assert said == sorted([(collect.NO_CATEGORY, "GAP", "u9"), (collect.NO_CATEGORY, "HM", "u1"), (collect.NO_CATEGORY, "GAP", ""), (collect.NO_PAGE, "GAP", "u2"), (collect.NO_PAGE, "GAP", "")])
