import zlib
from collections import Counter, defaultdict

import pytest
from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import sharding as S


def check(out, rows, shards):
    assert sorted(str((r["doc_id"], r["size"])) for r in out) == sorted(str((i, len((t or "").encode()) + 1)) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return Counter({s: sum(r["size"] for r in out if r["shard"] == s) for s in range(shards)})


def test_even_sizes_and_few_cuts(spark):
    rows = [(i, prose(i if i % 4 else i // 160, 20 + (i % 60 if i % 4 else 0)), "en", "a") for i in range(2000)]
    found = S.assign(documents(spark, rows)).cache()
    out = found.collect()
    sizes = check(out, rows, 8)
    mean = sum(sizes.values()) / 8
    assert max(abs(b - mean) for b in sizes.values()) < 0.01 * mean
    links = S.cut(found, ["text_crc32", "size"]).first()
    assert links["links"] > 2000 and links["cut"] < 0.02 * links["links"]
    crc = {i: zlib.crc32(t.encode()) for i, t, *_ in rows}
    assert all(r["text_crc32"] == crc[r["doc_id"]] for r in out)
    again = S.assign(documents(spark, rows[::-1])).collect()
    assert {(r["doc_id"], r["shard"]) for r in again} == {(r["doc_id"], r["shard"]) for r in out}


def test_group_larger_than_a_shard_is_spread_over_few(spark):
    rows = [(i, "same text " * 5 if i % 2 else prose(i, 15), "en", "a") for i in range(3000)]
    out = S.assign(documents(spark, rows), shards=8).collect()
    sizes = check(out, rows, 8)
    mean = sum(sizes.values()) / 8
    assert max(abs(b - mean) for b in sizes.values()) < 0.02 * mean
    held = Counter(r["shard"] for r in out if r["doc_id"] % 2)
    share = sum(51 for r in out if r["doc_id"] % 2) / mean  # shards that the group fills
    big = [n for n in held.values() if n * 51 > 0.5 * mean]
    assert len(big) >= int(share) and sum(big) > 0.6 * sum(held.values())


def test_all_equal(spark):
    rows = [(i, "x", "en", "a") for i in range(1000)]
    sizes = check(S.assign(documents(spark, rows), shards=4).collect(), rows, 4)
    assert max(sizes.values()) - min(sizes.values()) <= 0.04 * sum(sizes.values()) / 4


def test_odd_rows(spark):
    docs = clash(documents(spark, odd_rows()), "size", "h", "label")
    out = S.assign(docs, shards=3).collect()
    check(out, odd_rows(), 3)
    assert {r["text_crc32"] for r in out if r["size"] == 1} == {0}
    assert S.assign(docs.limit(0)).count() == 0


def test_repeated_rows_stay_even(spark):
    """A third of all rows are one row, with an id and without; half are copies without an id."""
    text = "same text " * 4
    for doc_id, share in ((7, 3), (None, 3), (None, 2)):
        rows = [(doc_id if i % share == 0 else i, text if i % share == 0 else prose(i, 15), "en", "a") for i in range(3000)]
        sizes = check(S.assign(documents(spark, rows).repartition(3), shards=8).collect(), rows, 8)
        mean = sum(sizes.values()) / 8
        assert max(abs(b - mean) for b in sizes.values()) < 0.02 * mean


def test_uneven_loads_are_said(spark):
    rows = [(1, "x" * 10_000, "en", "a")] + [(i, "y", "en", "a") for i in range(2, 30)]
    with pytest.warns(UserWarning, match="off the mean"):
        S.assign(documents(spark, rows), shards=4).collect()
