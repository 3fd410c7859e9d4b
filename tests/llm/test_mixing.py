from collections import defaultdict

import pytest
from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import mixing as M


def wanted(sizes, weights=(3, 1, 2), share=1.5, ceiling=2.0):
    """Targets by resharing the excess source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    free, left, out = set(order), share * sum(sizes.values()), {}
    while free:
        per = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * per > ceiling * sizes[s]}
        if not over:
            return out | {s: weight[s] * per for s in free}
        for s in over:
            out[s] = ceiling * sizes[s]
            left -= out[s]
        free -= over
    return out


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(900):
        source = None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
        out.append((i, prose(i, 5 + (i * 37) % 180), "en", source))
    return out


def test_targets_rates_and_copies(spark, rows):
    docs = documents(spark, rows)
    plan = M.copies(docs).collect()
    assert sorted(r["doc_id"] for r in plan) == list(range(900))
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in plan:
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and 0 <= r["total"] <= 2 and r["n"] == 1
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["total"]
        target[r["source"]] = r["target"]
    goal = wanted(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(goal[s])
        assert taken[s] == pytest.approx(goal[s], rel=0.02)
        assert all(r["source_size"] == sizes[s] for r in plan if r["source"] == s)
    again = M.copies(documents(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, plan))


def test_rates_solve_the_dual(spark, rows):
    """Expected words meet each target, and rates tilt exponentially with size."""
    units = documents(spark, rows).selectExpr("source", "doc_id", "size(split(text, ' ')) as size").selectExpr("source", "doc_id", "cast(size as bigint) size", "1L as n")
    goals = M.targets(units, (3, 1, 2), 1.5, 2.0)
    state = M.tilts(units, goals, 2.0).withColumnRenamed("source", "s")
    rated = units.join(state, units.source.eqNullSafe(state.s)).selectExpr("source", "target", "full", "size", f"{M._rate(2.0)} as r").collect()
    got, goal = defaultdict(float), {}
    for r in rated:
        got[r["source"]] += r["size"] * r["r"]
        goal[r["source"]] = r["target"]
        assert 0 <= r["r"] <= 2
    for s, t in goal.items():
        assert got[s] == pytest.approx(t, rel=1e-6)


def test_mix_repeats_rows(spark, rows):
    docs = clash(documents(spark, rows), "copies", "s", "_s", "size", "_size", "target", "total", "number", "n", "id", "z")
    plan = {r["doc_id"]: r["total"] for r in M.copies(docs).collect()}
    got = defaultdict(int)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        got[r["doc_id"]] += 1
        assert r["size"] == "kept" and r["_s"] == "kept"
    assert dict(got) == {i: c for i, c in plan.items() if c}


def test_repeated_ids_meet_the_target(spark, monkeypatch):
    """A third of all rows have no id and one size; a line of them takes a number between one and two copies each."""
    monkeypatch.setattr(M, "PER_PIECE", 64)
    rows = [(None, prose(i % 7, 11), "en", "a") for i in range(1000)] + [(i, prose(i, 5 + i % 90), "en", "b") for i in range(1500)]
    rows += [(1, prose(3, 40), "en", "c")] * 500
    docs = documents(spark, rows).repartition(4)
    plan = M.copies(docs)
    listed = M.rows_of(plan).collect()
    assert len(listed) == len(rows) and all(0 <= r["copies"] <= 2 for r in listed)
    taken, goal = defaultdict(int), {r["source"]: r["target"] for r in listed}
    for r in listed:
        taken[r["source"]] += r["copies"] * r["size"]
    for s, t in goal.items():
        assert taken[s] == pytest.approx(t, rel=0.01)
    mixed = M.mix(docs).collect()
    words = defaultdict(int)
    for r in mixed:
        words[r["source"]] += len(r["text"].split())
    assert dict(words) == dict(taken)


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    plan = M.copies(docs).collect()
    assert sum(r["n"] for r in plan) == len(odd_rows())
    assert {r["n"] for r in plan if r["doc_id"] == 7} == {2}
    assert all(0 <= r["total"] <= 2 * r["n"] for r in plan)
    assert M.copies(docs.limit(0)).count() == 0 and M.mix(docs.limit(0)).count() == 0
    empty = documents(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert {(r["total"], r["target"]) for r in M.copies(empty).collect()} == {(1, 0.0)}
