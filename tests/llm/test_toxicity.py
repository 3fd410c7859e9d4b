import random

import pytest
from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import toxicity as T


def best_segments(scores):
    """All maximal segments by definition: recursively, the best segment, then what is left and right of it."""
    found = []

    def split(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-12 or (abs(total - best[0]) <= 1e-12 and j - i < best[2] - best[1])):
                    best = (total, i, j)
        if best:
            found.append(best)
            split(lo, best[1])
            split(best[2] + 1, hi)

    split(0, len(scores))
    return sorted((i, j) for _, i, j in found)


def test_linear_scan_finds_all_maximal_segments():
    rng = random.Random(3)
    lexicon = {f"bad{k}": 2.6 + 1.37 * k for k in range(6)}
    for _ in range(200):
        words = [rng.choice([*lexicon, "ok", "ok", "fine"]) for _ in range(rng.randint(0, 25))]
        scanner = T.Scanner(lexicon)
        n, found = scanner.segments(" ".join(words))
        starts = [sum(len(w) + 1 for w in words[:i]) for i in range(len(words))]
        got = sorted((starts.index(a), next(i for i, s in enumerate(starts) if s + len(words[i]) == b)) for a, b, _ in found)
        assert n == len(words) and got == best_segments([lexicon.get(w, 0.0) - T.DRIFT for w in words])


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(6)
    vile = ["vilex", "gruntoid", "scornful"]
    rows, labels = [], []
    for i in range(600):
        text = prose(i, rng.randint(20, 120))
        if toxic := i % 5 == 0:
            words = text.split()
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(vile) + rng.choice(["", "s", "ly"]))
            text = " ".join(words)
        rows.append((i, text, "en", "a"))
        labels.append((i, 1, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_passages(spark, data):
    docs, labels = data
    model = T.learn(docs, labels.where("doc_id % 4 <> 0"))
    assert max(model.lexicon, key=model.lexicon.get).startswith(("vile", "grun", "scor"))
    out = T.score(clash(docs, "passages", "score", "n"), model).join(labels, "doc_id").where("doc_id % 4 = 0").collect()
    assert sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in out) >= 0.97 * len(out)
    for r in out:
        assert 0 <= r["score"] <= 1
        for p in r["passages"]:
            assert any(v in r["text"][p["start"] : p["end"]] for v in ("vilex", "gruntoid", "scornful"))


def test_longer_clean_text_makes_a_hit_less_telling():
    m = T.Model({}, 1.0, 0.01, -3.0, 1.0)
    assert T.surprise(m, 100, 4.0) > T.surprise(m, 10_000, 4.0) > T.surprise(m, 10_000, 1.0) >= 0
    assert T.probability(m, 100, 60.0) > 0.999 and T.probability(m, 0, 0.0) < 0.5


def test_near_copies_share_a_signature():
    text = prose(1, 200)
    assert T._signature(text) == T._signature(text.upper()) and T._signature(text) != T._signature(prose(2, 200))
    assert T._signature(None) == T._signature("")


def test_odd_rows(spark, data):
    docs, labels = data
    model = T.learn(docs, labels)
    odd = documents(spark, odd_rows())
    out = T.score(odd, model).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if not (r["text"] or "").strip()}) == 1
    assert T.score(odd.limit(0), model).count() == 0
    # nothing to learn from, one class only, null labels, repeated rows
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.selectExpr("doc_id", "quality", "cast(null as int) as toxic"), labels.union(labels)):
        assert all(0 <= r["score"] <= 1 for r in T.score(odd, T.learn(docs, some)).collect())
    assert T.learn(docs.limit(0), labels).lexicon == {}


def test_lower_casing_keeps_positions():
    scanner = T.Scanner({"bad": 9.0})
    text = "İİİ Bad"
    _, found = scanner.segments(text)
    assert [text[a:b] for a, b, _ in found] == ["Bad"]
