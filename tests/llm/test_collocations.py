import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import collocations as K

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, covered=80, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= covered * a for b in longer):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in K.collocations(df, **options).collect())


def corpus(seed, n=60):
    rng = random.Random(seed)
    few = ["a", "b", "É", "New", "york", "to", "be", " x"]
    rows = []
    for i in range(n):
        words = [rng.choice(few) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\r\n", "!?", "\x0b"]) for w in words)
        rows.append((i % 50, text + " new york city" * rng.randint(0, 3), rng.choice(["en", "de", None]), None))
    return rows + [(None, "so so so so so so so", "en", None)] * 4


@pytest.mark.parametrize("block", [40, 1000])
def test_against_brute_force(spark, block):
    rows = corpus(block)
    df = clash(documents(spark, rows), "block", "words", "spots", "id", "a", "f").repartition(3)
    for least in (3, 8):
        assert mined(df, least=least, block=block) == brute(rows, least)
    assert mined(df, least=3, covered=50, top=5, block=block) == brute(rows, 3, 50, 5)


def test_odd_rows(spark):
    rows = odd_rows() + [(50 + i, prose(9, 200, ["uno", "dos", "tres"]), None, None) for i in range(5)]
    assert mined(documents(spark, rows), least=5) == brute(rows, 5)


def test_long_text_is_cut_between_words():
    text = "Aa bb, " + "x" * 30 + " cc. dd\tee " * 20
    whole = [w for run in K._words(text) for w in run]
    for size in (1, 3, 10):
        assert [w for run in K._words(text, size) for w in run] == whole


def test_empty(spark):
    assert mined(documents(spark, [])) == []
    assert mined(documents(spark, [(1, None, None, None), (2, "", "en", None), (3, "one two", "en", None)])) == []


def test_large_counts_stay_exact(spark):
    """A score's product may pass 64 bits: the expression on counts of its own."""
    big = 10**15
    row = spark.sql(f"select {big}L as f, {big + 1}L as l, {big + 2}L as r")
    got = row.selectExpr("cast(f as decimal(20, 0)) * 2000000 div cast(l + r as decimal(20, 0)) as s").first()["s"]
    assert got == 2_000_000 * big // (2 * big + 3)
