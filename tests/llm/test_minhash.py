import random

import numpy as np
import pytest
from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import minhash as M

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def brute_set(text, width=5):
    words, word = [], ""
    for c in (text or "").translate(UPPER) + " ":
        if c not in BLANK:
            word += c
        elif word:
            words.append(word)
            word = ""
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent=85):
    sets = [brute_set(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    ids = {}
    for r, x in zip(rows, label):
        ids.setdefault(x, []).append(r[0])
    out = []
    for r, x, s in zip(rows, label, sets):
        known = [i for i in ids[x] if i is not None]
        component = min(known) if known else None
        out.append((r[0], len(s), component, r[0] == component))
    return sorted(out, key=str)


def placed(df, **options):
    return sorted((tuple(r) for r in M.near_duplicates(df, **options).collect()), key=str)


def edited(rng, text, share):
    words = text.split()
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = "new" + str(rng.randint(0, 10**6))
    return " ".join(words)


def family(rng, seed, n, share, words=150):
    """A text and ``n`` edits of it: most like the text, few like each other."""
    base = prose(seed, words)
    return [base] + [edited(rng, base, share) for _ in range(n)]


def test_families_against_brute_force(spark):
    rng = random.Random(8)
    texts = []
    for i, share in enumerate((0.005, 0.012, 0.014, 0.016, 0.02, 0.04)):
        texts += family(rng, 100 + i, 25, share)
    chain = prose(300, 200).split()
    texts += [" ".join(chain[i : i + 150]) for i in range(0, 50, 3)]  # each one like the next only
    texts += [prose(400 + i, 3) for i in range(10)] + [prose(500 + i, 9) for i in range(10)]
    texts += [t.upper() for t in texts[::7]]
    rows = [(i * 3 % 1000, t, None, None) for i, t in enumerate(texts)]
    df = clash(documents(spark, rows).repartition(3), "_n", "_set", "id", "key", "root", "least", "text_key")
    want = brute(rows)
    assert sum(not r[3] for r in want) > 60
    assert placed(df) == want


def test_members_unlike_the_centre(spark):
    """Two edits alike that both differ from the text most others derive from."""
    rng = random.Random(9)
    base = prose(50, 200)
    far = edited(rng, base, 0.03)
    texts = [base] + [edited(rng, base, 0.01) for _ in range(12)] + [far] + [edited(rng, far, 0.004) for _ in range(4)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    assert placed(documents(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = odd_rows() + [(None, "same same", "en", None)] * 3 + [(None, "", None, None), (60, "same  SAME", None, None)]
    assert placed(documents(spark, rows)) == brute(rows)


def test_null_ids_only(spark):
    rows = [(None, prose(1, 30), None, None)] * 2 + [(None, prose(2, 30), None, None), (None, None, None, None)]
    assert placed(documents(spark, rows)) == brute(rows) == sorted([(None, 26, None, True)] * 3 + [(None, 0, None, True)], key=str)


def test_text_ids_and_empty_table(spark):
    df = spark.createDataFrame([("b", "one two"), ("a", "ONE two"), (None, "x")], "name string, body string")
    assert placed(df, doc_id="name", text="body") == [("a", 1, "a", True), ("b", 1, "a", False), (None, 1, None, True)]
    assert placed(documents(spark, [])) == []


def test_densified_bins():
    """Bins agree as often as the sets do, for sets smaller than the bins too."""
    rng, orders = np.random.default_rng(3), M._orders()
    for size in (20, 200, 2000):
        rates = []
        for _ in range(200):
            pool = np.unique(rng.integers(0, 1 << 63, size + size // 5, dtype=np.uint64))
            a, b = np.sort(rng.permutation(pool)[:size]), np.sort(rng.permutation(pool)[:size])
            same = len(np.intersect1d(a, b))
            rates.append((M.bins_of(a, orders) == M.bins_of(b, orders)).mean() - same / (2 * size - same))
        assert abs(np.mean(rates)) < 0.03


@pytest.mark.parametrize("size", [7, 14, 60, 400])
def test_bands_meet(size):
    """Sets just at the threshold share a bucket."""
    rng, orders, mixers = np.random.default_rng(size), M._orders(), M._mixers(M.ROWS)
    for _ in range(300):
        shared = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        more = rng.integers(0, 1 << 63, int(size * 15 / 85), dtype=np.uint64)
        a, b = np.sort(shared), np.sort(np.concatenate([shared, more]))
        assert (M.bands_of(M.bins_of(a, orders), mixers) == M.bands_of(M.bins_of(b, orders), mixers)).any()


def test_members_unlike_each_other_are_not_compared(spark, monkeypatch):
    """Edits whose new shingles few others have: a pair is confirmed if it shares such shingles, or enough without them."""
    rng = random.Random(11)
    base, swaps = prose(60, 150).split(), ["kan", "lo", "mur"]
    texts = [" ".join(base)]
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(150), 2 + i % 5):
            words[at] = rng.choice(swaps)
        texts.append(" ".join(words))
    looked, linked = [], M._linked

    def counted(pairs, *rest):
        looked.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(M, "_linked", counted)
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    assert placed(documents(spark, rows)) == brute(rows)
    assert sum(looked) < 20 * len(rows)
