import random

import numpy as np
import xxhash
from helpers import clash, documents, odd_rows, prose

from shelfwatch.llm import simhash as S
from shelfwatch.llm.components import components


def brute_print(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for t in (None, "", " \n", "One", "a b c", "A b C d", "Ünder É a\x0bb c d e", prose(1, 400), "a b " * 300):
        assert S.fingerprint(t) == brute_print(t)


def near(n, seed):
    """Random fingerprints, some a few bits apart, some chained, one dense bunch."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for i in range(0, n - 5, 5):
        out[i + 1] = out[i] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))
        out[i + 2] = out[i + 1] ^ sum(1 << b for b in rng.sample(range(64), 3))
    return np.array(sorted(set(out + [out[0] ^ (1 << b) for b in range(64)])), np.uint64)


def brute_groups(values, bits=4):
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= bits):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_tree_and_shards_find_every_pair():
    values = near(3000, 3)
    for depth in (0, 1, 4):
        tree = S.fit_tree(values[::3], depth) if depth else 0
        leaf, value, own = S.route(tree, values, 4)
        assert sorted(value[own].tolist()) == values.tolist()  # one own leaf each
        label = np.arange(len(values))
        for k in np.unique(leaf):
            a, b = S.search(value[leaf == k], own[leaf == k], 4, block=1 << 10)
            S._union(label, np.searchsorted(values, a), np.searchsorted(values, b))
        assert label.tolist() == brute_groups(values)


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, k) for k in range(2, 60)]
    cycle = [(200, 201), (201, 202), (202, 200), (202, 202)]
    edges = spark.createDataFrame([*chain, *star, *cycle, *star], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    for nodes in (range(100, 141), range(1, 60), (200, 201, 202)):
        assert len({roots[n] for n in nodes}) == 1 and roots[nodes[0]] in nodes
    assert len(set(roots.values())) == 3
    assert components(edges.limit(0)).count() == 0


def test_bands_and_trees_find_every_link(spark):
    """Random values, chains and a dense bunch; half of them share the bits of a band, whose block is cut by a tree."""
    values = near(800, 4)
    hot = near(700, 9) & np.uint64((1 << 51) - 1) | np.uint64(5 << 51)
    values = np.unique(np.concatenate([values, hot, np.array([0, 1, 3, (1 << 64) - 1], np.uint64)]))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "_fp long").repartition(4)
    for bits, leaf in ((4, 40), (4, 100_000), (2, 64), (0, 10)):
        label = np.arange(len(values))
        found = S.links(df, bits=bits, leaf=leaf).collect()
        a, b = (np.array([r[c] for r in found], np.int64).view(np.uint64) for c in "ab")
        assert all(0 < np.bitwise_count(x ^ y) for x, y in zip(a, b))
        S._union(label, np.searchsorted(values, a), np.searchsorted(values, b))
        assert label.tolist() == brute_groups(values, bits)


def test_visitors_are_bounded():
    """Values that agree in a band are dealt to as many blocks as there are bands, whatever their number."""
    values = near(3000, 3)
    for bits in (0, 2, 4):
        keys = list(S.band_keys(values, bits))
        assert len(keys) == bits + 1
        for i in range(0, 200, 7):
            other = values[i] ^ np.uint64(sum(1 << b for b in random.Random(i).sample(range(64), bits)))
            assert any(k[i] == x[0] for k, x in zip(keys, S.band_keys(np.array([other], np.uint64), bits)))


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "LEAF", 16)  # a tree of several shards
    base = [prose(i, 150) for i in range(60)]
    texts = base + [t.replace("an.", "an!", 1) for t in base[:30]] + base[:20] + ["", None, "x", "X"]
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    random.Random(1).shuffle(rows)
    out = {r["doc_id"]: r for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = [brute_print(t) for _, t in rows]
    values = np.array(sorted(set(prints)), np.uint64)
    group = dict(zip(values.tolist(), brute_groups(values)))
    least = {}
    for (i, _), p in zip(rows, prints):
        least[group[p]] = min(least.get(group[p], i), i)
    for (i, _), p in zip(rows, prints):
        assert out[i]["fingerprint"] == f"{p:016x}" and out[i]["component_id"] == least[group[p]]


def test_keep_first_leaves_one_row_of_each_group(spark):
    docs = clash(documents(spark, odd_rows()), "_fp", "root", "component_id", "id", "_id", "_hash", "hash", "n", "k")
    kept = S.keep_first(docs).collect()
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8, 9] and ids.count(None) == 1
    assert all(r["root"] == "kept" for r in kept)
    found = S.near_duplicates(docs).collect()
    assert len(found) == len(odd_rows()) and {r["component_id"] for r in found if r["fingerprint"] == "0" * 16} == {1}
    assert S.keep_first(docs.limit(0)).count() == 0


def test_keep_first_keeps_unrelated_rows_without_or_with_equal_ids(spark):
    rows = [(None, prose(300 + i, 90), "en", "a") for i in range(6)]
    rows += [rows[0], (7, prose(400, 90), "en", "a"), (7, prose(401, 90), "en", "a"), (8, prose(401, 90), "en", "b")]
    kept = S.keep_first(documents(spark, rows)).collect()
    want = [(r[0], r[1]) for r in rows[:6] + rows[7:9]]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted((i or 0, t) for i, t in want)
