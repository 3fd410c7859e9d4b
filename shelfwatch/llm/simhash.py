"""SimHash near-duplicates: fingerprints, and exact Hamming search in vantage-point trees.

Fingerprints within r bits agree in one of r + 1 bands of their bits, so each is dealt to the block
of its value in every band, and pairs are looked for inside blocks only. A block that is too large
for one task is cut by a vantage-point tree. The tree's inner nodes hold a vantage fingerprint and a
radius; the inside child has what is no farther from the vantage. Every fingerprint goes to its own
leaf, and as a visitor to each leaf that the triangle inequality can't rule out: a neighbour within
r bits differs by at most r in its distance to any vantage. Each leaf is one shard; its own
fingerprints are compared with all its members, so every pair is found in the leaf of either end.
Visitors grow by about 1.7 times per level, as distances of unrelated texts lie close together, so
only large blocks are cut, and a shard goes on by itself with rings around further vantages, which
take no copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import free_names, map_slices, materialise
from shelfwatch.llm.components import components

SEED = 42
#: own fingerprints a leaf should have; blocks of no more are one shard
LEAF = 65_536
#: shards of no more are compared without rings
SMALL = 256
#: the tree's shape is fitted on this many fingerprints per leaf, MOST at most; what it finds doesn't depend on it
PER_LEAF, LEAST, MOST = 16, 4096, 65_536


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash over ``shingle``-word shingles of the lower-cased text; 0 without words.

    Lower-casing and words are ASCII, as are ``bytes.lower`` and ``bytes.split``. A text with
    fewer words is one shingle. Repeated shingles count repeatedly.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65_536):
        hashes = [digest(body[i:j], SEED) for i, j in zip(starts[at : at + 65_536], stops[at : at + 65_536])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "_fp", shingle: int = 4) -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""

    def make():
        return lambda texts: {out: np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}

    return map_slices(docs, f"`{out}` long", text, make)


def distance(values: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint64(vantage))


def _wide(values: np.ndarray, k: int) -> list[int]:
    """Sign patterns of the ``k`` widest directions: vantages from which distances differ most."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(flat, axis=1, bitorder="little").astype(np.float64)
    _, axes = np.linalg.eigh(np.cov(bits, rowvar=False))
    return [int(np.packbits(axes[:, -i] > 0, bitorder="little").view("<u8")[0]) for i in range(1, k + 1)]


def _vantage(values: np.ndarray, rng: np.random.Generator) -> tuple[int, int]:
    """Of some candidates, the vantage and radius whose boundary fewest values overlap."""
    best = None
    for v in [*_wide(values, 3), *map(int, rng.choice(values, 8))]:
        d = distance(values, v).astype(np.int64)
        radius = int(np.median(d))
        inside = float(np.mean(d <= radius))
        near = float(np.mean(np.abs(d - radius - 0.5) < 4))
        score = near + abs(inside - 0.5)
        if best is None or score < best[0]:
            best = (score, v, radius)
    return best[1], best[2]


def fit_tree(values: np.ndarray, depth: int, seed: int = 7) -> list:
    """Nested nodes [vantage, radius, inside, outside]; a leaf is its number."""
    rng, leaves = np.random.default_rng(seed), iter(range(1 << 62))

    def grow(part: np.ndarray, left: int):
        if left == 0 or len(part) < 4:
            return next(leaves)
        vantage, radius = _vantage(part, rng)
        near = distance(part, vantage) <= radius
        return [vantage, radius, grow(part[near], left - 1), grow(part[~near], left - 1)]

    return grow(values, depth)


def route(tree: list, values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, value, own) for each value's own leaf and each leaf that may hold a neighbour."""
    found, todo = [], [(tree, values, np.ones(len(values), bool))]
    while todo:
        node, part, own = todo.pop()
        if not len(part):
            continue
        if isinstance(node, int):
            found.append((np.full(len(part), node, np.int32), part, own))
            continue
        vantage, radius, inside, outside = node
        d = distance(part, vantage).astype(np.int16)
        for child, visits, mine in ((inside, d <= radius + bits, d <= radius), (outside, d > radius - bits, d > radius)):
            todo.append((child, part[visits], own[visits] & mine[visits]))
    if not found:
        return np.array([], np.int32), values[:0], np.array([], bool)
    return tuple(np.concatenate(x) for x in zip(*found))


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each pair; ``label`` holds every item's smallest item."""
    while True:
        la, lb = label[a], label[b]
        if not (apart := la != lb).any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(la[apart], lb[apart]), np.minimum(la[apart], lb[apart]))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def search(values: np.ndarray, own: np.ndarray, bits: int, block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Links between the own values of a leaf and its members, as (value, smallest of its set).

    Further vantages cut the leaf into rings; a value meets only members whose rings are all within
    ``bits`` of its own. A set of many near copies yields one link per member, not all pairs.
    """
    values, at = np.unique(values, return_index=True)
    own = own[at]
    label = np.arange(len(values))
    if len(values) < 2 or not own.any():
        return values[:0], values[:0]
    if len(values) <= SMALL:
        a, b = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= bits, 1))
        _union(label, a, b) if own.all() else _union(label, *(x[own[a] | own[b]] for x in (a, b)))
        linked = np.flatnonzero(label != np.arange(len(values)))
        return values[linked], values[label[linked]]
    some = values if len(values) <= 4096 else np.random.default_rng(11).choice(values, 4096, replace=False)
    vantages = _wide(some, 1 + (len(values) > 2000) + (len(values) > 30_000))
    rings = [distance(values, v).astype(np.int64) for v in vantages]
    scale = 65 ** np.arange(len(rings) - 1, -1, -1)
    ring = np.dot(scale, rings)
    order = np.argsort(ring, kind="stable")
    sorted_rings, members = ring[order], values[order]
    mine = order[own[order]]  # own values, by ring
    cells, first = np.unique(ring[mine], return_index=True)
    for cell, queries in zip(cells.tolist(), np.split(mine, first[1:])):
        *outer, last = (cell // scale % 65).tolist()
        near = np.zeros(1, np.int64)
        for k, unit in zip(outer, scale):
            near = (near[:, None] + np.arange(max(0, k - bits), min(64, k + bits) + 1) * unit).ravel()
        lo = np.searchsorted(sorted_rings, near + max(0, last - bits), "left")
        hi = np.searchsorted(sorted_rings, near + min(64, last + bits), "right")
        spots = np.concatenate([np.arange(i, j) for i, j in zip(lo, hi) if i < j])
        others = members[spots]
        for part in np.array_split(queries, len(queries) * len(others) // block + 1):
            hit_q, hit_m = np.nonzero(np.bitwise_count(values[part][:, None] ^ others[None, :]) <= bits)
            a, b = part[hit_q], order[spots[hit_m]]
            _union(label, a[a != b], b[a != b])
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def band_keys(values: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """For each of ``bits + 1`` bands, the value of its bits with the band's number above them."""
    edges = np.linspace(0, 64, bits + 2).astype(int)
    for band, (low, high) in enumerate(zip(edges, edges[1:])):
        part = (values >> np.uint64(low)) & np.uint64((1 << int(high - low)) - 1)
        yield (part | np.uint64(band << 56) if high - low < 56 else part).view(np.int64)


def links(prints: DataFrame, fp: str = "_fp", bits: int = 4, leaf: int | None = None) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints within ``bits`` of each other.

    ``prints`` has distinct fingerprints in ``fp`` and must be stable. Each is in ``bits + 1``
    blocks. Blocks over ``leaf`` fingerprints, fewer than (bits + 1) / leaf of all fingerprints, are
    known to every task, and share one tree, fitted on a bounded sample; its shape doesn't change
    what is found. A shard passes through its task as its rows come.
    """

    leaf = leaf or LEAF

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[fp].to_numpy(np.int64).view(np.uint64)
            for keys in band_keys(values, bits):
                yield pd.DataFrame({"block": keys, "value": values.view(np.int64)})

    dealt = prints.select(fp).mapInPandas(deal, "block long, value long")
    sizes = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf).collect()
    large = np.sort(np.array([r["block"] for r in sizes], np.int64))
    depth = max((math.ceil(math.log2(r["n"] / leaf)) for r in sizes), default=0)
    tree = 0
    if depth:
        size = min(MOST, max(LEAST, PER_LEAF << depth))
        sample = prints.orderBy(F.xxhash64(fp), fp).limit(size).toPandas()[fp].to_numpy(np.int64).view(np.uint64)
        tree = fit_tree(sample, depth)

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[fp].to_numpy(np.int64).view(np.uint64)
            for keys in band_keys(values, bits):
                cut = np.isin(keys, large)
                yield pd.DataFrame({"block": keys[~cut], "leaf": np.int32(0), "value": values[~cut].view(np.int64), "own": True})
                if cut.any():
                    # values are distinct, so a value leads back to its block
                    order = np.argsort(values[cut])
                    place, value, own = route(tree, values[cut], bits)
                    block = keys[cut][order][np.searchsorted(values[cut][order], value)]
                    yield pd.DataFrame({"block": block, "leaf": place, "value": value.view(np.int64), "own": own})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            block, place = rows.column("block").to_numpy(), rows.column("leaf").to_numpy()
            value, own = rows.column("value").to_numpy().view(np.uint64), rows.column("own").to_numpy().astype(bool)
            ends = np.flatnonzero((np.diff(block) != 0) | (np.diff(place) != 0)) + 1
            out = [search(v, o, bits) for v, o in zip(np.split(value, ends), np.split(own, ends)) if len(v) > 1]
            if out:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.table(batch))
            rows = pa.concat_tables(held)
            block, place = rows.column("block").to_numpy(), rows.column("leaf").to_numpy()
            # the last shard may go on in the next batch
            last = int(np.argmax((block == block[-1]) & (place == place[-1])))
            yield from found(rows.slice(0, last))
            held = [rows.slice(last)]
        if held:
            yield from found(pa.concat_tables(held))

    dealt = prints.select(fp).mapInPandas(shards, "block long, leaf int, value long, own boolean")
    shard = ["block", "leaf"]
    return dealt.repartition(*shard).sortWithinPartitions(*shard).mapInArrow(join, "a long, b long")


def _placed(docs: DataFrame, doc_id: str, text: str, shingle: int, bits: int) -> DataFrame:
    """(doc_id, text_hash, _fp, root, component_id) of every row; ``root`` is the component's key, never null."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    rows = materialise(with_fingerprints(rows, "_text", shingle=shingle).drop("_text"))
    prints = materialise(rows.groupBy("_fp").agg(F.min("doc_id").alias("_least")))
    roots = components(links(prints, bits=bits))
    placed = prints.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("root")
    )
    placed = materialise(placed)
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    by_print = placed.join(least, "root").select("_fp", "root", "component_id")
    return rows.join(by_print, "_fp")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4
) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id) of every row.

    Fingerprints link at ``bits`` or fewer differing bits; the component's id is the smallest
    doc_id reached over any number of links, itself included (nulls last; null if it has no other).
    A null text counts as empty; texts without words have fingerprint zero, linked like any other.
    Equal fingerprints are one node, so copies cost nothing in the search.
    """
    return _placed(docs, doc_id, text, shingle, bits).select(
        "doc_id", "text_hash", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row per component: that with the smallest doc_id, then the smallest text hash.

    Components are told apart by their root: several may share a smallest doc_id, or have none. Of
    rows that repeat an id and a text one stays, whichever values their other columns have. All
    columns stay, whatever their names; an empty table stays empty.
    """
    found = _placed(docs, "doc_id", "text", shingle, bits)
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    kept = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("k"))
    own, hashed = free_names(docs.columns, "id", "hash")
    kept = materialise(kept.select(F.col("k.doc_id").alias(own), F.col("k.text_hash").alias(hashed), "k.n"))
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(hashed))
    # texts move once, for the join; only repeated rows go through an aggregation as well
    single = docs.join(kept.where("n = 1").drop("n"), same, "left_semi")
    repeated = kept.where("n > 1").drop("n")
    if repeated.isEmpty():
        return single
    return single.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
