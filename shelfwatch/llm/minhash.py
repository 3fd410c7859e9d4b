"""MinHash near-duplicates: one hash per shingle, densified bins, bands, and star-shaped candidates.

A document's distinct shingles are hashed once; each of ``BINS`` bins keeps its least hash, and an
empty bin takes that of the first occupied one in an order of its own (optimal densification).
Bands of ``ROWS`` bins are bucket keys. Two sets of similarity 0.85 miss all 42 buckets with a
probability of about 2e-9.

Equal sets are one node. In a bucket, candidates go from a few centres to the other members, not
between all members; a candidate is confirmed on the full sets. Centres are taken by the number of
buckets and members a node meets, so the text that many others derive from comes first and a large
group is joined by one star.

One star is not enough, as two members may be alike without being like the centre. Of the nodes in
buckets that still have two components, a shingle is rare if few have it and common if more do. A
linked pair shares a rare shingle, or its whole intersection is among the common ones. The former
are looked up by their rare shingles. The latter need nodes that are common shingles nearly
throughout; among them rounds go on with further centres, each round three times as many as all
before, until every bucket has one component left or all its members have been centres: no link
inside a bucket is lost. Left out are pairs of one component, pairs already looked at, and pairs
whose bounds rule a link out: a shingle that no other candidate has is in no intersection, so the
smaller number of shared shingles bounds it, and without a rare one the smaller number of common
ones. That spares edits of a text that are all unlike each other from being compared pair by pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_slices, materialise
from shelfwatch.llm.components import components

SEED = 42
ROWS, BANDS = 6, 42
BINS = ROWS * BANDS
#: a shingle that more nodes have is common; pairs are not looked up by it
RARE = 50


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Hashes of the distinct ``width``-word shingles, ascending; fewer words are one shingle, none is none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.array([], np.uint64)
    body = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - width + 1)
    starts = (ends - sizes)[:n].tolist()
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(body[i:j], SEED) for i, j in zip(starts, stops)], np.uint64))


def _orders(bins: int = BINS) -> np.ndarray:
    """For each bin the order in which it tries the others."""
    return np.argsort(np.random.default_rng(5).random((bins, bins)), axis=1)


def bins_of(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The least hash of each bin; an empty bin takes that of the first occupied bin in its order."""
    count = len(orders)
    place = ((hashes >> np.uint64(32)) % np.uint64(count)).astype(np.int64)
    least, full = np.zeros(count, np.uint64), np.zeros(count, bool)
    least[place[::-1]] = hashes[::-1]  # ascending hashes: the last one written is the least
    full[place] = True
    empty = np.flatnonzero(~full)
    tried = orders[empty]
    least[empty] = least[tried[np.arange(len(empty)), full[tried].argmax(axis=1)]]
    return least


def _mixers(rows: int) -> np.ndarray:
    return np.random.default_rng(6).integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)


def bands_of(least: np.ndarray, mixers: np.ndarray) -> np.ndarray:
    """One bucket key per band."""
    parts = least.reshape(-1, len(mixers))
    mixed = (parts ^ (parts >> np.uint64(29))) * mixers
    keys = (mixed ^ (mixed >> np.uint64(32))).sum(axis=1, dtype=np.uint64)
    return (keys * np.uint64(64) + np.arange(len(parts), dtype=np.uint64)).view(np.int64)


def with_signatures(docs: DataFrame, text: str, width: int) -> DataFrame:
    """``docs`` with ``_n`` (set size), ``_set`` (a digest of the set, null if empty) and ``_bands``."""

    def make():
        orders, mixers = _orders(), _mixers(ROWS)

        def work(texts: list) -> dict[str, list]:
            out = {"_n": [], "_set": [], "_bands": []}
            for t in texts:
                found = shingles(t, width)
                out["_n"].append(len(found))
                out["_set"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                out["_bands"].append(bands_of(bins_of(found, orders), mixers) if len(found) else [])
            return out

        return work

    return map_slices(docs, "_n long, _set binary, _bands array<long>", text, make)


def _sets(docs: DataFrame, nodes: DataFrame, text: str, width: int) -> DataFrame:
    """(id, set) of ``nodes`` (id, text_key): the full shingle sets, from the texts."""

    def make():
        return lambda texts: {"set": [shingles(t, width).view(np.int64) for t in texts]}

    texts = docs.select(F.md5(text).alias("text_key"), F.col(text).alias("_text")).join(nodes, "text_key")
    one = texts.groupBy("id").agg(F.first("_text").alias("_text"))
    return map_slices(one, "set array<long>", "_text", make, rows=64).select("id", "set")


def _shared(sets: DataFrame) -> DataFrame:
    """(id, shared): how many of a node's shingles another node has as well."""
    once = sets.select("id", F.explode("set").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("_nodes"), F.min("id").alias("id"))
    own = once.where("_nodes = 1").groupBy("id").agg(F.count(F.lit(1)).alias("_own"))
    sized = sets.select("id", F.size("set").cast("long").alias("n"))
    return sized.join(own, "id", "left").select("id", "n", (F.col("n") - F.coalesce("_own", F.lit(0))).alias("shared"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, n_a, n_b) whose full sets are alike enough."""
    left, right = (sets.select(F.col("id").alias(x), F.col("set").alias(f"_{x}")) for x in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("_same", F.size(F.array_intersect("_a", "_b")))
    return both.where(f"100L * _same >= {percent}L * (n_a + n_b - _same)").select("a", "b")


def _stars(live: DataFrame, first: int, last: int, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of every bucket's centres number ``first`` to ``last`` with members of other roots.

    ``live`` has (key, id, root, n, most, _meets); the smaller ``most`` bounds the intersection.
    """
    by = Window.partitionBy("key").orderBy(F.desc("_meets"), "id")
    places = live.withColumn("_place", F.row_number().over(by)).where(f"_place <= {last} and _place >= {first}")
    centres = places.select(F.col("key").alias("key_c"), F.col("id").alias("c"), F.col("n").alias("n_c"), F.col("most").alias("most_c"), F.col("root").alias("root_c"))
    most = "least(most, most_c, n, n_c)"
    stars = live.join(centres, F.expr(f"key = key_c and root <> root_c and 100L * {most} >= {percent}L * (n + n_c - {most})"))
    return stars.select(
        F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b"),
        F.expr("if(id < c, n, n_c)").alias("n_a"), F.expr("if(id < c, n_c, n)").alias("n_b"),
    ).distinct()


def _rare(live: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, root, n, common, held, rare) of the nodes in ``live``, ``rare`` having (at, s) of their rare shingles.

    A shingle is rare if two to ``RARE`` of the nodes have it, and common if more have it. ``rare``
    lists those that nodes of two roots have, ``held`` counts them.
    """
    nodes = live.select("id", "root", "n").distinct()
    spread = nodes.join(sets, "id").select("id", "root", F.explode("set").alias("s"))
    seen = spread.groupBy("s").agg(F.count(F.lit(1)).alias("at"), F.min("id").alias("id"), F.expr("min(root) <> max(root)").alias("across"))
    own = seen.where("at = 1").groupBy("id").agg(F.count(F.lit(1)).alias("_own"))
    few = spread.drop("root").join(seen.where(f"at > 1 and at <= {RARE}").drop("id"), "s")
    few = few.groupBy("id").agg(F.count(F.lit(1)).alias("_few"), F.expr("array_sort(collect_list(struct(at, s)) filter (where across))").alias("rare"))
    known = nodes.join(own, "id", "left").join(few, "id", "left")
    return known.select(
        "id", "root", "n", F.expr("n - coalesce(_own, 0) - coalesce(_few, 0)").alias("common"),
        F.expr("coalesce(size(rare), 0)").cast("long").alias("held"), "rare",
    )


def _sharing(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of nodes (see ``_rare``) of two roots that share a rare shingle and may be linked.

    A link takes ``percent`` percent of a node's shingles, so all that are not common have to be
    rare ones. Sorted by their number of nodes, two nodes that share so many share one that is not
    among the last of either: only the first ones are looked up.
    """
    least = f"greatest(1L, ({percent}L * n + 99) div 100 - common)"
    able = nodes.where(f"held >= {least}").withColumn("_most", F.expr("common + held"))
    first = able.select("id", "root", "n", "_most", F.explode(F.expr(f"slice(rare, 1, int(held - {least} + 1))")).alias("r"))
    first = materialise(first.select("id", "root", "n", "_most", F.col("r.s").alias("s")))
    left, right = (first.select("s", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "root", "n", "_most")]) for x in ("a", "b"))
    most = "least(_most_a, _most_b, n_a, n_b)"
    both = left.join(right, "s").where(f"id_a < id_b and root_a <> root_b and 100L * {most} >= {percent}L * (n_a + n_b - {most})")
    return both.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "n_a", "n_b").distinct()


def _merged(roots: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``roots`` (id, root) after the links among ``pairs``."""
    found = _linked(pairs, sets, percent)
    ends = [roots.select(F.col("id").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")]
    moved = components(found.join(ends[0], "a").join(ends[1], "b").select("root_a", "root_b"), "root_a", "root_b")
    moved = moved.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return materialise(roots.join(moved, "root", "left").select("id", F.coalesce("_to", "root").alias("root")))


def _open(live: DataFrame, roots: DataFrame, used: int) -> DataFrame:
    """The rows of ``live``, with their roots of now, in buckets of two roots and more than ``used`` members."""
    now = live.drop("root").join(roots, "id")
    open_ = now.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.count(F.lit(1)).alias("_size"))
    return materialise(now.join(open_.where(f"_low <> _high and _size > {used}").select("key"), "key"))


def links_by_stars(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, root) of every node that may have a link: components over the links within buckets.

    ``members`` has (key, id), of buckets with two nodes or more; ``sets`` (id, set) of their nodes.
    """
    able = materialise(_shared(sets).where(f"100L * shared >= {percent}L * n"))
    members = materialise(members.join(able.select("id"), "id"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("_size"))
    meets = members.join(sizes, "key").groupBy("id").agg(F.sum(F.col("_size") - 1).alias("_meets"))
    meets = materialise(meets.join(able, "id").select("id", "n", F.col("shared").alias("most"), "_meets", F.col("id").alias("root")))
    roots = meets.select("id", "root")
    live = materialise(members.join(meets, "id"))
    seen = materialise(_stars(live, 1, 1, percent))
    roots = _merged(roots, seen, sets, percent)
    live = _open(live, roots, 1)
    if live.isEmpty():
        return roots
    known = materialise(_rare(live, sets))
    pairs = materialise(_sharing(known, percent).join(seen, ["a", "b"], "left_anti"))
    roots = _merged(roots, pairs, sets, percent)
    seen = seen.union(pairs)
    # what is left shares no rare shingle, so its intersection is among the common ones
    common = known.where(f"100L * common >= {percent}L * n").select("id", F.col("common").alias("most"))
    live = _open(live.drop("most").join(common, "id"), roots, 0)
    used, more = 0, 1
    while not live.isEmpty():
        pairs = materialise(_stars(live, used + 1, used + more, percent).join(seen, ["a", "b"], "left_anti"))
        seen = seen.union(pairs)
        roots = _merged(roots, pairs, sets, percent)
        used, more = used + more, 3 * (used + more)
        live = _open(live, roots, used)
    return roots


def _placed(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = with_signatures(docs.withColumn("text_key", F.md5("text")), "text", width).drop("text")
    rows = materialise(rows)
    nodes = rows.where("_set is not null").groupBy("_set").agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.first("_n").alias("n"), F.first("_bands").alias("bands"))
    nodes = materialise(nodes.withColumn("id", F.monotonically_increasing_id()))
    spread = nodes.select("id", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1").select("key")
    members = materialise(spread.join(shared, "key"))
    candidates = members.select("id").distinct()
    full = materialise(_sets(docs, nodes.join(candidates, "id").select("id", "text_key"), "text", width))
    roots = links_by_stars(members, full, percent)
    rooted = nodes.select("_set", "id", "least").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = rooted.join(least, "root").select("_set", "root", "component_id")
    return rows.join(by_set, "_set", "left")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words are lower-cased (A-Z) and split at ASCII white space; a document's set has its distinct
    ``width``-word shingles, or its whole sequence of words if they are fewer. Sets are linked if
    the intersection is ``percent`` percent of the union or more. ``component_id`` is the smallest
    doc_id reached over any number of links, itself included; ``kept`` says that it is the row's
    own. Null texts and texts without words have an empty set, linked with nothing: their
    component is their own id. Null ids are the largest; a component with none but null ids has a
    null one, and its rows are kept. Repeated rows are linked as equal sets. An empty table gives
    no rows; other columns are left out.
    """
    found = _placed(docs, doc_id, text, width, percent)
    component = F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("_n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
