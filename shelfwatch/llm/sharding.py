"""Sharding by balanced label propagation: copies come together, shards stay even in bytes.

Documents with equal texts are linked. Every document starts in a shard by hash. In each round a
join shows it how much of its group every shard holds, and it asks for the fullest one that has
room; quotas per pair of shards, swaps first and then free room, admit the requests with the
highest gain. Documents without links fill what is left, and a last step moves the cheapest
documents out of shards that are still too large.

Copies in one group and bundle (a hash of the id, BUNDLES per group) move as one node. A node with
more than a small share of a shard's bytes, such as that of a row repeated very often, is split into
numbered parts, so no group and no repeated row keeps the shards from being even. The driver sees
sums per pair of shards and order bin, whose number is fixed.
"""

from __future__ import annotations

import warnings
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import gapless, materialise

BUNDLES = 1024
#: rounds of propagation, and passes of evening without a move before it ends
ROUNDS, IDLE = 12, 4
#: order bins: of requests with like gain, and of documents in a shard
BINS, FILL_BINS = 64, 4096
#: shards whose size is this near the mean, as a share of it, are even
EVEN = 0.001

KEY = ["h", "crc", "size"]


def _hash(salt: int, bins: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(bins))


def _pick(rows: list, quota: dict) -> tuple[dict, set]:
    """Per (from, to): the last order bin admitted under its quota; and the shards that refused some.

    ``rows``: from, to, bin, bytes.
    """
    last, used, closed = {}, defaultdict(float), set()
    for r in sorted(rows, key=lambda r: (r["label"], r["to"], r["o"])):
        pair = (r["label"], r["to"])
        if pair not in closed and used[pair] + r["bytes"] <= quota.get(pair, 0.0):
            used[pair] += r["bytes"]
            last[pair] = r["o"]
        else:
            closed.add(pair)
    return last, {j for _, j in closed}


def _quotas(rows: list, load: dict, cap: float, shards: int) -> dict:
    """Bytes each pair may move: what it swaps, and a share of the free room of the target."""
    wish = defaultdict(float)
    for r in rows:
        wish[r["label"], r["to"]] += r["bytes"]
    out = {}
    for j in range(shards):
        room = max(0.0, cap - load.get(j, 0.0))
        more = {i: wish[i, j] - min(wish[i, j], wish[j, i]) for i in range(shards) if i != j}
        for i, extra in more.items():
            out[i, j] = min(wish[i, j], wish[j, i]) + (room * extra / total if (total := sum(more.values())) else 0.0)
    return out


def _admitted(last: dict) -> Column:
    admitted = F.lit(False)
    for (i, j), o in last.items():
        admitted = admitted | ((F.col("label") == i) & (F.col("to") == j) & (F.col("o") <= o))
    return admitted


def propagate(nodes: DataFrame, cap: float, shards: int) -> DataFrame:
    """``nodes`` (KEY, bundle, n, bytes, label) of groups with more than one node, moved together.

    A shard that had to refuse requests is full, and asked for no more; its groups go elsewhere.
    """
    full: set[int] = set()
    for turn in range(ROUNDS):
        load = {r["label"]: float(r["bytes"]) for r in nodes.groupBy("label").agg(F.sum("bytes").alias("bytes")).collect()}
        room = [j for j in range(shards) if j not in full and cap - load.get(j, 0.0) > EVEN * cap]
        open_ = f"array_contains(array({', '.join(map(str, room)) or '-1'}), x.label)"
        held = nodes.groupBy(*KEY, "label").agg(F.sum("n").alias("w"))
        spread = held.groupBy(*KEY).agg(F.collect_list(F.struct("w", "label")).alias("held"))  # a row per shard at most
        # the shard that holds most of the group, of those with room and one's own; ties to one with room, then by hash
        best = F.expr(
            f"array_max(transform(filter(held, x -> x.label = label or {open_}),"
            f" x -> struct(x.w as w, {open_} as open, pmod(xxhash64(h, x.label), 1000) as t, x.label as label)))"
        )
        own = F.expr("filter(held, x -> x.label = label)[0].w - n")
        asked = (
            nodes.join(spread, KEY).withColumn("_best", best)
            .withColumns({"to": F.col("_best.label"), "gain": F.col("_best.w") - own})
            .withColumn("o", (40 - F.floor(F.log2(F.greatest("gain", F.lit(0)) + 1))) * BINS + _hash(turn, BINS, "h", "bundle"))
            .select(*nodes.columns, "to", "o", "gain")
        )
        asked = materialise(asked)
        rows = asked.where("`to` <> label and gain >= 0").groupBy("label", "to", "o").agg(F.sum("bytes").alias("bytes")).collect()
        last, refused = _pick(rows, _quotas(rows, load, cap, shards))
        if not last and refused <= full:
            return nodes
        full |= refused
        moves = _admitted(last) & (F.col("gain") >= 0)
        nodes = asked.withColumn("label", F.when(moves, F.col("to")).otherwise(F.col("label")).cast("int")).select(*nodes.columns)
    return materialise(nodes)


def _fill(nodes: DataFrame, need: dict[int, float]) -> DataFrame:
    """Nodes without links, dealt to shards by what each still needs."""
    o = _hash(101, FILL_BINS, "h", "bundle")
    rows = nodes.groupBy(o.alias("o")).agg(F.sum("bytes").alias("bytes")).collect()
    total, wanted = sum(float(r["bytes"]) for r in rows), sum(need.values())
    scale = total / wanted if wanted else 0.0
    order = sorted(need)
    label, done, at = F.lit(None).cast("int"), 0.0, 0
    limit = need[order[0]] * scale
    starts = {0: -1}
    for r in sorted(rows, key=lambda r: r["o"]):
        while at + 1 < len(order) and done + float(r["bytes"]) / 2 > limit:
            at += 1
            limit += need[order[at]] * scale
            starts[at] = r["o"]
        done += float(r["bytes"])
    label = F.lit(order[0])
    for k, first in starts.items():
        if k:
            label = F.when(o >= first, F.lit(order[k])).otherwise(label)
    return nodes.withColumn("label", label.cast("int"))


def _even(nodes: DataFrame, cap: float, shards: int) -> DataFrame:
    """Move the cheapest nodes out of shards that are too large until all are even, or nothing helps.

    Loads that stay uneven, as single documents may be larger than what is missing, are warned of.
    """
    turn = idle = 0
    while True:
        load = {j: 0.0 for j in range(shards)}
        load |= {r["label"]: float(r["bytes"]) for r in nodes.groupBy("label").agg(F.sum("bytes").alias("bytes")).collect()}
        over = {j: b - cap for j, b in load.items() if b > cap}
        room = {j: cap - b for j, b in load.items() if b < cap}
        worst = max(map(abs, (*over.values(), *room.values())), default=0.0)
        if not over or not room or worst <= EVEN * cap:
            break
        if idle == IDLE:
            warnings.warn(f"shards stay up to {worst:.0f} bytes off the mean of {cap:.0f}", stacklevel=2)
            break
        excess = F.lit(None).cast("double")
        for j, b in over.items():
            excess = F.when(F.col("label") == j, F.lit(min(b, max(room.values())) * (2 if idle else 1))).otherwise(excess)
        # nodes without links first, then those of small groups; large ones first, to be followed by finer ones
        o = F.when(F.col("linked"), 1 + F.floor(F.log2("total"))).otherwise(0) * FILL_BINS + _hash(200 + turn, FILL_BINS, "h", "bundle")
        bins = nodes.where(F.col("bytes") <= excess).groupBy("label", o.alias("o")).agg(F.sum("bytes").alias("bytes")).collect()
        moves = []
        for i in sorted(over):
            for r in sorted((r for r in bins if r["label"] == i), key=lambda r: r["o"]):
                j = max(room, key=lambda k: (room[k], -k))
                b = float(r["bytes"])
                # a move has to bring the two shards nearer to each other
                if over[i] <= 0 or over[i] + room[j] <= b:
                    continue
                if b > 1.5 * over[i] or b > 1.5 * room[j]:
                    continue
                over[i] -= b
                room[j] -= b
                moves.append((i, r["o"], j))
        turn, idle = turn + 1, 0 if moves else idle + 1
        if not moves:
            continue
        plan = nodes.sparkSession.createDataFrame(moves, "label int, _o long, _to int")  # order bins at most
        nodes = materialise(
            nodes.withColumn("_o", F.when(F.col("bytes") <= excess, o))
            .join(F.broadcast(plan), ["label", "_o"], "left")
            .withColumn("label", F.coalesce("_to", "label").cast("int")).select(*nodes.columns)
        )
    return nodes


def assign(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text counts as empty. Sizes of shards
    are even as far as single documents allow. ``slot`` numbers each shard's rows from 0. Repeated
    rows, and null ids, are documents like others, and may lie in different shards. Other columns
    are left out. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.xxhash64(body).alias("h"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("bundle", _hash(5, BUNDLES, "doc_id"))
    )
    whole = base.agg(F.sum("size")).first()[0] or 0
    cap = whole / shards
    # nodes too large to be evened out, split by their ids and then, where one id repeats, by row
    most = EVEN * cap / 2
    one_id = F.min("doc_id").eqNullSafe(F.max("doc_id"))
    for by, repeats in (("doc_id", False), ("row", True)):
        counted = base.groupBy(*KEY, "bundle").agg(F.count(F.lit(1)).alias("n"), one_id.alias("_one"))
        large = counted.where((F.col("n") > 1) & (F.col("n") * F.col("size") > F.lit(most)) & (F.col("_one") == F.lit(repeats)))
        parts = 4 * F.least("n", F.ceil(F.col("n") * F.col("size") / F.lit(most)))
        # fewer rows than shards by 2 / EVEN, whatever the table
        split = F.broadcast(large.select(*KEY, "bundle", parts.alias("_parts")))
        finer = F.xxhash64("bundle", F.pmod(F.xxhash64(by, F.lit(9)), F.col("_parts")))
        base = base.join(split, [*KEY, "bundle"], "left").withColumn("bundle", F.when(F.col("_parts").isNull(), F.col("bundle")).otherwise(finer)).drop("_parts")
    base = materialise(base)
    nodes = base.groupBy(*KEY, "bundle").agg(F.count(F.lit(1)).alias("n"))
    groups = nodes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_nodes"), F.sum("n").alias("total"))
    nodes = materialise(
        nodes.join(groups, KEY)
        .withColumns({"linked": F.col("_nodes") > 1, "bytes": F.col("n") * F.col("size"), "label": _hash(3, shards, *KEY, "bundle").cast("int")})
        .drop("_nodes")
    )
    linked = propagate(nodes.where("linked"), cap, shards)
    load = {r["label"]: float(r["bytes"]) for r in linked.groupBy("label").agg(F.sum("bytes").alias("bytes")).collect()}
    need = {j: max(cap - load.get(j, 0.0), 0.0) for j in range(shards)}
    placed = materialise(linked.unionByName(_fill(nodes.where("not linked"), need)))
    placed = _even(placed, cap, shards)
    shard = placed.select(*KEY, "bundle", F.col("label").alias("shard"))
    rows = materialise(base.join(shard, [*KEY, "bundle"]).select("doc_id", "size", F.col("crc").alias("text_crc32"), "h", "row", "shard"))
    return gapless(rows, "slot", ["shard"], ["doc_id", "h", "row"], per_chunk=5000).drop("h", "row")


def cut(assigned: DataFrame, group: list[str]) -> DataFrame:
    """(links, cut): pairs of rows that agree in ``group``, and those of them in different shards."""
    held = assigned.groupBy(*group, "shard").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    per = held.groupBy(*group).agg(F.sum("n").alias("n"), F.sum(pairs).alias("same"))
    return per.agg(F.sum(pairs).alias("links"), F.sum(pairs - F.col("same")).alias("cut"))
