"""Conversation structure repair: the cheapest edits that make turns alternate, by branch and bound.

A repaired conversation is empty, or an optional system row and then one or more pairs of a user
and an assistant row. Edits per row: Keep (0), Rerole to user or assistant (3), Delete (4; a blank
or duplicate row must go); Insert an empty user or assistant row anywhere (3). A truncated row that
stays adds 3. Among cheapest edits the least string of initials wins.

Each conversation is searched depth first on an explicit stack. A suffix bound (the cost of the
rest if a system row alone were a whole conversation) cuts what can't beat the incumbent
(cost, audit), and a table per node keeps the best (cost, prefix) that reached it. Two prefixes of
one node with equal cost are never one the start of the other, for further letters are inserts and
cost 3 each; so the lesser prefix stays the lesser whatever follows.

A conversation can be of any length. Rows are range-partitioned by conversation and order, and a
conversation that ends inside its range is searched there. One that spans ranges, or has over
``RUN`` rows, is cut into runs: each run is searched for every pair of entry and exit state, the
runs' results are folded in order, and each run then applies its part of the edits. Only costs and
letters of a conversation ever meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwatch.llm.common import BLANKS, materialise

#: rows of one conversation that are searched at once
RUN = 500
#: states: nothing yet, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: the one state that an inserted or reroled row leads to
NEXT = (USER, USER, ASSISTANT, USER)
#: what the bound tells apart: the start, a user row due, an assistant row due
DUE = (0, 1, 2, 1)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: inserts that finish a conversation
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
FAR = 1 << 60


def _bounds(rows: list[tuple[str, bool, bool]], goal: int | None) -> list[tuple[int, int, int]]:
    """At least the cost of the rows from each position on: at the start, with a user (1) or an assistant row (2) due.

    The state after the system row counts as that after an assistant row, where a conversation may end.
    """
    out = [(0, 0, 3) if goal is None else tuple(0 if DUE[goal] == d else FAR for d in range(3))]
    for initial, must_go, truncated in reversed(rows):
        start, user, assistant = out[-1]
        here = [4 + start, 4 + user, 4 + assistant]
        if not must_go:
            extra = 3 if truncated else 0
            here = [min(here[0], extra + 3 + assistant), min(here[1], extra + 3 + assistant), min(here[2], extra + 3 + user)]
            if initial == "s":
                here[0] = min(here[0], extra + user)
            elif initial == "u":
                here[0], here[1] = min(here[0], extra + assistant), min(here[1], extra + assistant)
            elif initial == "a":
                here[2] = min(here[2], extra + user)
        out.append((min(here[0], 3 + here[2], 6 + here[1]), min(here[1], 3 + here[2]), min(here[2], 3 + here[1])))
    return out[::-1]


def search(rows: list[tuple[str, bool, bool]], entry: int = START, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, audit) of the best edits of ``rows``: (role initial, must go, truncated) each.

    Without ``goal`` the conversation ends here; with it, the rows must lead from state ``entry``
    to state ``goal``, and nothing is inserted behind the last one. None if they can't.
    """
    n, bounds = len(rows), _bounds(rows, goal)
    best_cost, best = FAR, ""
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bounds[at][DUE[state]]
        if least > best_cost or least >= FAR or (least == best_cost and audit > best[: len(audit)]):
            continue
        known = reached.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[at, state] = (cost, audit)
        if at == n and (goal == state if goal is not None else state in (START, ASSISTANT)):
            if (cost, audit) < (best_cost, best):
                best_cost, best = cost, audit
            continue  # whatever else is inserted costs more
        children = []
        if at < n:
            initial, must_go, truncated = rows[at]
            children.append((at + 1, state, cost + 4, audit + "D"))
            if not must_go:
                extra = 3 if truncated else 0
                if (state, initial) in KEEP:
                    children.append((at + 1, KEEP[state, initial], cost + extra, audit + "K"))
                children.append((at + 1, NEXT[state], cost + extra + 3, audit + "R"))
        if at < n or goal is None:
            children.append((at, NEXT[state], cost + 3, audit + "I"))
        # the most promising one is taken first, so it goes on the stack last
        children.sort(key=lambda c: (c[2] + bounds[c[0]][DUE[c[1]]], c[3]), reverse=True)
        stack += children
    return None if best_cost >= FAR else (best_cost, best)


def _apply(rows: list[dict], audit: str, state: int) -> Iterator[dict]:
    """The rows after the edits, inserted ones among them; deleted ones have no ``new_role``."""
    left = iter(rows)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield {"edit": "I", "new_role": ROLE[state]}
            continue
        row = next(left)
        new_role = None
        if letter == "R":
            state = NEXT[state]
            new_role = ROLE[state]
        elif letter == "K":
            state = KEEP[state, row["role"][:1]]
            new_role = row["role"]
        yield row | {"edit": letter, "new_role": new_role}


def _fault(row: dict, seen: set) -> str | None:
    """The first of a row's faults; ``seen`` gets its role and text."""
    key = row["role"], row["_text_key"]
    again = key in seen or row["_seen"]
    seen.add(key)
    return "blank" if row["_blank"] else "duplicate" if again else "truncated" if row["_truncated"] else None


def _coded(rows: list[dict]) -> list[tuple[str, bool, bool]]:
    return [(r["role"][:1], r["fault"] in ("blank", "duplicate"), r["fault"] == "truncated") for r in rows]


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in schema}, schema=schema)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from batch.slice(at, rows).to_pylist()


def _gathered(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield from _table(held, schema).to_batches()
            held = []
    if held:
        yield from _table(held, schema).to_batches()


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` damaged by a checksum of conversation and turn; nulls become one space.

    Of twenty values 0 drops the row, 1 empties its text, 2 removes sentence ends, 3 repeats it
    and 4 sets the role user. Null ids and turns stay null, and count as one space in the checksum.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select(
        "conv_id", "turn", F.when(fate == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        text.alias("text"), fate.alias("_fate"), F.explode(copies).alias("_copy"),
    )
    return rows.where("_fate <> 0").drop("_fate", "_copy")


def _measured(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with what the search needs of a text, and the columns that order them."""
    end = F.expr(f"right(trim(TRAILING {BLANKS} FROM text), 1)")
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("_n"),
    )
    rows = rows.withColumn("_end", end).select(
        "*", F.sha2("text", 256).alias("_text_key"), (F.col("_end") == "").alias("_blank"),
        (~F.col("_end").isin(".", "!", "?", "")).alias("_truncated"), F.lit(False).alias("_seen"),
    )
    # equal rows may lie in several ranges, told apart by their place in the input
    return rows.drop("_end"), ["conv_id", "turn", "role", "_text_key", "_n"]


def _schema(rows: DataFrame, *more: str) -> T.StructType:
    """The columns of ``rows`` and more, all of which may hold nulls."""
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], *T.StructType.fromDDL(", ".join(more)).fields])


def repair(rows: DataFrame, run: int = RUN) -> DataFrame:
    """(conv_id, part, at, turn, role, text, fault, edit, new_role) of every row and every inserted one.

    ``rows`` has conv_id, turn, role and text; other columns are left out. A conversation's rows
    go by turn (nulls first), then role and a checksum of the text; equal rows are interchangeable.
    (part, at) orders the result within a conversation. ``fault`` is the first of blank, duplicate
    (role and text seen earlier in the conversation) and truncated (the text does not end with
    ``.``, ``!`` or ``?``), or null. ``edit`` is K, R, D or I; ``new_role`` is null for a deleted
    row; inserted rows have no turn, role and text. Null conversation ids are one conversation.
    Null roles and texts count as one space. An empty table gives no rows.
    """
    rows, order = _measured(rows)
    decided = _schema(rows, "part long", "at int", "fault string", "edit string", "new_role string")
    arrow = to_arrow_schema(decided)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Searches conversations that lie inside the range; those at its ends, and long ones, are only numbered."""
        part = TaskContext.get().partitionId() << 32

        def edited() -> Iterator[dict]:
            previous = None  # held back until it is known that another one follows
            for number, (_, group) in enumerate(groupby(_slices(batches), key=lambda r: r["conv_id"])):
                if previous is not None:
                    yield from settled(previous)
                previous = None
                if number == 0:
                    for at, row in enumerate(group):
                        yield row | {"part": part + at // run, "at": at % run}
                else:
                    previous = list(group)
            for at, row in enumerate(previous or ()):
                yield row | {"part": part + at // run, "at": at % run}

        def settled(rows: list[dict]) -> Iterator[dict]:
            if len(rows) > run:
                for at, row in enumerate(rows):
                    yield row | {"part": part + at // run, "at": at % run}
                return
            seen: set = set()
            rows = [r | {"fault": _fault(r, seen)} for r in rows]
            for at, row in enumerate(_apply(rows, search(_coded(rows))[1], START)):
                yield row | {"conv_id": rows[0]["conv_id"], "part": part, "at": at}

        yield from _gathered(edited(), arrow)

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    first = materialise(ranged.mapInArrow(whole, decided))
    columns = ["conv_id", "part", "at", "turn", "role", "text", "fault", "edit", "new_role"]
    return first.where("edit is not null").select(columns).unionByName(_in_runs(first.where("edit is null"), decided).select(columns))


def _in_runs(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` edited run by run, of conversations that don't lie in one."""
    key = ["conv_id", "part"]
    texts = rows.select(*key, "role", "_text_key").distinct()
    earlier = Window.partitionBy("conv_id", "role", "_text_key")
    seen = texts.withColumn("_first", F.min("part").over(earlier)).where("part > _first").drop("_first")
    here = [F.col(f"here.{c}").eqNullSafe(F.col(f"seen.{c}")) for c in ("conv_id", "part", "role", "_text_key")]
    marked = rows.drop("_seen").alias("here").join(seen.alias("seen"), here, "left")
    marked = marked.select("here.*", F.col("seen.part").isNotNull().alias("_seen"))
    marked = materialise(marked)

    def judged(table: pa.Table) -> list[dict]:
        known: set = set()
        found = sorted(table.to_pylist(), key=lambda r: r["at"])
        return [r | {"fault": _fault(r, known)} for r in found]

    ways_schema = _schema(rows.select(*key), "entry int", "goal int", "cost long", "audit string")
    ways_arrow = to_arrow_schema(ways_schema)

    def ways(table: pa.Table) -> pa.Table:
        rows = judged(table)
        coded, found = _coded(rows), []
        for entry in range(4):
            for goal in range(4):
                if (got := search(coded, entry, goal)) is not None:
                    found.append(dict(zip(ways_schema.names, (rows[0]["conv_id"], rows[0]["part"], entry, goal, *got))))
        return _table(found, ways_arrow)

    chosen_schema = _schema(rows.select(*key), "entry int", "audit string")
    chosen_arrow = to_arrow_schema(chosen_schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best way through all runs of each conversation, one run after the other."""

        def choices() -> Iterator[dict]:
            for _, runs in groupby(_slices(batches), key=lambda r: r["conv_id"]):
                best = {START: (0, "")}
                steps: list[tuple[int, dict[int, dict]]] = []
                for part, found in groupby(runs, key=lambda r: r["part"]):
                    now: dict[int, tuple[int, str]] = {}
                    via: dict[int, dict] = {}
                    for way in found:
                        if way["entry"] in best:
                            cost, audit = best[way["entry"]]
                            one = (cost + way["cost"], audit + way["audit"])
                            if way["goal"] not in now or one < now[way["goal"]]:
                                now[way["goal"]], via[way["goal"]] = one, way
                    best = now
                    steps.append((part, via))
                end = min((cost + 3 * len(CLOSING[s]), audit + CLOSING[s], s) for s, (cost, audit) in best.items())[2]
                more, state = CLOSING[end], end
                for part, via in reversed(steps):
                    way = via[state]
                    yield way | {"audit": way["audit"] + more}
                    state, more = way["entry"], ""

        yield from _gathered(choices(), chosen_arrow, 16)

    found = materialise(marked.groupBy(*key).applyInArrow(ways, ways_schema))
    chosen = found.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(fold, chosen_schema)
    arrow = to_arrow_schema(schema)

    def edited(rows: pa.Table, choice: pa.Table) -> pa.Table:
        rows, way = judged(rows), choice.to_pylist()[0]
        done = _apply(rows, way["audit"], way["entry"])
        return _table([r | {"conv_id": way["conv_id"], "part": way["part"], "at": at} for at, r in enumerate(done)], arrow)

    return marked.groupBy(*key).cogroup(materialise(chosen).groupBy(*key)).applyInArrow(edited, schema)


def report(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: faults, cost, audit and the digest of the repaired text.

    ``repaired`` is the result of ``repair``. Rows of a conversation are read in order as they
    come; of each only running counts, the audit and the state of the digest are kept. A
    conversation without rows has zeros, an empty audit and the digest of the empty string.
    """
    named = conversations.select("conv_id").distinct()
    rows = repaired.unionByName(named, allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = _schema(named, *[f"{c} long" for c in counts], "audit string", "repaired_sha256 string")
    arrow = to_arrow_schema(schema)

    def one(conv_id, rows: Iterator[dict]) -> dict:
        n = dict.fromkeys(counts, 0)
        audit, digest, joined = [], hashlib.sha256(), False
        least = most = turn = initial = None
        turns = 0
        for row in rows:
            if row["edit"] is None:  # names the conversation
                continue
            audit.append(row["edit"])
            n["cost"] += {"K": 0, "R": 3, "D": 4, "I": 3}[row["edit"]]
            if row["edit"] != "I":
                if row["fault"]:
                    n[row["fault"]] += 1
                if row["fault"] == "truncated" and row["edit"] != "D":
                    n["cost"] += 3
                if initial is not None and initial + row["role"][:1] not in ("su", "ua", "au"):
                    n["illegal"] += 1
                initial = row["role"][:1]
                if row["turn"] is not None and row["turn"] != turn:
                    turn = most = row["turn"]
                    least = turn if least is None else least
                    turns += 1
            if row["new_role"] is not None:
                digest.update(("\n" if joined else "").encode() + f"{row['new_role']}:{row['text'] or ''}".encode("utf-8", "surrogatepass"))
                joined = True
        if turns:
            n["gaps"] = most - least + 1 - turns
        return n | {"conv_id": conv_id, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered((one(c, g) for c, g in groupby(_slices(batches), key=lambda r: r["conv_id"])), arrow)

    order = ["conv_id", "part", "at"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(fold, schema)
