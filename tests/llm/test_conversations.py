import hashlib
import itertools
import random
import zlib

import pytest
from helpers import clash

from shelfwatch.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        elif fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def brute_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.strip(BLANK)
        again = (role, text) in seen
        seen.add((role, text))
        faults.append("blank" if not core else "duplicate" if again else "truncated" if core[-1] not in ".!?" else None)
    return faults


def cheapest(rows):
    """By complete suffixes, from the back: every state's least (cost, audit, result) of the rest.

    ``rows`` has (role, text, fault); a state is the initials so far, as far as they matter.
    """
    following = {"": "s u", "s": "u", "u": "a", "a": "u"}
    rest = {"": (0, "", ()), "a": (0, "", ()), "u": (3, "I", ("assistant:",)), "s": (6, "II", ("user:", "assistant:"))}
    for role, text, fault in reversed(rows):
        here = {}
        for state in ("", "s", "u", "a"):
            cost, audit, lines = rest[state]
            options = [(cost + 4, "D" + audit, lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] and role[:1] in following[state].split():
                    cost, audit, lines = rest[role[:1]]
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                for new in ("user", "assistant"):
                    if new[0] in following[state].split():
                        cost, audit, lines = rest[new[0]]
                        options.append((cost + more + 3, "R" + audit, (f"{new}:{text}", *lines)))
            here[state] = min(options)
        for _ in range(3):
            for state in here:
                for new in ("user", "assistant"):
                    if new[0] in following[state].split():
                        cost, audit, lines = here[new[0]]
                        here[state] = min(here[state], (cost + 3, "I" + audit, (f"{new}:", *lines)))
        rest = here
    return rest[""]


def brute(rows, damaged=None):
    damaged = brute_damage(rows) if damaged is None else damaged
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in damaged if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
        faults = brute_faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)])
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def found(df):
    got = df.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_search_against_all_edits():
    """Every string of edits over short conversations, tried out."""
    import re

    rng = random.Random(4)
    for _ in range(60):
        rows = [(rng.choice("suaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 3))]
        best = None
        for length in range(len(rows) + 4):
            for audit in itertools.product("DIKR", repeat=length):
                if sum(x != "I" for x in audit) != len(rows):
                    continue
                for roles in itertools.product("ua", repeat=sum(x in "IR" for x in audit)):
                    left, given, line, cost = iter(rows), iter(roles), "", 0
                    for x in audit:
                        initial, must_go, cut = ("", False, False) if x == "I" else next(left)
                        cost += {"K": 0, "R": 3, "D": 4, "I": 3}[x] + (3 if cut and x != "D" else 0)
                        cost += 1000 if must_go and x != "D" else 0
                        line += initial if x == "K" else "" if x == "D" else next(given)
                    if cost < 1000 and re.fullmatch("(s?(ua)+)?", line):
                        best = min(best or (cost, "".join(audit)), (cost, "".join(audit)))
        assert C.search(rows) == best


def test_search_long():
    rng = random.Random(5)
    for pattern in ("s", "x", "u", "aus", "ssu", None):
        rows = [(pattern[i % len(pattern)] if pattern else rng.choice("suax"), rng.random() < 0.1, i % 7 == 0) for i in range(300)]
        named = [(r, "t", "blank" if go else "truncated" if cut else None) for r, go, cut in rows]
        assert C.search(rows) == cheapest(named)[:2]


def odd(rng):
    """Nulls in every column, repeated rows, ties of a turn, odd roles, long conversations."""
    texts = ["Hi.", "Hi", "", " \n", None, "Yes!\n", "ünder …", "a\nb?", "long " * 3000 + "."]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [
        (c, rng.choice([t, t, t, None, 1]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts + [f"Text {rng.random()}."] * 9))
        for c in [None, *range(60)] for t in range(rng.randint(1, 9))
    ]
    rows += [(900, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)]
    rows += [(901, None, "user", "Same.")] * 300 + [(None, None, None, None)] * 200
    rows += [(902, t, "system", f"{t}") for t in range(120)]
    return rows


@pytest.mark.parametrize("run", [7, C.RUN])
def test_repair_against_brute_force(spark, run):
    rows = odd(random.Random(run))
    df = spark.createDataFrame(rows, SCHEMA)
    df = clash(df.repartition(5), "part", "at", "fault", "edit", "_n", "_seen")
    repaired = C.repair(C.damage(df), run=run)
    assert found(C.report(repaired, df)) == brute(rows)


def test_rows_of_the_operator(spark):
    rows = [(1, 1, "user", "Hello."), (1, 2, "user", "There."), (1, 3, "assistant", "")]
    got = [(r.edit, r.new_role, r.text, r.fault) for r in C.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("part", "at").collect()]
    assert got == [("K", "user", "Hello.", None), ("R", "assistant", "There.", None), ("D", None, "", "blank")]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.report(C.repair(C.damage(none)), none).collect() == []


def test_all_rows_dropped(spark):
    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(C.report(C.repair(C.damage(df)), df)) == {conv: (0, 0, 0, 0, 0, 0, "", empty)}


def test_query_against_brute_force(spark):
    from shelfwatch.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversation_repair"](spark, folder)) == brute(rows)
