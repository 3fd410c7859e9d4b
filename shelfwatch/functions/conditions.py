"""Declarative conditions on columns, compiled to one boolean ``Column``.

A rule set is a list of :class:`Test`. The tests are OR-ed, as are the values of one test, and
texts are compared without regard to case. A null reads as ``null_text`` ("None" unless said
otherwise), so that rules can name missing levels.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

EQUAL = "EQUAL"
IN = "IN"
START_WITH = "START_WITH"
IS_NUMBER = "IS_NUMBER"
OPERATORS = (EQUAL, IN, START_WITH, IS_NUMBER)
FEW = 2

# Decimal digits of all scripts, and the digit-like signs (superscripts, circled digits ...).
_DIGITS = (
    r"^[\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}]+\z"
)


@dataclass(frozen=True)
class Test:
    """``column`` compared with any of ``values`` by ``op``."""

    column: str
    op: str
    values: tuple[str, ...] = ()

    def __post_init__(self):
        if self.op not in OPERATORS:
            raise ValueError(f"invalid comparison operator: {self.op}")


RuleSet = Sequence[Test]


def is_number(col: Column) -> Column:
    """True for a non-empty text of digits only: no sign, point or blank."""
    return F.coalesce(col.rlike(_DIGITS), F.lit(False))


def _one(test: Test, null_text: str) -> Column:
    raw = F.coalesce(F.col(test.column).cast("string"), F.lit(null_text))
    if test.op == IS_NUMBER:
        return is_number(raw)
    text = F.lower(raw)
    wanted = list(dict.fromkeys(v.lower() for v in test.values))
    if not wanted:
        return F.lit(False)
    if test.op == EQUAL:
        return text.isin(wanted)
    if test.op == IN:
        return contains_any(text, wanted)
    if len(wanted) <= FEW:
        return reduce(or_, (text.startswith(v) for v in wanted))
    return text.rlike(f"^(?:{'|'.join(map(re.escape, wanted))})")


def contains_any(text: Column, values: Sequence[str]) -> Column:
    """True if any of the values is part of the text.

    Long lists become one pattern: a chain of ``contains`` would swell the generated method past
    the size the JVM compiles. Values that have another value in them add nothing and are left out.
    """
    needed = [v for v in values if not any(o != v and o in v for o in values)]
    if len(needed) <= FEW:
        return reduce(or_, (text.contains(v) for v in needed))
    return text.rlike("|".join(map(re.escape, needed)))


def matches(rules: RuleSet, null_text: str = "None") -> Column:
    """One boolean column for a rule set; never null.

    A number test settles the answer: tests listed after it are not looked at.
    """
    parts = []
    for test in rules:
        parts.append(_one(test, null_text))
        if test.op == IS_NUMBER:
            break
    return reduce(or_, parts) if parts else F.lit(False)


@dataclass(frozen=True)
class Bucket:
    """Rows for which the rule set gives ``outcome`` get ``rank``, unless an earlier bucket did."""

    rules: tuple[Test, ...]
    outcome: bool
    rank: int


@dataclass(frozen=True)
class Ladder:
    """Ordered buckets; rows that fall through get ``last``. Rank 0 is best."""

    buckets: tuple[Bucket, ...]
    last: int
    null_text: str = "None"


def rank_of(ladder: Ladder) -> Column:
    """The rank as one CASE expression."""
    out = None
    for bucket in ladder.buckets:
        hit = matches(bucket.rules, ladder.null_text)
        hit = hit if bucket.outcome else ~hit
        out = F.when(hit, bucket.rank) if out is None else out.when(hit, bucket.rank)
    return F.lit(ladder.last) if out is None else out.otherwise(ladder.last)


def by_shop(branches: dict[str, Column], otherwise: Column | None = None, shop: str = "shop") -> Column:
    """One CASE over the shop column, so that all shops share a single scan."""
    out = None
    for name, value in branches.items():
        hit = F.col(shop) == name
        out = F.when(hit, value) if out is None else out.when(hit, value)
    if out is None:
        return otherwise
    return out.otherwise(otherwise) if otherwise is not None else out


def member(col: Column, values: Sequence[str]) -> Column:
    """Null is not a member."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def not_member(col: Column, values: Sequence[str]) -> Column:
    """Null passes."""
    return ~member(col, values)
