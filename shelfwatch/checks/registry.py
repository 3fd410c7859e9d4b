"""Registered queries: each reads the given tables and, where SQL can say it, has checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.config.classes import ClassRule
from shelfwatch.functions.conditions import EQUAL, IN, IS_NUMBER, Ladder, RuleSet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``views`` are put in front of ``sql`` as common table expressions."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = (f"WITH {', '.join(views)} " if views else "") + sql
        return fn

    return register


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return ", ".join(text(v) for v in values)


def rules_sql(rules: RuleSet, null_text: str = "None") -> str:
    parts = []
    for t in rules:
        col = f"coalesce({t.column}, {text(null_text)})"
        if t.op == IS_NUMBER:
            parts.append(f"regexp_full_match({col}, '[0-9]+')")
            break
        low = [v.lower() for v in t.values]
        if t.op == EQUAL:
            parts.append(f"lower({col}) IN ({texts(low)})")
        elif t.op == IN:
            parts.extend(f"strpos(lower({col}), {text(v)}) > 0" for v in low)
        else:
            parts.extend(f"starts_with(lower({col}), {text(v)})" for v in low)
    return "(" + " OR ".join(parts) + ")"


def ladder_sql(ladder: Ladder) -> str:
    whens = " ".join(
        f"WHEN {'' if b.outcome else 'NOT '}{rules_sql(b.rules, ladder.null_text)} THEN {b.rank}" for b in ladder.buckets
    )
    return f"CASE {whens} ELSE {ladder.last} END"


def ranks_sql(ladders: dict[str, Ladder]) -> str:
    whens = " ".join(f"WHEN shop = {text(s)} THEN {ladder_sql(l)}" for s, l in ladders.items())
    return f"CASE {whens} ELSE 0 END"


def _rule_sql(rule: ClassRule, name: str, taxo2: str, taxo3: str) -> str:
    parts = []
    if rule.words:
        parts.append("(" + " OR ".join(f"strpos({name}, {text(w)}) > 0" for w in rule.words) + ")")
    parts.extend(f"strpos({name}, {text(w)}) = 0" for w in rule.without)
    if rule.taxo2 is not None:
        parts.append(f"{taxo2} = {text(rule.taxo2)}")
    if rule.taxo3:
        parts.append(f"{taxo3} IN ({texts(rule.taxo3)})")
    if rule.taxo3_not is not None:
        parts.append(f"{taxo3} IS DISTINCT FROM {text(rule.taxo3_not)}")
    return " AND ".join(parts)


def class_sql(rules: tuple[ClassRule, ...], name: str = "lower(name)", taxo2: str = "taxo2", taxo3: str = "taxo3") -> str:
    """Label of the last rule that holds: all hits in order, nulls out, last entry."""
    hits = ", ".join(f"CASE WHEN {_rule_sql(r, name, taxo2, taxo3)} THEN {text(r.label)} END" for r in rules)
    return f"coalesce(list_filter([{hits}], lambda h: h IS NOT NULL)[-1], '')"


PARENT_SQL = (
    "CASE WHEN {0} IN ('SWEATSHIRT', 'JACKET/COAT', 'SHIRT', 'TSHIRT') THEN 'TOP' "
    "WHEN {0} IN ('JEANS', 'DRESS', 'SKIRTS') THEN 'BOTTOM' ELSE '' END"
)
