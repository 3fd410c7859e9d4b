"""Mapping of names and shop categories to the common taxonomy: one CASE per gender."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from itertools import groupby
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.config.classes import PARENT, ClassRule
from shelfwatch.functions.conditions import contains_any
from shelfwatch.functions.levels import lookup
from shelfwatch.schema import MAN, WOMAN


def _holds(rule: ClassRule, name: Column, taxo2: Column, taxo3: Column) -> Column:
    parts = []
    if rule.words:
        parts.append(contains_any(name, rule.words))
    parts.extend(~name.contains(w) for w in rule.without)
    if rule.taxo2 is not None:
        parts.append(taxo2 == rule.taxo2)
    if rule.taxo3:
        parts.append(taxo3.isin(list(rule.taxo3)))
    if rule.taxo3_not is not None:
        parts.append(~taxo3.eqNullSafe(F.lit(rule.taxo3_not)))
    return reduce(and_, parts)


def _kind(rule: ClassRule) -> tuple:
    """Neighbouring rules of one kind fold into one condition."""
    others = rule.without or rule.taxo3 or rule.taxo3_not
    if rule.words and not others and rule.taxo2 is None:
        return ("words", rule.label)
    if rule.taxo2 is not None and not others and not rule.words:
        return ("level",)
    return ("single", rule)


def class_of(
    rules: Sequence[ClassRule], name_lc: str = "name_lc", taxo2: str = "taxo2", taxo3: str = "taxo3"
) -> Column:
    """Label of the **last** rule that holds, '' if none does.

    Rules overwrite each other in order, so the expression tests them from last to first and a row
    is settled in one projection. Neighbouring rules fold: words with the same label into one
    search, plain level equalities into one lookup. A null name or level never matches.
    """
    name, level2, level3 = F.col(name_lc), F.col(taxo2), F.col(taxo3)
    out = F.lit("")
    for kind, run in groupby(rules, _kind):
        run = list(run)
        if kind[0] == "level":
            out = F.coalesce(lookup(level2, {r.taxo2: r.label for r in run}), out)
        else:
            merged = replace(run[0], words=tuple(w for r in run for w in r.words))
            out = F.when(_holds(merged, name, level2, level3), merged.label).otherwise(out)
    return out


def parent_of(label: Column) -> Column:
    """TOP or BOTTOM, '' for anything else."""
    return F.coalesce(lookup(label, PARENT), F.lit(""))


def with_name_lc(df: DataFrame, name: str = "name") -> DataFrame:
    """The lower-cased name once, for all rules to read."""
    return df.withColumn("name_lc", F.lower(F.col(name)))


def classify(df: DataFrame, men: Column, women: Column) -> DataFrame:
    """Keep MAN and WOMAN rows and replace taxo2/taxo3 by parent and class."""
    label = F.when(F.col("taxo1") == MAN, men).otherwise(women)
    return (
        df.where(F.col("taxo1").isin(MAN, WOMAN))
        .withColumn("taxo3", label)
        .withColumn("taxo2", parent_of(F.col("taxo3")))
    )
