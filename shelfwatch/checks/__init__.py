"""Queries on the given tables, one or more per operator, with checking SQL."""

from shelfwatch.checks import category_checks, class_checks, cohort_checks, level_checks, rule_checks, source_checks, state_checks  # noqa: F401
from shelfwatch.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
