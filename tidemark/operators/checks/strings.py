"""Length, LIKE and regex checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import like_pattern, with_flags
from tidemark.operators.checks.kernels import Condition, expression_between, expression_is_true

__all__ = [
    "lengths_between",
    "lengths_equal",
    "match_like",
    "not_match_like",
    "match_like_list",
    "not_match_like_list",
    "match_regex",
    "not_match_regex",
    "match_regex_list",
    "not_match_regex_list",
]


def lengths_between(
    df: DataFrame,
    column: str,
    min_value: int | None = None,
    max_value: int | None = None,
    strictly: bool = False,
    row_condition: Condition = None,
) -> DataFrame:
    return expression_between(df, F.length(column), min_value, max_value, strictly, row_condition)


def lengths_equal(df: DataFrame, column: str, value: int, row_condition: Condition = None) -> DataFrame:
    return expression_is_true(df, F.length(column) == value, row_condition)


def _joined(tests, match_on: str):
    if match_on not in ("any", "all"):
        raise ValueError(f"match_on must be 'any' or 'all', got {match_on!r}")
    return reduce(and_ if match_on == "all" else or_, tests)


def match_like(df: DataFrame, column: str, pattern: str, row_condition: Condition = None) -> DataFrame:
    return match_like_list(df, column, [pattern], row_condition=row_condition)


def not_match_like(df: DataFrame, column: str, pattern: str, row_condition: Condition = None) -> DataFrame:
    return not_match_like_list(df, column, [pattern], row_condition=row_condition)


def match_like_list(
    df: DataFrame,
    column: str,
    patterns: Sequence[str],
    match_on: str = "any",
    row_condition: Condition = None,
) -> DataFrame:
    tests = [like_pattern(column, p) for p in patterns]
    return expression_is_true(df, _joined(tests, match_on), row_condition)


def not_match_like_list(
    df: DataFrame,
    column: str,
    patterns: Sequence[str],
    match_on: str = "any",
    row_condition: Condition = None,
) -> DataFrame:
    """With ``any``, a row passes as soon as one of the patterns does not match."""
    tests = [like_pattern(column, p, positive=False) for p in patterns]
    return expression_is_true(df, _joined(tests, match_on), row_condition)


def match_regex(
    df: DataFrame, column: str, regex: str, flags: str = "", row_condition: Condition = None
) -> DataFrame:
    return match_regex_list(df, column, [regex], flags=flags, row_condition=row_condition)


def not_match_regex(
    df: DataFrame, column: str, regex: str, flags: str = "", row_condition: Condition = None
) -> DataFrame:
    return not_match_regex_list(df, column, [regex], flags=flags, row_condition=row_condition)


def match_regex_list(
    df: DataFrame,
    column: str,
    regexes: Sequence[str],
    match_on: str = "any",
    flags: str = "",
    row_condition: Condition = None,
) -> DataFrame:
    tests = [F.col(column).rlike(with_flags(r, flags)) for r in regexes]
    return expression_is_true(df, _joined(tests, match_on), row_condition)


def not_match_regex_list(
    df: DataFrame,
    column: str,
    regexes: Sequence[str],
    match_on: str = "any",
    flags: str = "",
    row_condition: Condition = None,
) -> DataFrame:
    """With ``any``, a row passes as soon as one of the expressions does not match."""
    tests = [~F.col(column).rlike(with_flags(r, flags)) for r in regexes]
    return expression_is_true(df, _joined(tests, match_on), row_condition)
