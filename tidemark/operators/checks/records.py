"""Checks across the columns of a row, and key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks.kernels import (
    Condition,
    aggregate_is_true,
    expression_is_true,
    ignore_row_if,
    where,
)

__all__ = [
    "pair_greater",
    "pair_equal",
    "pair_in_set",
    "compound_unique",
    "unique_combination",
    "multicolumn_sum",
    "unique_within_record",
]


def pair_greater(
    df: DataFrame, a: str, b: str, or_equal: bool = False, row_condition: Condition = None
) -> DataFrame:
    ok = F.col(a) >= F.col(b) if or_equal else F.col(a) > F.col(b)
    return expression_is_true(df, ok, row_condition)


def pair_equal(df: DataFrame, a: str, b: str, row_condition: Condition = None) -> DataFrame:
    return expression_is_true(df, F.col(a) == F.col(b), row_condition)


def pair_in_set(
    df: DataFrame, a: str, b: str, pairs: Sequence[tuple], row_condition: Condition = None
) -> DataFrame:
    if any(len(p) != 2 for p in pairs):
        raise ValueError("each entry of pairs must have two items")
    ok = reduce(or_, [(F.col(a) == x) & (F.col(b) == y) for x, y in pairs])
    return expression_is_true(df, ok, row_condition)


def unique_combination(df: DataFrame, columns: Sequence[str], row_condition: Condition = None) -> DataFrame:
    """Combinations that occur more than once; NULLs count as equal."""
    return (
        where(df, row_condition)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def compound_unique(
    df: DataFrame,
    columns: Sequence[str],
    ignore: str = "all_values_are_missing",
    row_condition: Condition = None,
) -> DataFrame:
    if not columns:
        raise ValueError("columns must not be empty")
    return unique_combination(where(df, row_condition).filter(ignore_row_if(ignore, columns)), columns)


def multicolumn_sum(
    df: DataFrame,
    columns: Sequence[str],
    total: float | str,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
) -> DataFrame:
    """Groups whose column sums do not add up to a number or to the sum of another column."""
    left = reduce(add, [F.sum(c) for c in columns])
    right = F.sum(total) if isinstance(total, str) else F.lit(total)
    return aggregate_is_true(df, left == right, lambda c: c, group_by, row_condition).drop("observed")


def unique_within_record(
    df: DataFrame,
    columns: Sequence[str],
    ignore: str = "all_values_are_missing",
    row_condition: Condition = None,
) -> DataFrame:
    """Rows where two of the columns hold the same value; NULL lowers the count of distinct values."""
    values = F.array_compact(F.array(*[F.col(c) for c in columns]))
    found = F.size(F.array_distinct(values))
    return (
        where(df, row_condition)
        .filter(ignore_row_if(ignore, columns))
        .withColumn("column_values", found)
        .filter(F.col("column_values") < len(columns))
    )
