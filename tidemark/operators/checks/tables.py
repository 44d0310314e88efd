"""Checks between tables, between ranges, and on recency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import add_periods
from tidemark.operators.checks.kernels import Condition, where
from tidemark.operators.ordered import adjacent_violations
from tidemark.operators.reshape import symmetric_difference

__all__ = [
    "relationships",
    "cardinality_equality",
    "equal_rowcount",
    "equality",
    "fewer_rows_than",
    "mutually_exclusive_ranges",
    "recency",
    "recent_data",
    "grouped_recent_data",
]


def relationships(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: Condition = None,
    to_condition: Condition = None,
) -> DataFrame:
    """Non-null child keys without a parent, with the number of child rows.

    Child keys are collapsed before the join, so a hot key costs one row per task.
    """
    children = (
        where(df, from_condition)
        .filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("id"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = where(to, to_condition).select(F.col(field).alias("id"))
    return children.join(parents, "id", "left_anti")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose row count differs between the tables: one row per side that holds them."""
    a = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(F.col(field).alias("value_field")).agg(F.count(F.lit(1)).alias("num_rows"))
    return symmetric_difference(a, b)


def equality(df: DataFrame, compare: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows on one side only; how often a row occurs is not compared."""
    return symmetric_difference(df, compare, columns)


def _counts(df: DataFrame, compare: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of both sides, one row per group; the two inputs share one shuffle."""
    group = list(group_by)
    a = df.select(*group, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    b = compare.select(*group, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    both = a.unionByName(b)
    for g in group:  # NULL groups never match each other
        both = both.filter(F.col(g).isNotNull())
    counts = both.groupBy(*group).agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("count_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("count_b")
    )
    # a group on one side only is not comparable and passes
    return counts.filter((F.col("count_a") > 0) & (F.col("count_b") > 0)) if group else counts


def equal_rowcount(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] | None = None
) -> DataFrame:
    """Groups with different counts; the failure measure is the sum of ``diff_count``."""
    return (
        _counts(df, compare, group_by or ())
        .withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))
        .filter(F.col("diff_count") > 0)
    )


def fewer_rows_than(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] | None = None
) -> DataFrame:
    """Groups with as many or more rows than the other table; equal counts fail with delta 1."""
    delta = F.when(
        F.col("count_a") > F.col("count_b"), F.col("count_a") - F.col("count_b")
    ).when(F.col("count_a") == F.col("count_b"), F.lit(1).cast("bigint"))
    return (
        _counts(df, compare, group_by or ())
        .withColumn("row_count_delta", delta)
        .filter(F.col("row_count_delta").isNotNull())
    )


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: Sequence[str] | None = None,
    gaps: str = "allowed",
    zero_length: bool = False,
) -> DataFrame:
    """Ranges that are empty, overlap their successor, or break the gap rule."""
    rules = {
        "allowed": lambda end, nxt: end <= nxt,
        "not_allowed": lambda end, nxt: end == nxt,
        "required": lambda end, nxt: end < nxt,
    }
    if gaps not in rules:
        raise ValueError(f"gaps must be one of {sorted(rules)}, got {gaps!r}")

    def broken(here, there, alone):
        start, end = here(lower), here(upper)
        proper = start <= end if zero_length else start < end
        follows = F.coalesce(rules[gaps](end, there(lower)), alone)
        return ~(F.coalesce(proper, F.lit(False)) & follows)

    return adjacent_violations(
        df,
        order_by=[lower, upper],
        carry=[lower, upper],
        broken=broken,
        group_by=partition_by or (),
        direction="next",
        prefix="next_",
    )


def _limit(as_of, interval: int, datepart: str) -> Column:
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return add_periods(moment.cast("timestamp"), -interval, datepart)


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of,
    ignore_time: bool = False,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    """Groups whose newest value is older than ``as_of`` minus the interval."""
    kind = "date" if ignore_time else "timestamp"
    return (
        df.groupBy(*(group_by or []))
        .agg(F.max(field).cast(kind).alias("most_recent"))
        .withColumn("threshold", _limit(as_of, interval, datepart).cast(kind))
        .filter(F.col("most_recent") < F.col("threshold"))
    )


def _up_to(df: DataFrame, column: str, as_of, row_condition: Condition) -> DataFrame:
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return where(df, row_condition).filter(F.col(column).cast("timestamp") <= moment.cast("timestamp"))


def recent_data(
    df: DataFrame, column: str, datepart: str, interval: int, as_of, row_condition: Condition = None
) -> DataFrame:
    """One row when the newest value is too old; rows after ``as_of`` are ignored, no rows fail."""
    epoch = F.lit("1970-01-01").cast("timestamp")
    return (
        _up_to(df, column, as_of, row_condition)
        .agg(F.max(F.col(column).cast("timestamp")).alias("max_timestamp"))
        .filter(F.coalesce(F.col("max_timestamp"), epoch) < _limit(as_of, interval, datepart))
    )


def grouped_recent_data(
    df: DataFrame,
    group_by: Sequence[str],
    column: str,
    datepart: str,
    interval: int,
    as_of,
    row_condition: Condition = None,
) -> DataFrame:
    return (
        _up_to(df, column, as_of, row_condition)
        .groupBy(*group_by)
        .agg(F.max(F.col(column).cast("timestamp")).alias("latest_timestamp_column"))
        .filter(F.col("latest_timestamp_column") < _limit(as_of, interval, datepart))
    )
