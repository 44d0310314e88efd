"""Checks on the values of one column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks.kernels import (
    Condition,
    bounds,
    expression_between,
    expression_is_true,
    where,
)
from tidemark.operators.ordered import adjacent_violations

__all__ = [
    "not_null",
    "unique",
    "accepted_values",
    "not_accepted_values",
    "accepted_range",
    "not_empty_string",
    "values_between",
    "values_increasing",
    "values_decreasing",
    "values_in_set",
    "values_not_in_set",
    "values_null",
    "values_not_null",
    "values_unique",
    "consistent_casing",
    "values_of_type",
    "schema_type_in",
    "sequential_values",
]


def not_null(df: DataFrame, column: str, row_condition: Condition = None) -> DataFrame:
    return where(df, row_condition).filter(F.col(column).isNull())


def unique(df: DataFrame, column: str, row_condition: Condition = None) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return (
        where(df, row_condition)
        .filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    """Values outside the list with their count; NULL passes."""
    return (
        where(df, row_condition)
        .filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def not_accepted_values(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    return (
        where(df, row_condition)
        .filter(F.col(column).isin(*values))
        .select(F.col(column).alias("value_field"))
        .distinct()
    )


def accepted_range(
    df: DataFrame,
    column: str,
    min_value=None,
    max_value=None,
    inclusive: bool = True,
    row_condition: Condition = None,
) -> DataFrame:
    return expression_is_true(
        df, bounds(F.col(column), min_value, max_value, strictly=not inclusive), row_condition
    )


def not_empty_string(
    df: DataFrame, column: str, trim: bool = True, row_condition: Condition = None
) -> DataFrame:
    text = F.trim(F.col(column)) if trim else F.col(column)
    return where(df, row_condition).filter(text == "")


def values_between(
    df: DataFrame,
    column: str,
    min_value=None,
    max_value=None,
    strictly: bool = False,
    row_condition: Condition = None,
) -> DataFrame:
    return expression_between(df, F.col(column), min_value, max_value, strictly, row_condition)


def _monotonic(df, column, sort_column, strictly, row_condition, group_by, ascending):
    sort_column = sort_column or column

    def broken(here, there, alone):
        now, before = here(column), there(column)
        if ascending:
            ok = now > before if strictly else now >= before
        else:
            ok = now < before if strictly else now <= before
        return ~alone & ~ok

    return adjacent_violations(
        where(df, row_condition),
        order_by=[sort_column],
        carry=[column],
        broken=broken,
        group_by=group_by or (),
        prefix="previous_",
    )


def values_increasing(
    df: DataFrame,
    column: str,
    sort_column: str | None = None,
    strictly: bool = True,
    row_condition: Condition = None,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows not greater than the row before them; rows with equal sort value are ordered by value."""
    return _monotonic(df, column, sort_column, strictly, row_condition, group_by, True)


def values_decreasing(
    df: DataFrame,
    column: str,
    sort_column: str | None = None,
    strictly: bool = True,
    row_condition: Condition = None,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    return _monotonic(df, column, sort_column, strictly, row_condition, group_by, False)


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that are not exactly ``interval`` after the row before them; the first row passes."""
    from tidemark.functions.dates import add_periods

    def broken(here, there, alone):
        before = there(column)
        if datepart:
            expected = add_periods(before.cast("timestamp"), interval, datepart)
            return ~(here(column).cast("timestamp") == expected)
        return ~(here(column) == before + interval)

    return adjacent_violations(
        df, order_by=[column], carry=[column], broken=broken, group_by=group_by or (), prefix="previous_"
    )


def values_in_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    """Rows outside the set. NULL is outside: this check fails on it, unlike ``accepted_values``."""
    inside = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return where(df, row_condition).filter(~inside)


def values_not_in_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    return where(df, row_condition).filter(F.col(column).isin(*values))


def values_null(df: DataFrame, column: str, row_condition: Condition = None) -> DataFrame:
    return expression_is_true(df, F.col(column).isNull(), row_condition)


def values_not_null(df: DataFrame, column: str, row_condition: Condition = None) -> DataFrame:
    return expression_is_true(df, F.col(column).isNotNull(), row_condition)


def values_unique(df: DataFrame, column: str, row_condition: Condition = None) -> DataFrame:
    from tidemark.operators.checks.records import compound_unique

    return compound_unique(df, [column], row_condition=row_condition)


def consistent_casing(df: DataFrame, column: str, display_inconsistent: bool = False) -> DataFrame:
    """Values that occur in more than one casing, or one summary row when there are any."""
    per_fold = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.lower(F.col(column)).alias("inconsistent_columns"), F.col(column).alias("_spelling"))
        .agg(F.lit(1).alias("_one"))
        .groupBy("inconsistent_columns")
        .agg(F.count(F.lit(1)).alias("set_count_case_insensitive"))
    )
    if display_inconsistent:
        return per_fold.filter(F.col("set_count_case_insensitive") > 1)
    return per_fold.agg(
        F.coalesce(F.sum("set_count_case_insensitive"), F.lit(0)).alias("set_count"),
        F.count(F.lit(1)).alias("set_count_case_insensitive"),
    ).filter(F.col("set_count") != F.col("set_count_case_insensitive"))


def values_of_type(
    df: DataFrame, column: str, types: str | Sequence[str], row_condition: Condition = None
) -> DataFrame:
    """Rows whose text casts to none of the types."""
    names = [types] if isinstance(types, str) else list(types)
    text = F.col(column)
    castable = reduce(or_, [text.try_cast(t).isNotNull() for t in names])
    return where(df, row_condition).filter(text.isNotNull() & ~castable)


def schema_type_in(df: DataFrame, column: str, types: str | Sequence[str]) -> DataFrame:
    """One row when the declared type of the column is in none of the listed types."""
    from pyspark.sql.types import _parse_datatype_string

    names = [types] if isinstance(types, str) else list(types)
    wanted = {_parse_datatype_string(t).simpleString() for t in names}
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    found = actual.get(column.lower())
    bad = [(column, found)] if found is not None and found not in wanted else []
    return df.sparkSession.createDataFrame(bad, "relation_column string, relation_column_type string")
