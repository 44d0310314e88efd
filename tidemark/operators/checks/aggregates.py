"""Checks on one aggregate of a column, per table or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks.kernels import (
    Condition,
    aggregate_between,
    aggregate_is_true,
    bounds,
    equal_expression,
    where,
)
from tidemark.operators.ordered import exact_quantile

__all__ = [
    "max_between",
    "min_between",
    "mean_between",
    "sum_between",
    "stdev_between",
    "median_between",
    "quantile_between",
    "unique_count_between",
    "unique_proportion_between",
    "distinct_count_greater",
    "distinct_count_less",
    "distinct_count_equals",
    "distinct_count_equals_other",
    "distinct_values_in_set",
    "distinct_values_contain_set",
    "distinct_values_equal_set",
    "most_common_value_in_set",
    "at_least_one",
    "not_constant",
    "not_null_proportion",
    "value_list",
]


def _between(aggregate):
    def check(
        df: DataFrame,
        column: str,
        min_value=None,
        max_value=None,
        group_by: Sequence[str] | None = None,
        row_condition: Condition = None,
        strictly: bool = False,
    ) -> DataFrame:
        return aggregate_between(
            df, aggregate(column), min_value, max_value, strictly, group_by, row_condition
        )

    return check


max_between = _between(F.max)
min_between = _between(F.min)
mean_between = _between(F.avg)
sum_between = _between(F.sum)
stdev_between = _between(F.stddev_samp)
unique_count_between = _between(F.countDistinct)
unique_proportion_between = _between(
    lambda c: F.try_divide(F.countDistinct(c).cast("double"), F.count(c).cast("double"))
)


def quantile_between(
    df: DataFrame,
    column: str,
    quantile: float,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    strictly: bool = False,
) -> DataFrame:
    observed = exact_quantile(where(df, row_condition), column, quantile, group_by or (), "observed")
    inside = bounds(F.col("observed"), min_value, max_value, strictly)
    return observed.withColumn("expression", inside).filter(~F.col("expression"))


def median_between(df: DataFrame, column: str, min_value=None, max_value=None, **options) -> DataFrame:
    return quantile_between(df, column, 0.5, min_value, max_value, **options)


def _distinct_count(rule):
    def check(
        df: DataFrame,
        column: str,
        value: int,
        group_by: Sequence[str] | None = None,
        row_condition: Condition = None,
    ) -> DataFrame:
        return aggregate_is_true(
            df, F.countDistinct(column), lambda c: rule(c, value), group_by, row_condition
        )

    return check


distinct_count_greater = _distinct_count(lambda c, v: c > v)
distinct_count_less = _distinct_count(lambda c, v: c < v)
distinct_count_equals = _distinct_count(lambda c, v: c == v)


def distinct_count_equals_other(
    df: DataFrame,
    column: str,
    compare: DataFrame,
    compare_column: str | None = None,
    row_condition: Condition = None,
    compare_row_condition: Condition = None,
) -> DataFrame:
    return equal_expression(
        where(df, row_condition),
        F.countDistinct(column),
        where(compare, compare_row_condition),
        F.countDistinct(compare_column or column),
    )


def value_list(df: DataFrame, values: Sequence, alias: str = "value_field") -> DataFrame:
    """The literal list as a one-column relation (duplicates removed)."""
    items = F.array(*[F.lit(v) for v in dict.fromkeys(values)])
    return df.sparkSession.range(1).select(F.explode(items).alias(alias))


def distinct_values_in_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    """Distinct values outside the set; a NULL value is outside."""
    inside = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return (
        where(df, row_condition).filter(~inside).select(F.col(column).alias("value_field")).distinct()
    )


def distinct_values_contain_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    """Members of the set that no row holds."""
    present = (
        where(df, row_condition)
        .filter(F.col(column).isin(*values))
        .select(F.col(column).alias("value_field"))
        .distinct()
    )
    return value_list(df, values).join(present, "value_field", "left_anti")


def distinct_values_equal_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition = None
) -> DataFrame:
    """Values on one side only: ``column_value`` from the data, ``value_field`` from the set."""
    extra = distinct_values_in_set(df, column, values, row_condition).select(
        F.col("value_field").alias("column_value"),
        F.lit(None).cast(df.schema[column].dataType).alias("value_field"),
    )
    missing = distinct_values_contain_set(df, column, values, row_condition).select(
        F.lit(None).cast(df.schema[column].dataType).alias("column_value"), "value_field"
    )
    return extra.unionByName(missing)


def most_common_value_in_set(
    df: DataFrame, column: str, values: Sequence, top_n: int, row_condition: Condition = None
) -> DataFrame:
    """The value at frequency rank ``top_n`` when it is outside the set; ties go to the lower value."""
    ranked = (
        where(df, row_condition)
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("value_count"))
        .orderBy(F.desc("value_count"), F.asc("value_field"))
        .offset(top_n - 1)
        .limit(1)
    )
    return ranked.filter(~F.col("value_field").isin(*values)).select("value_field")


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] | None = None) -> DataFrame:
    """Groups without any non-null value."""
    return (
        df.groupBy(*(group_by or []))
        .agg(F.count(column).alias("filler_column"))
        .filter(F.col("filler_column") == 0)
    )


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] | None = None) -> DataFrame:
    """Groups with exactly one distinct value."""
    # min = max says the same as "one distinct value" but needs no distinct shuffle
    return (
        df.groupBy(*(group_by or []))
        .agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
        .filter(F.col("_low") == F.col("_high"))
        .select(*(group_by or []), F.lit(1).cast("bigint").alias("filler_column"))
    )


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float,
    at_most: float = 1.0,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    share: Column = F.try_divide(F.count(column).cast("double"), F.count(F.lit(1)).cast("double"))
    return (
        df.groupBy(*(group_by or []))
        .agg(share.alias("not_null_proportion"))
        .filter(
            (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)
        )
    )
