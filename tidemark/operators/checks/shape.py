"""Row-count checks, and rules over a list of fields.

A field list is a relation ``(field, position)``: ``schema_fields`` reads it from the schema of a
typed table, ``governance.payload_profile`` from the JSON payloads of a whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks.aggregates import value_list
from tidemark.operators.checks.kernels import (
    Condition,
    aggregate_between,
    aggregate_is_true,
    equal_expression,
)

__all__ = [
    "row_count_between",
    "row_count_equals",
    "row_count_equals_other",
    "aggregation_equals_other",
    "schema_fields",
    "field_exists",
    "field_count_between",
    "field_count_equals",
    "field_count_equals_other",
    "fields_contain_set",
    "fields_not_contain_set",
    "fields_match_set",
    "fields_match_ordered_list",
]


def row_count_between(
    df: DataFrame,
    min_value: int | None = None,
    max_value: int | None = None,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    strictly: bool = False,
) -> DataFrame:
    return aggregate_between(
        df, F.count(F.lit(1)), min_value, max_value, strictly, group_by, row_condition
    )


def row_count_equals(
    df: DataFrame, value: int, group_by: Sequence[str] | None = None, row_condition: Condition = None
) -> DataFrame:
    return aggregate_is_true(df, F.count(F.lit(1)), lambda c: c == value, group_by, row_condition)


def row_count_equals_other(
    df: DataFrame,
    compare: DataFrame,
    factor: float = 1,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    compare_row_condition: Condition = None,
) -> DataFrame:
    """Groups where the row count is not ``factor`` times that of the other table."""
    rows = F.count(F.lit(1))
    return equal_expression(
        df,
        rows,
        compare,
        rows * factor,
        group_by,
        compare_group_by,
        row_condition,
        compare_row_condition,
    )


def aggregation_equals_other(
    df: DataFrame, expression: Column | str, compare: DataFrame, **options
) -> DataFrame:
    return equal_expression(df, expression, compare, **options)


def schema_fields(df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.sparkSession.range(1).select(F.posexplode(names).alias("position", "field"))


def _folded(fields: DataFrame) -> DataFrame:
    return fields.withColumn("field", F.lower("field"))


def field_exists(fields: DataFrame, name: str, index: int | None = None) -> DataFrame:
    """One row when the field is missing, or is not at the given 0-based position."""
    wanted = F.col("field") == name.lower()
    if index is not None:
        wanted = wanted & (F.col("position") == index)
    return (
        _folded(fields)
        .agg(F.count_if(wanted).alias("_hits"))
        .filter(F.col("_hits") == 0)
        .select(F.lit(name).alias("field"))
    )


def field_count_between(
    fields: DataFrame, min_value: int | None = None, max_value: int | None = None
) -> DataFrame:
    return row_count_between(fields, min_value, max_value)


def field_count_equals(fields: DataFrame, value: int) -> DataFrame:
    return row_count_equals(fields, value)


def field_count_equals_other(fields: DataFrame, compare: DataFrame) -> DataFrame:
    return row_count_equals_other(fields, compare)


def _wanted(fields: DataFrame, names: Sequence[str]) -> DataFrame:
    return value_list(fields, [n.lower() for n in names], "field")


def fields_contain_set(fields: DataFrame, names: Sequence[str]) -> DataFrame:
    """Listed names that no field has."""
    return _wanted(fields, names).join(_folded(fields).select("field"), "field", "left_anti")


def fields_not_contain_set(fields: DataFrame, names: Sequence[str]) -> DataFrame:
    """Listed names that a field has."""
    return _wanted(fields, names).join(_folded(fields).select("field"), "field", "left_semi")


def fields_match_set(fields: DataFrame, names: Sequence[str]) -> DataFrame:
    """Names on one side only."""
    found = _folded(fields).select(F.col("field").alias("relation_field"))
    listed = _wanted(fields, names).select(F.col("field").alias("input_field"))
    return found.join(listed, F.col("relation_field") == F.col("input_field"), "full_outer").filter(
        F.col("relation_field").isNull() | F.col("input_field").isNull()
    )


def fields_match_ordered_list(fields: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positions where the field and the listed name differ."""
    items = F.array(*[F.lit(n.lower()) for n in names])
    listed = fields.sparkSession.range(1).select(
        F.posexplode(items).alias("position", "input_field")
    )
    found = _folded(fields).select("position", F.col("field").alias("relation_field"))
    return found.join(listed, "position", "full_outer").filter(
        ~F.col("relation_field").eqNullSafe(F.col("input_field"))
    )
