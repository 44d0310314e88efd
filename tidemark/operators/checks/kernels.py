"""Shared kernels.

NULL rule: an expression that is NULL is not a violation. Checks with another rule say so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "as_condition",
    "where",
    "expression_is_true",
    "aggregate_is_true",
    "bounds",
    "expression_between",
    "aggregate_between",
    "equal_expression",
    "ignore_row_if",
]

Condition = Column | str | None


def as_condition(condition: Column | str) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def where(df: DataFrame, condition: Condition) -> DataFrame:
    return df if condition is None else df.filter(as_condition(condition))


def expression_is_true(df: DataFrame, expression: Column | str, row_condition: Condition = None) -> DataFrame:
    """Whole rows for which the expression is false."""
    return where(df, row_condition).filter(~as_condition(expression))


def aggregate_is_true(
    df: DataFrame,
    observed: Column,
    rule,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
) -> DataFrame:
    """Groups (or the whole table) whose aggregate breaks ``rule(observed)``."""
    return (
        where(df, row_condition)
        .groupBy(*(group_by or []))
        .agg(observed.alias("observed"))
        .withColumn("expression", rule(F.col("observed")))
        .filter(~F.col("expression"))
    )


def bounds(value: Column, min_value=None, max_value=None, strictly: bool = False) -> Column:
    """``value`` lies between the given limits; a limit may be a literal or a column."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    tests = []
    if min_value is not None:
        tests.append(value > min_value if strictly else value >= min_value)
    if max_value is not None:
        tests.append(value < max_value if strictly else value <= max_value)
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def expression_between(
    df: DataFrame,
    expression: Column | str,
    min_value=None,
    max_value=None,
    strictly: bool = False,
    row_condition: Condition = None,
) -> DataFrame:
    inside = bounds(as_condition(expression), min_value, max_value, strictly)
    return expression_is_true(df, inside, row_condition)


def aggregate_between(
    df: DataFrame,
    observed: Column,
    min_value=None,
    max_value=None,
    strictly: bool = False,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
) -> DataFrame:
    return aggregate_is_true(
        df, observed, lambda c: bounds(c, min_value, max_value, strictly), group_by, row_condition
    )


def equal_expression(
    df: DataFrame,
    expression: Column | str,
    compare: DataFrame | None = None,
    compare_expression: Column | str | None = None,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    compare_row_condition: Condition = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
) -> DataFrame:
    """Groups whose aggregate differs between two relations by more than the tolerance.

    A group missing on one side counts as 0 there. The percent form divides by the left value and
    passes when that is NULL or 0.
    """
    left_keys = list(group_by or [])
    right_keys = list(compare_group_by or left_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("group_by and compare_group_by must name the same number of columns")
    other = df if compare is None else compare
    other_expr = expression if compare_expression is None else compare_expression
    other_cond = row_condition if compare_row_condition is None else compare_row_condition

    def side(frame, keys, expr, condition, name):
        aliased = [F.col(k).alias(left) for k, left in zip(keys, left_keys)]
        return where(frame, condition).groupBy(*aliased).agg(as_condition(expr).alias(name))

    a = side(df, left_keys, expression, row_condition, "expression")
    b = side(other, right_keys, other_expr, other_cond, "compare_expression")
    if left_keys:
        both = a.join(b, left_keys, "full_outer")
    else:  # each side is one row
        both = a.withColumn("compare_expression", b.scalar())
    gap = F.abs(
        F.coalesce(F.col("expression"), F.lit(0)) - F.coalesce(F.col("compare_expression"), F.lit(0))
    )
    both = both.withColumn("expression_difference", gap).withColumn(
        "expression_difference_percent",
        F.try_divide(F.col("expression_difference").cast("double"), F.col("expression").cast("double")),
    )
    if tolerance_percent is not None:
        return both.filter(F.col("expression_difference_percent") > tolerance_percent)
    return both.filter(F.col("expression_difference") > tolerance)


def ignore_row_if(rule: str, columns: Sequence[str]) -> Column:
    """Condition that keeps the rows to be tested."""
    if rule == "all_values_are_missing":
        present = F.lit(False)
        for c in columns:
            present = present | F.col(c).isNotNull()
        return present
    if rule == "any_value_is_missing":
        present = F.lit(True)
        for c in columns:
            present = present & F.col(c).isNotNull()
        return present
    raise ValueError(f"rule must be all_values_are_missing or any_value_is_missing, got {rule!r}")

