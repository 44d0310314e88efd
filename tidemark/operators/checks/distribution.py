"""Checks on the spread of totals and on gaps in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import add_periods, period_diff
from tidemark.operators.calendar import period_rows
from tidemark.operators.checks.kernels import Condition, where

__all__ = ["within_n_stdevs", "within_n_moving_stdevs", "data_for_every_n_datepart"]


def within_n_stdevs(
    df: DataFrame, column: str, group_by: Sequence[str], sigma_threshold: float = 3
) -> DataFrame:
    """Groups whose total lies more than ``sigma_threshold`` standard deviations from the mean total."""
    totals = df.groupBy(*group_by).agg(F.sum(column).alias(column))
    # one-row statistics as a scalar subquery, instead of an unpartitioned window
    stats = totals.agg(
        F.struct(
            F.avg(column).alias(f"{column}_average"), F.stddev_samp(column).alias(f"{column}_stddev")
        )
    )
    sigma = F.try_divide(F.col(column) - F.col(f"{column}_average"), F.col(f"{column}_stddev"))
    return (
        totals.withColumn("_stats", stats.scalar())
        .select(*totals.columns, "_stats.*")
        .withColumn(f"{column}_sigma", sigma)
        .filter(F.abs(F.col(f"{column}_sigma")) > sigma_threshold)
    )


def _metric(value: Column, take_logs: bool) -> Column:
    return F.coalesce(F.ln(F.nullif(value, F.lit(0))) if take_logs else value, F.lit(0))


def within_n_moving_stdevs(
    df: DataFrame,
    column: str,
    date_column: str,
    as_of,
    group_by: Sequence[str] | None = None,
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None,
    sigma_threshold_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
) -> DataFrame:
    """Periods whose total leaves the band around the trailing average (current row excluded).

    The windows run over period totals, so a group holds as many rows as it has periods.
    """
    upper = sigma_threshold_upper or sigma_threshold
    lower = sigma_threshold_lower or -sigma_threshold
    group = list(group_by or [])
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    today = F.date_trunc(period, moment.cast("timestamp"))
    span = Window.partitionBy(*(group or [F.lit(0)])).orderBy("metric_period")
    trend = span.rowsBetween(-trend_periods, -1)

    totals = df.groupBy(
        F.date_trunc(period, F.col(date_column).cast("timestamp")).alias("metric_period"), *group
    ).agg(F.sum(column).alias("agg_metric_value"))
    test_value = _metric(F.col("agg_metric_value"), take_logs)
    if take_diffs:
        totals = totals.withColumn(
            "prior_agg_metric_value", F.lag("agg_metric_value", lookback_periods).over(span)
        )
        test_value = test_value - _metric(F.col("prior_agg_metric_value"), take_logs)
    scored = (
        totals.withColumn("metric_test_value", test_value)
        .withColumn("metric_test_rolling_average", F.avg("metric_test_value").over(trend))
        .withColumn("metric_test_rolling_stddev", F.stddev_samp("metric_test_value").over(trend))
        .withColumn(
            "metric_test_delta", F.col("metric_test_value") - F.col("metric_test_rolling_average")
        )
        .withColumn(
            "metric_test_sigma",
            F.try_divide(F.col("metric_test_delta"), F.col("metric_test_rolling_stddev")),
        )
    )
    return scored.filter(
        (F.col("metric_period") >= add_periods(today, -test_periods, period))
        & (F.col("metric_period") < today)
        & ~F.col("metric_test_sigma").between(lower, upper)
    )


def data_for_every_n_datepart(
    df: DataFrame,
    date_column: str,
    datepart: str = "day",
    interval: int = 1,
    row_condition: Condition = None,
    exclusion_condition: Condition = None,
    start=None,
    end=None,
) -> DataFrame:
    """Periods between the first and last date (or the given ones) that hold no row."""
    name = f"date_{datepart}"
    rows = where(df, row_condition).select(F.col(date_column).cast("timestamp").alias("_ts"))
    span = rows.agg(F.min("_ts").cast("date").alias("_lo"), F.max("_ts").cast("date").alias("_hi"))
    low = F.col("_lo") if start is None else F.lit(start).cast("date")
    high = F.col("_hi") if end is None else F.lit(end).cast("date")
    span = span.select(F.date_trunc(datepart, low).alias("_lo"), high.cast("timestamp").alias("_hi"))
    # the spine grows with the calendar, not with the rows
    spine = period_rows(span, datepart)

    day = F.date_trunc(datepart, F.col("_ts"))
    if interval > 1:
        origin = span.select("_lo").scalar()

        def past_start(moment: str) -> Column:
            return F.pmod(period_diff("_start", moment, datepart), F.lit(interval))

        spine = spine.withColumn("_start", origin).filter(past_start(name) == 0).drop("_start")
        # move each row back to the start of its bucket
        rows = rows.withColumn("_start", origin)
        offset = past_start("_ts")
        day = F.timestamp_add(datepart.upper(), (-offset).cast("int"), day)
    filled = rows.groupBy(day.alias(name)).agg(F.count(F.lit(1)).alias("row_cnt"))
    gaps = (
        spine.join(filled, name, "left")
        .filter(F.col("row_cnt").isNull())
        .select(name, F.lit(True).alias("is_missing"), F.lit(0).cast("bigint").alias("row_cnt"))
    )
    return where(gaps, exclusion_condition)
