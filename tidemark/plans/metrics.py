"""Parameterised queries over the marts, and the project's own quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks.tables import relationships

__all__ = [
    "METRICS",
    "project_metrics",
    "kpi_on",
    "kpi_range",
    "users_in_segment",
    "versions",
    "recent_releases",
    "rows_per_day",
    "users_with_order_count",
    "top_users",
    "overpaid_orders",
    "captured_above_gmv",
    "orphan_payments",
    "negative_orders",
    "completeness",
    "missing_days",
    "kpi_day_coverage",
    "completeness_range",
]

# Metrics that can be asked for, versions and segments.
METRICS = (
    "order_count", "total_gmv", "paid_gmv", "active_users", "payment_count", "captured_amount",
    "failed_payment_count", "successful_payment_count", "payment_success_rate", "payment_failure_rate",
)
VERSIONS = ("v1",)
SEGMENTS = {
    "high_value": "value_segment",
    "medium_value": "value_segment",
    "low_value": "value_segment",
    "churn_risk": "activity_segment",
    "active": "activity_segment",
    "dormant": "activity_segment",
}


def project_metrics(kpis: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Date, version and the requested metrics; unknown names are ignored."""
    if metrics is None:
        return kpis
    wanted = {m.strip() for m in metrics}
    return kpis.select("kpi_date", *[m for m in METRICS if m in wanted], "metric_version")


def _of_version(kpis: DataFrame, version: str) -> DataFrame:
    if version not in VERSIONS:
        raise ValueError(f"version {version!r} is not supported, available: {', '.join(VERSIONS)}")
    return kpis.filter(F.col("metric_version") == version)


def kpi_on(kpis: DataFrame, day, version: str = "v1", metrics: Sequence[str] | None = None) -> DataFrame:
    return project_metrics(
        _of_version(kpis, version).filter(F.col("kpi_date") == F.lit(day).cast("date")), metrics
    )


def kpi_range(kpis: DataFrame, start, end, version: str = "v1") -> DataFrame:
    inside = F.col("kpi_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return _of_version(kpis, version).filter(inside).drop("_computed_at").orderBy("kpi_date")


def users_in_segment(segments: DataFrame, segment: str, day=None, limit: int = 100) -> DataFrame:
    """Top users of a segment by recent order value, on a date or on the newest one."""
    if segment not in SEGMENTS:
        raise ValueError(f"invalid segment {segment!r}, valid: {', '.join(SEGMENTS)}")
    if not 1 <= limit <= 10000:
        raise ValueError("limit must be between 1 and 10000")
    rows = segments.filter(F.col(SEGMENTS[segment]) == segment)
    if day is not None:
        rows = rows.filter(F.col("segment_date") == F.lit(day).cast("date"))
    else:
        newest = segments.agg(F.max("segment_date"))
        rows = rows.filter(F.col("segment_date") == newest.scalar())
    return rows.orderBy(F.desc("last_90d_gmv"), F.asc("user_id")).limit(limit)


def versions(releases: DataFrame) -> DataFrame:
    return (
        releases.groupBy("metric_version")
        .agg(F.max("released_at").alias("latest_release"))
        .orderBy(F.desc("latest_release"))
    )


def recent_releases(releases: DataFrame, limit: int = 10) -> DataFrame:
    return releases.orderBy(F.desc("released_at"), F.asc("release_id")).limit(limit)


def rows_per_day(kpis: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return (
        kpis.filter(F.col("kpi_date") >= F.date_sub(as_of.cast("date"), days))
        .groupBy("kpi_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("kpi_date")
    )


def users_with_order_count(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Every user with the number of orders; orders are counted before the join."""
    counts = orders.groupBy("user_id").agg(F.count("order_id").alias("_n"))
    return (
        users.select("user_id", "email", "status")
        .join(counts, "user_id", "left")
        .withColumn("order_count", F.coalesce(F.col("_n"), F.lit(0)))
        .drop("_n")
    )


def top_users(segments: DataFrame, limit: int = 10) -> DataFrame:
    return segments.orderBy(F.desc("last_90d_gmv"), F.asc("user_id")).limit(limit)


def overpaid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose captured payments exceed the order total."""
    captured = payments.groupBy("order_id").agg(
        F.sum("captured_amount").cast("decimal(28,2)").alias("total_captured")
    )
    return (
        orders.select("order_id", F.col("total_amount").alias("order_total"))
        .join(captured, "order_id")
        .filter(F.col("total_captured") > F.col("order_total"))
    )


def captured_above_gmv(kpis: DataFrame) -> DataFrame:
    return kpis.filter(
        (F.col("captured_amount") > F.col("total_gmv")) & (F.col("total_gmv") > 0)
    ).select("kpi_date", "total_gmv", "captured_amount")


def orphan_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Order ids of payments without an order, with the number of payments.

    Unlike a foreign-key check, payments with a NULL order id are orphans too.
    """
    # reduced map-side first: an order with any number of payments is one row; an anti join keeps NULL keys
    paid = payments.groupBy(F.col("order_id").alias("id")).agg(F.count(F.lit(1)).alias("n_records"))
    return paid.join(orders.select(F.col("order_id").alias("id")), "id", "left_anti")


def negative_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("total_amount") < 0)


def completeness(kpis: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Number and list of KPI days in the trailing window, and the days that are missing.

    The array is bounded by the window length.
    """
    today = as_of.cast("date")
    found = kpis.filter(F.col("kpi_date").between(F.date_sub(today, days), today)).agg(
        F.countDistinct("kpi_date").alias("partition_count"),
        F.sort_array(F.collect_set("kpi_date")).alias("dates"),
    )
    expected = F.sequence(F.date_sub(today, days - 1), today)
    return found.withColumn("missing_dates", F.array_except(expected, F.col("dates")))


def missing_days(kpis: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Days of the trailing window without KPI rows."""
    today = as_of.cast("date")
    spine = kpis.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(today, days - 1), today)).alias("kpi_date")
    )
    present = kpis.filter(F.col("kpi_date").between(F.date_sub(today, days - 1), today)).select("kpi_date")
    return spine.join(present, "kpi_date", "left_anti")


def kpi_day_coverage(kpis: DataFrame, orders: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """KPI days against days with orders in the trailing window."""
    start = F.date_sub(as_of.cast("date"), days)
    built = kpis.filter(F.col("kpi_date") >= start).agg(
        F.countDistinct("kpi_date").alias("partition_count")
    )
    day = F.to_date("order_ts")
    # the filter stays on the raw column, so it reaches the scan
    sold = orders.filter(F.col("order_ts") >= start.cast("timestamp")).agg(F.countDistinct(day))
    return built.withColumn("missing_partitions", F.col("partition_count") - sold.scalar())


def completeness_range(kpis: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return kpis.filter(F.col("kpi_date") >= F.date_sub(as_of.cast("date"), days)).agg(
        F.countDistinct("kpi_date").alias("partition_count"),
        F.min("kpi_date").alias("min_date"),
        F.max("kpi_date").alias("max_date"),
    )
