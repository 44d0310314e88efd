"""Staging, business and mart models as DataFrame → DataFrame functions.

``as_of`` replaces the current date and time everywhere, so a rebuild of an old day gives the old
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import CDC_CONTRACTS
from tidemark.operators.joins import left_join_many
from tidemark.operators.reshape import cast_columns

__all__ = [
    "MONEY_SUM",
    "stage",
    "normalise_enum",
    "without_soft_deleted",
    "non_negative",
    "business_users",
    "business_orders",
    "business_payments",
    "dim_users",
    "fct_orders",
    "fct_payments",
    "daily_kpis",
    "exact_daily_gmv",
    "versioned_kpis",
    "user_metrics",
    "label_segments",
    "user_segments",
    "segment_mart",
]

# sums of decimal(18,2)
MONEY_SUM = "decimal(28,2)"

# Statuses kept by the business layer; any other becomes "unknown".
USER_STATUSES = ("active", "blocked", "deleted")
ORDER_STATUSES = ("created", "paid", "shipped", "cancelled", "refunded")
PAYMENT_STATUSES = ("created", "authorized", "captured", "failed", "refunded", "cancelled")

# Segment limits.
HIGH_VALUE, MEDIUM_VALUE = 1000, 500
GMV_DAYS, CHURN_DAYS, ACTIVE_DAYS = 90, 30, 7

_AUDIT = [
    T.StructField("_bronze_event_uid", T.StringType()),
    T.StructField("_bronze_ordering_key", T.StringType()),
    T.StructField("_bronze_ts_ms", T.LongType()),
    T.StructField("_silver_updated_at", T.TimestampType()),
]


def stage(entity: str, rows: DataFrame) -> DataFrame:
    """Entity rows with every column cast to its declared type."""
    return cast_columns(rows, T.StructType([*CDC_CONTRACTS[entity].payload_schema.fields, *_AUDIT]))


def normalise_enum(value: Column | str, allowed: tuple[str, ...], other: str = "unknown") -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column.isin(*allowed), column).otherwise(F.lit(other))


def without_soft_deleted(df: DataFrame, column: str = "status", mark: str = "deleted") -> DataFrame:
    """Drops the marked rows, and rows whose status is NULL."""
    return df.filter(F.col(column) != mark)


def non_negative(df: DataFrame, column: str) -> DataFrame:
    """Keeps values of at least 0; a NULL value drops the row."""
    return df.filter(F.col(column) >= 0).withColumn(column, F.coalesce(F.col(column), F.lit(0)))


def business_users(staged: DataFrame) -> DataFrame:
    return without_soft_deleted(staged).withColumn("status", normalise_enum("status", USER_STATUSES))


def business_orders(staged: DataFrame) -> DataFrame:
    return non_negative(staged, "total_amount").withColumn(
        "status", normalise_enum("status", ORDER_STATUSES)
    )


def business_payments(staged: DataFrame) -> DataFrame:
    return non_negative(staged, "amount").withColumn(
        "status", normalise_enum("status", PAYMENT_STATUSES)
    )


def dim_users(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", "email", "status", "created_at", "updated_at",
        F.col("_silver_updated_at").alias("_last_updated_at"),
    )


def _amount_when(test: Column, amount: str) -> Column:
    return F.when(test, F.col(amount)).otherwise(F.lit(0)).cast("decimal(18,2)")


def fct_orders(orders: DataFrame) -> DataFrame:
    status = F.col("status")
    return orders.select(
        "order_id", "user_id", "order_ts", "status", "total_amount", "updated_at",
        _amount_when(status == "paid", "total_amount").alias("paid_amount"),
        F.when(status.isin("cancelled", "refunded"), 1).otherwise(0).alias("is_cancelled"),
        F.col("_silver_updated_at").alias("_last_updated_at"),
    )


def fct_payments(payments: DataFrame) -> DataFrame:
    status = F.col("status")
    return payments.select(
        "payment_id", "order_id", "amount", "status", "failure_reason", "updated_at",
        _amount_when(status == "captured", "amount").alias("captured_amount"),
        F.when(status == "failed", 1).otherwise(0).alias("is_failed"),
        F.col("_silver_updated_at").alias("_last_updated_at"),
    )


def _payments_per_order(payments: DataFrame) -> DataFrame:
    """One row per order: payment rows, distinct payments, captured sum, failures.

    The first step groups by order and payment, the second by order; both combine inside each task
    first, so one order with a third of all payments is spread over many tasks.
    """
    captured = F.col("status") == "captured"
    per_payment = payments.groupBy("order_id", "payment_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("captured_amount").alias("_captured"),
        F.sum("is_failed").alias("_failed"),
        F.count_if(captured).alias("_captured_rows"),
    )
    return per_payment.groupBy("order_id").agg(
        F.sum("_rows").alias("payment_rows"),
        F.count("payment_id").alias("payments"),
        F.sum("_captured").alias("captured_amount"),
        F.sum("_failed").alias("failed_rows"),
        F.count(F.when(F.col("_captured_rows") > 0, F.col("payment_id"))).alias("captured_payments"),
    )


def daily_kpis(
    orders: DataFrame, payments: DataFrame, computed_at: Column, keyed: bool = True
) -> DataFrame:
    """Daily KPIs of orders and their payments.

    The published metric sums order amounts after joining payments, so an order with k payments
    counts k times; that is kept (``exact_daily_gmv`` has the sum without it).

    ``keyed`` states what the entity merge guarantees: one row per order id, and a payment id that
    never belongs to two orders. Payments are then reduced to one row per order before the join, so
    the join and the distinct counts run at order grain. With ``keyed=False`` the plan joins first
    and is right for any input.
    """
    kpi_date = F.to_date("order_ts").alias("kpi_date")
    if not keyed:
        joined = left_join_many(
            orders.select(kpi_date, "order_id", "user_id", "total_amount", "paid_amount"),
            payments.select("order_id", "payment_id", "status", "captured_amount", "is_failed"),
            ["order_id"],
        )
        captured_id = F.when(F.col("status") == "captured", F.col("payment_id"))
        daily = joined.groupBy("kpi_date").agg(
            F.countDistinct("order_id").alias("order_count"),
            F.sum("total_amount").alias("total_gmv"),
            F.sum("paid_amount").alias("paid_gmv"),
            F.countDistinct("user_id").alias("active_users"),
            F.countDistinct("payment_id").alias("payment_count"),
            F.sum("captured_amount").alias("captured_amount"),
            F.sum("is_failed").alias("failed_payment_count"),
            F.countDistinct(captured_id).alias("successful_payment_count"),
        )
    else:
        per_order = orders.select(
            kpi_date, "order_id", "user_id", "total_amount", "paid_amount"
        ).join(_payments_per_order(payments), "order_id", "left")
        times = F.coalesce(F.col("payment_rows"), F.lit(1)).cast("decimal(10,0)")
        daily = per_order.groupBy("kpi_date").agg(
            F.count("order_id").alias("order_count"),
            F.sum((F.col("total_amount") * times).cast("decimal(28,2)")).alias("total_gmv"),
            F.sum((F.col("paid_amount") * times).cast("decimal(28,2)")).alias("paid_gmv"),
            F.countDistinct("user_id").alias("active_users"),
            F.coalesce(F.sum("payments"), F.lit(0)).alias("payment_count"),
            F.sum("captured_amount").alias("captured_amount"),
            F.sum("failed_rows").alias("failed_payment_count"),
            F.coalesce(F.sum("captured_payments"), F.lit(0)).alias("successful_payment_count"),
        )
    return daily.select(
        "kpi_date",
        F.col("order_count").cast("bigint"),
        F.col("total_gmv").cast(MONEY_SUM),
        F.col("paid_gmv").cast(MONEY_SUM),
        F.col("active_users").cast("bigint"),
        F.col("payment_count").cast("bigint"),
        F.col("captured_amount").cast(MONEY_SUM),
        F.col("failed_payment_count").cast("bigint"),
        F.col("successful_payment_count").cast("bigint"),
        computed_at.cast("timestamp").alias("_computed_at"),
    )


def exact_daily_gmv(orders: DataFrame) -> DataFrame:
    """Daily order value, each order counted once."""
    return orders.groupBy(F.to_date("order_ts").alias("kpi_date")).agg(
        F.sum("total_amount").cast(MONEY_SUM).alias("exact_gmv"),
        F.sum("paid_amount").cast(MONEY_SUM).alias("exact_paid_gmv"),
    )


def versioned_kpis(kpis: DataFrame, version: str = "v1") -> DataFrame:
    """Adds both payment rates and the version tag.

    A rate is 0 without orders (payments), and NULL where its denominator is 0 all the same.
    """

    def rate(part: str, whole: str, guard: str) -> Column:
        ratio = F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))
        return F.when(F.col(guard) > 0, ratio).otherwise(F.lit(0.0))

    return kpis.select(
        "kpi_date", "order_count", "total_gmv", "paid_gmv", "active_users", "payment_count",
        "captured_amount", "failed_payment_count", "successful_payment_count",
        rate("captured_amount", "total_gmv", "order_count").alias("payment_success_rate"),
        rate("failed_payment_count", "payment_count", "payment_count").alias("payment_failure_rate"),
        "_computed_at",
        F.lit(version).alias("metric_version"),
    )


def user_metrics(users: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """Recent order value and activity flags per active user.

    Orders are reduced to one row per user before the join, so a user with a third of all orders is
    combined inside the tasks.
    """
    today = as_of.cast("date")

    def days_back(n: int) -> Column:
        return F.date_sub(today, n).cast("timestamp")

    recent = F.when(F.col("order_ts") >= days_back(GMV_DAYS), F.col("total_amount")).otherwise(F.lit(0))
    per_user = orders.groupBy("user_id").agg(
        F.sum(recent).alias("_recent"), F.max("order_ts").alias("_last")
    )
    return (
        users.filter(F.col("status") == "active")
        .select("user_id", "status", "created_at")
        .join(per_user, "user_id", "left")
        .select(
            "user_id", "status", "created_at",
            F.coalesce(F.col("_recent"), F.lit(0)).cast(MONEY_SUM).alias("last_90d_gmv"),
            F.when(F.col("_last") < days_back(CHURN_DAYS), 1).otherwise(0).alias("is_churn_risk"),
            F.when(F.col("_last") >= days_back(ACTIVE_DAYS), 1).otherwise(0).alias("is_active"),
        )
    )


def label_segments(metrics: DataFrame) -> DataFrame:
    value = F.col("last_90d_gmv")
    return metrics.withColumns(
        {
            "value_segment": F.when(value >= HIGH_VALUE, "high_value")
            .when(value >= MEDIUM_VALUE, "medium_value")
            .otherwise("low_value"),
            "activity_segment": F.when(F.col("is_churn_risk") == 1, "churn_risk")
            .when(F.col("is_active") == 1, "active")
            .otherwise("dormant"),
        }
    )


def user_segments(users: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    return label_segments(user_metrics(users, orders, as_of)).withColumn(
        "_computed_at", as_of.cast("timestamp")
    )


def segment_mart(segments: DataFrame, as_of: Column) -> DataFrame:
    return segments.withColumn("segment_date", as_of.cast("date"))
