"""The given star-schema tables seen as entities and as a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import marts

__all__ = [
    "ORDERS_AS_OF",
    "EVENTS_AS_OF",
    "table",
    "users",
    "orders",
    "payments",
    "dim_users",
    "fct_orders",
    "fct_payments",
    "kpis",
    "segments",
    "change_messages",
    "damaged_messages",
]

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _audit(entity: str, key: Column, moment: Column) -> list[Column]:
    return [
        F.concat_ws("|", F.lit(entity), F.lit("0"), key.cast("string")).alias("_bronze_event_uid"),
        F.concat(F.lit("lsn_"), F.lpad(key.cast("string"), 20, "0")).alias("_bronze_ordering_key"),
        F.unix_millis(moment.cast("timestamp")).alias("_bronze_ts_ms"),
        F.lit(ORDERS_AS_OF).cast("timestamp").alias("_silver_updated_at"),
    ]


def users(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    status = (
        F.when(segment.isin("BUILDING", "AUTOMOBILE"), "active")
        .when(segment == "HOUSEHOLD", "blocked")
        .when(segment == "FURNITURE", "deleted")
        .otherwise(F.lower(segment))
    )
    joined = F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_nationkey")).cast("timestamp")
    raw = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        status.alias("status"),
        joined.alias("created_at"),
        joined.alias("updated_at"),
        *_audit("users", F.col("c_custkey"), joined),
    )
    return marts.stage("users", raw)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("o_orderstatus")
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.when(code == "F", "paid").when(code == "O", "created").when(code == "P", "shipped").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("updated_at"),
        *_audit("orders", F.col("o_orderkey"), F.col("o_orderdate")),
    )
    return marts.stage("orders", raw)


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as payments. The key repeats: (l_orderkey, l_linenumber) is not unique."""
    flag = F.col("l_returnflag")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    raw = table(spark, folder, "lineitem").select(
        key.alias("payment_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").alias("amount"),
        F.when(flag == "N", "captured").when(flag == "R", "refunded").when(flag == "A", "failed").alias("status"),
        F.when(flag == "A", "declined").alias("failure_reason"),
        F.col("l_shipdate").alias("updated_at"),
        *_audit("payments", key, F.col("l_shipdate")),
    )
    return marts.stage("payments", raw)


def dim_users(spark: SparkSession, folder: str) -> DataFrame:
    return marts.dim_users(marts.business_users(users(spark, folder)))


def fct_orders(spark: SparkSession, folder: str) -> DataFrame:
    return marts.fct_orders(marts.business_orders(orders(spark, folder)))


def fct_payments(spark: SparkSession, folder: str) -> DataFrame:
    return marts.fct_payments(marts.business_payments(payments(spark, folder)))


def kpis(spark: SparkSession, folder: str) -> DataFrame:
    daily = marts.daily_kpis(fct_orders(spark, folder), fct_payments(spark, folder), F.lit(ORDERS_AS_OF))
    return marts.versioned_kpis(daily)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit(ORDERS_AS_OF)
    built = marts.user_segments(dim_users(spark, folder), fct_orders(spark, folder), as_of)
    return marts.segment_mart(built, as_of)


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _message(entity: str, key: str, image: Column, op: Column, source: Column, with_after: Column, with_before: Column):
    body = F.struct(
        F.when(with_before, image).alias("before"),
        F.when(with_after, image).alias("after"),
        source.alias("source"),
        op.alias("op"),
        F.unix_millis("_ts").alias("ts_ms"),
    )
    return [
        F.lit(f"dbserver_docker.public.{entity}").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("_ts").alias("timestamp"),
        F.to_json(F.struct(F.col(key).alias(key))).cast("binary").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    ]


def _source(entity: str, with_lsn: bool) -> Column:
    parts = [F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit(entity).alias("table")]
    if with_lsn:
        parts.append((F.col("event_id") + 1000).alias("lsn"))
    return F.struct(*parts)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("bigint")
    return (
        table(spark, folder, "events")
        .withColumn("_ts", F.col("ts").cast("timestamp"))
        .withColumn("_iso", _iso(F.col("_ts")))
        .withColumn(
            "_op",
            F.when(F.col("event_type").isin("signup", "purchase"), "c")
            .when(F.col("event_type") == "error", "d")
            .otherwise("u"),
        )
        .withColumn("_amount", F.col("value").cast("decimal(18,2)"))
        .withColumn("order_id", F.col("user_id") * 1000 + number)
        .withColumn("payment_id", F.col("user_id") * 10 + number % 10)
    )


def change_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Three change topics from the event table.

    Users take every event; orders all but signups; payments clicks, purchases and errors, and they
    carry no log position, so they are ordered by ``updated_at``.
    """
    events = _events(spark, folder)
    kind, op = F.col("event_type"), F.col("_op")
    deleted = op == "d"
    user_image = F.struct(
        "user_id",
        F.concat(F.lit("u"), F.col("user_id"), F.lit("@example.com")).alias("email"),
        F.when(kind == "view", "blocked").otherwise("active").alias("status"),
        F.col("_iso").alias("created_at"),
        F.col("_iso").alias("updated_at"),
    )
    order_image = F.struct(
        "order_id",
        "user_id",
        F.col("_iso").alias("order_ts"),
        F.when(kind == "purchase", "paid").when(kind == "view", "created").otherwise("shipped").alias("status"),
        F.col("_amount").alias("total_amount"),
        F.col("_iso").alias("updated_at"),
    )
    payment_image = F.struct(
        "payment_id",
        "order_id",
        F.col("_amount").alias("amount"),
        F.when(kind == "purchase", "captured").otherwise("authorized").alias("status"),
        F.lit(None).cast("string").alias("failure_reason"),
        F.col("_iso").alias("updated_at"),
    )
    parts = [
        events.select(*_message("users", "user_id", user_image, op, _source("users", True), ~deleted, deleted)),
        events.filter(kind != "signup").select(
            *_message("orders", "order_id", order_image, op, _source("orders", True), ~deleted, deleted)
        ),
        events.filter(kind.isin("click", "purchase", "error")).select(
            *_message("payments", "payment_id", payment_image, op, _source("payments", False), ~deleted, deleted)
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def damaged_messages(spark: SparkSession, folder: str) -> DataFrame:
    """User messages with one defect per event type, for contract validation."""
    events = _events(spark, folder)
    kind = F.col("event_type")
    image = F.struct(
        "user_id",
        F.concat(F.lit("u"), F.col("user_id"), F.lit("@example.com")).alias("email"),
        F.when(kind == "signup", "unheard").otherwise("active").alias("status"),
    )
    op = F.when(kind == "click", "x").when(kind == "error", "d").otherwise("c")
    body = F.struct(
        F.lit(None).cast("string").alias("before"),
        F.when(kind != "purchase", image).alias("after"),
        op.alias("op"),
        F.unix_millis("_ts").alias("ts_ms"),
    )
    full = F.struct(
        F.lit(None).cast("string").alias("before"),
        F.when(kind != "purchase", image).alias("after"),
        _source("users", True).alias("source"),
        op.alias("op"),
        F.unix_millis("_ts").alias("ts_ms"),
    )
    options = {"ignoreNullFields": "false"}
    # a view lacks its source; the other defects sit in the full envelope
    text = F.when(kind == "view", F.to_json(body, options)).otherwise(F.to_json(full, options))
    return events.select(
        F.lit("dbserver_docker.public.users").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("_ts").alias("timestamp"),
        F.to_json(F.struct("user_id")).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
    )
