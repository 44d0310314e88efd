"""Write-back of segments: keyed upsert, messages, rollback; release log; stored failures."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_rows

__all__ = [
    "SEGMENT_KEY",
    "segment_rows",
    "upsert_segments",
    "upsert_counts",
    "upsert_partitions",
    "segment_messages",
    "publish_messages",
    "rollback_run",
    "release_entry",
    "append_release",
    "failure_rows",
    "store_failures",
]

SEGMENT_KEY = ("user_id", "segment_date")
_VALUES = ("value_segment", "activity_segment", "last_90d_gmv", "is_churn_risk", "is_active")


def segment_rows(segments: DataFrame, run_id: str, updated_at: Column) -> DataFrame:
    """Segments in the shape of the write-back target."""
    return segments.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("segment_date").cast("date").alias("segment_date"),
        "value_segment",
        "activity_segment",
        F.coalesce(F.col("last_90d_gmv"), F.lit(0)).cast("decimal(18,2)").alias("last_90d_gmv"),
        F.coalesce(F.col("is_churn_risk"), F.lit(0)).cast("int").alias("is_churn_risk"),
        F.coalesce(F.col("is_active"), F.lit(0)).cast("int").alias("is_active"),
        F.lit(run_id).alias("source_run_id"),
        updated_at.cast("timestamp").alias("last_updated_at"),
    )


def upsert_segments(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Target after the upsert: every row of the batch replaces or adds its key."""
    return merge_rows(target, rows, SEGMENT_KEY)


def upsert_counts(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact number of inserted and updated keys of a batch."""
    known = target.select(*SEGMENT_KEY, F.lit(True).alias("_known"))
    return rows.join(known, list(SEGMENT_KEY), "left").agg(
        F.count_if(F.col("_known").isNull()).alias("inserted_count"),
        F.count("_known").alias("updated_count"),
        F.count(F.lit(1)).alias("total"),
    )


def upsert_partitions(
    rows: DataFrame, connect: Callable, table: str, batch_size: int = 1000, placeholder: str = "%s"
) -> None:
    """Upsert into a relational database, each partition in batches over its own connection.

    ``connect`` makes a DB-API connection inside the task. A retried task repeats its batches, which
    the conflict clause makes harmless. Needs a database server, so nothing here calls it.
    """
    columns = rows.columns
    marks = ", ".join([placeholder] * len(columns))
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in SEGMENT_KEY)
    sql = (
        f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks}) "
        f"ON CONFLICT ({', '.join(SEGMENT_KEY)}) DO UPDATE SET {updates}"
    )

    def send(partition) -> None:
        from itertools import islice

        connection = connect()
        try:
            cursor = connection.cursor()
            while batch := [tuple(r) for r in islice(partition, batch_size)]:
                cursor.executemany(sql, batch)
                connection.commit()
        finally:
            connection.close()

    rows.foreachPartition(send)


def segment_messages(segments: DataFrame, run_id: str, published_at: Column) -> DataFrame:
    """One message per segment row: key is the user, value is JSON."""
    body = F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("segment_date").cast("string").alias("segment_date"),
        "value_segment",
        "activity_segment",
        F.coalesce(F.col("last_90d_gmv").cast("double"), F.lit(0.0)).alias("last_90d_gmv"),
        F.coalesce(F.col("is_churn_risk").cast("int"), F.lit(0)).alias("is_churn_risk"),
        F.coalesce(F.col("is_active").cast("int"), F.lit(0)).alias("is_active"),
        F.lit(run_id).alias("source_run_id"),
        F.date_format(published_at, "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
    )
    value = F.to_json(body, {"ignoreNullFields": "false"})
    return segments.select(F.col("user_id").cast("string").alias("key"), value.alias("value"))


def publish_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Send keyed messages to the bus; needs Spark's Kafka connector on the class path.

    Rows of one key stay in one task and in date order, so the bus keeps their order.
    """
    day = F.get_json_object("value", "$.segment_date")
    ordered = messages.repartition("key").sortWithinPartitions("key", day)
    writer = ordered.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).option("kafka.enable.idempotence", "true").save()


def rollback_run(target: DataFrame, run_id: str) -> DataFrame:
    """Target without the rows that a run wrote."""
    return target.filter(~F.col("source_run_id").eqNullSafe(F.lit(run_id)))


def release_entry(
    kpis: DataFrame,
    *,
    release_id: str,
    metric_version: str,
    released_by: str,
    released_at: Column,
    git_commit: str = "unknown",
    git_branch: str = "unknown",
    tests_passed: bool | Column = True,
    tests_summary: str | Column = "{}",
    completeness_passed: bool | Column = True,
    notes: str | None = None,
) -> DataFrame:
    """One release-log row; the data range is read from the KPI table."""

    def lit(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    # fixed values: the column names of release logs in use
    return kpis.agg(F.min("kpi_date").alias("_lo"), F.max("kpi_date").alias("_hi")).select(
        F.lit(release_id).alias("release_id"),
        F.lit(metric_version).alias("metric_version"),
        F.lit(git_commit).alias("git_commit"),
        F.lit(git_branch).alias("git_branch"),
        F.lit(released_by).alias("released_by"),
        released_at.cast("timestamp").alias("released_at"),
        lit(tests_passed).alias("dbt_tests_passed"),
        lit(tests_summary).alias("dbt_tests_summary"),
        lit(completeness_passed).alias("completeness_check_passed"),
        F.col("_lo").alias("data_range_start"),
        F.col("_hi").alias("data_range_end"),
        F.lit(notes).cast("string").alias("release_notes"),
    )


def append_release(entry: DataFrame, path: str) -> None:
    entry.write.mode("append").partitionBy("metric_version").parquet(path)


def failure_rows(violations: DataFrame, check_name: str, run_id: str) -> DataFrame:
    """Violations of any shape as uniform rows."""
    columns: Sequence[str] = violations.columns
    return violations.select(
        F.lit(check_name).alias("check_name"),
        F.lit(run_id).alias("run_id"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("violation"),
    )


def store_failures(violations: DataFrame, check_name: str, run_id: str, path: str) -> None:
    """Append all violating rows under their check's partition."""
    failure_rows(violations, check_name, run_id).write.mode("append").partitionBy("check_name").parquet(path)
