"""The append-only log as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.contracts import CDC_CONTRACTS, TOPIC_ENTITIES, Contract
from tidemark.operators.envelope import open_envelope, rejected, to_log, with_violations
from tidemark.sources.tables import with_ingest_date

__all__ = ["start_log", "start_quarantine", "deduplicated", "append_stream"]


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    trigger: str | None = None,
) -> StreamingQuery:
    """Append to parquet. Without ``trigger`` all available rows are processed and the query ends."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def start_log(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    contracts: Mapping[str, Contract] = CDC_CONTRACTS,
    routes: Mapping[str, str] = TOPIC_ENTITIES,
    on_violation: str = "fail",
    trigger: str | None = None,
    ingest_time: Column | None = None,
) -> StreamingQuery:
    """Valid messages to the log, partitioned by day of ingest.

    The file sink records each batch in the checkpoint, so a restart neither loses nor repeats rows;
    messages the bus delivers twice keep the same ``event_uid`` and are harmless downstream.
    """
    log = to_log(messages, contracts, routes, ingest_time, on_violation)
    return append_stream(with_ingest_date(log), path, checkpoint, ("ingest_date",), trigger)


def start_quarantine(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    contracts: Mapping[str, Contract] = CDC_CONTRACTS,
    routes: Mapping[str, str] = TOPIC_ENTITIES,
    trigger: str | None = None,
    field_rules: bool = False,
) -> StreamingQuery:
    """Invalid messages with their reasons, as a query of its own; pair it with ``on_violation="drop"``."""
    bad = rejected(with_violations(open_envelope(messages, contracts, routes), contracts, field_rules))
    return append_stream(bad, path, checkpoint, (), trigger)


def deduplicated(log: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Drop repeated ``event_uid`` values that arrive within ``delay`` of each other."""
    moment = F.col(event_time).cast("timestamp")
    return log.withColumn("_event_time", moment).withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(
        ["event_uid"]
    )
