"""Entity tables kept up to date from the log stream."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import latest_events, typed_changes
from tidemark.session import stored
from tidemark.sources.tables import EntityStore

__all__ = ["apply_batch", "start_entities", "ingest_window", "replay"]


def _fold(latest: DataFrame, stores: Mapping[str, EntityStore], settle_share: float) -> None:
    """Adds the latest events of all entities to their stores; a store with enough pending rows is settled."""
    applied_at = F.current_timestamp()

    def fold(entity: str) -> None:
        store = stores[entity]
        store.apply(typed_changes(latest.filter(F.col("entity") == entity), store.spec, applied_at), settle_share)

    # the stores do not depend on each other: their jobs run side by side
    with ThreadPoolExecutor(max(1, len(stores))) as pool:
        list(pool.map(fold, stores))


def apply_batch(log_batch: DataFrame, stores: Mapping[str, EntityStore], settle_share: float = 0.0) -> None:
    """Fold a batch of log rows into the entity tables.

    The batch is read and its latest events are found once for all entities. Applying a batch again changes nothing: a row is replaced only by a
    higher ordering key.
    """
    latest = latest_events(log_batch.filter(F.col("entity").isin(*stores))).persist()
    try:
        _fold(latest, stores, settle_share)
    finally:
        latest.unpersist()


def start_entities(
    log_stream: DataFrame,
    stores: Mapping[str, EntityStore],
    checkpoint: str,
    trigger: str | None = None,
    settle_share: float = 0.25,
) -> StreamingQuery:
    """Apply each micro-batch as pending changes; a store is settled once they are more than ``settle_share`` of its rows.

    So a row is rewritten a bounded number of times while the table doubles, and between two settlements a batch costs what its own rows
    cost; readers see it at once.
    """

    def merge(batch: DataFrame, _: int) -> None:
        apply_batch(batch, stores, settle_share)

    writer = log_stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def ingest_window(log: DataFrame, start=None, end=None) -> DataFrame:
    """Log rows ingested from ``start`` to before ``end``; days outside are pruned where the log is partitioned by ``ingest_date``."""
    rows, by_day = log, "ingest_date" in log.columns
    if start is not None:
        start = F.lit(start).cast("timestamp")
        rows = rows.filter(F.col("ingest_time") >= start)
        rows = rows.filter(F.col("ingest_date") >= F.to_date(start)) if by_day else rows
    if end is not None:
        end = F.lit(end).cast("timestamp")
        rows = rows.filter(F.col("ingest_time") < end)
        rows = rows.filter(F.col("ingest_date") <= F.to_date(end)) if by_day else rows
    return rows


def replay(log: DataFrame, stores: Mapping[str, EntityStore], start=None, end=None, settle_share: float = 0.0) -> None:
    """Fold a whole log, or an ingest-time window of it, into the entity tables again.

    The window is read and parsed once: the latest events of all entities are written before they are dealt out, so that a
    lost executor repeats no more than its own share.
    """
    rows = ingest_window(log, start, end).filter(F.col("entity").isin(*stores))
    _fold(stored(latest_events(rows), "replay"), stores, settle_share)
