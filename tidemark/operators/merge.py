"""Latest event per key, and the keyed merge of those events into entity tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import CDC_CONTRACTS, Contract
from tidemark.functions.numbers import decode_decimal

__all__ = [
    "EntitySpec",
    "ENTITY_SPECS",
    "latest_events",
    "typed_changes",
    "merge_changes",
    "merge_rows",
    "last_changes",
    "live_rows",
    "delete_by_keys",
    "fold_log",
    "mixed_ordering_prefixes",
]

_AUDIT = T.StructType(
    [
        T.StructField("_bronze_event_uid", T.StringType()),
        T.StructField("_bronze_ordering_key", T.StringType()),
        T.StructField("_bronze_ts_ms", T.LongType()),
        T.StructField("_silver_updated_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class EntitySpec:
    """What the merge needs to know about an entity; a new nullable field is just one more entry.

    ``encodings`` names the fields whose decimals the source does not write as numbers (see ``decode_decimal``); nothing is guessed.
    """

    entity: str
    key: tuple[str, ...]
    payload: T.StructType
    encodings: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        """Stored columns: payload, audit columns and the tombstone flag."""
        flag = T.StructField("_deleted", T.BooleanType())
        return T.StructType([*self.payload.fields, *_AUDIT.fields, flag])

    @classmethod
    def from_contract(cls, contract: Contract) -> EntitySpec:
        coded = tuple((name, rule.encoding) for name, rule in contract.fields.items() if rule.encoding != "number")
        return cls(contract.entity, contract.primary_key, contract.payload_schema, coded)


ENTITY_SPECS = {name: EntitySpec.from_contract(c) for name, c in CDC_CONTRACTS.items()}


def latest_events(log: DataFrame, entity: str | None = None) -> DataFrame:
    """Last event per key by ordering key; equal keys are settled by event id.

    The row-number filter is pruned inside each task before the shuffle, so a key with a third of
    all events sends at most one row per task.
    """
    rows = log if entity is None else log.filter(F.col("entity") == entity)
    keys = ["entity_key"] if entity else ["entity", "entity_key"]
    newest = Window.partitionBy(*keys).orderBy(F.desc("ordering_key"), F.desc("event_uid"))
    return (
        rows.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .select(
            *([] if entity else ["entity"]),
            "entity_key", "op", "after", "before", "event_uid", "ordering_key", "ts_ms",
        )
    )


def _payload_column(source: Column, field: T.StructField, spec: EntitySpec) -> Column:
    if isinstance(field.dataType, T.DecimalType):
        kind = field.dataType
        return decode_decimal(source.getField(field.name), kind.precision, kind.scale, dict(spec.encodings).get(field.name, "number"))
    return source.getField(field.name)


def typed_changes(latest: DataFrame, spec: EntitySpec, applied_at: Column) -> DataFrame:
    """Typed rows of the stored schema: upserts from ``after``, tombstones from ``before``."""
    # decimals are read as text first: the connector may send base64 bytes
    loose = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DecimalType) else f.dataType)
            for f in spec.payload.fields
        ]
    )
    deleted = F.col("op") == "d"
    image = F.when(deleted, F.col("before")).otherwise(F.col("after"))
    opened = latest.filter(F.col("op").isin("c", "u", "r", "d")).withColumn("_row", F.from_json(image, loose))
    key_text = F.split("entity_key", r"\|")
    columns = []
    for f in spec.payload.fields:
        value = _payload_column(F.col("_row"), f, spec)
        if f.name in spec.key:
            # the key may have come from the message key only
            value = F.coalesce(value, key_text[spec.key.index(f.name)].try_cast(f.dataType))
        else:
            value = F.when(~deleted, value)
        columns.append(value.cast(f.dataType).alias(f.name))
    return opened.select(
        *columns,
        F.col("event_uid").alias("_bronze_event_uid"),
        F.col("ordering_key").alias("_bronze_ordering_key"),
        F.col("ts_ms").alias("_bronze_ts_ms"),
        applied_at.cast("timestamp").alias("_silver_updated_at"),
        deleted.alias("_deleted"),
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    newer: Column | None = None,
) -> DataFrame:
    """Full-outer keyed merge of two relations with unique keys.

    Where both sides hold a key, the source row wins if ``newer`` (over aliases ``t`` and ``s``) is
    true; by default it always wins. Columns that only the source has are added to the result.
    Joins on the bare keys, so a target bucketed by them is not shuffled.
    """
    names = list(dict.fromkeys([*target.columns, *source.columns]))
    types = {f.name: f.dataType for f in [*source.schema.fields, *target.schema.fields]}
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in key], "full_outer")
    take_source = F.col("t._in_t").isNull()
    both = F.col("s._in_s").isNotNull() & F.col("t._in_t").isNotNull()
    take_source = take_source | (both & (F.coalesce(newer, F.lit(False)) if newer is not None else F.lit(True)))

    def side(frame: DataFrame, alias: str, name: str) -> Column:
        return F.col(f"{alias}.{name}") if name in frame.columns else F.lit(None).cast(types[name])

    return joined.select(
        *[
            F.when(take_source, side(source, "s", n)).otherwise(side(target, "t", n)).alias(n)
            for n in names
        ]
    )


def merge_changes(target: DataFrame, changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """Apply typed changes: update only when the ordering key is higher, insert when absent.

    Deletes stay as tombstones with their ordering key, so a late event can neither revive a deleted
    row nor remove a newer one, in any order of batches.
    """
    newer = F.col("s._bronze_ordering_key") > F.col("t._bronze_ordering_key")
    return merge_rows(target, changes, spec.key, newer)


def last_changes(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """One typed change per key: the one with the highest ordering key."""
    newest = Window.partitionBy(*spec.key).orderBy(
        F.desc("_bronze_ordering_key"), F.desc("_bronze_event_uid")
    )
    return changes.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def live_rows(stored: DataFrame) -> DataFrame:
    """Rows as readers see them: no tombstones."""
    return stored.filter(~F.coalesce(F.col("_deleted"), F.lit(False))).drop("_deleted")


def delete_by_keys(target: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return target.join(keys.select(*key), list(key), "left_anti")


def fold_log(log: DataFrame, spec: EntitySpec, applied_at: Column) -> DataFrame:
    """Entity table from a whole log in one pass: no target, so no join."""
    return typed_changes(latest_events(log, spec.entity), spec, applied_at)


def mixed_ordering_prefixes(log: DataFrame) -> DataFrame:
    """Keys whose events carry both log positions and timestamps; their order is not reliable."""
    prefix = F.substring_index("ordering_key", "_", 1)
    return (
        log.groupBy("entity", "entity_key")
        .agg(F.count_if(prefix == "lsn").alias("with_lsn"), F.count_if(prefix == "ts").alias("with_ts"))
        .filter((F.col("with_lsn") > 0) & (F.col("with_ts") > 0))
    )
