"""Change envelopes to log rows: parsing, keys, ordering and contract validation.

Everything is one chain of native expressions over the message columns; no Python runs in tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import CDC_CONTRACTS, TOPIC_ENTITIES, Contract, constraint_column
from tidemark.sources.bus import decode_text, topic_entity

__all__ = [
    "LOG_SCHEMA",
    "event_uid",
    "ordering_key",
    "entity_key",
    "open_envelope",
    "with_violations",
    "to_log",
    "accepted",
    "rejected",
    "fail_fast",
]

LOG_SCHEMA = T.StructType(
    [
        T.StructField("event_uid", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("entity_key", T.StringType()),
        T.StructField("ordering_key", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("ingest_time", T.TimestampType()),
    ]
)

_ENVELOPE = "op string, ts_ms bigint, source string, before string, after string"


def event_uid(topic: Column, partition: Column, offset: Column) -> Column:
    return F.concat_ws("|", topic, partition.cast("string"), offset.cast("string"))


def _padded(number: Column, width: int) -> Column:
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _log_position(source: Column) -> Column:
    return F.get_json_object(source, "$.lsn").try_cast("bigint")


def _sorted_text(lsn: Column, updated: Column, after: Column, partition: Column, offset: Column) -> Column:
    # only a JSON number is padded; the type is looked up only where there is no log position and the text does not begin as a date
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(after), "$.updated_at", "variant"))
    is_number = ~updated.rlike("^[0-9]{4}-") & kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    whole = F.coalesce(updated.try_cast("bigint"), updated.try_cast("double").try_cast("bigint"))
    moment = F.when(updated.isNull(), F.lit("ts_0")).otherwise(
        F.when(is_number, F.format_string("ts_%020d", whole)).otherwise(
            F.concat(F.lit("ts_"), F.substring(updated, 1, 26))
        )
    )
    head = F.when(lsn.isNotNull(), F.concat(F.lit("lsn_"), _padded(lsn, 20))).otherwise(moment)
    return F.concat(
        head, F.lit("|p"), _padded(partition, 6), F.lit("|o"), _padded(offset, 20)
    )


def ordering_key(source: Column, after: Column, partition: Column, offset: Column) -> Column:
    """Text that sorts by log position, else by ``updated_at``, then by partition and offset."""
    return _sorted_text(_log_position(source), F.get_json_object(after, "$.updated_at"), after, partition, offset)


def entity_key(op: Column, before: Column, after: Column, key: Column, fields: tuple[str, ...]) -> Column:
    """Key values joined by ``|``, from the row image or else the message key; NULL if one is missing."""
    image = F.when(op == "d", before).otherwise(after)
    parts = [
        F.coalesce(F.get_json_object(image, f"$.{f}"), F.get_json_object(key, f"$.{f}")) for f in fields
    ]
    # concat is NULL if a part is; to ask first would parse the image twice
    return F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit("|"), p)])


def _per_entity(entity: Column, contracts: Mapping[str, Contract], build) -> Column:
    """``build(contract)`` chosen by the row's entity."""
    chosen = None
    for name, contract in contracts.items():
        test, value = entity == name, build(contract)
        chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
    return chosen


def open_envelope(
    messages: DataFrame,
    contracts: Mapping[str, Contract] = CDC_CONTRACTS,
    routes: Mapping[str, str] = TOPIC_ENTITIES,
) -> DataFrame:
    """Decode and parse each message once; adds the log columns and the top-level field names."""
    text = messages.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        decode_text(F.col("key")).alias("_key"),
        decode_text(F.col("value")).alias("_value"),
        topic_entity(F.col("topic"), routes).alias("entity"),
    )
    parsed = text.withColumns(
        {
            "_env": F.from_json("_value", _ENVELOPE),
            # NULL exactly where the text is no JSON object
            "_present": F.json_object_keys("_value"),
        }
    )
    op, before, after = F.col("_env.op"), F.col("_env.before"), F.col("_env.after")
    source, key = F.col("_env.source"), F.col("_key")
    # columns of their own: Spark would parse again for each use inside a condition
    placed = parsed.withColumn("_lsn", _log_position(source))
    placed = placed.withColumn("_updated", F.when(F.col("_lsn").isNull(), F.get_json_object(after, "$.updated_at")))
    return placed.select(
        event_uid(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_uid"),
        "entity",
        _per_entity(
            F.col("entity"), contracts, lambda c: entity_key(op, before, after, key, c.primary_key)
        ).alias("entity_key"),
        _sorted_text(F.col("_lsn"), F.col("_updated"), after, F.col("partition"), F.col("offset")).alias("ordering_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_timestamp"),
        op.alias("op"),
        F.col("_env.ts_ms").alias("ts_ms"),
        source.alias("source"),
        before.alias("before"),
        after.alias("after"),
        "_value",
        "_present",
    )


def _envelope_rules(contract: Contract) -> list[Column]:
    op, after, present = F.col("op"), F.col("after"), F.col("_present")
    rules = [
        F.when(~F.array_contains(present, f), F.lit(f"missing envelope field {f}"))
        for f in contract.required_envelope_fields
    ]
    rules.append(
        F.when(
            ~F.coalesce(op.isin(*contract.allowed_ops), F.lit(False)),
            F.concat(F.lit("invalid op "), F.coalesce(op, F.lit("null"))),
        )
    )
    if contract.after_required_ops:
        rules.append(
            F.when(
                op.isin(*contract.after_required_ops) & after.isNull(),
                F.concat(F.lit("after is required for op "), op),
            )
        )
    if contract.delete_after_must_be_null:
        rules.append(F.when((op == "d") & after.isNotNull(), F.lit("after must be null for op d")))
    if contract.delete_before_should_exist:
        rules.append(
            F.when((op == "d") & ~F.array_contains(present, "before"), F.lit("before is required for op d"))
        )
    if contract.primary_key:
        rules.append(F.when(F.col("entity_key").isNull(), F.lit("primary key not found")))
    return rules


def _field_rules(contract: Contract) -> list[Column]:
    """Rules on the fields of ``after``; a field that is absent is not tested."""
    after = F.col("after")
    keys = F.json_object_keys(after)
    rules = []
    for name, rule in contract.fields.items():
        text = F.get_json_object(after, f"$.{name}")
        there = F.array_contains(keys, name)
        if not rule.nullable:
            rules.append(F.when(there & text.isNull(), F.lit(f"field {name} must not be null")))
        if rule.allowed_values:
            inside = F.coalesce(text.isin(*[str(v) for v in rule.allowed_values]), F.lit(False))
            rules.append(
                F.when(
                    there & ~inside,
                    F.concat(F.lit(f"field {name} has value not allowed: "), F.coalesce(text, F.lit("null"))),
                )
            )
        for constraint in rule.constraints:

            def typed(other: str) -> Column:
                return F.get_json_object(after, f"$.{other}").try_cast("decimal(38,9)")

            ok = constraint_column(text.try_cast("decimal(38,9)"), constraint, typed)
            rules.append(F.when(~ok, F.lit(f"field {name} breaks {constraint}")))
    return rules


def with_violations(
    opened: DataFrame,
    contracts: Mapping[str, Contract] = CDC_CONTRACTS,
    field_rules: bool = False,
) -> DataFrame:
    """Add ``violations``: all broken rules of the row's contract, empty when it is valid."""

    def build(contract: Contract) -> Column:
        rules = _envelope_rules(contract) + (_field_rules(contract) if field_rules else [])
        return F.array_compact(F.array(*rules))

    one = lambda message: F.array(F.lit(message))
    violations = (
        F.when(F.coalesce(F.length("_value"), F.lit(0)) == 0, one("empty message value"))
        .when(F.col("_present").isNull(), one("value is not a JSON object"))
        .when(F.col("entity").isNull(), F.array(F.concat(F.lit("unknown topic "), F.col("kafka_topic"))))
        .otherwise(
            F.coalesce(
                _per_entity(F.col("entity"), contracts, build),
                F.array(F.concat(F.lit("no contract for entity "), F.col("entity"))),
            )
        )
    )
    return opened.withColumn("violations", violations)


def _emit(validated: DataFrame, columns: list[Column], keep: Column, otherwise: Column | None = None) -> DataFrame:
    """Rows where ``keep`` holds, shaped as ``columns``.

    Written as a generator of no or one row instead of a filter: a filter on the violations would be
    pushed below the parsing steps and parse every message again.
    """
    row = F.when(keep, F.array(F.struct(*columns)))
    return validated.select(F.inline(row if otherwise is None else row.otherwise(otherwise)))


def _log_columns(ingest_time: Column | None) -> list[Column]:
    moment = (ingest_time if ingest_time is not None else F.current_timestamp()).cast("timestamp")
    return [moment.alias(c) if c == "ingest_time" else F.col(c) for c in LOG_SCHEMA.names]


def accepted(validated: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Valid rows in log shape."""
    return _emit(validated, _log_columns(ingest_time), F.size("violations") == 0)


def rejected(validated: DataFrame) -> DataFrame:
    """Invalid rows with their messages and the raw text."""
    names = ["event_uid", "entity", "kafka_topic", "kafka_partition", "kafka_offset", "violations"]
    columns = [*[F.col(n) for n in names], F.col("_value").alias("raw_value")]
    return _emit(validated, columns, F.size("violations") > 0)


def fail_fast(validated: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Rows in log shape; the first invalid one stops the query with its id and broken rules."""
    reasons = F.array_join("violations", "; ")
    stop = F.raise_error(F.concat(F.lit("contract violation in "), F.col("event_uid"), F.lit(": "), reasons))
    return _emit(validated, _log_columns(ingest_time), F.size("violations") == 0, stop)


def to_log(
    messages: DataFrame,
    contracts: Mapping[str, Contract] = CDC_CONTRACTS,
    routes: Mapping[str, str] = TOPIC_ENTITIES,
    ingest_time: Column | None = None,
    on_violation: str = "fail",
) -> DataFrame:
    """Messages to log rows. ``on_violation``: ``fail`` stops the query, ``drop`` keeps valid rows."""
    validated = with_violations(open_envelope(messages, contracts, routes), contracts)
    if on_violation == "fail":
        return fail_fast(validated, ingest_time)
    if on_violation == "drop":
        return accepted(validated, ingest_time)
    raise ValueError(f"on_violation must be 'fail' or 'drop', got {on_violation!r}")
