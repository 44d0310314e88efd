"""Contract conformance of tables, payload profiling, freshness, continuity and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import Contract, constraint_column
from tidemark.functions.keys import mask_email
from tidemark.operators.ordered import adjacent_violations, numbered
from tidemark.operators.suite import GroupCheck, RowCheck, run_checks

__all__ = [
    "contract_checks",
    "conformance",
    "declared_field_rules",
    "mask_pii",
    "freshness",
    "event_rate",
    "payload_profile",
    "observed_fields",
    "profile_against_contract",
    "offset_ranges",
    "offset_gaps",
    "layer_reconciliation",
    "kpi_checksum",
    "compare_runs",
]


def declared_field_rules(contract: Contract, columns: Sequence[str]) -> list[tuple[str, Column]]:
    """``(name, bad)`` per declared rule of the fields that the table has."""
    rules = []
    for name, rule in contract.fields.items():
        if name not in columns:
            continue
        value = F.col(name)
        if not rule.nullable or name in contract.required_fields:
            rules.append((f"{name}: not null", value.isNull()))
        if rule.allowed_values:
            rules.append((f"{name}: allowed values", ~value.isin(*rule.allowed_values)))
        for text in rule.constraints:
            rules.append((f"{name} {text}", ~constraint_column(value, text)))
    return rules


def contract_checks(df: DataFrame, contract: Contract) -> list:
    """All declared rules of a contract as checks: one fused scan plus one key check."""
    missing = [
        n for n in dict.fromkeys([*contract.primary_key, *contract.required_fields]) if n not in df.columns
    ]
    checks: list = [RowCheck(f"{contract.entity}.{n}", bad) for n, bad in declared_field_rules(contract, df.columns)]
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for name, rule in contract.fields.items():
        if name in actual and not _type_matches(actual[name], rule.spark_type):
            checks.append(RowCheck(f"{contract.entity}.{name}: type {rule.type}", F.lit(True)))
    for name in missing:
        checks.append(RowCheck(f"{contract.entity}.{name}: missing", F.lit(True)))
    if contract.primary_key and not set(contract.primary_key) & set(missing):
        checks.append(
            GroupCheck(f"{contract.entity}: unique key", contract.primary_key, F.count(F.lit(1)), lambda n: n <= 1)
        )
    return checks


def _type_matches(actual: str, declared: str) -> bool:
    # sums of a decimal(p,s) are wider decimals of the same scale
    if actual.startswith("decimal") and declared.startswith("decimal"):
        return actual.split(",")[1] == declared.split(",")[1]
    return actual == declared or (actual, declared) == ("timestamp_ntz", "timestamp")


def conformance(df: DataFrame, contract: Contract) -> DataFrame:
    return run_checks(df, contract_checks(df, contract))


def mask_pii(df: DataFrame, contract: Contract) -> DataFrame:
    """Partially mask every column that the contract marks as personal data."""
    return df.withColumns(
        {n: mask_email(n) for n, rule in contract.fields.items() if rule.pii and n in df.columns}
    )


def freshness(df: DataFrame, column: str, as_of, limit_seconds: int) -> DataFrame:
    """Newest moment, its age and whether it is within the limit; no rows are stale."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = F.unix_timestamp(moment.cast("timestamp")) - F.unix_timestamp("newest")
    return (
        df.agg(F.max(F.col(column).cast("timestamp")).alias("newest"))
        .withColumn("age_seconds", age)
        .withColumn("is_fresh", F.coalesce(F.col("age_seconds") <= limit_seconds, F.lit(False)))
    )


def event_rate(df: DataFrame, column: str, window: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Events per tumbling window; works on a batch, and on a stream that has a watermark."""
    return (
        df.groupBy(F.window(F.col(column), window).alias("_w"), *group_by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *group_by, "events")
    )


def payload_profile(df: DataFrame, payload: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Fields seen in JSON payloads of a whole table, with how often they are null or castable."""
    entries = F.from_json(F.col(payload), "map<string,string>")
    return (
        df.select(*group_by, F.explode(entries).alias("field", "_text"))
        .groupBy(*group_by, "field")
        .agg(
            F.count(F.lit(1)).alias("seen"),
            F.count_if(F.col("_text").isNull()).alias("nulls"),
            F.count(F.col("_text").try_cast("bigint")).alias("as_bigint"),
            F.count(F.col("_text").try_cast("double")).alias("as_double"),
            F.count(F.col("_text").try_cast("timestamp")).alias("as_timestamp"),
        )
    )


def payload_shape(df: DataFrame, payload: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Fields of JSON payloads with their merged type, nested objects and arrays included.

    ``inferred`` is the one type that fits all values of a field: numbers widen, objects merge field by field, arrays by their elements, and what fits
    nothing else is a VARIANT. Types are merged map-side. Payloads that are no JSON objects have no fields.
    """
    opened = df.select(*group_by, F.try_parse_json(F.col(payload)).alias("_payload")).filter(F.col("_payload").isNotNull())
    fields = opened.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_payload").outer())).filter(F.col("key").isNotNull())
    return fields.groupBy(*group_by, F.col("key").alias("field")).agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if(F.is_variant_null("value")).alias("nulls"),
        F.schema_of_variant_agg("value").alias("inferred"),
    )


def observed_fields(profile: DataFrame) -> DataFrame:
    """Field list ``(field, position)`` of a profile, in name order, for the field rules."""
    return numbered(profile.select("field").distinct(), ["field"], "position")


def profile_against_contract(profile: DataFrame, contract: Contract) -> DataFrame:
    """Fields whose payloads do not fit the contract: dropped, undeclared, wrong type, forbidden null."""
    declared = profile.sparkSession.range(1).select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("field"),
                        F.lit(r.spark_type).alias("declared_type"),
                        F.lit(r.nullable).alias("nullable"),
                    )
                    for n, r in contract.fields.items()
                ]
            )
        ).alias("_d")
    ).select("_d.*")
    present = F.col("seen") - F.col("nulls")
    kind = F.col("declared_type")
    fits = (
        F.when(kind.isin("bigint", "int"), F.col("as_bigint"))
        .when(kind.isin("double") | kind.startswith("decimal"), F.col("as_double"))
        .when(kind.isin("timestamp", "date"), F.col("as_timestamp"))
        .otherwise(present)
    )
    issue = (
        F.when(F.col("seen").isNull(), "dropped")
        .when(kind.isNull(), "undeclared")
        .when(fits < present, "type_changed")
        .when(~F.col("nullable") & (F.col("nulls") > 0), "null_not_allowed")
    )
    return (
        profile.join(declared, "field", "full_outer")
        .withColumn("issue", issue)
        .filter(F.col("issue").isNotNull())
        .select("field", "declared_type", "seen", "nulls", "issue")
    )


def offset_ranges(log: DataFrame) -> DataFrame:
    """Offsets per topic and partition, with the number missing inside the range."""
    return (
        log.groupBy("kafka_topic", "kafka_partition")
        .agg(
            F.min("kafka_offset").alias("min_offset"),
            F.max("kafka_offset").alias("max_offset"),
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("kafka_offset").alias("distinct_offsets"),
        )
        .withColumn(
            "missing_offsets",
            F.col("max_offset") - F.col("min_offset") + 1 - F.col("distinct_offsets"),
        )
    )


def offset_gaps(log: DataFrame) -> DataFrame:
    """Each gap between neighbouring offsets. Replayed offsets are no gap."""
    return adjacent_violations(
        log.select("kafka_topic", "kafka_partition", "kafka_offset"),
        order_by=["kafka_offset"],
        carry=["kafka_offset"],
        broken=lambda here, there, alone: here("kafka_offset") > there("kafka_offset") + 1,
        group_by=["kafka_topic", "kafka_partition"],
        prefix="previous_",
    ).select(
        "kafka_topic",
        "kafka_partition",
        (F.col("previous_kafka_offset") + 1).alias("gap_start"),
        (F.col("kafka_offset") - 1).alias("gap_end"),
        (F.col("kafka_offset") - F.col("previous_kafka_offset") - 1).alias("missing"),
    )


def layer_reconciliation(log: DataFrame, entities: Mapping[str, DataFrame]) -> DataFrame:
    """Per entity: log events, keys still alive by the log, rows in the entity table, match flag."""
    # one pass: a key's events are reduced map-side to their number and the last operation
    newest = F.max_by("op", F.struct("ordering_key", "event_uid"))
    keys = log.groupBy("entity", "entity_key").agg(F.count(F.lit(1)).alias("events"), newest.alias("op"))
    logged = keys.groupBy("entity").agg(
        F.sum("events").alias("bronze_events"), F.count_if(F.col("op") != "d").alias("expected_rows")
    )
    stored = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("silver_rows")).withColumn("entity", F.lit(name))
            for name, df in entities.items()
        ],
    )
    return (
        logged.join(stored, "entity", "full_outer")
        .select(
            "entity",
            F.coalesce("bronze_events", F.lit(0)).alias("bronze_events"),
            F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
            F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"),
        )
        .withColumn("counts_match", F.col("expected_rows") == F.col("silver_rows"))
    )


def kpi_checksum(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.coalesce(F.sum("total_gmv"), F.lit(0)).cast("decimal(28,2)").alias("total_gmv"),
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce(F.sum("active_users"), F.lit(0)).cast("bigint").alias("active_users"),
    )


def compare_runs(runs: Sequence[DataFrame], tolerance: float = 0.01) -> DataFrame:
    """Metrics by run, side by side, with a match flag. Each run is a one-row relation."""
    measures = runs[0].columns
    tagged = reduce(
        DataFrame.unionByName,
        [
            run.select(*[F.col(c).cast("double").alias(c) for c in measures]).withColumn("_run", F.lit(i))
            for i, run in enumerate(runs, 1)
        ],
    )
    long = tagged.unpivot(["_run"], measures, "metric", "value")
    names = [f"run_{i}" for i in range(1, len(runs) + 1)]
    wide = long.groupBy("metric").agg(
        *[F.max(F.when(F.col("_run") == i, F.col("value"))).alias(n) for i, n in enumerate(names, 1)],
        F.coalesce(F.max("value") - F.min("value") <= tolerance, F.lit(True)).alias("_close"),
        (F.count("value").isin(0, len(runs))).alias("_complete"),
    )
    return wide.select("metric", *names, (F.col("_close") & F.col("_complete")).alias("match"))
