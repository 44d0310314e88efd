"""The change log, latest events, merges and write-back."""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import CDC_CONTRACTS
from tidemark.operators import envelope as E
from tidemark.operators import merge as G
from tidemark.plans import inputs as I
from tidemark.plans import metrics as K
from tidemark.session import scratch_path
from tidemark.sources import tables as S
from tidemark.sources import writeback as W
from tidemark.sources.bus import decode_text, topic_entity
from tidemark.streaming.entities import replay
from tidemark.workload.registry import Registry
from tidemark.workload.sql import FACTS, LOG, SEGMENTS, with_

QUERIES = Registry()
add = QUERIES.add

LOG_COLUMNS = [
    "event_uid", "entity", "entity_key", "ordering_key", "kafka_topic", "kafka_partition", "kafka_offset",
    "kafka_timestamp", "op", "ts_ms",
]
MIDDLE = "2024-01-16 00:00:00"


def _applied_at():
    return F.lit(I.EVENTS_AS_OF)


def change_log(s, d, entity=None):
    messages = I.change_messages(s, d)
    if entity:
        messages = messages.filter(F.col("topic") == f"dbserver_docker.public.{entity}")
    return E.to_log(messages, ingest_time=_applied_at())


def merged(s, d, entity, spec=None):
    """Entity table built by merging the log in two batches."""
    spec = spec or G.ENTITY_SPECS[entity]
    log = change_log(s, d, entity)
    split = F.unix_millis(F.lit(MIDDLE).cast("timestamp"))
    early = log.filter(F.col("kafka_timestamp") < split)
    late = log.filter(F.col("kafka_timestamp") >= split)
    first = G.merge_changes(S.empty_entity(s, spec), G.fold_log(early, spec, _applied_at()), spec)
    return G.merge_changes(first, G.fold_log(late, spec, _applied_at()), spec)


add(
    "decode_messages",
    lambda s, d: I.change_messages(s, d).select(
        "topic", "partition", "offset",
        F.get_json_object(decode_text(F.col("key")), "$.user_id").alias("key_user"),
        F.get_json_object(decode_text(F.col("value")), "$.op").alias("op"),
    ),
    with_(
        LOG,
        "SELECT kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS offset, "
        "CASE WHEN entity = 'users' THEN entity_key END AS key_user, op FROM bronze",
    ),
)
add(
    "route_topics",
    lambda s, d: I.change_messages(s, d).groupBy(topic_entity(F.col("topic")).alias("entity")).agg(F.count(F.lit(1)).alias("n")),
    with_(LOG, "SELECT entity, CAST(COUNT(*) AS BIGINT) AS n FROM bronze GROUP BY 1"),
)
add(
    "parse_envelopes",
    lambda s, d: change_log(s, d).select(*LOG_COLUMNS, "ingest_time"),
    with_(LOG, f"SELECT {', '.join(LOG_COLUMNS)}, TIMESTAMP '2024-01-31' AS ingest_time FROM bronze"),
)
add(
    "event_uids",
    lambda s, d: I.change_messages(s, d).select(E.event_uid(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_uid")),
    with_(LOG, "SELECT event_uid FROM bronze"),
)
add(
    "ordering_keys",
    lambda s, d: E.open_envelope(I.change_messages(s, d)).select("event_uid", "ordering_key"),
    with_(LOG, "SELECT event_uid, ordering_key FROM bronze"),
)
add(
    "entity_keys",
    lambda s, d: E.open_envelope(I.change_messages(s, d)).select("event_uid", "entity_key"),
    with_(LOG, "SELECT event_uid, entity_key FROM bronze"),
)

_DAMAGED_UID = "'dbserver_docker.public.users|' || (user_id % 4) || '|' || event_id AS event_uid"
_DEFECT = (
    "CASE event_type WHEN 'view' THEN 'missing envelope field source' WHEN 'click' THEN 'invalid op x' "
    "WHEN 'error' THEN 'after must be null for op d' WHEN 'purchase' THEN 'after is required for op c' END"
)


def _damaged(s, d, field_rules=False):
    return E.with_violations(E.open_envelope(I.damaged_messages(s, d)), field_rules=field_rules)


add(
    "contract_violations",
    lambda s, d: E.rejected(_damaged(s, d)).select("event_uid", F.array_join("violations", "; ").alias("violations")),
    f"SELECT {_DAMAGED_UID}, {_DEFECT} AS violations FROM events WHERE event_type <> 'signup'",
)
add(
    "contract_accepted",
    lambda s, d: E.accepted(_damaged(s, d), _applied_at()).select("event_uid", "entity", "op"),
    f"SELECT {_DAMAGED_UID}, 'users' AS entity, 'c' AS op FROM events WHERE event_type = 'signup'",
)
add(
    "field_rule_violations",
    lambda s, d: E.rejected(_damaged(s, d, True)).select("event_uid", F.array_join("violations", "; ").alias("violations")),
    f"SELECT {_DAMAGED_UID}, COALESCE({_DEFECT}, 'field status has value not allowed: unheard') AS violations FROM events",
)
add(
    "latest_events",
    lambda s, d: G.latest_events(change_log(s, d)).select("entity", "entity_key", "op", "event_uid", "ordering_key", "ts_ms"),
    with_(LOG, "SELECT entity, entity_key, op, event_uid, ordering_key, ts_ms FROM latest"),
)
for _entity in ("users", "orders", "payments"):
    add(
        f"merge_{_entity}",
        lambda s, d, e=_entity: G.live_rows(merged(s, d, e)),
        with_(LOG, f"SELECT * FROM silver_{_entity}"),
    )
add(
    "fold_log_tombstones",
    lambda s, d: G.fold_log(change_log(s, d, "orders"), G.ENTITY_SPECS["orders"], _applied_at())
    .filter("_deleted")
    .select("order_id", "total_amount", "_bronze_ordering_key"),
    with_(
        LOG,
        "SELECT CAST(entity_key AS BIGINT) AS order_id, CAST(NULL AS DECIMAL(18,2)) AS total_amount, "
        "ordering_key AS _bronze_ordering_key FROM latest WHERE entity = 'orders' AND op = 'd'",
    ),
)


def _replayed(s, d):
    spec = G.ENTITY_SPECS["orders"]
    changes = G.fold_log(change_log(s, d, "orders"), spec, _applied_at())
    return G.merge_changes(merged(s, d, "orders"), changes, spec)


add("replay_orders", lambda s, d: G.live_rows(_replayed(s, d)), with_(LOG, "SELECT * FROM silver_orders"))


def _replay_sums(s, d):
    """Checksums of the merged table beside those of the same table after the whole log was applied once more."""
    measures = ["total_amount", "_bronze_ts_ms"]
    before, after = (S.checksum(df, measures) for df in (merged(s, d, "orders"), _replayed(s, d)))
    return before.drop("content_hash").withColumn("all_equal", S.same_checksum(before, after).select("all_equal").scalar())


add(
    "replay_checksum",
    _replay_sums,
    with_(
        LOG,
        "SELECT CAST(COUNT(*) AS BIGINT) AS row_count, CAST(SUM(CASE WHEN op <> 'd' THEN amount END) AS DECIMAL(28,2)) AS sum_total_amount, "
        "CAST(SUM(ts_ms) AS BIGINT) AS sum__bronze_ts_ms, true AS all_equal FROM latest WHERE entity = 'orders'",
    ),
)


def _evolved(s, d):
    """A field that appears in the payload halfway and in the stored schema with it."""
    old = G.ENTITY_SPECS["users"]
    new = replace(old, payload=T.StructType([*old.payload.fields, T.StructField("channel", T.StringType())]))
    log = change_log(s, d, "users")
    events = I.table(s, d, "events").select(F.col("event_id").alias("kafka_offset"), "event_type")
    log = log.join(events, "kafka_offset")
    extra = F.concat(F.expr("substring(after, 1, length(after) - 1)"), F.lit(',"channel":"'), F.col("event_type"), F.lit('"}'))
    split = F.unix_millis(F.lit(MIDDLE).cast("timestamp"))
    early = log.filter(F.col("kafka_timestamp") < split)
    late = log.filter(F.col("kafka_timestamp") >= split).withColumn("after", extra)
    first = G.fold_log(early, old, _applied_at())
    return G.merge_changes(first, G.fold_log(late, new, _applied_at()), new)


add(
    "schema_evolution",
    lambda s, d: G.live_rows(_evolved(s, d)).select("user_id", "status", "channel"),
    with_(
        LOG,
        "SELECT CAST(entity_key AS BIGINT) AS user_id, CASE WHEN event_type = 'view' THEN 'blocked' ELSE 'active' END AS status, "
        f"CASE WHEN ts >= TIMESTAMP '{MIDDLE}' THEN event_type END AS channel FROM latest WHERE entity = 'users' AND op <> 'd'",
    ),
)
add(
    "delete_by_keys",
    lambda s, d: G.delete_by_keys(
        I.fct_orders(s, d).select("order_id", "user_id", "total_amount"),
        I.fct_payments(s, d).filter(F.col("is_failed") == 1),
        ["order_id"],
    ),
    with_(
        FACTS,
        "SELECT order_id, user_id, total_amount FROM fct_orders WHERE order_id NOT IN "
        "(SELECT order_id FROM fct_payments WHERE is_failed = 1)",
    ),
)
add(
    "mixed_ordering_prefixes",
    lambda s, d: G.mixed_ordering_prefixes(change_log(s, d).withColumn("entity", F.lit("any"))),
    with_(
        LOG,
        "SELECT 'any' AS entity, entity_key, CAST(COUNT(*) FILTER (ordering_key LIKE 'lsn%') AS BIGINT) AS with_lsn, "
        "CAST(COUNT(*) FILTER (ordering_key LIKE 'ts%') AS BIGINT) AS with_ts FROM bronze GROUP BY entity_key "
        "HAVING COUNT(*) FILTER (ordering_key LIKE 'lsn%') > 0 AND COUNT(*) FILTER (ordering_key LIKE 'ts%') > 0",
    ),
)


# write-back

def _batch(s, d):
    return W.segment_rows(I.segments(s, d), "run_1", F.lit(I.ORDERS_AS_OF))


def _target(s, d):
    """Yesterday's rows of all users, and today's high-value users from an earlier run."""
    rows = W.segment_rows(I.segments(s, d), "run_0", F.lit("2001-07-31"))
    yesterday = rows.withColumn("segment_date", F.date_sub("segment_date", 1))
    today = rows.filter(F.col("value_segment") == "high_value").withColumn("activity_segment", F.lit("old"))
    return yesterday.unionByName(today)


_ROWS = (
    "CAST(user_id AS VARCHAR) AS user_id, {day} AS segment_date, value_segment, {activity} AS activity_segment, "
    "CAST(last_90d_gmv AS DECIMAL(18,2)) AS last_90d_gmv, is_churn_risk, is_active, '{run}' AS source_run_id, "
    "TIMESTAMP '{at}' AS last_updated_at"
)
_NEW = _ROWS.format(day="segment_date", activity="activity_segment", run="run_1", at="2001-08-01")
_OLD = _ROWS.format(day="CAST(segment_date - INTERVAL 1 DAY AS DATE)", activity="activity_segment", run="run_0", at="2001-07-31")
add(
    "segments_upsert",
    lambda s, d: W.upsert_segments(_target(s, d), _batch(s, d)),
    with_(SEGMENTS, f"SELECT {_NEW} FROM segments UNION ALL SELECT {_OLD} FROM segments"),
)
add(
    "segments_upsert_counts",
    lambda s, d: W.upsert_counts(_target(s, d), _batch(s, d)),
    with_(
        SEGMENTS,
        "SELECT CAST(COUNT(*) FILTER (value_segment <> 'high_value') AS BIGINT) AS inserted_count, "
        "CAST(COUNT(*) FILTER (value_segment = 'high_value') AS BIGINT) AS updated_count, CAST(COUNT(*) AS BIGINT) AS total FROM segments",
    ),
)
add(
    "segments_rollback",
    lambda s, d: W.rollback_run(W.upsert_segments(_target(s, d), _batch(s, d)), "run_1"),
    with_(SEGMENTS, f"SELECT {_OLD} FROM segments"),
)
_BODY = "user_id string, segment_date string, value_segment string, activity_segment string, last_90d_gmv double, is_churn_risk int, is_active int, source_run_id string, published_at string"
add(
    "segment_messages",
    lambda s, d: W.segment_messages(I.segments(s, d), "run_1", F.lit(I.ORDERS_AS_OF).cast("timestamp"))
    .select("key", F.from_json("value", _BODY).alias("v"))
    .select("key", "v.*"),
    with_(
        SEGMENTS,
        "SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS user_id, CAST(segment_date AS VARCHAR) AS segment_date, "
        "value_segment, activity_segment, CAST(last_90d_gmv AS DOUBLE) AS last_90d_gmv, is_churn_risk, is_active, "
        "'run_1' AS source_run_id, '2001-08-01T00:00:00' AS published_at FROM segments",
    ),
)


# tables on storage

def _refreshed(s, d):
    path = scratch_path(s, "dim_users")
    S.refresh_table(I.dim_users(s, d), path, ["status"])
    return S.read_table(s, path)


def _copied(s, d):
    counts = S.copy_verified(I.table(s, d, "orders"), scratch_path(s, "copy"))
    return s.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])


def _in_small_files(s, d):
    """Events by type, in 16 files a type; clicks in one."""
    small = scratch_path(s, "small")
    part = F.when(F.col("event_type") == "click", 0).otherwise(F.col("event_id") % 16).cast("int")
    I.table(s, d, "events").repartitionById(16, part).write.partitionBy("event_type").parquet(small)
    return small


def _compacted(s, d):
    small, large = _in_small_files(s, d), scratch_path(s, "large")
    S.compact(s, small, large, ["event_type"], ["event_id"])
    return s.read.parquet(large)


def _compaction_counts(s, d):
    return S.compact(s, _in_small_files(s, d), scratch_path(s, "large"), ["event_type"], ["event_id"], small_bytes=64 << 20)


def _coded_orders(s, d):
    """Amounts as the connector writes them by its precise setting; every fifth one as base64 text that reads like a number."""
    log = change_log(s, d, "orders")
    digits = F.hex((F.get_json_object("after", "$.total_amount").cast("decimal(18,2)") * 100).cast("bigint"))
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    signed = F.when(F.substring(even, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F"), F.concat(F.lit("00"), even)).otherwise(even)
    coded = F.when(F.col("kafka_offset") % 5 == 0, "1234").otherwise(F.base64(F.unhex(signed)))
    text = F.concat(F.lit('"total_amount":"'), coded, F.lit('"'))
    log = log.withColumn("after", F.regexp_replace("after", F.lit('"total_amount":[0-9.]+'), text))
    spec = G.EntitySpec.from_contract(CDC_CONTRACTS["orders"].with_decimals("precise"))
    return G.merge_changes(S.empty_entity(s, spec), G.fold_log(log, spec, _applied_at()), spec)


ENTITIES = ("users", "orders", "payments")


def stores(s, buckets=8):
    """A store for each entity; whoever knows the location can open it again."""
    return {e: S.EntityStore(s, scratch_path(s, f"store_{e}"), G.ENTITY_SPECS[e], buckets=buckets).ensure() for e in ENTITIES}


def all_rows(of):
    """Rows of all entities, one under the other."""
    frames = [of[e].drop("_silver_updated_at").withColumn("entity", F.lit(e)) for e in ENTITIES]
    return frames[0].unionByName(frames[1], allowMissingColumns=True).unionByName(frames[2], allowMissingColumns=True)


ALL_ROWS = " UNION ALL BY NAME ".join(f"SELECT * EXCLUDE (_silver_updated_at), '{e}' AS entity FROM silver_{e}" for e in ENTITIES)


def _store_merged(s, d):
    spec = G.ENTITY_SPECS["orders"]
    store = stores(s)["orders"]
    log = change_log(s, d, "orders")
    split = F.unix_millis(F.lit(MIDDLE).cast("timestamp"))
    store.merge(G.fold_log(log.filter(F.col("kafka_timestamp") >= split), spec, _applied_at()))
    # older events arrive last and must not win
    store.merge(G.fold_log(log.filter(F.col("kafka_timestamp") < split), spec, _applied_at()))
    return store.read()


def _replayed_all(s, d):
    """All entities from the stored log: its later days first, then all days again, which changes nothing that is newer."""
    path = scratch_path(s, "log")
    log = change_log(s, d).withColumn("ingest_time", F.timestamp_millis("kafka_timestamp"))
    S.with_ingest_date(log).hint("rebalance", F.col("ingest_date")).write.partitionBy("ingest_date").parquet(path)
    kept, tables = s.read.parquet(path), stores(s)
    replay(kept, tables, start=MIDDLE)
    replay(kept, tables)
    return all_rows({e: store.read() for e, store in tables.items()})


add("table_scan", lambda s, d: S.read_table(s, f"{d}/nation.parquet").join(S.read_table(s, f"{d}/region.parquet"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name"),
    "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
add("full_refresh", _refreshed, with_(FACTS, "SELECT * FROM dim_users"))
add("copy_verified", _copied, "SELECT CAST(COUNT(*) AS BIGINT) AS source_rows, CAST(COUNT(*) AS BIGINT) AS target_rows FROM orders")
add("compacted_events", _compacted, "SELECT * FROM events")
add(
    "compaction_counts",
    _compaction_counts,
    "SELECT event_type, CAST(COUNT(DISTINCT event_id % 16) AS BIGINT) AS files_before, CAST(1 AS BIGINT) AS files_after "
    "FROM events WHERE event_type <> 'click' GROUP BY 1 HAVING COUNT(DISTINCT event_id % 16) > 1",
)
# 1234 is base64 of the bytes D7 6D F8
add(
    "merge_orders_coded_decimals",
    lambda s, d: G.live_rows(_coded_orders(s, d)),
    with_(
        LOG,
        "SELECT s.* REPLACE (CASE WHEN l.kafka_offset % 5 = 0 THEN CAST(-26588.24 AS DECIMAL(18,2)) ELSE s.total_amount END AS total_amount) "
        "FROM silver_orders s JOIN latest l ON l.event_uid = s._bronze_event_uid",
    ),
)
add("replay_all", _replayed_all, with_(LOG, ALL_ROWS))
add("bucketed_store_orders", _store_merged, with_(LOG, "SELECT * FROM silver_orders"))


def _log_table(s, d):
    """The log as a catalog table, partitioned by day; here each row is ingested at its event time."""
    name = "tidemark_" + scratch_path(s, "x").rsplit("-", 1)[1]
    s.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(s, 'log_db')}'")
    S.ensure_log_table(s, f"{name}.raw_changes")
    log = change_log(s, d).withColumn("ingest_time", F.timestamp_millis("kafka_timestamp"))
    S.append_log(log, f"{name}.raw_changes")
    return s.table(f"{name}.raw_changes").groupBy("ingest_date", "entity").agg(F.count(F.lit(1)).alias("n"))


add("log_table_partitions", _log_table, with_(LOG, "SELECT CAST(ts AS DATE) AS ingest_date, entity, CAST(count(*) AS BIGINT) AS n FROM bronze GROUP BY 1, 2"))


def _release_log(s, d):
    path = scratch_path(s, "releases")
    kpis = I.kpis(s, d)
    for number, moment in ((1, "2001-07-31 12:00:00"), (2, "2001-08-01 12:00:00")):
        entry = W.release_entry(
            kpis, release_id=f"r{number}", metric_version="v1", released_by="ops", released_at=F.lit(moment),
            tests_summary='{"failed": 0}', notes="scheduled",
        )
        W.append_release(entry, path)
    return s.read.parquet(path)


_RELEASES = (
    "releases AS (SELECT r.*, 'v1' AS metric_version, 'unknown' AS git_commit, 'unknown' AS git_branch, 'ops' AS released_by, "
    "true AS dbt_tests_passed, '{\"failed\": 0}' AS dbt_tests_summary, true AS completeness_check_passed, "
    "(SELECT CAST(MIN(o_orderdate) AS DATE) FROM orders) AS data_range_start, (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders) AS data_range_end, "
    "'scheduled' AS release_notes FROM (VALUES ('r1', TIMESTAMP '2001-07-31 12:00:00'), ('r2', TIMESTAMP '2001-08-01 12:00:00')) r(release_id, released_at))"
)
add("release_log", _release_log, with_(_RELEASES, "SELECT * FROM releases"))
add("metric_versions", lambda s, d: K.versions(_release_log(s, d)), with_(_RELEASES, "SELECT metric_version, MAX(released_at) AS latest_release FROM releases GROUP BY 1"))
add("recent_releases", lambda s, d: K.recent_releases(_release_log(s, d), 1), with_(_RELEASES, "SELECT * FROM releases ORDER BY released_at DESC LIMIT 1"))
