"""Contracts on tables, suites, gate, freshness, continuity and reconciliation."""

from pyspark.sql import functions as F

from tidemark.contracts import CDC_CONTRACTS, METRIC_CONTRACTS
from tidemark.operators import checks as Q
from tidemark.operators import diff as D
from tidemark.operators import governance as V
from tidemark.operators import merge as G
from tidemark.operators import suite as U
from tidemark.plans import inputs as I
from tidemark.plans import metrics as K
from tidemark.session import scratch_path, stored
from tidemark.sources import writeback as W
from tidemark.workload.entities import change_log
from tidemark.workload.registry import Registry
from tidemark.workload.sql import FACTS, KPIS, LOG, SEGMENTS, STAGED, with_

QUERIES = Registry()
add = QUERIES.add


def _summary_sql(rows) -> str:
    parts = [f"SELECT '{n}' AS check_name, CAST(({q}) AS BIGINT) AS failures" for n, q in rows]
    return "SELECT check_name, failures, CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status FROM (" + " UNION ALL ".join(parts) + ")"


def _count(table, rule) -> str:
    return f"SELECT count(*) FROM {table} WHERE {rule}"


_KPI_RULES = [
    ("kpis.kpi_date: not null", _count("kpis", "kpi_date IS NULL")),
    ("kpis.total_gmv: not null", _count("kpis", "total_gmv IS NULL")),
    ("kpis.total_gmv >= 0", _count("kpis", "total_gmv < 0")),
    ("kpis.order_count: not null", _count("kpis", "order_count IS NULL")),
    ("kpis.order_count >= 0", _count("kpis", "order_count < 0")),
    ("kpis.active_users >= 0", _count("kpis", "active_users < 0")),
    ("kpis.payment_count >= 0", _count("kpis", "payment_count < 0")),
    ("kpis.captured_amount >= 0", _count("kpis", "captured_amount < 0")),
    ("kpis.captured_amount <= total_gmv", _count("kpis", "captured_amount > total_gmv")),
    ("kpis.payment_success_rate >= 0", _count("kpis", "payment_success_rate < 0")),
    ("kpis.payment_success_rate <= 1", _count("kpis", "payment_success_rate > 1")),
    ("kpis.metric_version: not null", _count("kpis", "metric_version IS NULL")),
    ("kpis.metric_version: allowed values", _count("kpis", "metric_version NOT IN ('v1', 'v2')")),
    ("kpis: unique key", "SELECT count(*) FROM (SELECT 1 FROM kpis GROUP BY kpi_date, metric_version HAVING count(*) > 1)"),
]
add("kpi_contract_conformance", lambda s, d: V.conformance(I.kpis(s, d), METRIC_CONTRACTS["kpis"]), with_(KPIS, _summary_sql(_KPI_RULES)))
_SEGMENT_RULES = [
    ("user_segments.user_id: not null", _count("segments", "user_id IS NULL")),
    ("user_segments.segment_date: not null", _count("segments", "segment_date IS NULL")),
    ("user_segments.value_segment: not null", _count("segments", "value_segment IS NULL")),
    ("user_segments.value_segment: allowed values", _count("segments", "value_segment NOT IN ('high_value', 'medium_value', 'low_value')")),
    ("user_segments.activity_segment: not null", _count("segments", "activity_segment IS NULL")),
    ("user_segments.activity_segment: allowed values", _count("segments", "activity_segment NOT IN ('churn_risk', 'active', 'dormant')")),
    ("user_segments.last_90d_gmv >= 0", _count("segments", "last_90d_gmv < 0")),
    ("user_segments.is_churn_risk: allowed values", _count("segments", "is_churn_risk NOT IN (0, 1)")),
    ("user_segments.is_active: allowed values", _count("segments", "is_active NOT IN (0, 1)")),
    ("user_segments: unique key", "SELECT count(*) FROM (SELECT 1 FROM segments GROUP BY user_id, segment_date HAVING count(*) > 1)"),
]
add("segment_contract_conformance", lambda s, d: V.conformance(I.segments(s, d), METRIC_CONTRACTS["user_segments"]), with_(SEGMENTS, _summary_sql(_SEGMENT_RULES)))
add("declared_payment_rules",
    lambda s, d: V.conformance(I.payments(s, d).drop("updated_at"), CDC_CONTRACTS["payments"]),
    with_(STAGED, _summary_sql([
        ("payments.payment_id: not null", _count("stg_payments", "payment_id IS NULL")),
        ("payments.order_id: not null", _count("stg_payments", "order_id IS NULL")),
        ("payments.amount >= 0", _count("stg_payments", "amount < 0")),
        ("payments.status: allowed values", _count("stg_payments", "status NOT IN ('created', 'authorized', 'captured', 'failed', 'refunded', 'cancelled')")),
        ("payments: unique key", "SELECT count(*) FROM (SELECT 1 FROM stg_payments GROUP BY payment_id HAVING count(*) > 1)"),
    ])))


def _checks(s, d):
    payments = I.fct_payments(s, d)
    return payments, [
        U.RowCheck("amount in range", ~Q.bounds(F.col("amount"), 1000, 90000)),
        U.RowCheck("reason on failure", F.col("failure_reason").isNull(), F.col("is_failed") == 1),
        U.RowCheck("few refunds", F.col("status") == "refunded", severity=U.Severity(error_above=10**9, warn_above=10)),
        U.AggregateCheck("mean amount", F.avg("amount"), lambda c: Q.bounds(c, 10000, 40000)),
        U.AggregateCheck("orders paid", F.countDistinct("order_id"), lambda c: c > 0),
        U.GroupCheck("payment id unique", ("payment_id",), F.count(F.lit(1)), lambda c: c <= 1),
        U.GroupCheck("one order per payment", ("payment_id",), F.countDistinct("order_id"), lambda c: c <= 1),
        U.FrameCheck("payments have orders", K.orphan_payments(payments, I.fct_orders(s, d)), F.sum("n_records")),
    ]


_SUITE_SQL = (
    "suite AS (SELECT 'amount in range' AS check_name, CAST(count(*) AS BIGINT) AS failures FROM fct_payments WHERE amount NOT BETWEEN 1000 AND 90000 UNION ALL "
    "SELECT 'reason on failure', count(*) FROM fct_payments WHERE is_failed = 1 AND failure_reason IS NULL UNION ALL "
    "SELECT 'few refunds', count(*) FROM fct_payments WHERE status = 'refunded' UNION ALL "
    "SELECT 'mean amount', CASE WHEN avg(amount) BETWEEN 10000 AND 40000 THEN 0 ELSE 1 END FROM fct_payments UNION ALL "
    "SELECT 'orders paid', CASE WHEN count(DISTINCT order_id) > 0 THEN 0 ELSE 1 END FROM fct_payments UNION ALL "
    "SELECT 'payment id unique', count(*) FROM (SELECT 1 FROM fct_payments GROUP BY payment_id HAVING count(*) > 1) UNION ALL "
    "SELECT 'one order per payment', count(*) FROM (SELECT 1 FROM fct_payments GROUP BY payment_id HAVING count(DISTINCT order_id) > 1) UNION ALL "
    "SELECT 'payments have orders', count(*) FROM fct_payments WHERE order_id NOT IN (SELECT order_id FROM fct_orders)), "
    "judged AS (SELECT check_name, failures, CASE WHEN check_name = 'few refunds' AND failures > 10 THEN 'warn' WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status FROM suite)"
)
add("check_suite", lambda s, d: U.run_checks(*_checks(s, d)), with_(FACTS + ", " + _SUITE_SQL, "SELECT * FROM judged"))
add("check_severity", lambda s, d: U.with_severity(U.run_checks(*_checks(s, d)), error_above=15000, warn_above=0),
    with_(FACTS + ", " + _SUITE_SQL, "SELECT check_name, failures, CASE WHEN failures > 15000 THEN 'failed' WHEN failures > 0 THEN 'warn' ELSE 'passed' END AS status FROM judged"))
add("gate_decision", lambda s, d: U.gate_decision(U.run_checks(*_checks(s, d))),
    with_(FACTS + ", " + _SUITE_SQL,
          "SELECT CASE WHEN bool_and(status IN ('passed', 'warn')) THEN 'allow' ELSE 'block' END AS decision, CAST(count(*) AS BIGINT) AS checks, "
          "CAST(count(*) FILTER (status NOT IN ('passed', 'warn')) AS BIGINT) AS failed_checks, "
          "COALESCE(string_agg(check_name, ', ' ORDER BY check_name) FILTER (status NOT IN ('passed', 'warn')), '') AS failed_names FROM judged"))


def _stored(s, d):
    path = scratch_path(s, "failures")
    W.store_failures(Q.unique(I.payments(s, d), "payment_id"), "payment id unique", "run_1", path)
    W.store_failures(K.captured_above_gmv(I.kpis(s, d)), "captured above gmv", "run_1", path)
    return s.read.parquet(path).groupBy("check_name", "run_id").agg(F.count("violation").alias("n"))


add("store_failures", _stored,
    with_(KPIS, "SELECT 'payment id unique' AS check_name, 'run_1' AS run_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT 1 FROM fct_payments GROUP BY payment_id HAVING count(*) > 1) UNION ALL "
                "SELECT 'captured above gmv', 'run_1', count(*) FROM kpis WHERE captured_amount > total_gmv AND total_gmv > 0 HAVING count(*) > 0"))
add("freshness", lambda s, d: V.freshness(I.table(s, d, "events"), "ts", I.EVENTS_AS_OF, 120),
    "SELECT max(CAST(ts AS TIMESTAMP)) AS newest, CAST(1706659200 - epoch_us(max(CAST(ts AS TIMESTAMP))) // 1000000 AS BIGINT) AS age_seconds, "
    "1706659200 - epoch_us(max(CAST(ts AS TIMESTAMP))) // 1000000 <= 120 AS is_fresh FROM events")
add("event_rate", lambda s, d: V.event_rate(I.table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", ["event_type"]),
    "SELECT CAST(date_trunc('day', CAST(ts AS TIMESTAMP)) AS TIMESTAMP) AS window_start, CAST(date_trunc('day', CAST(ts AS TIMESTAMP)) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, event_type, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY 1, 2, 3")
add("payload_profile", lambda s, d: V.payload_profile(I.table(s, d, "events"), "props", ["event_type"]),
    "SELECT event_type, field, CAST(count(*) AS BIGINT) AS seen, CAST(count(*) FILTER (v IS NULL) AS BIGINT) AS nulls, CAST(count(TRY_CAST(v AS BIGINT)) AS BIGINT) AS as_bigint, "
    "CAST(count(TRY_CAST(v AS DOUBLE)) AS BIGINT) AS as_double, CAST(count(TRY_CAST(v AS TIMESTAMP)) AS BIGINT) AS as_timestamp "
    "FROM (SELECT event_type, field, json_extract_string(props, '$.' || field) AS v FROM (SELECT event_type, props, unnest(json_keys(props)) AS field FROM events)) GROUP BY 1, 2")


def _nested(s, d):
    """Payloads with planted fields: an object, an array of objects, a field of two types, and some that are no JSON."""
    number = F.col("event_id") % 4
    extra = (
        F.when(number == 0, F.concat(F.lit(', "cart": {"sum": '), F.col("value"), F.lit(', "paid": true}')))
        .when(number == 1, F.concat(F.lit(', "items": [{"sku": "a'), F.col("event_id"), F.lit('"}, {"n": 2}]')))
        .when(number == 2, F.concat(F.lit(', "note": '), F.when(F.col("event_id") % 8 == 2, '"x"').otherwise("null")))
        .otherwise(F.lit(', "note": [1]'))
    )
    whole = F.concat(F.expr("substring(props, 1, length(props) - 1)"), extra, F.lit("}"))
    payload = F.when(F.col("event_id") % 50 == 49, "no json").otherwise(whole)
    return I.table(s, d, "events").select(payload.alias("payload"))


add("payload_shape", lambda s, d: V.payload_shape(_nested(s, d), "payload").withColumn("inferred", F.regexp_replace("inferred", r"DECIMAL\(\d+,\d+\)", "DECIMAL")),
    "WITH e AS (SELECT event_id % 4 AS n, event_id % 8 AS m FROM events WHERE event_id % 50 <> 49) "
    "SELECT field, CAST(seen AS BIGINT) AS seen, CAST(nulls AS BIGINT) AS nulls, inferred FROM ("
    "SELECT 'k' AS field, count(*) AS seen, 0 AS nulls, 'BIGINT' AS inferred FROM e UNION ALL "
    "SELECT 'cart', count(*), 0, 'OBJECT<paid: BOOLEAN, sum: DECIMAL>' FROM e WHERE n = 0 UNION ALL "
    "SELECT 'items', count(*), 0, 'ARRAY<OBJECT<n: BIGINT, sku: STRING>>' FROM e WHERE n = 1 UNION ALL "
    "SELECT 'note', count(*), count(*) FILTER (m = 6), 'VARIANT' FROM e WHERE n >= 2)")


def _payments_profile(s, d):
    log = change_log(s, d, "payments").filter(F.col("after").isNotNull())
    changed = F.regexp_replace(F.regexp_replace("after", '"status"', '"state"'), '"payment_id":([0-9]+)', '"payment_id":"P$1"')
    return V.payload_profile(log.withColumn("after", changed), "after")


add("profile_against_contract", lambda s, d: V.profile_against_contract(_payments_profile(s, d), CDC_CONTRACTS["payments"]),
    with_(LOG, "SELECT f AS field, t AS declared_type, CASE WHEN f <> 'status' THEN (SELECT CAST(count(*) AS BIGINT) FROM bronze WHERE entity = 'payments' AND op <> 'd') END AS seen, "
               "CASE WHEN f <> 'status' THEN CAST(0 AS BIGINT) END AS nulls, i AS issue FROM (VALUES ('status', 'string', 'dropped'), ('state', NULL, 'undeclared'), ('payment_id', 'bigint', 'type_changed')) x(f, t, i)"))
add("offset_ranges", lambda s, d: V.offset_ranges(change_log(s, d)),
    with_(LOG, "SELECT kafka_topic, kafka_partition, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT kafka_offset) AS BIGINT) AS distinct_offsets, "
               "CAST(max(kafka_offset) - min(kafka_offset) + 1 - count(DISTINCT kafka_offset) AS BIGINT) AS missing_offsets FROM bronze GROUP BY 1, 2"))
add("offset_gaps", lambda s, d: V.offset_gaps(change_log(s, d)),
    with_(LOG, "SELECT kafka_topic, kafka_partition, p + 1 AS gap_start, kafka_offset - 1 AS gap_end, kafka_offset - p - 1 AS missing FROM (SELECT *, lag(kafka_offset) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset) AS p FROM bronze) WHERE p <> kafka_offset - 1"))


def _reconciled(s, d):
    at = F.lit(I.EVENTS_AS_OF)
    # the messages are parsed once; the log and all entities are read from what is stored
    log = stored(change_log(s, d).drop("source", "ingest_time"), "log")
    tables = {e: G.live_rows(G.fold_log(log, spec, at)) for e, spec in G.ENTITY_SPECS.items()}
    # planted: rows that the log does not know
    key = F.col("payment_id")
    both = F.when(F.col("amount") < 100, F.array(key, -key)).otherwise(F.array(key))
    tables["payments"] = tables["payments"].withColumn("payment_id", F.explode(both))
    return V.layer_reconciliation(log, tables)


add("layer_reconciliation", _reconciled,
    with_(LOG, "SELECT *, expected_rows = silver_rows AS counts_match FROM (SELECT entity, CAST(count(*) AS BIGINT) AS bronze_events, "
               "(SELECT CAST(count(*) AS BIGINT) FROM latest l WHERE l.entity = b.entity AND l.op <> 'd') AS expected_rows, "
               "(SELECT CAST(sum(CASE WHEN l.entity = 'payments' AND l.amount < 100 THEN 2 ELSE 1 END) AS BIGINT) FROM latest l WHERE l.entity = b.entity AND l.op <> 'd') AS silver_rows FROM bronze b GROUP BY entity)"))
_COMPARED = ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"]


def _orders(s, d):
    return I.table(s, d, "orders").select(*_COMPARED)


def _differing(s, d):
    """Two copies of orders laid out by priority. In one, urgent orders of some keys are lost, changed or doubled, and one is added."""
    left, right = scratch_path(s, "left"), scratch_path(s, "right")
    rows, key = _orders(s, d), F.col("o_orderkey")
    rows.write.partitionBy("o_orderpriority").parquet(left)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    hurt = rows.filter(~urgent | (key % 97 != 0)).withColumn("o_orderstatus", F.when(urgent & (key % 89 == 0), "X").otherwise(F.col("o_orderstatus")))
    hurt = hurt.union(rows.filter(urgent & (key % 83 == 0))).union(rows.agg(F.lit(-1), F.lit(-1), F.lit("1-URGENT"), F.lit("N")))
    hurt.write.partitionBy("o_orderpriority").parquet(right)
    return D.differing_rows(s.read.parquet(left), s.read.parquet(right), ["o_orderkey"], 256, "o_orderpriority")


def _digest_sql(columns) -> str:
    parts = ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), ''), CASE WHEN {c} IS NULL THEN 'n' ELSE CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) END" for c in columns
    )
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 15) AS BIGINT)"


add("range_sums", lambda s, d: D.range_sums(_orders(s, d), ["o_orderkey"], 64, "o_orderpriority"),
    f"SELECT o_orderpriority, CAST({_digest_sql(['o_orderkey'])} % 64 AS INTEGER) AS hash_range, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST(sum(CAST({_digest_sql(_COMPARED)} AS HUGEINT)) AS DECIMAL(38,0)) AS digest_sum FROM orders GROUP BY 1, 2")
_PICKED = ", ".join(_COMPARED)
add("differing_rows", _differing,
    f"""WITH hurt AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderkey % 97 <> 0
  UNION ALL SELECT {_PICKED} FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 83 = 0
  UNION ALL SELECT -1, -1, '1-URGENT', 'N'
), a AS (SELECT o_orderpriority, o_orderkey, count(*) AS n, list_sort(list((o_custkey, o_orderstatus))) AS r FROM orders GROUP BY 1, 2
), b AS (SELECT o_orderpriority, o_orderkey, count(*) AS n, list_sort(list((o_custkey, o_orderstatus))) AS r FROM hurt GROUP BY 1, 2
)
SELECT coalesce(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority, CAST(coalesce(a.o_orderkey, b.o_orderkey) AS BIGINT) AS o_orderkey,
  CASE WHEN b.n IS NULL THEN 'only_left' WHEN a.n IS NULL THEN 'only_right' ELSE 'changed' END AS difference,
  CAST(coalesce(a.n, 0) AS BIGINT) AS left_rows, CAST(coalesce(b.n, 0) AS BIGINT) AS right_rows
FROM a FULL JOIN b ON a.o_orderpriority = b.o_orderpriority AND a.o_orderkey = b.o_orderkey WHERE a.r IS DISTINCT FROM b.r""")
_SUM = "CAST(sum(total_gmv) AS DECIMAL(28,2)) AS total_gmv, CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(active_users) AS BIGINT) AS active_users"
add("kpi_checksum", lambda s, d: V.kpi_checksum(I.kpis(s, d)), with_(KPIS, f"SELECT {_SUM} FROM kpis"))
add("compare_runs", lambda s, d: V.compare_runs([V.kpi_checksum(I.kpis(s, d)), V.kpi_checksum(I.kpis(s, d)), V.kpi_checksum(I.kpis(s, d).withColumn("order_count", F.col("order_count") * 2))]),
    with_(KPIS + f", sums AS (SELECT {_SUM} FROM kpis)",
          "SELECT 'total_gmv' AS metric, CAST(total_gmv AS DOUBLE) AS run_1, CAST(total_gmv AS DOUBLE) AS run_2, CAST(total_gmv AS DOUBLE) AS run_3, true AS match FROM sums UNION ALL "
          "SELECT 'order_count', order_count, order_count, order_count * 2, false FROM sums UNION ALL SELECT 'active_users', active_users, active_users, active_users, true FROM sums"))
