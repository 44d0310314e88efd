"""Staging, marts and metric queries."""

from pyspark.sql import functions as F

from tidemark.operators import reshape
from tidemark.operators.governance import mask_pii
from tidemark.operators.joins import left_join_many
from tidemark.contracts import CDC_CONTRACTS
from tidemark.plans import inputs as I
from tidemark.plans import marts as M
from tidemark.plans import metrics as K
from tidemark.workload.registry import Registry
from tidemark.workload.sql import BUSINESS, FACTS, KPIS, SEGMENTS, STAGED, with_

QUERIES = Registry()
add = QUERIES.add


def _as_of():
    return F.lit(I.ORDERS_AS_OF)


KPI_COLUMNS = (
    "kpi_date, order_count, total_gmv, paid_gmv, active_users, payment_count, captured_amount, "
    "failed_payment_count, successful_payment_count, payment_success_rate, payment_failure_rate"
)

add("staged_users", I.users, with_(STAGED, "SELECT * FROM stg_users"))
add("staged_orders", I.orders, with_(STAGED, "SELECT * FROM stg_orders"))
add("staged_payments", I.payments, with_(STAGED, "SELECT * FROM stg_payments"))
add("business_users", lambda s, d: M.business_users(I.users(s, d)), with_(BUSINESS, "SELECT * FROM int_users"))
add("business_orders", lambda s, d: M.business_orders(I.orders(s, d)), with_(BUSINESS, "SELECT * FROM int_orders"))
add("business_payments", lambda s, d: M.business_payments(I.payments(s, d)), with_(BUSINESS, "SELECT * FROM int_payments"))
add("dim_users", I.dim_users, with_(FACTS, "SELECT * FROM dim_users"))
add("fct_orders", I.fct_orders, with_(FACTS, "SELECT * FROM fct_orders"))
add("fct_payments", I.fct_payments, with_(FACTS, "SELECT * FROM fct_payments"))
add(
    "enum_normalised_counts",
    lambda s, d: I.table(s, d, "events")
    .select(M.normalise_enum("event_type", ("click", "view", "purchase")).alias("kind"))
    .groupBy("kind")
    .agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type ELSE 'unknown' END AS kind, "
    "CAST(COUNT(*) AS BIGINT) AS n FROM events GROUP BY 1",
)
add(
    "non_negative_balances",
    lambda s, d: M.non_negative(I.table(s, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal"),
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0",
)
_DAILY = with_(KPIS, "SELECT * EXCLUDE (metric_version, payment_success_rate, payment_failure_rate) FROM kpis")
add("kpis_daily", lambda s, d: M.daily_kpis(I.fct_orders(s, d), I.fct_payments(s, d), _as_of()), _DAILY)
add(
    "kpis_daily_any_keys",
    lambda s, d: M.daily_kpis(I.fct_orders(s, d), I.fct_payments(s, d), _as_of(), keyed=False),
    _DAILY,
)
add("kpis_daily_v1", I.kpis, with_(KPIS, "SELECT * FROM kpis"))
add(
    "exact_daily_gmv",
    lambda s, d: M.exact_daily_gmv(I.fct_orders(s, d)),
    with_(
        FACTS,
        "SELECT CAST(order_ts AS DATE) AS kpi_date, CAST(SUM(total_amount) AS DECIMAL(28,2)) AS exact_gmv, "
        "CAST(SUM(paid_amount) AS DECIMAL(28,2)) AS exact_paid_gmv FROM fct_orders GROUP BY 1",
    ),
)
add(
    "user_metrics",
    lambda s, d: M.user_metrics(I.dim_users(s, d), I.fct_orders(s, d), _as_of()),
    with_(SEGMENTS, "SELECT * FROM user_metrics"),
)
add("user_segments", I.segments, with_(SEGMENTS, "SELECT * FROM segments"))
add(
    "orders_left_payments",
    lambda s, d: left_join_many(
        I.fct_orders(s, d).select("order_id", "total_amount"),
        I.fct_payments(s, d).select("order_id", "payment_id", "amount"),
        ["order_id"],
    ),
    with_(
        FACTS,
        "SELECT o.order_id, o.total_amount, p.payment_id, p.amount FROM fct_orders o "
        "LEFT JOIN fct_payments p ON o.order_id = p.order_id",
    ),
)
add(
    "masked_users",
    lambda s, d: mask_pii(I.users(s, d).select("user_id", "email"), CDC_CONTRACTS["users"]),
    with_(
        STAGED,
        "SELECT user_id, substr(email, 1, 1) || repeat('*', CAST(instr(email, '@') - 2 AS BIGINT)) || "
        "substr(email, instr(email, '@')) AS email FROM stg_users",
    ),
)
add(
    "star_renamed",
    lambda s, d: I.table(s, d, "customer").select(*reshape.star(I.table(s, d, "customer"), ["C_ACCTBAL"], "src_", "_x")),
    "SELECT c_custkey AS src_c_custkey_x, c_name AS src_c_name_x, c_nationkey AS src_c_nationkey_x, "
    "c_mktsegment AS src_c_mktsegment_x FROM customer",
)
add(
    "kpi_on_date",
    lambda s, d: K.kpi_on(I.kpis(s, d), "2000-01-21", metrics=["total_gmv", "order_count", "no_such_metric"]),
    with_(KPIS, "SELECT kpi_date, order_count, total_gmv, metric_version FROM kpis WHERE kpi_date = DATE '2000-01-21'"),
)
add(
    "kpi_range",
    lambda s, d: K.kpi_range(I.kpis(s, d), "2000-01-01", "2000-03-31"),
    with_(KPIS, f"SELECT {KPI_COLUMNS}, metric_version FROM kpis WHERE kpi_date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'"),
)
add(
    "kpi_projection",
    lambda s, d: K.project_metrics(I.kpis(s, d), ["active_users", "payment_failure_rate"]),
    with_(KPIS, "SELECT kpi_date, active_users, payment_failure_rate, metric_version FROM kpis"),
)
add(
    "latest_kpis",
    lambda s, d: I.kpis(s, d).orderBy(F.desc("kpi_date")).limit(7),
    with_(KPIS, "SELECT * FROM kpis ORDER BY kpi_date DESC LIMIT 7"),
)
_SEGMENT_SQL = "SELECT * FROM segments WHERE {} = '{}' AND segment_date = (SELECT MAX(segment_date) FROM segments) ORDER BY last_90d_gmv DESC, user_id LIMIT {}"
add(
    "segment_high_value",
    lambda s, d: K.users_in_segment(I.segments(s, d), "high_value", limit=100),
    with_(SEGMENTS, _SEGMENT_SQL.format("value_segment", "high_value", 100)),
)
add(
    "segment_churn_risk",
    lambda s, d: K.users_in_segment(I.segments(s, d), "churn_risk", day="2001-08-01", limit=50),
    with_(SEGMENTS, _SEGMENT_SQL.format("activity_segment", "churn_risk", 50)),
)
add(
    "top_users",
    lambda s, d: K.top_users(I.segments(s, d), 10),
    with_(SEGMENTS, "SELECT * FROM segments ORDER BY last_90d_gmv DESC, user_id LIMIT 10"),
)
add(
    "users_with_order_count",
    lambda s, d: K.users_with_order_count(I.dim_users(s, d), I.fct_orders(s, d)),
    with_(
        FACTS,
        "SELECT u.user_id, u.email, u.status, CAST(COUNT(o.order_id) AS BIGINT) AS order_count FROM dim_users u "
        "LEFT JOIN fct_orders o ON u.user_id = o.user_id GROUP BY 1, 2, 3",
    ),
)
add(
    "kpi_rows_per_day",
    lambda s, d: K.rows_per_day(I.kpis(s, d), _as_of()),
    with_(KPIS, "SELECT kpi_date, CAST(COUNT(*) AS BIGINT) AS row_count FROM kpis WHERE kpi_date >= DATE '2001-07-25' GROUP BY 1"),
)
add(
    "overpaid_orders",
    lambda s, d: K.overpaid_orders(I.fct_orders(s, d), I.fct_payments(s, d)),
    with_(
        FACTS,
        "SELECT o.order_id, o.total_amount AS order_total, CAST(SUM(p.captured_amount) AS DECIMAL(28,2)) AS total_captured "
        "FROM fct_orders o LEFT JOIN fct_payments p ON o.order_id = p.order_id GROUP BY 1, 2 "
        "HAVING SUM(p.captured_amount) > o.total_amount",
    ),
)
add(
    "captured_above_gmv",
    lambda s, d: K.captured_above_gmv(I.kpis(s, d)),
    with_(KPIS, "SELECT kpi_date, total_gmv, captured_amount FROM kpis WHERE captured_amount > total_gmv AND total_gmv > 0"),
)
def _with_orphans(s, d):
    """All payments, and beside each failed one another whose order is unknown, or missing if the amount is large."""
    payments = I.fct_payments(s, d)
    unknown = F.when(F.col("amount") < 2000, -1 - F.col("order_id"))
    return payments.unionByName(payments.filter("is_failed = 1").withColumn("order_id", unknown))


add(
    "orphan_payments",
    lambda s, d: K.orphan_payments(_with_orphans(s, d), I.fct_orders(s, d)),
    with_(
        FACTS,
        "SELECT p.order_id AS id, CAST(COUNT(*) AS BIGINT) AS n_records FROM (SELECT order_id FROM fct_payments UNION ALL "
        "SELECT CASE WHEN amount < 2000 THEN -1 - order_id END FROM fct_payments WHERE is_failed = 1) p "
        "LEFT JOIN fct_orders o ON p.order_id = o.order_id WHERE o.order_id IS NULL GROUP BY 1",
    ),
)
add(
    "negative_orders",
    lambda s, d: K.negative_orders(
        I.orders(s, d)
        .join(I.table(s, d, "customer"), F.col("user_id") == F.col("c_custkey"))
        .select("order_id", (F.col("total_amount") + F.col("c_acctbal").cast("decimal(18,2)") * 20).cast("decimal(18,2)").alias("total_amount"))
    ),
    with_(
        STAGED,
        "SELECT * FROM (SELECT order_id, CAST(total_amount + CAST(c_acctbal AS DECIMAL(18,2)) * 20 AS DECIMAL(18,2)) AS total_amount "
        "FROM stg_orders JOIN customer ON user_id = c_custkey) WHERE total_amount < 0",
    ),
)
add(
    "kpi_completeness",
    lambda s, d: K.completeness(I.kpis(s, d), _as_of()).select(
        "partition_count",
        F.array_join(F.col("dates").cast("array<string>"), ",").alias("dates"),
        F.array_join(F.col("missing_dates").cast("array<string>"), ",").alias("missing_dates"),
    ),
    with_(
        KPIS,
        "SELECT CAST(COUNT(DISTINCT kpi_date) AS BIGINT) AS partition_count, "
        "COALESCE(string_agg(CAST(kpi_date AS VARCHAR), ',' ORDER BY kpi_date), '') AS dates, "
        "COALESCE((SELECT string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) FROM (SELECT CAST(range AS DATE) AS x "
        "FROM range(TIMESTAMP '2001-07-26', TIMESTAMP '2001-08-02', INTERVAL 1 DAY)) "
        "WHERE x NOT IN (SELECT kpi_date FROM kpis)), '') AS missing_dates "
        "FROM kpis WHERE kpi_date BETWEEN DATE '2001-07-25' AND DATE '2001-08-01'",
    ),
)
add(
    "kpi_missing_days",
    # three weeks after the last order
    lambda s, d: K.missing_days(I.kpis(s, d), F.lit("2001-08-22"), 60),
    with_(
        KPIS,
        "SELECT CAST(range AS DATE) AS kpi_date FROM range(TIMESTAMP '2001-06-24', TIMESTAMP '2001-08-23', INTERVAL 1 DAY) "
        "WHERE CAST(range AS DATE) NOT IN (SELECT kpi_date FROM kpis)",
    ),
)
add(
    "kpi_day_coverage",
    lambda s, d: K.kpi_day_coverage(I.kpis(s, d), I.fct_orders(s, d), _as_of()),
    with_(
        KPIS,
        "SELECT CAST(COUNT(DISTINCT kpi_date) AS BIGINT) AS partition_count, CAST(COUNT(DISTINCT kpi_date) - "
        "(SELECT COUNT(DISTINCT CAST(order_ts AS DATE)) FROM fct_orders WHERE order_ts >= DATE '2001-07-02') AS BIGINT) "
        "AS missing_partitions FROM kpis WHERE kpi_date >= DATE '2001-07-02'",
    ),
)
add(
    "kpi_completeness_range",
    lambda s, d: K.completeness_range(I.kpis(s, d), _as_of()),
    with_(
        KPIS,
        "SELECT CAST(COUNT(DISTINCT kpi_date) AS BIGINT) AS partition_count, MIN(kpi_date) AS min_date, "
        "MAX(kpi_date) AS max_date FROM kpis WHERE kpi_date >= DATE '2001-07-25'",
    ),
)
