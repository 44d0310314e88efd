"""Data-quality checks over whole tables."""

from pyspark.sql import functions as F

from tidemark.operators import checks as Q
from tidemark.operators.governance import observed_fields, payload_profile
from tidemark.plans import inputs as I
from tidemark.workload.registry import Registry
from tidemark.workload.sql import FACTS, STAGED, with_

QUERIES = Registry()
add = QUERIES.add
T = I.table

N = "CAST(COUNT(*) AS BIGINT) AS n_records"


def money(column):
    return F.col(column).cast("decimal(18,2)")


# one column

add(
    "check_not_null",
    lambda s, d: Q.not_null(I.payments(s, d), "failure_reason").select("payment_id", "status"),
    with_(STAGED, "SELECT payment_id, status FROM stg_payments WHERE failure_reason IS NULL"),
)
add(
    "check_unique",
    lambda s, d: Q.unique(I.payments(s, d), "payment_id"),
    with_(STAGED, f"SELECT payment_id AS unique_field, {N} FROM stg_payments GROUP BY 1 HAVING COUNT(*) > 1"),
)
add(
    "check_accepted_values",
    lambda s, d: Q.accepted_values(T(s, d, "events"), "event_type", ["click", "view"]),
    f"SELECT event_type AS value_field, {N} FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1",
)
add(
    "check_accepted_values_null_passes",
    lambda s, d: Q.accepted_values(I.payments(s, d), "failure_reason", ["fraud"]),
    with_(STAGED, f"SELECT failure_reason AS value_field, {N} FROM stg_payments WHERE failure_reason NOT IN ('fraud') GROUP BY 1"),
)
add(
    "check_not_accepted_values",
    lambda s, d: Q.not_accepted_values(T(s, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "nothing"]),
    "SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', 'nothing')",
)
def _with_strangers(s, d):
    """All lines, and for the large ones another that belongs to no order."""
    lines = T(s, d, "lineitem")
    return lines.unionByName(lines.filter("l_quantity > 45").withColumn("l_orderkey", -1 - F.col("l_orderkey")))


add(
    "check_relationships",
    lambda s, d: Q.relationships(_with_strangers(s, d), "l_orderkey", T(s, d, "orders"), "o_orderkey"),
    f"SELECT l_orderkey AS id, {N} FROM (SELECT l_orderkey FROM lineitem UNION ALL SELECT -1 - l_orderkey FROM lineitem WHERE l_quantity > 45) "
    "WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1",
)
add(
    "check_relationships_where",
    lambda s, d: Q.relationships(
        T(s, d, "lineitem"), "l_orderkey", T(s, d, "orders"), "o_orderkey", "l_returnflag = 'R'", "o_orderstatus <> 'P'"
    ),
    f"SELECT l_orderkey AS id, {N} FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey NOT IN "
    "(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1",
)
add(
    "check_labels_documents",
    lambda s, d: Q.relationships(T(s, d, "documents"), "doc_id", T(s, d, "labels"), "doc_id"),
    f"SELECT doc_id AS id, {N} FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1",
)
add(
    "check_accepted_range",
    lambda s, d: Q.accepted_range(T(s, d, "lineitem"), "l_quantity", 3, 48).select("l_orderkey", "l_quantity"),
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE NOT (l_quantity >= 3) OR NOT (l_quantity <= 48)",
)
add(
    "check_accepted_range_exclusive",
    lambda s, d: Q.accepted_range(T(s, d, "customer"), "c_acctbal", min_value=0, inclusive=False).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE NOT (c_acctbal > 0)",
)
add(
    "check_not_empty_string",
    lambda s, d: Q.not_empty_string(
        T(s, d, "orders").select("o_orderkey", F.regexp_replace("o_orderstatus", "F", " ").alias("flag")), "flag"
    ).select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE trim(replace(o_orderstatus, 'F', ' ')) = ''",
)
add(
    "check_values_between",
    lambda s, d: Q.values_between(T(s, d, "events"), "value", 1, 50, strictly=True, row_condition="event_type = 'view'").select("event_id", "value"),
    "SELECT event_id, value FROM events WHERE event_type = 'view' AND NOT (value > 1 AND value < 50)",
)
_STEP = (
    "SELECT {keys}, previous_{c}, CAST(COUNT(*) AS BIGINT) AS n_records FROM (SELECT *, lag({c}) OVER ({part} ORDER BY {order}) AS previous_{c} "
    "FROM {table}) WHERE previous_{c} IS NOT NULL AND NOT ({rule}) GROUP BY ALL"
)
add(
    "check_increasing",
    lambda s, d: Q.values_increasing(T(s, d, "events"), "value", "event_id"),
    _STEP.format(keys="event_id, value", c="value", part="", order="event_id, value", table="events", rule="value > previous_value"),
)
add(
    "check_increasing_grouped",
    lambda s, d: Q.values_increasing(T(s, d, "events"), "value", "event_id", strictly=False, group_by=["user_id"]),
    _STEP.format(keys="user_id, event_id, value", c="value", part="PARTITION BY user_id", order="event_id, value", table="events", rule="value >= previous_value"),
)
add(
    "check_increasing_repeated",
    lambda s, d: Q.values_increasing(T(s, d, "lineitem"), "l_quantity"),
    _STEP.format(keys="l_quantity", c="l_quantity", part="", order="l_quantity", table="lineitem", rule="l_quantity > previous_l_quantity"),
)
add(
    "check_decreasing",
    lambda s, d: Q.values_decreasing(T(s, d, "orders"), "o_totalprice", "o_orderdate", group_by=["o_orderstatus"]).withColumn("o_orderdate", F.to_date("o_orderdate")),
    _STEP.format(
        keys="o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice", c="o_totalprice", part="PARTITION BY o_orderstatus",
        order="o_orderdate, o_totalprice", table="orders", rule="o_totalprice < previous_o_totalprice",
    ),
)
add(
    "check_sequential_values",
    lambda s, d: Q.sequential_values(T(s, d, "lineitem"), "l_linenumber", group_by=["l_orderkey"]),
    _STEP.format(keys="l_orderkey, l_linenumber", c="l_linenumber", part="PARTITION BY l_orderkey", order="l_linenumber", table="lineitem", rule="l_linenumber = previous_l_linenumber + 1"),
)
add(
    "check_sequential_whole_table",
    lambda s, d: Q.sequential_values(T(s, d, "events"), "event_id", interval=2),
    _STEP.format(keys="event_id", c="event_id", part="", order="event_id", table="events", rule="event_id = previous_event_id + 2"),
)
add(
    "check_sequential_days",
    lambda s, d: Q.sequential_values(
        T(s, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day")).distinct(), "day", 1, "day", ["o_custkey"]
    ),
    _STEP.format(
        keys="o_custkey, day", c="day", part="PARTITION BY o_custkey", order="day",
        table="(SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)", rule="day = previous_day + 1",
    ),
)
_PRIORITY = ["1-URGENT", "2-HIGH"]
add(
    "check_values_in_set",
    lambda s, d: Q.values_in_set(T(s, d, "orders"), "o_orderpriority", _PRIORITY).select("o_orderkey", "o_orderpriority"),
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT COALESCE(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)",
)
add(
    "check_values_in_set_null_fails",
    lambda s, d: Q.values_in_set(I.payments(s, d), "failure_reason", ["declined"]).select("payment_id"),
    with_(STAGED, "SELECT payment_id FROM stg_payments WHERE failure_reason IS NULL OR failure_reason <> 'declined'"),
)
add(
    "check_values_not_in_set",
    lambda s, d: Q.values_not_in_set(T(s, d, "orders"), "o_orderpriority", _PRIORITY, "o_orderstatus = 'O'").select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
add(
    "check_values_null",
    lambda s, d: Q.values_null(I.payments(s, d), "failure_reason", "status = 'failed'").select("payment_id"),
    with_(STAGED, "SELECT payment_id FROM stg_payments WHERE status = 'failed' AND failure_reason IS NOT NULL"),
)
add(
    "check_values_not_null",
    lambda s, d: Q.values_not_null(I.payments(s, d), "failure_reason", "status = 'captured'").select("payment_id"),
    with_(STAGED, "SELECT payment_id FROM stg_payments WHERE status = 'captured' AND failure_reason IS NULL"),
)
add(
    "check_values_unique",
    lambda s, d: Q.values_unique(I.payments(s, d), "failure_reason"),
    with_(STAGED, f"SELECT failure_reason, {N} FROM stg_payments WHERE failure_reason IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"),
)


def _cased(s, d):
    loud = F.when(F.col("value") > 20, F.upper("event_type")).otherwise(F.col("event_type"))
    return T(s, d, "events").select(F.when(F.col("event_type") == "view", "view").otherwise(loud).alias("kind"))


_CASED = "(SELECT CASE WHEN event_type = 'view' THEN 'view' WHEN value > 20 THEN upper(event_type) ELSE event_type END AS kind FROM events)"
add(
    "check_consistent_casing",
    lambda s, d: Q.consistent_casing(_cased(s, d), "kind"),
    "SELECT CAST(COUNT(DISTINCT kind) AS BIGINT) AS set_count, CAST(COUNT(DISTINCT lower(kind)) AS BIGINT) AS set_count_case_insensitive "
    f"FROM {_CASED} HAVING COUNT(DISTINCT kind) <> COUNT(DISTINCT lower(kind))",
)
add(
    "check_consistent_casing_listed",
    lambda s, d: Q.consistent_casing(_cased(s, d), "kind", display_inconsistent=True),
    "SELECT lower(kind) AS inconsistent_columns, CAST(COUNT(DISTINCT kind) AS BIGINT) AS set_count_case_insensitive "
    f"FROM {_CASED} GROUP BY 1 HAVING COUNT(DISTINCT kind) > 1",
)
add(
    "check_values_of_type",
    lambda s, d: Q.values_of_type(T(s, d, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(5)).alias("tail")), "tail", "bigint"),
    "SELECT page_id, split_part(url, '/', 5) AS tail FROM pages WHERE TRY_CAST(split_part(url, '/', 5) AS BIGINT) IS NULL",
)
add(
    "check_schema_type_in",
    lambda s, d: Q.schema_type_in(T(s, d, "orders"), "o_totalprice", ["bigint", "string"]).unionByName(
        Q.schema_type_in(T(s, d, "orders"), "o_orderkey", ["bigint", "string"])
    ),
    "SELECT DISTINCT 'o_totalprice' AS relation_column, lower(typeof(o_totalprice)) AS relation_column_type FROM orders "
    "WHERE typeof(o_totalprice) NOT IN ('BIGINT', 'VARCHAR') UNION ALL "
    "SELECT DISTINCT 'o_orderkey', lower(typeof(o_orderkey)) FROM orders WHERE typeof(o_orderkey) NOT IN ('BIGINT', 'VARCHAR')",
)

# aggregates


def _grouped(name, check, sql_expr, low, high, observed=True):
    keep = ["l_partkey", "expression"] + (["observed"] if observed else [])
    extra = f", {sql_expr} AS observed" if observed else ""
    add(
        name,
        lambda s, d: check(T(s, d, "lineitem").withColumn("l_extendedprice", money("l_extendedprice")), "l_extendedprice", low, high, group_by=["l_partkey"]).select(*keep),
        f"SELECT l_partkey, false AS expression{extra} FROM (SELECT * REPLACE (CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice) FROM lineitem) "
        f"GROUP BY l_partkey HAVING NOT ({sql_expr} >= {low} AND {sql_expr} <= {high})",
    )


_grouped("check_max_between", Q.max_between, "max(l_extendedprice)", 60000, 95000)
_grouped("check_min_between", Q.min_between, "min(l_extendedprice)", 1500, 15000)
_grouped("check_sum_between", lambda *a, **k: Q.sum_between(*a, **k).withColumn("observed", F.col("observed").cast("decimal(28,2)")),
         "CAST(sum(l_extendedprice) AS DECIMAL(28,2))", 900000, 1900000)
_grouped("check_mean_between", Q.mean_between, "avg(l_extendedprice)", 40000, 60000, observed=False)
_grouped("check_stdev_between", Q.stdev_between, "stddev_samp(l_extendedprice)", 24000, 33000, observed=False)
_grouped("check_unique_count_between", Q.unique_count_between, "count(DISTINCT l_extendedprice)", 22, 38)
add(
    "check_median_between",
    lambda s, d: Q.median_between(T(s, d, "lineitem"), "l_quantity", 20, 30, group_by=["l_partkey"]),
    "SELECT l_partkey, quantile_cont(l_quantity, 0.5) AS observed, false AS expression FROM lineitem GROUP BY 1 "
    "HAVING NOT (quantile_cont(l_quantity, 0.5) BETWEEN 20 AND 30)",
)
add(
    "check_median_whole_table",
    lambda s, d: Q.median_between(T(s, d, "lineitem"), "l_quantity", 90, 100, row_condition="l_returnflag = 'R'"),
    "SELECT quantile_cont(l_quantity, 0.5) AS observed, false AS expression FROM lineitem WHERE l_returnflag = 'R'",
)
add(
    "check_quantile_between",
    lambda s, d: Q.quantile_between(T(s, d, "orders"), "o_totalprice", 0.95, 100, 400000, group_by=["o_orderpriority"]).withColumn("observed", F.round("observed", 4)),
    "SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.95), 4) AS observed, false AS expression FROM orders GROUP BY 1 "
    "HAVING NOT (quantile_cont(o_totalprice, 0.95) BETWEEN 100 AND 400000)",
)
add(
    "check_unique_proportion_between",
    lambda s, d: Q.unique_proportion_between(T(s, d, "lineitem"), "l_linenumber", 0.9, 1, group_by=["l_orderkey"]),
    "SELECT l_orderkey, CAST(count(DISTINCT l_linenumber) AS DOUBLE) / count(l_linenumber) AS observed, false AS expression FROM lineitem "
    "GROUP BY 1 HAVING CAST(count(DISTINCT l_linenumber) AS DOUBLE) / count(l_linenumber) < 0.9",
)
_DISTINCT = (
    "SELECT user_id, CAST(count(DISTINCT event_type) AS BIGINT) AS observed, false AS expression FROM events WHERE value > 60 "
    "GROUP BY 1 HAVING NOT (count(DISTINCT event_type) {} {})"
)
for _name, _check, _op, _value in (
    ("greater", Q.distinct_count_greater, ">", 4),
    ("less", Q.distinct_count_less, "<", 5),
    ("equal", Q.distinct_count_equals, "=", 4),
):
    add(
        f"check_distinct_count_{_name}",
        lambda s, d, c=_check, v=_value: c(T(s, d, "events"), "event_type", v, ["user_id"], "value > 60"),
        _DISTINCT.format(_op, _value),
    )
add(
    "check_distinct_count_other_table",
    lambda s, d: Q.distinct_count_equals_other(T(s, d, "orders"), "o_custkey", T(s, d, "customer"), "c_nationkey"),
    "SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference, "
    "CAST(abs(a - b) AS DOUBLE) / a AS expression_difference_percent FROM (SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS a FROM orders), "
    "(SELECT CAST(count(DISTINCT c_nationkey) AS BIGINT) AS b FROM customer) WHERE abs(a - b) > 0",
)
_KINDS = ["click", "view", "refund"]
_KIND_SQL = "'click', 'view', 'refund'"
add(
    "check_distinct_values_in_set",
    lambda s, d: Q.distinct_values_in_set(T(s, d, "events"), "event_type", _KINDS),
    f"SELECT DISTINCT event_type AS value_field FROM events WHERE event_type NOT IN ({_KIND_SQL})",
)
add(
    "check_distinct_values_contain_set",
    lambda s, d: Q.distinct_values_contain_set(T(s, d, "events"), "event_type", _KINDS),
    "SELECT v AS value_field FROM (VALUES ('click'), ('view'), ('refund')) t(v) WHERE v NOT IN (SELECT event_type FROM events)",
)
add(
    "check_distinct_values_equal_set",
    lambda s, d: Q.distinct_values_equal_set(T(s, d, "events"), "event_type", _KINDS),
    "SELECT e AS column_value, v AS value_field FROM (SELECT DISTINCT event_type AS e FROM events) FULL JOIN "
    "(VALUES ('click'), ('view'), ('refund')) t(v) ON e = v WHERE e IS NULL OR v IS NULL",
)
add(
    "check_most_common_value",
    lambda s, d: Q.most_common_value_in_set(T(s, d, "orders"), "o_orderpriority", ["none"], 2),
    "SELECT o_orderpriority AS value_field FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1 OFFSET 1",
)
add(
    "check_at_least_one",
    lambda s, d: Q.at_least_one(I.payments(s, d), "failure_reason", ["order_id"]),
    with_(STAGED, "SELECT order_id, CAST(0 AS BIGINT) AS filler_column FROM stg_payments GROUP BY 1 HAVING count(failure_reason) = 0"),
)
add(
    "check_not_constant",
    lambda s, d: Q.not_constant(T(s, d, "lineitem"), "l_returnflag", ["l_orderkey"]),
    "SELECT l_orderkey, CAST(1 AS BIGINT) AS filler_column FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1",
)
add(
    "check_not_null_proportion",
    lambda s, d: Q.not_null_proportion(I.payments(s, d), "failure_reason", 0.25, 0.75, ["order_id"]),
    with_(
        STAGED,
        "SELECT order_id, CAST(count(failure_reason) AS DOUBLE) / count(*) AS not_null_proportion FROM stg_payments GROUP BY 1 "
        "HAVING CAST(count(failure_reason) AS DOUBLE) / count(*) NOT BETWEEN 0.25 AND 0.75",
    ),
)

# records

add(
    "check_expression_is_true",
    lambda s, d: Q.expression_is_true(T(s, d, "lineitem"), "l_extendedprice > 2000 * l_quantity", "l_linestatus = 'F'").select("l_orderkey", "l_partkey"),
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linestatus = 'F' AND NOT (l_extendedprice > 2000 * l_quantity)",
)
add(
    "check_expression_between",
    lambda s, d: Q.expression_between(T(s, d, "lineitem"), "l_extendedprice * (1 - l_discount)", 1000, 80000).select("l_orderkey", "l_partkey"),
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) >= 1000 AND l_extendedprice * (1 - l_discount) <= 80000)",
)
add(
    "check_aggregate_is_true",
    lambda s, d: Q.aggregate_is_true(T(s, d, "events"), F.count(F.lit(1)), lambda c: c < 60, ["user_id"]),
    "SELECT user_id, CAST(count(*) AS BIGINT) AS observed, false AS expression FROM events GROUP BY 1 HAVING count(*) >= 60",
)
add(
    "check_pair_greater",
    lambda s, d: Q.pair_greater(T(s, d, "lineitem"), "l_partkey", "l_suppkey", or_equal=True).select("l_orderkey", "l_partkey", "l_suppkey"),
    "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE NOT (l_partkey >= l_suppkey)",
)
add(
    "check_pair_equal",
    lambda s, d: Q.pair_equal(T(s, d, "lineitem"), "l_discount", "l_tax", "l_quantity < 10").select("l_orderkey"),
    "SELECT l_orderkey FROM lineitem WHERE l_quantity < 10 AND NOT (l_discount = l_tax)",
)
add(
    "check_pair_in_set",
    lambda s, d: Q.pair_in_set(T(s, d, "lineitem"), "l_returnflag", "l_linestatus", [("N", "O"), ("R", "F")]).select("l_orderkey", "l_returnflag", "l_linestatus"),
    "SELECT l_orderkey, l_returnflag, l_linestatus FROM lineitem WHERE NOT ((l_returnflag = 'N' AND l_linestatus = 'O') OR (l_returnflag = 'R' AND l_linestatus = 'F'))",
)
add(
    "check_unique_combination",
    lambda s, d: Q.unique_combination(T(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    f"SELECT l_orderkey, l_linenumber, {N} FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
add(
    "check_compound_unique",
    lambda s, d: Q.compound_unique(I.payments(s, d), ["order_id", "failure_reason"], "any_value_is_missing"),
    with_(STAGED, f"SELECT order_id, failure_reason, {N} FROM stg_payments WHERE order_id IS NOT NULL AND failure_reason IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"),
)
add(
    "check_compound_unique_null_groups",
    lambda s, d: Q.compound_unique(I.payments(s, d), ["order_id", "failure_reason"]),
    with_(STAGED, f"SELECT order_id, failure_reason, {N} FROM stg_payments GROUP BY 1, 2 HAVING count(*) > 1"),
)
add(
    "check_multicolumn_sum",
    lambda s, d: Q.multicolumn_sum(T(s, d, "lineitem"), ["l_linenumber", "l_suppkey"], "l_partkey", ["l_returnflag", "l_suppkey"]),
    "SELECT l_returnflag, l_suppkey, false AS expression FROM lineitem GROUP BY 1, 2 HAVING sum(l_linenumber) + sum(l_suppkey) <> sum(l_partkey)",
)
add(
    "check_unique_within_record",
    lambda s, d: Q.unique_within_record(
        T(s, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("a"), F.col("l_quantity").cast("bigint").alias("b"), F.col("l_suppkey").alias("c")),
        ["a", "b", "c"],
    ),
    "SELECT * FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS a, CAST(l_quantity AS BIGINT) AS b, l_suppkey AS c, "
    "CAST(len(list_distinct([CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT), l_suppkey])) AS INTEGER) AS column_values FROM lineitem) WHERE column_values < 3",
)

# strings

add(
    "check_lengths_between",
    lambda s, d: Q.lengths_between(T(s, d, "documents"), "text", 500, 5000).select("doc_id"),
    "SELECT doc_id FROM documents WHERE NOT (length(text) >= 500 AND length(text) <= 5000)",
)
add(
    "check_lengths_equal",
    lambda s, d: Q.lengths_equal(T(s, d, "orders"), "o_orderpriority", 8).select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE length(o_orderpriority) <> 8",
)
add(
    "check_match_like",
    lambda s, d: Q.match_like(T(s, d, "pages"), "url", "https://%").select("page_id"),
    "SELECT page_id FROM pages WHERE NOT (url LIKE 'https://%')",
)
add(
    "check_not_match_like",
    lambda s, d: Q.not_match_like(T(s, d, "documents"), "text", "% the %").select("doc_id"),
    "SELECT doc_id FROM documents WHERE text LIKE '% the %'",
)
add(
    "check_match_like_any",
    lambda s, d: Q.match_like_list(T(s, d, "pages"), "url", ["%.com/%", "%.org/%"]).select("page_id"),
    "SELECT page_id FROM pages WHERE NOT (url LIKE '%.com/%' OR url LIKE '%.org/%')",
)
add(
    "check_match_like_all",
    lambda s, d: Q.match_like_list(T(s, d, "pages"), "url", ["https://%", "%.com/%"], "all").select("page_id"),
    "SELECT page_id FROM pages WHERE NOT (url LIKE 'https://%' AND url LIKE '%.com/%')",
)
add(
    "check_not_match_like_any",
    lambda s, d: Q.not_match_like_list(T(s, d, "pages"), "url", ["https://%", "%.com/%"]).select("page_id"),
    "SELECT page_id FROM pages WHERE url LIKE 'https://%' AND url LIKE '%.com/%'",
)
add(
    "check_not_match_like_all",
    lambda s, d: Q.not_match_like_list(T(s, d, "pages"), "url", ["https://%", "%.com/%"], "all").select("page_id"),
    "SELECT page_id FROM pages WHERE url LIKE 'https://%' OR url LIKE '%.com/%'",
)
add(
    "check_match_regex",
    lambda s, d: Q.match_regex(T(s, d, "pages"), "url", "/[0-9]+(\\.html)?$").select("page_id"),
    "SELECT page_id FROM pages WHERE NOT regexp_matches(url, '/[0-9]+(\\.html)?$')",
)
add(
    "check_match_regex_flags",
    lambda s, d: Q.match_regex(T(s, d, "documents"), "text", "\\bTHE\\b", flags="i").select("doc_id"),
    "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '\\bTHE\\b', 'i')",
)
add(
    "check_not_match_regex",
    lambda s, d: Q.not_match_regex(T(s, d, "documents"), "text", "[a-z0-9]+@[a-z0-9]+").select("doc_id"),
    "SELECT doc_id FROM documents WHERE regexp_matches(text, '[a-z0-9]+@[a-z0-9]+')",
)
add(
    "check_match_regex_list",
    lambda s, d: Q.match_regex_list(T(s, d, "conversations"), "text", ["[0-9]", "[?]"], "any").select("conv_id", "turn"),
    "SELECT conv_id, turn FROM conversations WHERE NOT (regexp_matches(text, '[0-9]') OR regexp_matches(text, '[?]'))",
)
add(
    "check_not_match_regex_list",
    lambda s, d: Q.not_match_regex_list(T(s, d, "conversations"), "text", ["[0-9]", "[.]"], "all").select("conv_id", "turn"),
    "SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, '[0-9]') OR regexp_matches(text, '[.]')",
)

# tables

_COUNTS = (
    "SELECT order_id, a AS count_a, b AS count_b, {measure} FROM (SELECT order_id, CAST(count(*) AS BIGINT) AS a FROM fct_orders GROUP BY 1) "
    "JOIN (SELECT order_id, CAST(count(*) AS BIGINT) AS b FROM fct_payments GROUP BY 1) USING (order_id) WHERE {rule}"
)
add(
    "check_cardinality_equality",
    lambda s, d: Q.cardinality_equality(T(s, d, "orders"), "o_custkey", T(s, d, "customer"), "c_custkey"),
    "WITH a AS (SELECT o_custkey AS value_field, CAST(count(*) AS BIGINT) AS num_rows FROM orders GROUP BY 1), "
    "b AS (SELECT c_custkey AS value_field, CAST(count(*) AS BIGINT) AS num_rows FROM customer GROUP BY 1) "
    "SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL "
    "SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)",
)
add(
    "check_equal_rowcount",
    lambda s, d: Q.equal_rowcount(T(s, d, "orders"), T(s, d, "lineitem")),
    "SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count FROM (SELECT CAST(count(*) AS BIGINT) AS a FROM orders), (SELECT CAST(count(*) AS BIGINT) AS b FROM lineitem) WHERE a <> b",
)
add(
    "check_equal_rowcount_grouped",
    lambda s, d: Q.equal_rowcount(I.fct_orders(s, d), I.fct_payments(s, d), ["order_id"]),
    with_(FACTS, _COUNTS.format(measure="abs(a - b) AS diff_count", rule="a <> b")),
)
add(
    "check_fewer_rows_than",
    lambda s, d: Q.fewer_rows_than(I.fct_orders(s, d), I.fct_payments(s, d), ["order_id"]),
    with_(FACTS, _COUNTS.format(measure="CAST(CASE WHEN a > b THEN a - b ELSE 1 END AS BIGINT) AS row_count_delta", rule="a >= b")),
)
add(
    "check_equality",
    lambda s, d: Q.equality(I.fct_orders(s, d), I.dim_users(s, d), ["user_id"]),
    with_(
        FACTS,
        "SELECT 'a_minus_b' AS which_diff, user_id FROM (SELECT user_id FROM fct_orders EXCEPT SELECT user_id FROM dim_users) UNION ALL "
        "SELECT 'b_minus_a', user_id FROM (SELECT user_id FROM dim_users EXCEPT SELECT user_id FROM fct_orders)",
    ),
)
_RANGES = "SELECT user_id, event_id AS lo, event_id + CAST(floor(value) AS BIGINT) AS hi FROM events"
_RANGE_SQL = (
    "SELECT {keys}lo, hi, next_lo, next_hi, CAST(count(*) AS BIGINT) AS n_records FROM (SELECT *, lead(lo) OVER w AS next_lo, lead(hi) OVER w AS next_hi, "
    "lead(1) OVER w IS NULL AS is_last FROM ({rows}) WINDOW w AS ({part} ORDER BY lo, hi)) "
    "WHERE NOT (COALESCE(lo {zero} hi, false) AND COALESCE(hi {gap} next_lo, is_last, false)) GROUP BY ALL"
)


def _ranges(s, d):
    return T(s, d, "events").select("user_id", F.col("event_id").alias("lo"), (F.col("event_id") + F.floor("value").cast("bigint")).alias("hi"))


def _line_ranges(s, d):
    return T(s, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("lo"), (F.col("l_linenumber") + F.when(F.col("l_quantity") > 25, 1).otherwise(0)).alias("hi"))


add(
    "check_exclusive_ranges",
    lambda s, d: Q.mutually_exclusive_ranges(_ranges(s, d), "lo", "hi", ["user_id"], "allowed", zero_length=True),
    _RANGE_SQL.format(keys="user_id, ", part="PARTITION BY user_id", rows=_RANGES, zero="<=", gap="<="),
)
add(
    "check_exclusive_ranges_whole_table",
    lambda s, d: Q.mutually_exclusive_ranges(_ranges(s, d).drop("user_id"), "lo", "hi", None, "required"),
    _RANGE_SQL.format(keys="", part="", rows=_RANGES, zero="<", gap="<"),
)
add(
    "check_exclusive_ranges_repeated",
    lambda s, d: Q.mutually_exclusive_ranges(_line_ranges(s, d), "lo", "hi", ["l_orderkey"], "not_allowed", zero_length=True),
    _RANGE_SQL.format(
        keys="l_orderkey, ", part="PARTITION BY l_orderkey", zero="<=", gap="=",
        rows="SELECT l_orderkey, l_linenumber AS lo, l_linenumber + CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS hi FROM lineitem",
    ),
)
add(
    "check_recency",
    lambda s, d: Q.recency(T(s, d, "events"), "ts", "hour", 12, I.EVENTS_AS_OF, group_by=["user_id"]),
    "SELECT user_id, max(CAST(ts AS TIMESTAMP)) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'",
)
add(
    "check_recency_dates",
    lambda s, d: Q.recency(T(s, d, "orders"), "o_orderdate", "month", 2, I.ORDERS_AS_OF, ignore_time=True, group_by=["o_custkey"]),
    "SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS most_recent, DATE '2001-06-01' AS threshold FROM orders GROUP BY 1 HAVING CAST(max(o_orderdate) AS DATE) < DATE '2001-06-01'",
)
add(
    "check_recent_data",
    lambda s, d: Q.recent_data(T(s, d, "events"), "ts", "day", 3, "2024-02-05 00:00:00", "event_type = 'error'"),
    "SELECT max(CAST(ts AS TIMESTAMP)) AS max_timestamp FROM events WHERE event_type = 'error' HAVING max(ts) < TIMESTAMP '2024-02-02'",
)
add(
    "check_recent_data_grouped",
    lambda s, d: Q.grouped_recent_data(T(s, d, "events"), ["user_id", "event_type"], "ts", "day", 4, "2024-01-29 12:00:00"),
    "SELECT user_id, event_type, max(CAST(ts AS TIMESTAMP)) AS latest_timestamp_column FROM events WHERE ts <= TIMESTAMP '2024-01-29 12:00:00' "
    "GROUP BY 1, 2 HAVING max(ts) < TIMESTAMP '2024-01-25 12:00:00'",
)

# spread

add(
    "check_within_n_stdevs",
    lambda s, d: Q.within_n_stdevs(T(s, d, "orders").withColumn("o_totalprice", money("o_totalprice")), "o_totalprice", ["o_custkey"], 2)
    .select("o_custkey", F.col("o_totalprice").cast("decimal(28,2)").alias("total"), F.round("o_totalprice_sigma", 6).alias("sigma")),
    "WITH t AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY 1), "
    "z AS (SELECT *, (CAST(total AS DOUBLE) - avg(CAST(total AS DOUBLE)) OVER ()) / stddev_samp(CAST(total AS DOUBLE)) OVER () AS sigma FROM t) "
    "SELECT o_custkey, total, round(sigma, 6) AS sigma FROM z WHERE abs(sigma) > 2",
)
add(
    "check_within_n_moving_stdevs",
    lambda s, d: Q.within_n_moving_stdevs(
        T(s, d, "events").withColumn("value", money("value")), "value", "ts", I.EVENTS_AS_OF, ["event_type"], sigma_threshold=1.2, test_periods=20
    ).select("metric_period", "event_type", F.col("agg_metric_value").cast("decimal(28,2)").alias("agg_metric_value"), F.round("metric_test_sigma", 6).alias("sigma")),
    "WITH t AS (SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS metric_period, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS agg_metric_value FROM events GROUP BY 1, 2), "
    "p AS (SELECT *, COALESCE(ln(NULLIF(CAST(agg_metric_value AS DOUBLE), 0)), 0) - COALESCE(ln(NULLIF(CAST(lag(agg_metric_value) OVER (PARTITION BY event_type ORDER BY metric_period) AS DOUBLE), 0)), 0) AS x FROM t), "
    "m AS (SELECT *, avg(x) OVER w AS mean, stddev_samp(x) OVER w AS sd FROM p WINDOW w AS (PARTITION BY event_type ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) "
    "SELECT CAST(metric_period AS TIMESTAMP) AS metric_period, event_type, agg_metric_value, round((x - mean) / NULLIF(sd, 0), 6) AS sigma FROM m "
    "WHERE metric_period >= TIMESTAMP '2024-01-11' AND metric_period < TIMESTAMP '2024-01-31' AND NOT ((x - mean) / NULLIF(sd, 0) BETWEEN -1.2 AND 1.2)",
)
add(
    "check_every_hour",
    lambda s, d: Q.data_for_every_n_datepart(T(s, d, "events"), "ts", "hour", row_condition="event_type = 'signup'"),
    "SELECT g AS date_hour, true AS is_missing, CAST(0 AS BIGINT) AS row_cnt FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 HOUR)) AS g "
    "FROM events WHERE event_type = 'signup') WHERE g NOT IN (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) FROM events WHERE event_type = 'signup')",
)
add(
    "check_every_three_hours",
    lambda s, d: Q.data_for_every_n_datepart(
        T(s, d, "events"), "ts", "hour", 3, row_condition="event_type = 'purchase' AND value > 60", exclusion_condition="hour(date_hour) <> 0"
    ),
    "SELECT g AS date_hour, true AS is_missing, CAST(0 AS BIGINT) AS row_cnt FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 3 HOUR)) AS g "
    "FROM events WHERE event_type = 'purchase' AND value > 60) WHERE g NOT IN (SELECT time_bucket(INTERVAL 3 HOUR, CAST(ts AS TIMESTAMP), TIMESTAMP '2024-01-01') FROM events "
    "WHERE event_type = 'purchase' AND value > 60) AND hour(g) <> 0",
)

# shape

add(
    "check_row_count_between",
    lambda s, d: Q.row_count_between(T(s, d, "events"), 50, 80, ["user_id"]),
    "SELECT user_id, CAST(count(*) AS BIGINT) AS observed, false AS expression FROM events GROUP BY 1 HAVING count(*) NOT BETWEEN 50 AND 80",
)
add(
    "check_row_count_equals",
    lambda s, d: Q.row_count_equals(T(s, d, "customer"), 60, ["c_nationkey"], "c_acctbal > 0"),
    "SELECT c_nationkey, CAST(count(*) AS BIGINT) AS observed, false AS expression FROM customer WHERE c_acctbal > 0 GROUP BY 1 HAVING count(*) <> 60",
)
_EQUAL = (
    "SELECT COALESCE(k, j) AS {key}, a AS expression, b AS compare_expression, abs(COALESCE(a, 0) - COALESCE(b, 0)) AS expression_difference, "
    "CAST(abs(COALESCE(a, 0) - COALESCE(b, 0)) AS DOUBLE) / NULLIF(CAST(a AS DOUBLE), 0) AS expression_difference_percent FROM ({left}) FULL JOIN ({right}) ON k = j "
)
add(
    "check_row_count_other_table",
    lambda s, d: Q.row_count_equals_other(T(s, d, "lineitem"), T(s, d, "orders"), 4, ["l_orderkey"], ["o_orderkey"]),
    _EQUAL.format(
        key="l_orderkey", left="SELECT l_orderkey AS k, CAST(count(*) AS BIGINT) AS a FROM lineitem GROUP BY 1",
        right="SELECT o_orderkey AS j, CAST(count(*) * 4 AS BIGINT) AS b FROM orders GROUP BY 1",
    )
    + "WHERE abs(COALESCE(a, 0) - COALESCE(b, 0)) > 0",
)
add(
    "check_row_count_whole_tables",
    lambda s, d: Q.row_count_equals_other(T(s, d, "lineitem"), T(s, d, "orders"), 3),
    "SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference, CAST(abs(a - b) AS DOUBLE) / a AS expression_difference_percent "
    "FROM (SELECT CAST(count(*) AS BIGINT) AS a FROM lineitem), (SELECT CAST(count(*) * 3 AS BIGINT) AS b FROM orders) WHERE a <> b",
)
add(
    "check_aggregation_other_table",
    lambda s, d: Q.aggregation_equals_other(
        I.fct_orders(s, d), F.sum("total_amount").cast("decimal(28,2)"), I.fct_payments(s, d),
        compare_expression=F.sum("amount").cast("decimal(28,2)"), group_by=["order_id"], tolerance_percent=1.5,
    ).withColumn("expression_difference", F.col("expression_difference").cast("decimal(28,2)")),
    with_(
        FACTS,
        _EQUAL.format(
            key="order_id", left="SELECT order_id AS k, CAST(sum(total_amount) AS DECIMAL(28,2)) AS a FROM fct_orders GROUP BY 1",
            right="SELECT order_id AS j, CAST(sum(amount) AS DECIMAL(28,2)) AS b FROM fct_payments GROUP BY 1",
        ).replace("abs(COALESCE(a, 0) - COALESCE(b, 0)) AS expression_difference,", "CAST(abs(COALESCE(a, 0) - COALESCE(b, 0)) AS DECIMAL(28,2)) AS expression_difference,")
        + "WHERE CAST(abs(COALESCE(a, 0) - COALESCE(b, 0)) AS DOUBLE) / NULLIF(CAST(a AS DOUBLE), 0) > 1.5",
    ),
)


def _fields(s, d):
    """Fields that occur in order payloads: a relation derived from every message."""
    messages = I.change_messages(s, d).filter(F.col("topic").endswith(".orders"))
    after = messages.select(F.get_json_object(F.col("value").cast("string"), "$.after").alias("after"))
    return observed_fields(payload_profile(after, "after"))


_FIELD_LIST = "(SELECT * FROM (VALUES (0, 'order_id'), (1, 'order_ts'), (2, 'status'), (3, 'total_amount'), (4, 'updated_at'), (5, 'user_id')) f(position, field) WHERE EXISTS (SELECT 1 FROM events WHERE event_type <> 'signup'))"
add("fields_observed", _fields, f"SELECT CAST(position AS INTEGER) AS position, field FROM {_FIELD_LIST}")
add("fields_exist", lambda s, d: Q.field_exists(_fields(s, d), "CHANNEL").unionByName(Q.field_exists(_fields(s, d), "status", 0)).unionByName(Q.field_exists(_fields(s, d), "status", 2)),
    f"SELECT 'CHANNEL' AS field WHERE 'channel' NOT IN (SELECT field FROM {_FIELD_LIST}) UNION ALL SELECT 'status' FROM range(0, 3, 2) t(p) "
    f"WHERE NOT EXISTS (SELECT 1 FROM {_FIELD_LIST} WHERE field = 'status' AND position = p)")
add("fields_count_between", lambda s, d: Q.field_count_between(_fields(s, d), 7, 9), f"SELECT CAST(count(*) AS BIGINT) AS observed, false AS expression FROM {_FIELD_LIST}")
add("fields_count_equals", lambda s, d: Q.field_count_equals(_fields(s, d), 5), f"SELECT CAST(count(*) AS BIGINT) AS observed, false AS expression FROM {_FIELD_LIST}")
add("fields_count_other_table", lambda s, d: Q.field_count_equals_other(_fields(s, d), Q.schema_fields(T(s, d, "customer"))),
    f"SELECT a AS expression, CAST(5 AS BIGINT) AS compare_expression, abs(a - 5) AS expression_difference, abs(a - 5) / CAST(a AS DOUBLE) AS expression_difference_percent FROM (SELECT CAST(count(*) AS BIGINT) AS a FROM {_FIELD_LIST})")
add("fields_contain_set", lambda s, d: Q.fields_contain_set(_fields(s, d), ["order_id", "channel"]), f"SELECT v AS field FROM (VALUES ('order_id'), ('channel')) t(v) WHERE v NOT IN (SELECT field FROM {_FIELD_LIST})")
add("fields_not_contain_set", lambda s, d: Q.fields_not_contain_set(_fields(s, d), ["STATUS", "channel"]), f"SELECT v AS field FROM (VALUES ('status'), ('channel')) t(v) WHERE v IN (SELECT field FROM {_FIELD_LIST})")
add("fields_match_set", lambda s, d: Q.fields_match_set(_fields(s, d), ["order_id", "user_id", "channel"]),
    f"SELECT field AS relation_field, v AS input_field FROM {_FIELD_LIST} FULL JOIN (VALUES ('order_id'), ('user_id'), ('channel')) t(v) ON field = v WHERE field IS NULL OR v IS NULL")
add("fields_match_ordered_list", lambda s, d: Q.fields_match_ordered_list(_fields(s, d), ["order_id", "status"]),
    f"SELECT CAST(f.position AS INTEGER) AS position, field AS relation_field, v AS input_field FROM {_FIELD_LIST} f FULL JOIN (VALUES (0, 'order_id'), (1, 'status')) t(p, v) ON f.position = p WHERE field IS DISTINCT FROM v")
