"""Relational transforms and joins."""

from pyspark.sql import functions as F

from tidemark.operators import reshape as R
from tidemark.operators.ordered import exact_quantile
from tidemark.plans import inputs as I
from tidemark.workload.registry import Registry

QUERIES = Registry()
add = QUERIES.add
T = I.table


def money(column):
    return F.col(column).cast("decimal(18,2)")


def _blank(s, d):
    return T(s, d, "customer").select("c_custkey", F.regexp_replace("c_mktsegment", "BUILDING", "").alias("c_mktsegment"), "c_name")


add("nullcheck_table", lambda s, d: R.nullcheck_table(_blank(s, d)),
    "SELECT c_custkey, NULLIF(replace(c_mktsegment, 'BUILDING', ''), '') AS c_mktsegment, c_name FROM customer")
add("cast_columns",
    lambda s, d: R.cast_columns(T(s, d, "orders"), s.sql("SELECT CAST(1 AS bigint) o_orderkey, CAST('' AS date) o_orderdate, CAST(1 AS decimal(18,2)) o_totalprice").schema),
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders")
add("column_values", lambda s, d: R.column_values(T(s, d, "orders"), "o_custkey", max_records=20, where="o_orderstatus = 'F'"),
    "SELECT o_custkey AS value, CAST(count(*) AS BIGINT) AS n_records FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
add("pivot_counts",
    lambda s, d: T(s, d, "lineitem").groupBy("l_suppkey").agg(*R.pivot("l_returnflag", ["A", "N", "R"], prefix="flag_")).select(
        "l_suppkey", *[F.col(f"flag_{v}").cast("bigint").alias(f"flag_{v}") for v in "ANR"]),
    "SELECT l_suppkey, " + ", ".join(f"CAST(sum(CASE WHEN l_returnflag = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS flag_{v}" for v in "ANR") + " FROM lineitem GROUP BY 1")
add("pivot_values",
    lambda s, d: T(s, d, "lineitem").withColumn("price", money("l_extendedprice")).groupBy("l_linestatus").agg(
        *R.pivot("l_returnflag", ["A", "N"], agg="max", cmp="!=", suffix="_max", then_value="price", else_value=None),
        *R.pivot("l_returnflag", ["A", "N"], agg="count", suffix="_orders", then_value="l_orderkey", else_value=None, distinct=True)),
    "SELECT l_linestatus, " + ", ".join(f"max(CASE WHEN l_returnflag <> '{v}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS \"{v}_max\", "
    f"CAST(count(DISTINCT CASE WHEN l_returnflag = '{v}' THEN l_orderkey END) AS BIGINT) AS \"{v}_orders\"" for v in "AN") + " FROM lineitem GROUP BY 1")
add("unpivot",
    lambda s, d: R.unpivot(T(s, d, "customer").withColumn("rich", F.col("c_acctbal") > 5000), exclude=["C_CUSTKEY"], remove=["c_acctbal"], field_name="prop", value_name="val"),
    "SELECT c_custkey, 'c_name' AS prop, c_name AS val FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer "
    "UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'rich', CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END FROM customer")


def _unlike(s, d):
    a = T(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"), money("o_totalprice").alias("amount"))
    b = T(s, d, "lineitem").select(F.col("l_orderkey").alias("id"), money("l_extendedprice").alias("amount"), F.col("l_returnflag").alias("flag"))
    return {"orders": a, "lines": b}


_UNION = (
    "SELECT 'orders' AS _source_relation, o_orderkey AS id, o_custkey AS owner, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(NULL AS VARCHAR) AS flag FROM orders "
    "UNION ALL SELECT 'lines', l_orderkey, CAST(NULL AS BIGINT), CAST(l_extendedprice AS DECIMAL(18,2)), l_returnflag FROM lineitem"
)
add("union_relations", lambda s, d: R.union_relations(_unlike(s, d)), _UNION)
add("union_relations_chosen",
    lambda s, d: R.union_relations(_unlike(s, d), {"id": "string"}, include=["ID", "amount"], source_column=None, where="amount > 50000"),
    f"SELECT CAST(id AS VARCHAR) AS id, amount FROM ({_UNION}) WHERE amount > 50000")


def _by_name(s, d):
    for name, frame in _unlike(s, d).items():
        frame.createOrReplaceTempView(f"tidemark_part_{name}")
    T(s, d, "customer").createOrReplaceTempView("tidemark_part_skipped")
    return R.union_tables_like(s, "tidemark_part_*", exclude="*skipped")


add("union_tables_like", _by_name, "SELECT 'tidemark_part_' || _source_relation AS _source_relation, id, owner, amount, flag FROM (" + _UNION + ")")
add("symmetric_difference",
    lambda s, d: R.symmetric_difference(
        # pending orders name customers that do not exist, debtors are known by another number
        T(s, d, "orders").select(F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("k")),
        T(s, d, "customer").select(F.when(F.col("c_acctbal") < 0, 10**9 + F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("k")),
    ),
    "WITH a AS (SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_custkey ELSE o_custkey END AS k FROM orders), "
    "b AS (SELECT CASE WHEN c_acctbal < 0 THEN 1000000000 + c_custkey ELSE c_custkey END AS k FROM customer) "
    "SELECT 'a_minus_b' AS which_diff, k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL "
    "SELECT 'b_minus_a', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)")
add("deduplicate",
    lambda s, d: R.deduplicate(T(s, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], [F.desc("value"), F.asc("event_id")]),
    "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) = 1")


def _missing_keys(s, d):
    """Numbers up to that of the last order that no line has."""
    top = T(s, d, "orders").agg(F.max("o_orderkey")).first()[0]
    lines = T(s, d, "lineitem").select(F.col("l_orderkey").alias("generated_number"))
    return R.generate_series(s, top).join(lines, "generated_number", "left_anti")


add("generate_series", _missing_keys,
    "SELECT g AS generated_number FROM (SELECT unnest(generate_series(1, max(o_orderkey))) AS g FROM orders) WHERE g NOT IN (SELECT l_orderkey FROM lineitem)")
add("cross_series",
    lambda s, d: R.cross_series(T(s, d, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("n")), F.col("n"), "part_no").groupBy("l_suppkey", "part_no").agg(F.count(F.lit(1)).alias("n")),
    "SELECT l_suppkey, CAST(part_no AS INTEGER) AS part_no, CAST(count(*) AS BIGINT) AS n FROM (SELECT l_suppkey, unnest(generate_series(1, l_linenumber)) AS part_no FROM lineitem) GROUP BY 1, 2")
add("exact_median",
    lambda s, d: exact_quantile(T(s, d, "lineitem"), "l_quantity", 0.5, ["l_suppkey"], "median"),
    "SELECT l_suppkey, quantile_cont(l_quantity, 0.5) AS median FROM lineitem GROUP BY 1")
add("exact_quantile",
    lambda s, d: exact_quantile(T(s, d, "lineitem"), "l_extendedprice", 0.9, ["l_returnflag", "l_linestatus"], "q90").withColumn("q90", F.round("q90", 4)),
    "SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.9), 4) AS q90 FROM lineitem GROUP BY 1, 2")
add("exact_quantile_whole_table",
    lambda s, d: exact_quantile(T(s, d, "events"), "value", 0.333).withColumn("quantile", F.round("quantile", 6)),
    "SELECT round(quantile_cont(value, 0.333), 6) AS quantile FROM events")
