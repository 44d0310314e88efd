import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_merge import event, log_of
from tidemark.contracts import CDC_CONTRACTS, METRIC_CONTRACTS
from tidemark.operators import governance as V
from tidemark.operators import merge as G
from tidemark.operators import suite as U


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(1, 5), (2, -1), (3, None), (3, -7)], "id int, v int")


def test_fused_checks_share_one_scan(numbers):
    checks = [
        U.RowCheck("positive", F.col("v") < 0),
        U.RowCheck("positive for 2", F.col("v") < 0, F.col("id") == 2),
        U.RowCheck("warned", F.col("v").isNull(), severity=U.Severity(error_above=5)),
        U.AggregateCheck("enough rows", F.count(F.lit(1)), lambda c: c >= 4),
        U.AggregateCheck("unknown passes", F.sum(F.lit(None).cast("int")), lambda c: c > 0),
    ]
    summary = U.run_checks(numbers, checks)
    assert rows(summary) == [("enough rows", 0, "passed"), ("positive for 2", 1, "failed"), ("positive", 2, "failed"), ("unknown passes", 0, "passed"), ("warned", 1, "warn")]
    plan = summary._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan") == 1


def test_group_checks_share_a_shuffle(numbers):
    checks = [
        U.GroupCheck("unique", ("id",), F.count(F.lit(1)), lambda n: n <= 1),
        U.GroupCheck("positive sum", ("id",), F.sum("v"), lambda v: v > 0),
    ]
    summary = U.run_checks(numbers, checks)
    assert rows(summary) == [("positive sum", 2, "failed"), ("unique", 1, "failed")]
    plan = summary._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("hashpartitioning(id") == 1


def test_gate(spark, numbers):
    duplicates = numbers.groupBy("id").count().filter("count > 1")
    summary = U.run_checks(None, [U.FrameCheck("unique", duplicates), U.FrameCheck("weighted", duplicates, F.sum("count")), U.FrameCheck("empty", numbers.limit(0))])
    assert rows(summary) == [("empty", 0, "passed"), ("unique", 1, "failed"), ("weighted", 2, "failed")]
    assert tuple(U.gate_decision(summary).first()) == ("block", 3, 2, "unique, weighted")
    assert U.gate_decision(U.with_severity(summary, error_above=2)).first()["decision"] == "allow"
    assert U.gate_decision(summary.limit(0)).first()["decision"] == "block"
    skipped = spark.createDataFrame([("a", 0, "passed"), ("b", 0, "skipped")], "check_name string, failures long, status string")
    assert U.gate_decision(skipped).first()["decision"] == "block"
    assert U.gate_decision(skipped, skippable=["b"]).first()["decision"] == "allow"
    with pytest.raises(ValueError):
        U.run_checks(None, [U.RowCheck("x", F.lit(True))])


def test_conformance_reports_types_and_missing_fields(spark):
    df = spark.createDataFrame([("2024-01-01", 5, "v3")], "kpi_date string, order_count long, metric_version string")
    got = {r["check_name"]: r["failures"] for r in V.conformance(df, METRIC_CONTRACTS["kpis"]).collect()}
    assert got["kpis.kpi_date: type date"] == 1 and got["kpis.total_gmv: missing"] == 1
    assert got["kpis.metric_version: allowed values"] == 1 and got["kpis: unique key"] == 0


def test_mask_and_freshness(spark):
    df = spark.createDataFrame([(1, "ab@c.d")], "user_id int, email string")
    assert V.mask_pii(df, CDC_CONTRACTS["users"]).first()["email"] == "a*@c.d"
    times = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0),)], "t timestamp")
    assert tuple(V.freshness(times, "t", "2024-01-01 00:02:00", 120).first())[1:] == (120, True)
    assert V.freshness(times.limit(0), "t", "2024-01-01", 120).first()["is_fresh"] is False


def test_profile(spark):
    df = spark.createDataFrame([('{"order_id": 1, "total_amount": "x", "note": 1}',), ('{"order_id": null, "total_amount": 2.5}',)], "p string")
    issues = {r["field"]: r["issue"] for r in V.profile_against_contract(V.payload_profile(df, "p"), CDC_CONTRACTS["orders"]).collect()}
    assert issues == {"order_id": "null_not_allowed", "total_amount": "type_changed", "note": "undeclared", "user_id": "dropped", "order_ts": "dropped", "status": "dropped", "updated_at": "dropped"}


def test_offsets_and_reconciliation(spark):
    log = log_of(spark, *[event("c", i, i) for i in range(1, 9)], event("d", 3, 20))
    holed = log.filter(~F.col("kafka_offset").isin(2, 5, 6))
    ranged = V.offset_ranges(holed.unionByName(holed)).first()
    assert (ranged["min_offset"], ranged["max_offset"], ranged["events"], ranged["missing_offsets"]) == (1, 9, 12, 3)
    assert rows(V.offset_gaps(holed.unionByName(holed)).select("gap_start", "gap_end", "missing")) == [(2, 2, 1), (5, 6, 2)]
    table = G.live_rows(G.fold_log(log, G.ENTITY_SPECS["orders"], F.lit("2024-01-01")))
    assert rows(V.layer_reconciliation(log, {"orders": table})) == [("orders", 9, 7, 7, True)]
    assert rows(V.layer_reconciliation(log, {"orders": table.limit(5), "users": table.limit(0)})) == [("orders", 9, 7, 5, False), ("users", 0, 0, 0, True)]


def test_compare_runs(spark):
    def run(gmv, n):
        return spark.createDataFrame([(gmv, n)], "total_gmv double, order_count long")

    got = rows(V.compare_runs([run(125000.5, 4200), run(125000.505, 4200), run(125000.5, 4201)]))
    assert got == [("order_count", 4200.0, 4200.0, 4201.0, False), ("total_gmv", 125000.5, 125000.505, 125000.5, True)]


def test_payload_shape_of_odd_payloads(spark):
    texts = ['{"a": 1, "b": {"c": [1, 2.5]}}', '{"a": 2.5, "b": {"d": "x"}}', '{"a": null, "b": null}', '{"a": "x"}', "[1]", "7", "null", "{", "", None, "{}"]
    shape = V.payload_shape(spark.createDataFrame([(t, 1) for t in texts], "p string, value int").select("p", "value"), "p")
    assert rows(shape) == [("a", 4, 1, "VARIANT"), ("b", 3, 1, "OBJECT<c: ARRAY<DECIMAL(21,1)>, d: STRING>")]
    assert V.payload_shape(spark.createDataFrame([], "p string"), "p").count() == 0


def test_fields_are_numbered_over_ranges(spark):
    profile = spark.range(300).select(F.concat(F.lit("f"), F.lpad((F.col("id") % 90).cast("string"), 3, "0")).alias("field"))
    assert [r.field for r in V.observed_fields(profile).orderBy("position").collect()] == [f"f{i:03}" for i in range(90)]
    assert V.observed_fields(profile.limit(0)).count() == 0


def test_reconciliation_reads_the_stored_log(spark, data):
    from tidemark.workload import ALL

    plan = ALL["layer_reconciliation"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "jsonObjectKeys" not in plan
