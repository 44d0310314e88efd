import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.joins import left_join_many
from tidemark.plans import inputs as I
from tidemark.plans import marts as M
from tidemark.plans import metrics as K

DAY = dt.datetime(2024, 3, 1, 10)


@pytest.fixture
def facts(spark):
    at = F.lit("2024-03-02").cast("timestamp")
    orders = spark.createDataFrame(
        [(1, 10, DAY, "paid", Decimal("100.00")), (2, 10, DAY, "created", Decimal("50.00")), (3, 11, DAY, "weird", Decimal("7.00")), (4, 12, DAY, "paid", None), (5, 12, DAY, "paid", Decimal("-1.00"))],
        "order_id long, user_id long, order_ts timestamp, status string, total_amount decimal(18,2)",
    ).withColumns({"updated_at": at, "_silver_updated_at": at})
    payments = spark.createDataFrame(
        [(1, 1, Decimal("60.00"), "captured"), (2, 1, Decimal("40.00"), "captured"), (2, 1, Decimal("1.00"), "failed"), (3, 2, Decimal("50.00"), "failed"), (4, 77, Decimal("5.00"), "captured"), (5, None, Decimal("5.00"), "captured"), (6, 3, Decimal("2.00"), "lost")],
        "payment_id long, order_id long, amount decimal(18,2), status string",
    ).withColumns({"failure_reason": F.lit(None).cast("string"), "updated_at": at, "_silver_updated_at": at})
    return M.fct_orders(M.business_orders(orders)), M.fct_payments(M.business_payments(payments))


def test_business_rules(facts):
    orders, payments = facts
    assert [(r["order_id"], r["status"], r["paid_amount"]) for r in orders.orderBy("order_id").collect()] == [(1, "paid", 100), (2, "created", 0), (3, "unknown", 0)]
    assert {r["status"] for r in payments.collect()} == {"captured", "failed", "unknown"}


@pytest.mark.parametrize("keyed", [True, False])
def test_daily_kpis_count_an_order_once_per_payment(facts, keyed):
    kpis = M.versioned_kpis(M.daily_kpis(*facts, F.lit("2024-03-02"), keyed))
    row = kpis.first()
    assert row["order_count"] == 3 and row["active_users"] == 2
    assert row["total_gmv"] == Decimal("357.00") and row["paid_gmv"] == Decimal("300.00")
    assert row["payment_count"] == 4 and row["captured_amount"] == Decimal("100.00")
    assert row["failed_payment_count"] == 2 and row["successful_payment_count"] == 2
    assert row["payment_success_rate"] == pytest.approx(100 / 357) and row["payment_failure_rate"] == 0.5
    assert row["metric_version"] == "v1"


def test_exact_gmv(facts):
    assert rows(M.exact_daily_gmv(facts[0])) == [(dt.date(2024, 3, 1), Decimal("157.00"), Decimal("100.00"))]


def test_shared_payment_ids_need_the_general_plan(spark, facts):
    """A payment id in two orders breaks the key guarantee; the general plan still counts it once."""
    orders, payments = facts
    twice = payments.unionByName(payments.filter("payment_id = 3").withColumn("order_id", F.lit(3).cast("bigint")))
    assert M.daily_kpis(orders, twice, F.lit("2024-03-02"), keyed=False).first()["payment_count"] == 4


def test_rates_with_zero_denominators(spark):
    kpis = spark.createDataFrame([(0, 0, 0, 0), (1, 0, 0, 0), (1, 10, 0, 5)], "order_count long, payment_count long, failed_payment_count long, total_gmv long")
    kpis = kpis.withColumns({c: F.lit(0) for c in ("paid_gmv", "active_users", "captured_amount", "successful_payment_count", "kpi_date", "_computed_at")})
    got = [tuple(r) for r in M.versioned_kpis(kpis).select("payment_success_rate", "payment_failure_rate").collect()]
    assert got == [(0.0, 0.0), (None, 0.0), (0.0, 0.0)]


def test_segments(spark):
    as_of = F.lit("2024-03-31")
    users = spark.createDataFrame([(i, "active", DAY) for i in range(1, 6)] + [(6, "blocked", DAY)], "user_id long, status string, created_at timestamp")
    orders = spark.createDataFrame(
        [(1, dt.datetime(2024, 3, 30), Decimal("1000")), (2, dt.datetime(2024, 2, 1), Decimal("500")), (3, dt.datetime(2024, 3, 10), Decimal("499.99")), (4, dt.datetime(2023, 1, 1), Decimal("9999")), (4, dt.datetime(2024, 3, 24), Decimal("1"))],
        "user_id long, order_ts timestamp, total_amount decimal(18,2)",
    )
    got = M.segment_mart(M.user_segments(users, orders, as_of), as_of)
    assert rows(got.select("user_id", "value_segment", "activity_segment", F.col("segment_date").cast("string"))) == [
        (1, "high_value", "active", "2024-03-31"), (2, "medium_value", "churn_risk", "2024-03-31"), (3, "low_value", "dormant", "2024-03-31"),
        (4, "low_value", "active", "2024-03-31"), (5, "low_value", "dormant", "2024-03-31"),
    ]
    assert [r["user_id"] for r in K.users_in_segment(got, "low_value", limit=2).collect()] == [3, 4]
    for call in (lambda: K.users_in_segment(got, "vip"), lambda: K.users_in_segment(got, "active", limit=0)):
        with pytest.raises(ValueError):
            call()


def test_soft_delete_drops_null_status(spark):
    df = spark.createDataFrame([("active",), ("deleted",), (None,)], "status string")
    assert rows(M.without_soft_deleted(df)) == [("active",)]


def test_metric_queries(spark, data):
    kpis = I.kpis(spark, data)
    day = kpis.first()["kpi_date"]
    assert K.kpi_on(kpis, day, metrics=["total_gmv"]).columns == ["kpi_date", "total_gmv", "metric_version"]
    with pytest.raises(ValueError):
        K.kpi_on(kpis, day, version="v9")


def test_completeness(spark):
    kpis = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 5, 7)], "kpi_date date")
    row = K.completeness(kpis, F.lit("2024-01-07")).first()
    assert row["partition_count"] == 4 and [d.day for d in row["missing_dates"]] == [3, 4, 6]
    assert [r[0].day for r in K.missing_days(kpis, F.lit("2024-01-07")).orderBy("kpi_date").collect()] == [3, 4, 6]
    empty = K.completeness(kpis, F.lit("2020-01-07")).first()
    assert empty["partition_count"] == 0 and len(empty["missing_dates"]) == 7


def test_orphans(facts):
    assert rows(K.orphan_payments(facts[1], facts[0])) == [(77, 1), (None, 1)]


def test_kpi_plan_reduces_payments_before_the_join(spark, data):
    plan = I.kpis(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "PythonUDF" not in plan and "NestedLoop" not in plan
    join = plan.split("Join")[1]
    assert "order_id" in join and "HashAggregate" in join


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, l string")
    right = spark.createDataFrame([(2, 1.0), (2, 2.0), (3, None), (9, 5.0), (None, 7.0)], "k int, r double")
    assert rows(left_join_many(left, right, ["k"])) == rows(left.join(right, ["k"], "left"))
