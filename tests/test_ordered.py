import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import checks as Q
from tidemark.operators.ordered import exact_quantile


def neighbours(data, ok):
    """Brute force over sorted (group, order, value) tuples."""
    bad, last = {}, {}
    for g, o, v in sorted(data):
        if g in last and not ok(v, last[g]):
            bad[(g, o, v, last[g])] = bad.get((g, o, v, last[g]), 0) + 1
        last[g] = v
    return sorted(((*k, n) for k, n in bad.items()), key=repr)


@pytest.mark.parametrize("groups,n,hot", [(1, 300, 0.0), (5, 400, 0.0), (3, 400, 0.5), (40, 200, 0.3)])
def test_increasing_matches_brute_force(spark, groups, n, hot):
    rng = random.Random(groups * n)
    data = [(0 if rng.random() < hot else rng.randrange(groups), rng.randrange(60), rng.randrange(20)) for _ in range(n)]
    df = spark.createDataFrame(data, "g int, o int, v int").repartition(7)
    got = Q.values_increasing(df, "v", "o", group_by=["g"]).select("g", "o", "v", "previous_v", "n_records")
    assert rows(got) == neighbours(data, lambda now, before: now > before)


def test_whole_table_and_equal_rows(spark):
    data = [(0, 5, 5)] * 50 + [(0, i, i) for i in range(20)]
    df = spark.createDataFrame(data, "g int, o int, v int")
    got = rows(Q.values_increasing(df, "v").select("v", "previous_v", "n_records"))
    assert got == [(5, 5, 50)]
    assert Q.values_increasing(df, "v", strictly=False).count() == 0


def test_no_task_gets_a_hot_group(spark):
    """One group with all rows is still spread over the ranges."""
    df = spark.range(0, 4000).select(F.floor(F.col("id") / 5000).alias("g"), "id")
    plan = Q.values_increasing(df, "id", group_by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(g" in plan and "partition_id(_range" in plan and "hashpartitioning(g" not in plan.split("rangepartitioning")[0]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.25, 0.5, 0.333, 0.9, 1.0])
def test_quantile_equals_builtin(spark, q):
    rng = random.Random(11)
    data = [(rng.randrange(3), float(rng.choice([1, 1, 1, rng.randrange(50)]))) for _ in range(500)] + [(9, 4.0), (8, None)]
    df = spark.createDataFrame(data, "g int, v double").persist()
    want = rows(df.filter("v is not null").groupBy("g").agg(F.percentile("v", q)))
    assert [(g, pytest.approx(v)) for g, v in want] == rows(exact_quantile(df, "v", q, ["g"]))
    whole = [v for _, v in data if v is not None]
    assert exact_quantile(df, "v", 0.5).first()[0] == statistics.median(whole)


@pytest.mark.parametrize("width", [1, 60])
def test_quantile_with_any_number_of_ranges(spark, width):
    """A value holds a third of the rows."""
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 700.0).otherwise(F.col("id") * 1.0).alias("v")).persist()
        for q in (0.01, 0.2, 0.37, 0.5, 0.993):
            want = df.agg(F.percentile("v", q)).first()[0]
            assert exact_quantile(df, "v", q).first()[0] == pytest.approx(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_quantile_scans_its_table_once(spark, tmp_path):
    """Ranges are cut by Spark, none by a list in the plan or by a sketch on the driver."""
    spark.range(4000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for rows in batches:
            seen.add(rows.num_rows)
            yield rows

    result = exact_quantile(df.mapInArrow(count, df.schema), "v", 0.3, ["g"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "t") not in plan and "MapInArrow" not in plan
    assert result.count() == 7 and seen.value == 4000


def test_quantile_of_hot_group_is_spread(spark):
    """A group with nearly all rows lies in many ranges; ranking reads only those with the wanted ranks."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(0).alias("g"), F.col("id").alias("v"))
        got = {r.g: r.quantile for r in exact_quantile(df, "v", 0.5, ["g"]).collect()}
        assert got == {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("q")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_quantile_bounds(spark):
    with pytest.raises(ValueError):
        exact_quantile(spark.range(1), "id", 1.5)
    assert exact_quantile(spark.range(0), "id", 0.5).first()[0] is None


def test_quantile_keeps_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "g int, v double")
    got = {r.g: r.quantile for r in exact_quantile(df, "v", 0.5, group_by=["g"]).collect()}
    assert got == {None: 2.0, 1: 5.0}
