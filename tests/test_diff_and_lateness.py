import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import diff
from tidemark.session import scratch_path
from tidemark.streaming import rates

SCHEMA = "part string, id long, name string, amount double"


def made(seed, n=300):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), r.choice([None, *range(60)]), r.choice([None, "", "x|1", "x"]), r.choice([None, 0.0, 1.5])) for _ in range(n)]


def plain(left, right, within):
    sides = []
    for side in (left, right):
        by_key = defaultdict(Counter)
        for row in side:
            by_key[(row[0], row[1]) if within else (row[1],)][row] += 1
        sides.append(by_key)
    found = []
    for key in sides[0].keys() | sides[1].keys():
        a, b = sides[0].get(key, Counter()), sides[1].get(key, Counter())
        if a != b:
            found.append((*key, "only_left" if not b else "only_right" if not a else "changed", a.total(), b.total()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("within", [None, "part"])
def test_differences_against_all_rows(spark, within):
    left = made(1)
    r = random.Random(2)
    right = [row for row in left if r.random() > 0.05] + made(3, 8) + [(None, None, None, None)]
    r.shuffle(right)
    got = diff.differing_rows(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["id"], 16, within)
    assert rows(got) == plain(left, right, within)


def test_equal_tables_and_empty_ones(spark):
    a, empty = spark.createDataFrame(made(4), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert diff.differing_rows(a, a.orderBy("amount"), ["id", "name"]).count() == 0
    assert diff.differing_rows(empty, empty, ["id"]).count() == 0
    assert {row.difference for row in diff.differing_rows(a, empty, ["id"]).collect()} == {"only_left"}


def test_neighbouring_texts_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a|1", ""), ("a", None), ("a", "")], "x string, y string")
    assert df.select(diff.digest_number(["x", "y"]).alias("d")).distinct().count() == 5


def test_equal_partitions_are_not_read_again(spark):
    left, right = scratch_path(spark, "left"), scratch_path(spark, "right")
    df = spark.range(4000).select("id", (F.col("id") % 5).cast("string").alias("day"))
    df.write.partitionBy("day").parquet(left)
    df.filter("id <> 7").write.partitionBy("day").parquet(right)
    got = diff.differing_rows(spark.read.parquet(left), spark.read.parquet(right), ["id"], 64, "day")
    plan = got._jdf.queryExecution().executedPlan().toString()
    # both scans take the one partition that holds the difference, and no other row of it is shuffled than those of one range
    assert plan.count("PartitionFilters: [isnotnull(day") == 2 and "day#" in plan and "= 2)" in plan
    assert "LeftSemi" in plan.split("Exchange hashpartitioning(day")[1]
    assert rows(got) == [(2, 7, "only_left", 1, 0)]


def test_lateness_of_each_row(spark):
    """Brute force: landings in turn, the watermark follows the newest event of those before."""
    r, start = random.Random(5), datetime(2024, 1, 1)
    data = []
    for i in range(400):
        landing = r.choice([None, 1, 2, 3])
        moment = start + timedelta(minutes=400 * (landing or 0) + r.randint(-900, 500))
        data.append((i, None if r.random() < 0.05 else moment, landing))
    marked = rates.with_lateness(spark.createDataFrame(data, "id int, ts timestamp, landing int"), "ts", "landing", "1 hour", "30 minutes")
    got = {row.id: row.lateness for row in marked.select("id", "lateness").collect()}

    def mark(earlier):
        newest = max((t for _, t, landing in data if t is not None and earlier(landing)), default=None)
        return newest and newest - timedelta(minutes=30)

    last = mark(lambda _: True)
    for i, t, landing in data:
        if t is None:
            assert got[i] == "untimed"
            continue
        end = t.replace(minute=0) + timedelta(hours=1)
        before = mark(lambda other, landing=landing: landing is not None and (other is None or other < landing))
        assert got[i] == ("late" if before and end <= before else "open" if end > last else "kept")
    assert {"late", "open", "kept", "untimed"} == set(got.values())
    # from the windows given out alone, the same
    windows = rates.windows_by_state(marked)
    given = windows.filter("kept > 0").select("window_start", "window_end", F.col("kept").alias("events"))
    again = rates.reconcile_windows(marked.select("ts"), given, "ts", "1 hour", "30 minutes")
    assert rows(again.select(*windows.columns)) == rows(windows)


def test_lateness_of_an_empty_log(spark):
    empty = spark.createDataFrame([], "ts timestamp, landing int")
    marked = rates.with_lateness(empty, "ts", "landing", "1 hour", "1 hour")
    assert marked.count() == 0 and rates.windows_by_state(marked).count() == 0
