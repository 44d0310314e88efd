import random
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.test_envelope import DELETE, ORDERS, changed, messages
from tidemark.operators import envelope as E
from tidemark.operators import merge as G
from tidemark.session import scratch_path
from tidemark.sources.tables import EntityStore, empty_entity, with_ingest_date
from tidemark.streaming.entities import ingest_window, replay

SPEC = G.ENTITY_SPECS["orders"]
AT = "2026-02-01 00:00:00"


def event(op, order_id, lsn, amount=1.0, **extra):
    image = {"order_id": order_id, "user_id": 7, "order_ts": "2026-01-15T12:00:00Z", "status": "paid", "total_amount": amount, "updated_at": "2026-01-15T12:00:00Z", **extra}
    return changed(DELETE, op=op, source={"lsn": lsn}, before=image if op == "d" else None, after=None if op == "d" else image)


def log_of(spark, *events):
    return E.to_log(messages(spark, *[(ORDERS, None, e) for e in events]))


def fold(log):
    return G.fold_log(log, SPEC, F.lit(AT))


def state(df):
    return rows(G.live_rows(df).select("order_id", F.col("total_amount").cast("string"), "_bronze_ordering_key"))


def random_events(seed, n=120):
    rng = random.Random(seed)
    return [event(rng.choice("ccuuud"), rng.randint(1, 12), lsn, round(rng.random() * 100, 2)) for lsn in range(1, n + 1)]


def expected(events):
    """Brute force: the last event of each order by log position."""
    last = {}
    for e in events:
        image = e["after"] or e["before"]
        if image["order_id"] not in last or e["source"]["lsn"] > last[image["order_id"]][0]:
            last[image["order_id"]] = (e["source"]["lsn"], e["op"], image["total_amount"])
    return sorted((k, f"{v[2]:.2f}") for k, v in last.items() if v[1] != "d")


def amounts(df):
    return sorted((r[0], r[1]) for r in state(df))


def test_latest_event_wins(spark):
    events = random_events(1)
    assert amounts(fold(log_of(spark, *events))) == expected(events)


def test_any_split_and_order_of_batches_gives_the_same_table(spark):
    events = random_events(2)
    whole = fold(log_of(spark, *events))
    log = log_of(spark, *events).withColumn("n", F.regexp_extract("ordering_key", "lsn_0*([0-9]+)", 1).cast("int")).persist()
    for seed in (3, 4):
        batches = [log.filter(F.pmod(F.col("n") * seed, F.lit(3)) == i).drop("n") for i in range(3)]
        random.Random(seed).shuffle(batches)
        table = empty_entity(spark, SPEC)
        for batch in batches:
            table = G.merge_changes(table, fold(batch), SPEC)
        assert amounts(table) == amounts(whole) == expected(events)


def test_replay_changes_nothing(spark):
    log = log_of(spark, *random_events(5))
    once = fold(log)
    twice = G.merge_changes(once, fold(log.unionByName(log)), SPEC)
    assert rows(once) == rows(twice)


def test_late_events_do_not_revive_or_remove(spark):
    table = fold(log_of(spark, event("d", 1, 50), event("u", 2, 60, 5.0)))
    late = fold(log_of(spark, event("u", 1, 40, 9.0), event("d", 2, 30)))
    assert amounts(G.merge_changes(table, late, SPEC)) == [(2, "5.00")]


def test_equal_ordering_key_keeps_the_target(spark):
    table = fold(log_of(spark, event("u", 1, 10, 1.0)))
    other = table.withColumn("total_amount", F.lit(9).cast("decimal(18,2)"))
    assert amounts(G.merge_changes(table, other, SPEC)) == [(1, "1.00")]


@pytest.mark.parametrize("encoding,first,second", [("either", "99.99", "12.50"), ("bytes", "99.99", None), ("number", None, "12.50")])
def test_base64_decimals(spark, encoding, first, second):
    """The contract says how decimals are written; only a source that mixes both forms is read by guessing."""
    spec = replace(SPEC, encodings=(("total_amount", encoding),))
    table = G.fold_log(log_of(spark, event("c", 1, 1, "Jw8="), event("c", 2, 2, 12.5), event("c", 3, 3, None)), spec, F.lit(AT))
    assert [(a, b) for a, b, _ in state(table)] == [(1, first), (2, second), (3, None)]
    assert SPEC.encodings == ()


def test_new_field_reaches_the_table(spark):
    wider = replace(SPEC, payload=T.StructType([*SPEC.payload.fields, T.StructField("channel", T.StringType())]))
    old = fold(log_of(spark, event("c", 1, 1), event("c", 2, 2)))
    new = G.fold_log(log_of(spark, event("u", 2, 3, channel="web"), event("c", 3, 4)), wider, F.lit(AT))
    got = rows(G.live_rows(G.merge_changes(old, new, wider)).select("order_id", "channel"))
    assert got == [(1, None), (2, "web"), (3, None)]


def test_key_from_message_key(spark):
    delete = changed(DELETE, before={}, source={"lsn": 9})
    log = E.to_log(messages(spark, (ORDERS, {"order_id": 4}, delete)))
    row = fold(log).first()
    assert row["order_id"] == 4 and row["_deleted"]


def test_mixed_prefixes(spark):
    log = log_of(spark, event("c", 1, 5), changed(event("u", 1, 6), source={}), event("c", 2, 7))
    assert rows(G.mixed_ordering_prefixes(log)) == [("orders", "1", 1, 1)]


def test_hot_key_is_pruned_before_the_shuffle(spark):
    plan = G.latest_events(log_of(spark, event("c", 1, 5)), "orders")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def store_at(spark, **how):
    return EntityStore(spark, scratch_path(spark, "store"), SPEC, **{"buckets": 4, **how}).ensure()


def live(store):
    return sorted((r["order_id"], str(r["total_amount"])) for r in store.read().collect())


def test_store_appends_settles_and_reads(spark):
    store = store_at(spark)
    events = random_events(6)
    log = log_of(spark, *events).withColumn("n", F.regexp_extract("ordering_key", "lsn_0*([0-9]+)", 1).cast("int")).persist()
    parts = [log.filter(F.col("n") % 3 == i).drop("n") for i in (2, 0, 1)]
    store.append(fold(parts[0]))
    store.append(fold(parts[1]))
    store.append(fold(parts[1]))
    assert store.version() == 0 and store.due(0.5)
    pending = amounts(store.merged_plan(store.pending()))
    assert store.settle() == 1 and amounts(store.stored()) == pending and not store.due(0.0)
    before = store.read()
    store.append(fold(parts[2]))
    assert live(store) == expected(events)
    assert store.settle() == 2 and store.settle() == 2
    # a reader of the version before stays whole, older ones are gone
    assert before.count() == len(pending)
    assert len(list(Path(store.location).glob("version-*"))) == 2


def test_second_process_opens_the_store(spark):
    """Another process without this one's catalog appends, settles and reads; this one sees it."""
    store, events = store_at(spark), random_events(11)
    store.merge(fold(log_of(spark, *events[:20])))
    store.append(fold(log_of(spark, *events[20:40])))
    rest = scratch_path(spark, "rest")
    fold(log_of(spark, *events[40:])).write.parquet(rest)
    code = f"""
from tidemark.operators.merge import ENTITY_SPECS
from tidemark.session import build_session
from tidemark.sources.tables import EntityStore
spark = build_session("other", "local[2]", spark__sql__shuffle__partitions="3")
store = EntityStore(spark, {store.location!r}, ENTITY_SPECS["orders"], buckets=99).ensure()
store.append(spark.read.parquet({rest!r}))
assert store.settle() == 2 and store._state()[1]["buckets"] == 4
print(sorted((r["order_id"], str(r["total_amount"])) for r in store.read().collect()))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parents[1])
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.strip().splitlines()[-1] == repr(expected(events))
    assert store.version() == 2 and live(store) == expected(events)


def test_of_two_writers_one_fails(spark):
    store = store_at(spark)
    number, state = store._state()
    store.append(fold(log_of(spark, event("c", 1, 5))))
    with pytest.raises(Exception, match="[Ee]xist"):
        store.log.add(number + 1, state)
    assert live(store) == expected([event("c", 1, 5)])


@pytest.mark.parametrize("width", [2, 4, 9])
def test_store_merge_does_not_shuffle_the_table(spark, width):
    """Neither below, at nor above the number of buckets."""
    store = store_at(spark)
    store.merge(fold(log_of(spark, *random_events(7))))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for merged in (store.merged_plan(fold(log_of(spark, event("u", 1, 500)))), pending_merge(store, spark)):
            plan = merged._jdf.queryExecution().executedPlan().toString()
            joined = plan.split("FullOuter")[1]
            scan = next(line for line in joined.splitlines() if "FileScan" in line and "Bucketed: true" in line)
            above = joined[: joined.index(scan)].splitlines()
            assert not any("Exchange" in line for line in above)
            assert "hashpartitioning(order_id" in plan and ", 4)" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def pending_merge(store, spark):
    store.append(fold(log_of(spark, event("u", 1, 600))))
    return store.read()


def test_grown_buckets_are_divided(spark):
    store, events = store_at(spark, buckets=2, bucket_rows=3), random_events(12)
    store.append(fold(log_of(spark, *events)))
    store.settle()
    assert store._state()[1]["buckets"] >= 4 and live(store) == expected(events)
    store.merge(fold(log_of(spark, event("c", 9999, 9999))))
    assert live(store) == [*expected(events), (9999, "1.00")]


def test_older_store_takes_a_new_field(spark):
    store = store_at(spark)
    store.merge(fold(log_of(spark, event("c", 1, 1), event("c", 2, 2))))
    wider = replace(SPEC, payload=T.StructType([*SPEC.payload.fields, T.StructField("channel", T.StringType())]))
    again = EntityStore(spark, store.location, wider).ensure()
    again.append(G.fold_log(log_of(spark, event("u", 2, 3, channel="web"), event("c", 3, 4)), wider, F.lit(AT)))
    assert rows(again.read().select("order_id", "channel")) == [(1, None), (2, "web"), (3, None)]
    again.settle()
    assert rows(again.read().select("order_id", "channel")) == [(1, None), (2, "web"), (3, None)]


def test_replay_of_a_window(spark):
    store = store_at(spark)
    events = random_events(8)
    log = log_of(spark, *events).persist()
    at = log.withColumn("ingest_time", F.timestamp_seconds(F.regexp_extract("ordering_key", "lsn_0*([0-9]+)", 1).cast("bigint"))).persist()
    replay(at, {"orders": store}, start="1970-01-01 00:01:00")
    replay(at, {"orders": store}, end="1970-01-01 00:01:00")
    first = amounts(store.stored())
    replay(at, {"orders": store})
    assert amounts(store.stored()) == first == expected(events)


def test_window_prunes_days_of_the_log(spark):
    path = scratch_path(spark, "log")
    log = log_of(spark, *random_events(8)).withColumn("ingest_time", F.timestamp_seconds(F.col("kafka_offset") * 86_400))
    with_ingest_date(log).write.partitionBy("ingest_date").parquet(path)
    window = ingest_window(spark.read.parquet(path), "1970-01-03 12:00:00", "1970-01-05")
    plan = window._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ingest_date" in filters and ">=" in filters and "<=" in filters
    moments = [r[0] for r in window.select(F.unix_seconds("ingest_time")).collect()]
    assert all(2.5 * 86_400 <= m < 4 * 86_400 for m in moments)


def test_settle_after_a_crash_before_publishing(spark):
    store = store_at(spark)
    events = random_events(9)
    store.append(fold(log_of(spark, *events)))
    # the next version was written, but the writer died before naming it
    store.stored().write.parquet(store.log.path(store.log.folder("version")))
    assert store.version() == 0 and live(store) == expected(events)
    assert store.settle() == 1 and amounts(store.stored()) == expected(events)
