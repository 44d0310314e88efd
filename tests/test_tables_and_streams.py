import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import inputs as I
from tidemark.session import scratch_path, shared_root
from tidemark.sources import tables as S
from tidemark.sources import writeback as W
from tidemark.streaming import log as L
from tidemark.sources.bus import read_bus_files, read_bus_stream
from tidemark.workload import ALL


def test_compact_joins_small_files(spark, data):
    small, large = scratch_path(spark, "small"), scratch_path(spark, "large")
    I.table(spark, data, "events").repartition(20).write.partitionBy("event_type").parquet(small)
    result = S.compact(spark, small, large, ["event_type"], ["value"])
    assert result.count() == 5 and result.filter("files_after >= files_before").count() == 0
    assert rows(S.read_table(spark, large).select("event_id")) == rows(I.table(spark, data, "events").select("event_id"))


def test_compact_takes_partitions_with_small_files_only(spark):
    small, large = scratch_path(spark, "small"), scratch_path(spark, "large")
    part = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 8).cast("int")
    day = F.when(F.col("id") % 3 == 2, None).otherwise(F.concat(F.lit("d"), F.col("id") % 3))
    spark.range(600).withColumn("day", day).repartitionById(8, part).write.partitionBy("day").parquet(small)
    result = S.compact(spark, small, large, ["day"], ["id"], small_bytes=1 << 20)
    assert rows(result) == [("d1", 8, 1), (None, 8, 1)]
    assert spark.read.parquet(large).count() == 400
    # nothing is small at this size
    assert S.compact(spark, small, scratch_path(spark, "large"), ["day"], small_bytes=1).count() == 0
    whole = S.compact(spark, small, scratch_path(spark, "large"))
    assert rows(whole) == [(17, 1)]


def test_file_sizes_read_partition_columns_only(spark):
    path = scratch_path(spark, "wide")
    spark.range(50).select("id", F.lit("x").alias("wide"), (F.col("id") % 2).alias("half")).write.partitionBy("half").parquet(path)
    plan = S.file_sizes(spark.read.parquet(path), ["half"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_checksum_sees_a_changed_row(spark):
    a = spark.range(100).withColumn("v", F.col("id") * 1.5)
    b = a.withColumn("v", F.when(F.col("id") == 7, 0.0).otherwise(F.col("v")))
    assert S.same_checksum(S.checksum(a, ["v"]), S.checksum(a.orderBy(F.desc("id")), ["v"])).first()["all_equal"]
    flags = S.same_checksum(S.checksum(a, ["v"]), S.checksum(b, ["v"])).first()
    assert flags["row_count"] and not flags["sum_v"] and not flags["content_hash"] and not flags["all_equal"]


def test_copy_and_log_table(spark, data):
    counts = S.copy_verified(I.table(spark, data, "nation"), scratch_path(spark, "copy"))
    assert counts == {"source_rows": 25, "target_rows": 25}
    S.ensure_log_table(spark, "log_db.raw_changes")
    S.ensure_log_table(spark, "log_db.raw_changes")
    assert S.read_table(spark, "log_db.raw_changes").columns[-1] == "ingest_date"


def test_shared_root_is_the_checkpoint_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_upsert_is_idempotent(spark):
    columns = "user_id string, segment_date date, value_segment string, activity_segment string, last_90d_gmv decimal(18,2), is_churn_risk int, is_active int, source_run_id string, last_updated_at timestamp"
    target = spark.createDataFrame([], columns)
    segments = spark.sql("select 1L user_id, date'2024-01-01' segment_date, 'high_value' value_segment, 'active' activity_segment, cast(null as decimal(18,2)) last_90d_gmv, 0 is_churn_risk, 1 is_active")
    batch = W.segment_rows(segments, "r1", F.lit("2024-01-02"))
    once = W.upsert_segments(target, batch)
    assert rows(W.upsert_segments(once, batch)) == rows(once) and once.schema == target.schema
    assert tuple(W.upsert_counts(once, batch).first()) == (0, 1, 1)
    assert W.rollback_run(once, "r1").isEmpty()


def test_database_upsert_sends_batches(spark, tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE seg (user_id TEXT, segment_date TEXT, value_segment TEXT, PRIMARY KEY (user_id, segment_date))")

    def connect():
        return sqlite3.connect(path, timeout=30)

    def frame(label):
        return spark.range(5).select(F.col("id").cast("string").alias("user_id"), F.lit("2024-01-01").alias("segment_date"), F.lit(label).alias("value_segment")).coalesce(1)

    for label in ("old", "new"):
        W.upsert_partitions(frame(label), connect, "seg", batch_size=2, placeholder="?")
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT count(*), min(value_segment) FROM seg").fetchone() == (5, "new")


def test_refresh_from_itself_and_open_readers(spark):
    path = scratch_path(spark, "refreshed")
    S.refresh_table(spark.range(10).select("id", (F.col("id") % 2).alias("half")), path, ["half"])
    opened = S.read_table(spark, path)
    assert opened.columns == ["id", "half"]
    S.refresh_table(opened.select((F.col("id") + 100).alias("id"), "half"), path, ["half"])
    # the plan read its own target, and a reader of the version before stays whole
    assert rows(S.read_table(spark, path).select("id")) == [(i,) for i in range(100, 110)]
    assert rows(opened.select("id")) == [(i,) for i in range(10)]
    assert S.refresh_table(S.read_table(spark, path), path) == 2 and len(list(Path(path).glob("version-*"))) == 2


def test_half_written_refresh_is_not_seen(spark):
    path = scratch_path(spark, "refreshed")
    S.refresh_table(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        S.refresh_table(spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id")), path)
    assert S.read_table(spark, path).count() == 3


def test_bad_message_stops_the_stream(spark, data):
    bus = scratch_path(spark, "bus")
    I.damaged_messages(spark, data).write.parquet(bus)
    query = L.start_log(read_bus_files(spark, bus), scratch_path(spark, "log"), scratch_path(spark, "ckpt"))
    with pytest.raises(Exception, match="contract violation"):
        query.awaitTermination()


def test_bus_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        read_bus_stream(spark, "host:9092", "a,b", max_offsets_per_trigger=10)
    messages = spark.createDataFrame([("1", "{}")], "key string, value string")
    with pytest.raises(Exception, match="kafka"):
        W.publish_messages(messages, "host:9092", "segments")


def test_one_landed_file_feeds_several_tasks(spark):
    import pyarrow.parquet as pq
    from tidemark.workload.streams import _land

    bus = scratch_path(spark, "bus")
    text = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f"|{i}")), 256) for i in range(8)])
    _land(spark.range(80_000, numPartitions=1).select(text.alias("value")), bus)
    files = list(Path(bus).glob("*.parquet"))
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 1


def test_messages_format_a_moment_once(spark, data):
    plan = I.change_messages(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format(") == 3


@pytest.mark.parametrize("name", ["stream_log_restart", "stream_deduplicated", "stream_entities", "stream_quarantine", "stream_event_rate"])
def test_streams_end_where_batches_end(spark, data, name):
    check(spark, data, name)


def check(spark, data, name):
    import duckdb

    duck = duckdb.connect()
    for table in ("customer", "orders", "lineitem", "events", "nation", "region"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    df = ALL[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(map(repr, r)) for r in df.select(*columns).collect())
    cursor = duck.execute(ALL[name].sql)
    names = [c[0] for c in cursor.description]
    want = sorted(tuple(repr(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["kpis_daily", "kpis_daily_any_keys", "kpis_daily_v1", "user_segments", "merge_orders", "bucketed_store_orders", "segments_upsert", "check_suite", "offset_gaps"])
def test_headline_queries_match_sql(spark, data, name):
    check(spark, data, name)


def test_every_query_has_sql_and_entry_runs(spark):
    import __spark_entry__ as entry

    # queries of the optional part are tested with it
    assert ALL.keys() <= entry.queries().keys()
    assert all(query.sql for query in ALL.values()) and ALL.keys() <= entry.oracle_sql().keys()
    assert entry.entry(spark).count() > 0


def test_checksum_counts_copies(spark):
    a, b = (spark.createDataFrame([(v,) for v in rows], "v int") for rows in ([1, 1, 3], [2, 2, 3]))
    assert not S.same_checksum(S.checksum(a), S.checksum(b)).first()["all_equal"]
