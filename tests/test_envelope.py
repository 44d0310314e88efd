import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import envelope as E
from tidemark.sources.bus import BUS_SCHEMA, decode_text

USERS = "dbserver_docker.public.users"
ORDERS = "dbserver_docker.public.orders"
INSERT = {
    "before": None,
    "after": {"user_id": 1, "email": "ada@mail.test", "status": "active", "created_at": "2023-11-14T22:13:20Z", "updated_at": "2023-11-14T22:13:20Z"},
    "source": {"db": "shop", "schema": "public", "table": "users", "lsn": 700001},
    "op": "c",
    "ts_ms": 1700000000123,
}
DELETE = {
    "before": {"order_id": 1, "user_id": 1, "status": "shipped", "total_amount": 12.5, "updated_at": "2023-11-15T06:30:00Z"},
    "after": None,
    "source": {"db": "shop", "schema": "public", "table": "orders", "lsn": 700452},
    "op": "d",
    "ts_ms": 1700030000456,
}


def messages(spark, *items):
    """Items are (topic, key, value); a value may be a dict, raw text, bytes or None."""
    data = []
    for i, (topic, key, value) in enumerate(items, 1):
        body = json.dumps(value).encode() if isinstance(value, dict) else value.encode() if isinstance(value, str) else value
        data.append((topic, 0, i, dt.datetime(2023, 5, 6, 7), None if key is None else json.dumps(key).encode(), body))
    return spark.createDataFrame(data, BUS_SCHEMA)


def problems(spark, *items, field_rules=False):
    df = E.with_violations(E.open_envelope(messages(spark, *items)), field_rules=field_rules)
    return [r["violations"] for r in df.orderBy("kafka_offset").collect()]


def changed(base, drop=(), **updates):
    return {k: v for k, v in {**base, **updates}.items() if k not in drop}


def test_insert_and_delete(spark):
    log = E.to_log(messages(spark, (USERS, {"user_id": 1}, INSERT), (ORDERS, {"order_id": 1}, DELETE)))
    first, second = log.orderBy("kafka_offset").collect()
    assert first["event_uid"] == f"{USERS}|0|1" and first["entity"] == "users" and first["entity_key"] == "1"
    assert first["ordering_key"] == "lsn_00000000000000700001|p000000|o00000000000000000001"
    assert first["ts_ms"] == 1700000000123 and first["before"] is None and json.loads(first["after"]) == INSERT["after"]
    assert first["ingest_time"] is not None and first["kafka_timestamp"] == 1683356400000
    assert second["entity_key"] == "1" and second["after"] is None and second["op"] == "d"
    assert [f.name for f in log.schema.fields] == E.LOG_SCHEMA.names
    assert log.schema.simpleString() == E.LOG_SCHEMA.simpleString()


@pytest.mark.parametrize(
    "source,after,head",
    [
        ({"lsn": "77"}, {"user_id": 1}, "lsn_00000000000000000077"),
        ({}, {"user_id": 1, "updated_at": "2026-01-15T12:00:00.123456789Z"}, "ts_2026-01-15T12:00:00.123456"),
        ({"lsn": None}, {"user_id": 1, "updated_at": 1700000000123}, "ts_00000001700000000123"),
        ({}, {"user_id": 1, "updated_at": 1700000000123123457}, "ts_01700000000123123457"),
        ({}, {"user_id": 1, "updated_at": 1700000000123.75}, "ts_00000001700000000123"),
        ({"lsn": "no"}, {"user_id": 1, "updated_at": "1700000000123"}, "ts_1700000000123"),
        ({}, {"user_id": 1}, "ts_0"),
    ],
)
def test_ordering_keys(spark, source, after, head):
    opened = E.open_envelope(messages(spark, (USERS, None, changed(INSERT, source=source, after=after))))
    assert opened.first()["ordering_key"] == f"{head}|p000000|o00000000000000000001"


def test_entity_key_falls_back_to_message_key(spark):
    value = changed(DELETE, before=None)
    row = E.open_envelope(messages(spark, (ORDERS, {"order_id": 9}, value))).first()
    assert row["entity_key"] == "9"


def test_composite_key(spark):
    df = spark.createDataFrame([("c", None, '{"a": 1, "b": "x"}', '{}'), ("c", None, '{"a": 1}', '{"b": 2}'), ("c", None, '{"a": 1}', '{}')], "op string, before string, after string, key string")
    got = [r[0] for r in df.select(E.entity_key(F.col("op"), F.col("before"), F.col("after"), F.col("key"), ("a", "b"))).collect()]
    assert got == ["1|x", "1|2", None]


def test_values_are_looked_up_once(spark):
    opened = E.open_envelope(messages(spark, (USERS, None, INSERT)))
    plan = opened.select("ordering_key", "entity_key")._jdf.queryExecution().optimizedPlan().toString()
    # the position, the time where there is none, and each key in the row image and the message key
    assert plan.count("$.lsn)") == 1 and plan.count("get_json_object") == 2 + 2 * 3


@pytest.mark.parametrize(
    "after,head",
    [
        ({"updated_at": 2024}, "ts_00000000000000002024"),
        ({"updated_at": "2024"}, "ts_2024"),
        ({"updated_at": -7.5}, "ts_-0000000000000000007"),
        ({"updated_at": 20240116}, "ts_00000000000020240116"),
        ({"updated_at": "2024-01-16T00:00:00.123456789Z"}, "ts_2024-01-16T00:00:00.123456"),
        ({"updated_at": None}, "ts_0"),
        ({}, "ts_0"),
    ],
)
def test_keys_of_times_and_numbers(spark, after, head):
    opened = E.open_envelope(messages(spark, (USERS, None, changed(INSERT, source={}, after=after))))
    assert opened.first()["ordering_key"] == f"{head}|p000000|o00000000000000000001"
    texts = [F.lit("{}"), F.lit(json.dumps(after)), F.lit(0), F.lit(1)]
    assert spark.range(1).select(E.ordering_key(*texts)).first()[0] == opened.first()["ordering_key"]


def test_valid_events_have_no_violation(spark):
    assert problems(spark, (USERS, None, INSERT), (ORDERS, None, DELETE), field_rules=True) == [[], []]


@pytest.mark.parametrize(
    "topic,value,expected",
    [
        (USERS, changed(INSERT, drop=("source",)), "missing envelope field source"),
        (USERS, changed(INSERT, drop=("op",)), "missing envelope field op"),
        (USERS, changed(INSERT, op="x"), "invalid op x"),
        (USERS, changed(INSERT, after=None), "after is required for op c"),
        (ORDERS, changed(DELETE, after={"order_id": 1}), "after must be null for op d"),
        (ORDERS, changed(DELETE, drop=("before",)), "before is required for op d"),
        (USERS, changed(INSERT, after={"email": "a"}), "primary key not found"),
        (USERS, "{broken", "value is not a JSON object"),
        (USERS, "", "empty message value"),
        (USERS, None, "empty message value"),
        ("other.topic", INSERT, "unknown topic other.topic"),
    ],
)
def test_violations(spark, topic, value, expected):
    assert expected in problems(spark, (topic, None, value))[0]


def test_null_source_is_present(spark):
    """The envelope rule is about presence; a null value is present."""
    assert problems(spark, (USERS, None, changed(INSERT, source=None))) == [[]]


@pytest.mark.parametrize(
    "after,expected",
    [
        ({"user_id": 1, "status": "nope"}, ["field status has value not allowed: nope"]),
        ({"user_id": 1, "status": None}, ["field status has value not allowed: null"]),
        ({"user_id": 1}, []),
    ],
)
def test_field_rules(spark, after, expected):
    assert problems(spark, (USERS, None, changed(INSERT, after=after)), field_rules=True) == [expected]


def test_constraint_rule(spark):
    order = changed(DELETE, op="u", before=None, after={"order_id": 1, "user_id": None, "total_amount": -5})
    assert problems(spark, (ORDERS, None, order), field_rules=True) == [["field user_id must not be null", "field total_amount breaks >= 0"]]


def test_fail_fast_names_the_event(spark):
    log = E.to_log(messages(spark, (USERS, None, INSERT), (USERS, None, changed(INSERT, op="x"))))
    with pytest.raises(PySparkException, match="contract violation in .*users.0.2: invalid op x"):
        log.collect()


def test_drop_keeps_valid_rows(spark):
    source = messages(spark, (USERS, None, INSERT), (USERS, None, changed(INSERT, op="x")))
    assert E.to_log(source, on_violation="drop").count() == 1
    assert E.rejected(E.with_violations(E.open_envelope(source))).first()["raw_value"].startswith("{")
    with pytest.raises(ValueError):
        E.to_log(source, on_violation="ignore")


def test_decode_replaces_bad_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xff"),)], "b binary")
    assert df.select(decode_text(F.col("b"))).first()[0] == "ok�"


def test_messages_are_parsed_once(spark):
    """No filter on the violations may end up below the parsing step."""
    plan = E.to_log(messages(spark, (USERS, None, INSERT)), on_violation="drop")._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("from_json" in line or "jsonObjectKeys" in line for line in filters)
