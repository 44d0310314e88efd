"""Streaming operators, run to the end of the available input."""

from pyspark.sql import functions as F

from tidemark.operators import merge as G
from tidemark.plans import inputs as I
from tidemark.session import scratch_path
from tidemark.sources.bus import read_bus_files
from tidemark.sources.tables import EntityStore
from tidemark.streaming import entities, log, rates
from tidemark.workload.entities import ALL_ROWS, MIDDLE, all_rows, stores
from tidemark.workload.registry import Registry
from tidemark.workload.sql import LOG, with_

QUERIES = Registry()
add = QUERIES.add

_COLUMNS = ["event_uid", "entity", "entity_key", "ordering_key", "op", "ts_ms"]


def _at():
    return F.lit(I.EVENTS_AS_OF)


def _land(messages, path):
    # small row groups: a batch of few files is still read by all tasks
    messages.write.mode("append").option("parquet.block.size", 4 << 20).parquet(path)


def _log_append(s, d):
    bus, out, ckpt = (scratch_path(s, n) for n in ("bus", "log", "ckpt"))
    _land(I.change_messages(s, d), bus)
    log.start_log(read_bus_files(s, bus), out, ckpt, ingest_time=_at()).awaitTermination()
    return s.read.parquet(out).select(*_COLUMNS)


def _log_restart(s, d):
    """The ingest stops between two landings and goes on from its checkpoint."""
    bus, out, ckpt = (scratch_path(s, n) for n in ("bus", "log", "ckpt"))
    messages = I.change_messages(s, d)
    for part in (F.col("timestamp") < MIDDLE, F.col("timestamp") >= MIDDLE):
        _land(messages.filter(part), bus)
        log.start_log(read_bus_files(s, bus, 4), out, ckpt, ingest_time=_at()).awaitTermination()
    return s.read.parquet(out).select(*_COLUMNS)


def _quarantine(s, d):
    bus, out, ckpt = (scratch_path(s, n) for n in ("bus", "bad", "ckpt"))
    _land(I.damaged_messages(s, d), bus)
    log.start_quarantine(read_bus_files(s, bus), out, ckpt).awaitTermination()
    return (
        s.read.parquet(out)
        .groupBy(F.array_join("violations", "; ").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _deduplicated(s, d):
    """Every message is delivered twice."""
    bus, out, ckpt = (scratch_path(s, n) for n in ("bus", "once", "ckpt"))
    messages = I.change_messages(s, d)
    _land(messages.unionByName(messages), bus)
    from tidemark.operators.envelope import to_log

    stream = to_log(read_bus_files(s, bus), ingest_time=_at()).withColumn(
        "event_time", F.timestamp_millis("kafka_timestamp")
    )
    once = log.deduplicated(stream, "event_time", "1 hour").select(*_COLUMNS)
    log.append_stream(once, out, ckpt).awaitTermination()
    return s.read.parquet(out)


def _entities(s, d):
    """All topics land twice; between the landings the stream stops, and a session that knows only the locations goes on."""
    bus, out = scratch_path(s, "bus"), scratch_path(s, "log")
    ckpt = [scratch_path(s, "ckpt") for _ in range(2)]
    places = {e: store.location for e, store in stores(s).items()}
    messages = I.change_messages(s, d)
    for part in (F.col("timestamp") < MIDDLE, F.col("timestamp") >= MIDDLE):
        _land(messages.filter(part), bus)
        log.start_log(read_bus_files(s, bus), out, ckpt[0], ingest_time=_at()).awaitTermination()
        session = s.newSession()
        session.conf.set("spark.sql.session.timeZone", "UTC")
        opened = {e: EntityStore(session, place, G.ENTITY_SPECS[e]) for e, place in places.items()}
        stream = session.readStream.schema(s.read.parquet(out).schema).parquet(out)
        entities.start_entities(stream, opened, ckpt[1]).awaitTermination()
    return all_rows({e: EntityStore(s, place, G.ENTITY_SPECS[e]).read() for e, place in places.items()})


def _events(s, d):
    schema = I.table(s, d, "events").schema
    return s.readStream.schema(schema).parquet(f"{d}/events*.parquet")


def _event_rate(s, d):
    out, ckpt = scratch_path(s, "rate"), scratch_path(s, "ckpt")
    windows = rates.rate_stream(_events(s, d), "ts", "6 hours", "1 hour", ["event_type"])
    log.append_stream(windows, out, ckpt).awaitTermination()
    return s.read.parquet(out)


def _sessions(s, d):
    out, ckpt = scratch_path(s, "sessions"), scratch_path(s, "ckpt")
    bursts = rates.session_stream(_events(s, d), "ts", "2 hours", "1 hour", ["user_id"])
    log.append_stream(bursts, out, ckpt).awaitTermination()
    return s.read.parquet(out)


def _landed(s, d):
    """Events as they land in four days: by event time in three parts, but every seventh event one day later and every eleventh two."""
    third = F.when(F.col("ts") < "2024-01-11", 1).when(F.col("ts") < "2024-01-21", 2).otherwise(3)
    delayed = F.when(F.col("event_id") % 11 == 0, 2).when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    return I.table(s, d, "events").withColumn("landing", F.least(third + delayed, F.lit(4)))


def _land_in_turn(s, d, start):
    """Each landing is streamed to its end before the next one comes."""
    landed, bus = _landed(s, d), scratch_path(s, "bus")
    for number in range(1, 5):
        landed.filter(F.col("landing") == number).write.mode("append").parquet(bus)
        start(s.readStream.schema(landed.schema).parquet(bus)).awaitTermination()
    return s.read.schema(landed.schema).parquet(bus)


_RATE = ("ts", "6 hours", "12 hours", ["event_type"])


def _late_rows(s, d):
    """The stream's own windows beside the rows that it dropped and those that it still holds."""
    out, ckpt = scratch_path(s, "rate"), scratch_path(s, "ckpt")
    landed = _land_in_turn(s, d, lambda stream: log.append_stream(rates.rate_stream(stream, *_RATE), out, ckpt))
    return rates.reconcile_windows(landed, s.read.parquet(out), *_RATE)


def _late_events(s, d):
    marked = rates.with_lateness(_landed(s, d), "ts", "landing", "6 hours", "12 hours")
    return marked.filter(F.col("lateness") != "kept").select("event_id", "event_type", "window_end", "lateness")


def _windows_by_state(s, d):
    return rates.windows_by_state(rates.with_lateness(_landed(s, d), "ts", "landing", "6 hours", "12 hours"), ["event_type"])


_LATENESS = """
landed AS (
  SELECT event_id, event_type, CAST(ts AS TIMESTAMP) AS ts,
    least(4, CASE WHEN ts < '2024-01-11' THEN 1 WHEN ts < '2024-01-21' THEN 2 ELSE 3 END
      + CASE WHEN event_id % 11 = 0 THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS landing
  FROM events
), marks AS (
  SELECT l.landing, date_trunc('millisecond', max(e.ts)) - INTERVAL 12 HOUR AS watermark
  FROM range(1, 6) l(landing) JOIN landed e ON e.landing < l.landing GROUP BY l.landing
), placed AS (
  SELECT e.*, time_bucket(INTERVAL 6 HOUR, e.ts, TIMESTAMP '2024-01-01') AS window_start, m.watermark,
    (SELECT watermark FROM marks WHERE landing = 5) AS last_watermark
  FROM landed e LEFT JOIN marks m ON m.landing = e.landing
), marked AS (
  SELECT event_id, event_type, window_start, window_start + INTERVAL 6 HOUR AS window_end,
    CASE WHEN window_start + INTERVAL 6 HOUR <= watermark THEN 'late' WHEN window_start + INTERVAL 6 HOUR > last_watermark THEN 'open' ELSE 'kept' END AS lateness
  FROM placed
)"""
_STATES = with_(
    _LATENESS,
    "SELECT window_start, window_end, event_type, "
    + ", ".join(f"CAST(COUNT(*) FILTER (lateness = '{state}') AS BIGINT) AS {state}" for state in ("kept", "late", "open"))
    + " FROM marked GROUP BY 1, 2, 3",
)
_BRONZE = with_(LOG, f"SELECT {', '.join(_COLUMNS)} FROM bronze")
add("stream_log_append", _log_append, _BRONZE)
add("stream_log_restart", _log_restart, _BRONZE)
add("stream_deduplicated", _deduplicated, _BRONZE)
add(
    "stream_quarantine",
    _quarantine,
    "SELECT CASE event_type WHEN 'view' THEN 'missing envelope field source' WHEN 'click' THEN 'invalid op x' "
    "WHEN 'error' THEN 'after must be null for op d' ELSE 'after is required for op c' END AS reason, "
    "CAST(COUNT(*) AS BIGINT) AS n FROM events WHERE event_type <> 'signup' GROUP BY 1",
)
add("stream_entities", _entities, with_(LOG, ALL_ROWS))
add("stream_late_rows", _late_rows, _STATES)
add("windows_by_state", _windows_by_state, _STATES)
add("late_events", _late_events, with_(_LATENESS, "SELECT event_id, event_type, window_end, lateness FROM marked WHERE lateness <> 'kept'"))
add(
    "stream_event_rate",
    _event_rate,
    "SELECT time_bucket(INTERVAL 6 HOUR, CAST(ts AS TIMESTAMP), TIMESTAMP '2024-01-01') AS window_start, "
    "time_bucket(INTERVAL 6 HOUR, CAST(ts AS TIMESTAMP), TIMESTAMP '2024-01-01') + INTERVAL 6 HOUR AS window_end, event_type, "
    "CAST(COUNT(*) AS BIGINT) AS events FROM events GROUP BY 1, 2, 3 "
    "HAVING window_end <= (SELECT date_trunc('millisecond', MAX(CAST(ts AS TIMESTAMP))) - INTERVAL 1 HOUR FROM events)",
)
add(
    "stream_sessions",
    _sessions,
    "WITH marked AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, CASE WHEN CAST(ts AS TIMESTAMP) < "
    "lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events), "
    "numbered AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM marked) "
    "SELECT MIN(ts) AS session_start, MAX(ts) + INTERVAL 2 HOUR AS session_end, user_id, CAST(COUNT(*) AS BIGINT) AS events "
    "FROM numbered GROUP BY user_id, n HAVING session_end <= "
    "(SELECT date_trunc('millisecond', MAX(CAST(ts AS TIMESTAMP))) - INTERVAL 1 HOUR FROM events)",
)
