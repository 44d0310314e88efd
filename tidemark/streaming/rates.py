"""Event-time monitoring of streams, and what became of late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.governance import event_rate
from tidemark.session import stored

__all__ = ["rate_stream", "session_stream", "with_lateness", "windows_by_state", "reconcile_windows"]


def _delayed(column: str, delay: str) -> Column:
    # a watermark counts in milliseconds
    return F.date_trunc("millisecond", F.col(column)) - F.expr(f"INTERVAL {delay}")


def rate_stream(
    stream: DataFrame, column: str, window: str, delay: str, group_by: Sequence[str] = ()
) -> DataFrame:
    """Events per tumbling window; rows later than ``delay`` are dropped by the watermark.

    The stream says neither how many rows it dropped nor what its open windows hold; ``reconcile_windows`` does.
    """
    timed = stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)
    return event_rate(timed, column, window, group_by)


def session_stream(
    stream: DataFrame, column: str, gap: str, delay: str, group_by: Sequence[str]
) -> DataFrame:
    """Bursts of events per key that are at most ``gap`` apart."""
    timed = stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)
    return (
        timed.groupBy(F.session_window(F.col(column), gap).alias("_w"), *group_by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *group_by, "events")
    )


def with_lateness(log: DataFrame, column: str, arrival: str, window: str, delay: str) -> DataFrame:
    """Log rows with ``window_start``, ``window_end`` and ``lateness``: what a stream does with the row that takes one landing at a time.

    A landing is the rows of one ``arrival``. Its watermark is the greatest event time of all earlier landings less ``delay``. A row is ``late`` if its window
    ended by that watermark, so that the window was given out without it; else it is ``open`` while the window ends after the watermark of the
    whole log, and ``kept`` once it is closed. Rows without event time are ``untimed``.

    One scan reduces the log to a row per landing; only these few are ordered in one task.
    """
    timed = log.withColumn(column, F.col(column).cast("timestamp"))
    newest = stored(timed.groupBy(F.col(arrival).alias("_arrival")).agg(F.max(column).alias("_newest")), "landings")
    earlier = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_first("_arrival")).rowsBetween(Window.unboundedPreceding, -1)
    marks = newest.withColumn("_before", F.max("_newest").over(earlier)).select("_arrival", _delayed("_before", delay).alias("_watermark"))
    last = newest.agg(F.max("_newest").alias("_all")).select(_delayed("_all", delay)).scalar()
    # window() drops rows without a time
    cut = F.window(F.coalesce(F.col(column), F.timestamp_seconds(F.lit(0))), window)
    has_time = F.col(column).isNotNull()
    placed = timed.withColumn("_cut", cut).withColumns(
        {"window_start": F.when(has_time, F.col("_cut.start")), "window_end": F.when(has_time, F.col("_cut.end"))}
    ).drop("_cut")
    joined = placed.join(marks, placed[arrival].eqNullSafe(marks["_arrival"]), "left")
    lateness = (
        F.when(F.col(column).isNull(), "untimed")
        .when(F.col("window_end") <= F.col("_watermark"), "late")
        .when(F.col("window_end") > last, "open")
        .otherwise("kept")
    )
    return joined.withColumn("lateness", lateness).drop("_arrival", "_watermark")


def windows_by_state(marked: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """``kept``, ``late`` and ``open`` rows of each window: the batch form of ``rate_stream``, with the windows that are still open."""
    return (
        marked.filter(F.col("lateness") != "untimed")
        .groupBy("window_start", "window_end", *group_by)
        .agg(*[F.count_if(F.col("lateness") == state).alias(state) for state in ("kept", "late", "open")])
    )


def reconcile_windows(
    log: DataFrame, windows: DataFrame, column: str, window: str, delay: str, group_by: Sequence[str] = ()
) -> DataFrame:
    """``kept``, ``late`` and ``open`` rows of each window, from the log and the windows that the stream has given out.

    Needs no arrival times: what the log holds beyond a window that was given out came late, and so did all rows of a window that has ended
    and was never given out. A window that ends after the watermark of the whole log is open.
    """
    keys = ["window_start", "window_end", *group_by]
    timed = log.withColumn(column, F.col(column).cast("timestamp")).filter(F.col(column).isNotNull())
    last = timed.agg(F.max(column).alias("_all")).select(_delayed("_all", delay)).scalar()
    # both sides are a row per window and group before they meet
    logged = event_rate(timed, column, window, group_by).withColumnRenamed("events", "_logged")
    given = windows.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("events").alias("_given"))
    same = [logged[k].eqNullSafe(given[f"_of_{k}"]) for k in keys]
    both = logged.join(given, same, "left").withColumn("_open", F.col("_given").isNull() & (F.col("window_end") > last))
    kept = F.coalesce("_given", F.lit(0)).cast("bigint")
    return both.select(
        *keys,
        kept.alias("kept"),
        F.when(F.col("_open"), 0).otherwise(F.col("_logged") - kept).cast("bigint").alias("late"),
        F.when(F.col("_open"), F.col("_logged")).otherwise(0).cast("bigint").alias("open"),
    )
