"""Table reading, creation, publishing, copying and compaction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import row_checksum
from tidemark.operators.envelope import LOG_SCHEMA
from tidemark.operators.merge import EntitySpec, last_changes, live_rows, merge_changes
from tidemark.session import stored
from tidemark.sources.versions import VersionLog

__all__ = [
    "read_table",
    "ensure_log_table",
    "with_ingest_date",
    "append_log",
    "empty_entity",
    "EntityStore",
    "refresh_table",
    "copy_verified",
    "file_sizes",
    "compact",
    "checksum",
    "same_checksum",
]


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or parquet files by path: the current version where ``refresh_table`` keeps versions."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    log = VersionLog(spark, name_or_path)
    found = log.latest()
    if found is None:
        return spark.read.parquet(name_or_path)
    state = found[1]
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(log.path(state["folders"][-1])).select(schema.names)


def with_ingest_date(log: DataFrame) -> DataFrame:
    """Partition column of the log: the day of ingest."""
    return log.withColumn("ingest_date", F.to_date("ingest_time"))


def ensure_log_table(spark: SparkSession, name: str) -> None:
    """Create the append-only log, partitioned by day of ingest, if it is missing."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields)
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, ingest_date date) "
        "USING parquet PARTITIONED BY (ingest_date)"
    )


def append_log(log: DataFrame, name: str) -> None:
    """Append log rows to the log table, in evenly sized files per day."""
    with_ingest_date(log).hint("rebalance", F.col("ingest_date")).write.mode("append").insertInto(name)


def empty_entity(spark: SparkSession, spec: EntitySpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


@dataclass(frozen=True)
class EntityStore:
    """An entity kept as bucketed versions in one location, with a list of pending changes.

    Each version is bucketed and sorted by the entity key. Pending changes are exchanged into the same buckets, so a merge shuffles them only and
    never the version, whatever the number of shuffle partitions. A bucket that outgrew ``bucket_rows`` is divided by the next settlement, which
    doubles the buckets: rows only move within their task.

    ``append`` only adds a batch to the pending changes, so its cost follows the batch and not the table; readers fold the pending changes in.
    ``settle`` merges them into a new version. What is current is said by the files of a ``VersionLog``: any session opens the
    store by its location, readers never see half a write, and the ``keep`` last versions stay. One writer per entity; a second one fails.
    """

    spark: SparkSession
    location: str
    spec: EntitySpec
    buckets: int = 64
    keep: int = 2
    bucket_rows: int = 10_000_000

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, self.location)

    def ensure(self) -> EntityStore:
        """Creates the store where there is none; the buckets of an existing one stay."""
        if self.log.latest() is None:
            state = {
                "version": 0, "folder": None, "buckets": self.buckets, "rows": 0, "schema": self.spec.schema.jsonValue(),
                "pending": [], "pending_rows": 0, "first": 0, "old": [],
            }
            self.log.add(0, state)
        return self

    def _state(self) -> tuple[int, dict]:
        found = self.log.latest()
        if found is None:
            raise ValueError(f"there is no store at {self.location}; call ensure()")
        return found

    def version(self) -> int:
        return self._state()[1]["version"]

    def due(self, share: float) -> bool:
        """Whether the pending changes are more than ``share`` of the rows stored."""
        state = self._state()[1]
        return state["pending_rows"] > share * state["rows"]

    def _table(self, folder: str) -> str:
        return f"{self.spec.entity}_{folder}".replace("-", "_")

    def _stored(self, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        if state["folder"] is None:
            return self.spark.createDataFrame([], schema)
        # the catalog of this session may not know the version yet; its bucketing makes the merge free of a shuffle
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        key = ", ".join(f"`{k}`" for k in self.spec.key)
        name = self._table(state["folder"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {state['buckets']} BUCKETS LOCATION '{self.log.path(state['folder'])}'"
        )
        return self.spark.table(name)

    def _pending(self, state: dict) -> DataFrame:
        if not state["pending"]:
            return empty_entity(self.spark, self.spec)
        changes = self.spark.read.schema(self.spec.schema).parquet(*map(self.log.path, state["pending"]))
        # a batch holds a key once, so no bucket is hot
        return last_changes(changes.repartition(state["buckets"], *self.spec.key), self.spec)

    def _merged(self, state: dict) -> DataFrame:
        if not state["pending"]:
            return self._stored(state)
        return merge_changes(self._stored(state), self._pending(state), self.spec)

    def stored(self) -> DataFrame:
        """Current version with tombstones, without pending changes."""
        return self._stored(self._state()[1])

    def pending(self) -> DataFrame:
        """Last pending change per key."""
        return self._pending(self._state()[1])

    def read(self) -> DataFrame:
        """Live rows, pending changes included."""
        return live_rows(self._merged(self._state()[1]))

    def _publish(self, df: DataFrame, buckets: int, number: int, before: dict) -> int:
        """Writes ``df`` as the next version, makes it current and drops the oldest one."""
        folder, counted = self.log.folder("version"), Observation()
        (
            df.observe(counted, F.count(F.lit(1)).alias("n"))
            .write.format("parquet")
            .option("path", self.log.path(folder))
            .bucketBy(buckets, *self.spec.key)
            .sortBy(*self.spec.key)
            .saveAsTable(self._table(folder))
        )
        # what each earlier version needs, and the number of the state that made it
        old = [*before["old"], [before["first"], *([before["folder"]] if before["folder"] else []), *before["pending"]]]
        stay, gone = old[-(self.keep - 1) :] if self.keep > 1 else [], old[: -(self.keep - 1)] if self.keep > 1 else old
        state = {
            "version": before["version"] + 1, "folder": folder, "buckets": buckets, "rows": counted.get["n"],
            "schema": df.schema.jsonValue(), "pending": [], "pending_rows": 0, "first": number + 1, "old": stay,
        }
        self.log.add(number + 1, state)
        for gone_folder in (name for _, *names in gone for name in names if name.startswith("version")):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(gone_folder)}")
        if gone:
            self.log.forget((name for _, *names in gone for name in names), stay[0][0] if stay else number + 1)
        return state["version"]

    def append(self, changes: DataFrame) -> None:
        """Adds a batch of typed changes, one of a key at most; repeating a batch changes nothing."""
        number, state = self._state()
        folder, counted = self.log.folder("pending"), Observation()
        rows = changes.select(*self.spec.schema.names).observe(counted, F.count(F.lit(1)).alias("n"))
        rows.write.parquet(self.log.path(folder))
        state["pending_rows"] += counted.get["n"]
        state["pending"].append(folder)
        self.log.add(number + 1, state)

    def settle(self) -> int:
        """Merges the pending changes into a new version."""
        number, state = self._state()
        if not state["pending"]:
            return state["version"]
        buckets = state["buckets"]
        while state["rows"] + state["pending_rows"] > buckets * self.bucket_rows:
            buckets *= 2
        return self._publish(self._merged(state), buckets, number, state)

    def apply(self, changes: DataFrame, settle_share: float) -> None:
        """Appends a batch, and settles once the pending changes are more than that share of the rows; the first batch becomes a version at once."""
        number, state = self._state()
        if state["folder"] is None and not state["pending"]:
            self._publish(self.merged_plan(changes.select(*self.spec.schema.names)), state["buckets"], number, state)
            return
        self.append(changes)
        if self.due(settle_share):
            self.settle()

    def merge(self, changes: DataFrame) -> int:
        """Append a batch and settle at once."""
        self.append(changes)
        return self.settle()

    def merged_plan(self, changes: DataFrame) -> DataFrame:
        """The current version with other changes (one per key) merged in, exchanged into its buckets."""
        state = self._state()[1]
        return merge_changes(self._stored(state), changes.repartition(state["buckets"], *self.spec.key), self.spec)


def refresh_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2) -> int:
    """Full rebuild of a derived table as a new version; readers of the last ``keep`` versions stay whole, and ``df`` may read the table itself.

    Rows are rebalanced by the partition columns: Spark splits a partition that holds most of the
    rows over several tasks and joins small ones, so files have an even size. ``read_table`` finds the current version.
    """
    log = VersionLog(df.sparkSession, path)
    number, state = log.latest() or (-1, {"folders": []})
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    folder = log.folder("version")
    rows.write.partitionBy(*partition_by).parquet(log.path(folder))
    folders = [*state["folders"], folder]
    log.add(number + 1, {"folders": folders[-keep:], "schema": df.schema.jsonValue()})
    log.forget(folders[:-keep], number + 2 - keep)
    return number + 1


def checksum(df: DataFrame, sums: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One row: count, sums of the named columns, and an order-independent hash of all rows."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(c).alias(f"sum_{c}") for c in sums],
        row_checksum(*(columns or df.columns)).alias("content_hash"),
    )


def same_checksum(a: DataFrame, b: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Compare two ``checksum`` rows: one boolean per measure and ``all_equal``."""
    measures = [c for c in a.columns if c in b.columns]
    other = b.select(F.struct(*measures)).scalar()
    both = a.select(*measures, other.alias("_other"))

    def equal(name: str) -> Column:
        left, right = F.col(name), F.col(f"_other.{name}")
        if not name.startswith("sum_"):
            return left.eqNullSafe(right)
        close = F.abs(left - right) <= tolerance
        return F.coalesce(close, left.isNull() & right.isNull())

    flags = both.select(*[equal(c).alias(c) for c in measures])
    return flags.withColumn("all_equal", F.array_min(F.array(*measures)))


def copy_verified(df: DataFrame, path: str) -> dict[str, int]:
    """Write a copy and compare its row count with what was read, in one pass over the source."""
    seen = Observation("copied")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    source = seen.get["n"]
    target = df.sparkSession.read.parquet(path).count()
    if source != target:
        raise RuntimeError(f"copy to {path} has {target} rows, source had {source}")
    return {"source_rows": source, "target_rows": target}


def file_sizes(rows: DataFrame, partition_by: Sequence[str] = (), small_bytes: int = 64 << 20) -> DataFrame:
    """``files``, ``small_files`` and ``bytes`` of each partition, counted in Spark from what each row says of its file.

    Reads no column but those of the partitions. Files without rows do not count.
    """
    of_file = rows.select(*partition_by, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    files = of_file.groupBy(*partition_by, "_path").agg(F.max("_size").alias("_size"))
    return files.groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("_size") < small_bytes).alias("small_files"),
        F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes"),
    )


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    sums: Sequence[str] = (),
    small_bytes: int | None = None,
) -> DataFrame:
    """Rewrite many small files into evenly sized ones at a new path and verify the content.

    With ``small_bytes`` only those partitions are rewritten that have several files below that size; the others are not read but for
    their file sizes. Returns ``files_before`` and ``files_after`` of each rewritten partition.
    """
    whole = spark.read.parquet(source)
    before = stored(file_sizes(whole, partition_by, small_bytes or 0), "file-sizes")
    rows = whole
    if small_bytes is not None:
        before = before.filter(F.col("small_files") > 1)
        if partition_by:
            asked = before.select(*[F.col(c).alias(f"_of_{c}") for c in partition_by])
            rows = whole.join(asked, [whole[c].eqNullSafe(asked[f"_of_{c}"]) for c in partition_by], "left_semi")
    balanced = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    balanced.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    result = spark.read.schema(whole.schema).parquet(target).select(*rows.columns)
    verdict = same_checksum(checksum(rows, sums), checksum(result, sums)).first()
    if not verdict["all_equal"]:
        raise RuntimeError(f"compacted copy at {target} differs from {source}: {verdict}")
    after = file_sizes(result, partition_by).select(*[F.col(c).alias(f"_of_{c}") for c in partition_by], F.col("files").alias("files_after"))
    same = [before[c].eqNullSafe(after[f"_of_{c}"]) for c in partition_by]
    counted = before.withColumnRenamed("files", "files_before")
    if not partition_by:
        return counted.select("files_before", after.scalar().alias("files_after"))
    return counted.join(after, same, "left").select(*partition_by, "files_before", F.coalesce("files_after", F.lit(0)).alias("files_after"))
