"""What the operators share: reading tables, stored intermediate results, text constants."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: five words make a shingle, and similar means at least 0.8
SHINGLE_WORDS = 5
SIMILAR = 0.8


_SENT: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Gives the executors this library, once per application: Python workers import it."""
    if spark.sparkContext.applicationId not in _SENT:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SENT.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    send_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: what Python workers keep between tasks, by operator: how to drop it
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(operator: str, drop: Callable[[], None]) -> None:
    """Tells how to drop what a worker keeps for an operator."""
    _KEPT[operator] = drop


def only(operator: str) -> None:
    """Drops what this worker keeps for other operators: Spark gives a worker of one stage to the next one."""
    for other, drop in _KEPT.items():
        if other != operator:
            drop()


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes of text in the column (one row at least)."""
    for rows in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(rows.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < rows.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield rows.slice(start, stop - start)
            start = stop


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a result to the shared folder and reads it again: cuts the plan, survives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text in joins, as two numbers."""
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit("second"), text).alias("key_b")]


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def picked_hashes(hashes: str, picked: list[int], salt: int) -> Column:
    """Hash of the picked places of every stretch of ``picked[-1] + 1`` values; empty if there is none."""
    starts = F.size(hashes) - F.lit(picked[-1])
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(starts - 1, F.lit(0))),
        lambda i: F.xxhash64(F.lit(salt), *(F.get(F.col(hashes), i + j) for j in picked)),
    )
    return F.when(starts > 0, each).otherwise(F.array().cast("array<long>"))


def text_digest(text: Column) -> Column:
    """128 bits that stand for a text in joins."""
    return F.unhex(F.md5(text.cast("binary")))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``key`` and ``text`` of every different text; copies meet map-side, so none is hot."""
    texts = docs.select(text_or_empty().alias("text"))
    return texts.groupBy(text_digest(F.col("text")).alias("key")).agg(F.first("text").alias("text"))
