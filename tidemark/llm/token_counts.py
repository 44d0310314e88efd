"""Token counts through a digest cache.

Texts are normalised as the tokenizer does before it cuts them (byte-pair coding of bytes: not at all;
null becomes empty) and stand in the cache as their SHA-256 beside the digest of the tokenizer file. A run
joins the digests of its documents to the stored counts, codes each distinct text that is missing once and
appends the new counts. The next run codes only what it has not seen.

Copies meet map-side first, so a text that fills a third of the table moves once per task. Two runs that
append the same digest at once do no harm: counts are equal, and readers take one of them.

Defined cases: null text counts as empty, 0 tokens. Null ids stay null. Repeated rows are counted each.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import send_code, stored, text_or_empty
from tidemark.llm.pieces import coder

CACHE_SCHEMA = "digest binary, n_tokens long, version string"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another file or version never meets the stored counts of this one."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """One count per digest."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(missing: DataFrame, path: str) -> DataFrame:
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = coder(path, "bytes").count
        for rows in batches:
            counts = pa.array([count(t) for t in rows.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.binary()), counts], schema=schema)

    return missing.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024) -> DataFrame:
    """doc_id, digest, n_bytes, n_tokens, over_limit of every row; new counts are in ``cache`` afterwards."""
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    send_code(spark)
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).select(
        "doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    missing = (
        texts.groupBy("digest")
        .agg(F.first("text").alias("text"))
        .join(read_cache(spark, cache, version), "digest", "left_anti")
    )
    _encode(missing, tokenizer).withColumn("version", F.lit(version)).write.mode("append").parquet(cache)
    # the counts of these texts only, written before they are joined: Spark splits a text that fills a third of the table over tasks
    asked = texts.select("digest").distinct()
    counts = stored(read_cache(spark, cache, version).join(asked, "digest", "left_semi"), "counts")
    return (
        texts.drop("text")
        .join(counts, "digest")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "digest")
    )
