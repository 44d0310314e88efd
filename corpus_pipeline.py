"""From raw documents to packed training windows, a stage for each decision.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet in the shared
folder and read again as the next stage's documents. All but the last return the columns of ``documents``.

Defined cases: an empty table gives an empty result in every stage. Rows without text are rejected by the first stage. Repeated
rows are reduced to one by the second. Columns beyond those of ``documents`` are carried to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, nearcopies, packing, suffixes
from tidemark.llm.common import send_code, stored, table

#: a text is kept if its language is at least this sure
LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows, with ``lang`` as it predicts.

    Texts without letters and texts whose language is unsure go.
    """
    send_code(spark)
    return language.label(docs, language.fit(docs), LEAST_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return nearcopies.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur elsewhere, ``n_chars`` counted anew."""
    return suffixes.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in windows of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("benchmark leaks", drop_benchmark_leaks),
    ("packing", pack_windows),
]

#: the first stage is a trained network
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
