"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language, licenses, nearcopies, packing, quotes, rules, spelling, spots, suffixes, token_counts, toxicity, vector_codes
from tidemark.llm.common import table
from tidemark.session import scratch_path
from tidemark.workload.registry import Registry

QUERIES = Registry()


def op1_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report(table(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.fit(docs))


def op3_spots(spark: SparkSession, folder: str) -> DataFrame:
    return spots.neighbour_likeness(table(spark, folder, "documents"))


def op4_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.conversations(table(spark, folder, "conversations"))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    # an empty cache of its own: the query codes every distinct text
    cache = scratch_path(spark, "token-counts")
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)


def op9_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return nearcopies.classes(table(spark, folder, "documents"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


SQL = {"op5_licenses": licenses.SQL, "op10_decontaminate": decontaminate.SQL, "op13_codes": vector_codes.SQL}

BUILDS = (
    op1_suffixes, op2_language, op3_spots, op4_quotes, op5_licenses, op6_toxicity, op7_packing, op8_token_counts, op9_near_copies,
    op10_decontaminate, op11_spelling, op12_rules, op13_codes,
)
for build in BUILDS:
    QUERIES.add(build.__name__, build, SQL.get(build.__name__))
