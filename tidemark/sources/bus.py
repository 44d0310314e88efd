"""Message-bus rows: schema, readers and text decoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import TOPIC_ENTITIES

BUS_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)


def read_bus_stream(
    spark: SparkSession,
    servers: str,
    topics: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Subscribe to topics; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(*BUS_SCHEMA.names)


def read_bus_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same rows landed as parquet files, read as a stream."""
    reader = spark.readStream.schema(BUS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def decode_text(value: Column) -> Column:
    """UTF-8 text; invalid bytes become the replacement character."""
    # an unaligned cast keeps the bytes as they are; make_valid_utf8 replaces the broken ones
    return F.make_valid_utf8(value.cast("string"))


def topic_entity(topic: Column, routes: Mapping[str, str] = TOPIC_ENTITIES) -> Column:
    """Entity of a topic, NULL for an unknown one."""
    pairs = [F.lit(x) for pair in routes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), topic)
