"""Query registration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        # moments are stored as UTC wall-clock time in the given tables
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _wall_clock(self.build(spark, folder))


def _wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so results do not depend on who reads them."""
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({m: F.col(m).cast("timestamp_ntz") for m in moments})


class Registry:
    def __init__(self) -> None:
        self.entries: dict[str, Query] = {}

    def add(self, name: str, build: Build, sql: str | None = None) -> None:
        if name in self.entries:
            raise ValueError(f"query {name} is already registered")
        self.entries[name] = Query(name, build, sql)
