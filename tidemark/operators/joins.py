"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["left_join_many"]


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join for a right side that may hold very many rows per key.

    In a left outer join Spark can split a skewed partition of the left side only. In an inner join
    it can split either, so the matches come from an inner join, and the left rows without a match
    from an anti join against the distinct right keys.
    """
    keys = list(on)
    extra = [f for f in right.schema.fields if f.name not in keys]
    matched = left.join(right, keys)
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(
        unmatched.select(
            *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
        )
    )
