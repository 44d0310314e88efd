"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per vertex (map-side combined) and a join, so a vertex with any number of links is never
gathered. Links are written to the shared folder between steps. The number of steps grows with the logarithm of the
number of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each vertex hang on the least vertex around it."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours hang on the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").filter(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return least.select("u", F.col("least").alias("v")).union(moved)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` (the least vertex of its component) for every vertex of ``links`` (u, v)."""
    ordered = links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    state = stored(ordered.distinct(), "links")
    mark = _mark(state)
    while True:
        state = stored(_small_star(_large_star(state).distinct()).distinct(), "links")
        before, mark = mark, _mark(state)
        if before == mark:
            break
    roots = state.select(F.col("v").alias("vertex")).distinct().select("vertex", F.col("vertex").alias("root"))
    return state.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(roots)
