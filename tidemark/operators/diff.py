"""Finding the rows in which two large tables differ.

Joining all rows of both tables would shuffle them wholly to find next to nothing. Here each side is first reduced to a few checksums, one for each hash range
of the key (within each partition value, if the tables are laid out by one); that is one scan with map-side sums. Only ranges whose checksums differ are
looked at again: partitions without any are pruned, other rows go before anything is shuffled, and the rest is compared by key.

The checksums are sums of md5 digests of the rows' text, so any engine can compute them over its own copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

__all__ = ["digest_number", "range_sums", "unequal_ranges", "differing_rows"]

#: 15 hex digits fit a signed 64-bit number
DIGITS = 15


def digest_number(columns: Sequence[str]) -> Column:
    """Number of the md5 of the columns' texts, each followed by its length, so that neighbours cannot run into each other; NULL has none."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    length = [F.when(F.col(c).isNull(), "n").otherwise(F.length(F.col(c).cast("string")).cast("string")) for c in columns]
    parts = [part for pair in zip(text, length, strict=True) for part in pair]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS), 16, 10).cast("bigint")


def _ranged(df: DataFrame, key: Sequence[str], ranges: int) -> DataFrame:
    return df.withColumn("hash_range", (digest_number(key) % ranges).cast("int"))


def range_sums(df: DataFrame, key: Sequence[str], ranges: int = 1024, partition: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """``n_rows`` and ``digest_sum`` of each hash range of the key; a partition has its own ranges."""
    within = [partition] if partition else []
    digest = digest_number(columns or sorted(df.columns)).cast("decimal(38,0)")
    return _ranged(df, key, ranges).groupBy(*within, "hash_range").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(digest).alias("digest_sum"))


def unequal_ranges(left: DataFrame, right: DataFrame, key: Sequence[str], ranges: int = 1024, partition: str | None = None) -> DataFrame:
    """Ranges whose rows are not the same on both sides, with both row counts."""
    keys = [*([partition] if partition else []), "hash_range"]
    columns = sorted(left.columns)
    sums = [range_sums(df, key, ranges, partition, columns) for df in (left, right)]
    tagged = sums[0].withColumn("_side", F.lit(0)).unionByName(sums[1].withColumn("_side", F.lit(1)))

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(name)))

    return (
        tagged.groupBy(*keys)
        .agg(
            F.coalesce(of(0, "n_rows"), F.lit(0)).alias("left_rows"),
            F.coalesce(of(1, "n_rows"), F.lit(0)).alias("right_rows"),
            of(0, "digest_sum").eqNullSafe(of(1, "digest_sum")).alias("_equal"),
        )
        .filter(~F.col("_equal") | (F.col("left_rows") != F.col("right_rows")))
        .drop("_equal")
    )


def differing_rows(left: DataFrame, right: DataFrame, key: Sequence[str], ranges: int = 1024, partition: str | None = None) -> DataFrame:
    """Keys whose rows differ: ``only_left``, ``only_right`` or ``changed``, with the row counts of both sides.

    Columns that one side lacks are not compared. A NULL key is a key. A key that lies in two partitions is one key in each.
    """
    columns = sorted(set(left.columns) & set(right.columns))
    left, right = left.select(*columns), right.select(*columns)
    within = [partition] if partition else []
    unequal = stored(unequal_ranges(left, right, key, ranges, partition), "unequal")
    asked = unequal.select(*[F.col(c).alias(f"_of_{c}") for c in [*within, "hash_range"]])
    names = list(dict.fromkeys([*within, *key]))

    def suspects(df: DataFrame, side: int) -> DataFrame:
        if partition:
            # the planner of a scan holds the list of partitions anyway; this one is no longer
            values = [r[0] for r in unequal.select(partition).distinct().collect()]
            some = F.col(partition).isin([v for v in values if v is not None])
            df = df.filter(some | F.col(partition).isNull() if None in values else some)
        rows = _ranged(df, key, ranges)
        same = [rows[c].eqNullSafe(asked[f"_of_{c}"]) for c in [*within, "hash_range"]]
        return rows.join(asked, same, "left_semi").select(*names, F.lit(side).alias("_side"), digest_number(columns).alias("_digest"))

    # copies meet map-side, so a key with many rows on either side is no hot one
    both = suspects(left, 0).unionByName(suspects(right, 1))
    counted = both.groupBy(*names).agg(
        F.count_if(F.col("_side") == 0).alias("left_rows"),
        F.count_if(F.col("_side") == 1).alias("right_rows"),
        F.sum(F.when(F.col("_side") == 0, F.col("_digest")).cast("decimal(38,0)")).alias("_left"),
        F.sum(F.when(F.col("_side") == 1, F.col("_digest")).cast("decimal(38,0)")).alias("_right"),
    )
    kind = F.when(F.col("right_rows") == 0, "only_left").when(F.col("left_rows") == 0, "only_right").otherwise("changed")
    unlike = ~F.col("_left").eqNullSafe(F.col("_right")) | (F.col("left_rows") != F.col("right_rows"))
    return counted.filter(unlike).select(*names, kind.alias("difference"), "left_rows", "right_rows")
