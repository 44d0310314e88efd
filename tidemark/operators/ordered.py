"""Neighbour comparisons and exact quantiles over data that does not fit one task.

A plain ``lag() over (order by …)`` moves the whole table, or a whole hot group, into one task.
Here rows are collapsed to distinct tuples with a count (map-side), range-partitioned over group and
order together, compared inside each range, and only the two edge rows of each range meet again to
settle the comparisons that cross a range border.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shuffle_width, stored

Broken = Callable[[Callable[[str], Column], Callable[[str], Column], Column], Column]


def adjacent_violations(
    df: DataFrame,
    *,
    order_by: Sequence[str],
    carry: Sequence[str],
    broken: Broken,
    group_by: Sequence[str] = (),
    direction: str = "previous",
    prefix: str = "neighbour_",
) -> DataFrame:
    """Rows whose neighbour in order breaks a rule.

    ``broken(here, there, alone)`` gets accessors for the carried columns of the row and of its
    neighbour, and a flag that is true when the row has no neighbour in its group. Equal rows are
    neighbours of each other. One output row stands for ``n_records`` equal violations.
    """
    group, order, carry = list(group_by), list(order_by), list(carry)
    keys = list(dict.fromkeys([*group, *order, *carry]))
    tuples = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))

    width = shuffle_width(df.sparkSession)
    ranged = tuples.repartitionByRange(width, *keys).withColumn("_range", F.spark_partition_id())
    # one range per task
    ranged = ranged.repartitionById(width, F.col("_range"))
    shift = F.lag if direction == "previous" else F.lead
    within = Window.partitionBy("_range").orderBy(*keys)
    packed = F.struct(*keys)
    local = (
        ranged.withColumn("_near", shift(packed).over(within))
        .withColumn("_first", F.lag(F.lit(1)).over(within).isNull())
        .withColumn("_last", F.lead(F.lit(1)).over(within).isNull())
    )
    open_side = F.col("_first") if direction == "previous" else F.col("_last")

    same_group = F.lit(True)
    for g in group:
        same_group = same_group & F.col(f"_near.{g}").eqNullSafe(F.col(g))
    # a neighbour is absent at the end of the table and at the end of the group
    present = F.col("_near").isNotNull() & F.coalesce(same_group, F.lit(False))

    def here(name: str) -> Column:
        return F.col(name)

    def there(name: str) -> Column:
        return F.when(present, F.col(f"_near.{name}"))

    fails = F.coalesce(broken(here, there, ~present), F.lit(False))
    fails_on_copy = F.coalesce(broken(here, here, F.lit(False)), F.lit(False))
    copies_fail = (F.col("n_records") > 1) & fails_on_copy

    edge = F.col("_first") | F.col("_last")
    suspects = local.filter(edge | fails | copies_fail)
    across = Window.partitionBy(F.when(edge, F.lit(-1)).otherwise(F.col("_range"))).orderBy(
        "_range", *keys
    )
    settled = suspects.withColumn("_across", shift(packed).over(across)).withColumn(
        "_near", F.when(open_side, F.col("_across")).otherwise(F.col("_near"))
    )
    outcomes = F.array_compact(
        F.array(
            F.when(
                fails,
                F.struct(
                    *[there(c).alias(f"{prefix}{c}") for c in carry], F.lit(1).cast("bigint").alias("n")
                ),
            ),
            F.when(
                copies_fail,
                F.struct(
                    *[here(c).alias(f"{prefix}{c}") for c in carry], (F.col("n_records") - 1).alias("n")
                ),
            ),
        )
    )
    return settled.select(*keys, F.explode(outcomes).alias("_o")).select(
        *keys,
        *[F.col(f"_o.{prefix}{c}") for c in carry],
        F.col("_o.n").alias("n_records"),
    )


def numbered(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """``df`` with the number of each row in order, from 0, without sorting all rows in one task.

    Rows are written in ranges; the totals of the ranges before, a row for each, are added to the number inside a range.
    """
    width = shuffle_width(df.sparkSession)
    ranged = stored(df.repartitionByRange(width, *order_by).withColumn("_range", F.spark_partition_id()), "ranges")
    upto = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by)) - 1
    placed = ranged.withColumn("_inside", inside).join(before, F.col("_range") == F.col("_of"))
    return placed.select((F.col("_before") + F.col("_inside")).cast("int").alias(name), *df.columns)


def exact_quantile(
    df: DataFrame,
    column: str,
    q: float,
    group_by: Sequence[str] = (),
    alias: str = "quantile",
) -> DataFrame:
    """Interpolated quantile per group, equal to ``percentile(column, q)``, without a hot buffer.

    The built-in keeps every distinct value of a group in one buffer. Here the distinct values of each group are counted and written in
    ranges over group and value together, as many as there are shuffle partitions. A range knows how many rows of a group it
    holds; these few totals say which ranges hold the wanted ranks, and only those are read again and ranked. The table is scanned once, and nothing
    passes the driver.
    """
    if not 0 <= q <= 1:
        raise ValueError(f"q must be in [0, 1], got {q}")
    group = list(group_by)
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*group, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # written: ranges that are sampled anew for each reading would not be the same ones
    width = shuffle_width(df.sparkSession)
    ranged = stored(counts.repartitionByRange(width, *group, "_v").withColumn("_range", F.spark_partition_id()), "ranges")

    # a row for each group and one more for each border of a range at most
    totals = ranged.groupBy(*group, "_range").agg(F.sum("_n").alias("_in_range"))
    by_group = Window.partitionBy(*(group or [F.lit(0)]))
    upto = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    position = F.lit(float(q)) * (F.col("_total") - 1)
    wanted = (
        totals.withColumn("_total", F.sum("_in_range").over(by_group))
        .withColumn("_before", F.coalesce(F.sum("_in_range").over(upto), F.lit(0)))
        .withColumn("_lo", F.floor(position))
        .withColumn("_hi", F.ceil(position))
        .withColumn("_pos", position)
        .filter((F.col("_before") <= F.col("_hi")) & (F.col("_before") + F.col("_in_range") > F.col("_lo")))
        .drop("_in_range", "_total")
    )
    running = Window.partitionBy(*group, "_range").orderBy("_v")
    upper = F.col("_before") + F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, 0))
    # a group may be NULL
    keys = [*group, "_range"]
    asked = wanted.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [ranged[k].eqNullSafe(asked[f"_of_{k}"]) for k in keys]
    placed = ranged.join(asked, same).drop(*(f"_of_{k}" for k in keys)).withColumn("_upper", upper)
    lower = F.col("_upper") - F.col("_n")

    def at(rank: str) -> Column:
        covers = (lower <= F.col(rank)) & (F.col(rank) < F.col("_upper"))
        return F.max(F.when(covers, F.col("_v"))).alias(f"_v{rank}")

    found = placed.groupBy(*group).agg(
        at("_lo"), at("_hi"), F.max("_pos").alias("_pos"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    blended = F.when(F.col("_lo") == F.col("_hi"), F.col("_v_lo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_v_lo") + (F.col("_pos") - F.col("_lo")) * F.col("_v_hi")
    )
    return found.select(*group, blended.alias(alias))
