"""Relational transforms: column selection, pivot, union of unlike tables, deduplication, series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "star",
    "nullcheck_table",
    "cast_columns",
    "column_values",
    "pivot",
    "unpivot",
    "union_relations",
    "union_tables_like",
    "symmetric_difference",
    "deduplicate",
    "generate_series",
    "cross_series",
]


def _kept(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    dropped = {c.lower() for c in except_}
    return [c for c in df.columns if c.lower() not in dropped]


def star(
    df: DataFrame,
    except_: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """All columns but the excluded ones (any case), renamed; for use inside ``select``."""
    owner = f"`{relation_alias}`." if relation_alias else ""
    return [F.col(f"{owner}`{c}`").alias(f"{prefix}{c}{suffix}") for c in _kept(df, except_)]


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to exactly the columns of ``schema``, each cast to its declared type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Distinct values with their count, most frequent first (ties by value)."""
    rows = df if where is None else df.filter(where)
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    ordered = counted.orderBy(*(order_by or [F.desc("n_records"), F.asc("value")]))
    return ordered if max_records is None else ordered.limit(max_records)


_COMPARISONS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def pivot(
    column: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | int | str = 1,
    else_value: Column | int | None = 0,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate column per value, for use inside ``groupBy(…).agg(*pivot(…))``."""
    plain = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}
    unique = {"sum": F.sum_distinct, "count": F.countDistinct}
    table = unique if distinct else plain
    if agg not in table or cmp not in _COMPARISONS:
        raise ValueError(f"unsupported agg {agg!r} or cmp {cmp!r}")
    then_col = F.col(then_value) if isinstance(then_value, str) else F.lit(then_value)
    else_col = F.lit(else_value)
    return [
        table[agg](F.when(_COMPARISONS[cmp](F.col(column), F.lit(v)), then_col).otherwise(else_col)).alias(
            f"{prefix}{v}{suffix}"
        )
        for v in values
    ]


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows; ``exclude`` columns are kept on each row, ``remove`` columns disappear.

    One pass over the input: the columns are exploded in place.
    """
    folded = {c.lower() for c in exclude}
    ids = [c for c in df.columns if c.lower() in folded]
    fields = _kept(df, [*exclude, *remove])
    typed = df.select(*ids, *[F.col(c).cast(cast_to).alias(c) for c in fields])
    return typed.unpivot(ids, fields, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column: str | None = "_source_relation",
    where: Column | str | None = None,
) -> DataFrame:
    """Union over the superset of columns; missing ones are NULL, each typed as first seen."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = column_override or {}
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}
    superset: dict[str, T.DataType | str] = {}
    for frame in relations.values():
        for field in frame.schema.fields:
            name = field.name.lower()
            if name in unwanted or (wanted and name not in wanted):
                continue
            superset.setdefault(field.name, field.dataType)
    if not superset:
        raise ValueError("no columns left to union")

    def shaped(name: str, frame: DataFrame) -> DataFrame:
        rows = frame if where is None else frame.filter(where)
        columns = [
            (F.col(f"`{c}`") if c in frame.columns else F.lit(None)).cast(override.get(c, kind)).alias(c)
            for c, kind in superset.items()
        ]
        tag = [F.lit(name).alias(source_column)] if source_column else []
        return rows.select(*tag, *columns)

    return reduce(DataFrame.unionByName, [shaped(n, f) for n, f in relations.items()])


def union_tables_like(
    spark: SparkSession, pattern: str, database: str | None = None, exclude: str = "", **options
) -> DataFrame:
    """``union_relations`` over the catalog tables whose name matches a ``*`` pattern.

    A prefix is the pattern ``prefix*``.
    """
    names = {t.name for t in spark.catalog.listTables(database, pattern)}
    if exclude:
        names -= {t.name for t in spark.catalog.listTables(database, exclude)}
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    owner = f"{database}." if database else ""
    return union_relations({n: spark.table(f"{owner}{n}") for n in sorted(names)}, **options)


def symmetric_difference(
    a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Distinct rows on one side only, tagged ``a_minus_b`` or ``b_minus_a``.

    Both inputs meet in one aggregation (NULLs equal), instead of two set differences.
    """
    names = list(columns or a.columns)
    left = a.select(*names, F.lit(True).alias("_in_a"), F.lit(False).alias("_in_b"))
    right = b.select(*names, F.lit(False).alias("_in_a"), F.lit(True).alias("_in_b"))
    return (
        left.unionByName(right)
        .groupBy(*names)
        .agg(F.bool_or("_in_a").alias("_in_a"), F.bool_or("_in_b").alias("_in_b"))
        .filter(F.col("_in_a") != F.col("_in_b"))
        .select(
            F.when(F.col("_in_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff"), *names
        )
    )


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key. ``order_by`` should end in a unique column to be deterministic.

    The filter on row number 1 lets Spark prune inside each task before the shuffle, so a hot key
    sends one row per task.
    """
    span = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(span)).filter(F.col("_rank") == 1).drop("_rank")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1 … ``upper_bound`` as ``generated_number``, made in parallel."""
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def cross_series(df: DataFrame, upper: Column | int, alias: str = "group_id") -> DataFrame:
    """Each row once per number 1 … ``upper``: a cross join with a series, without a join."""
    top = upper if isinstance(upper, Column) else F.lit(upper)
    return df.withColumn(alias, F.explode(F.sequence(F.lit(1), top.cast("int"))))
