"""Running many checks with few scans, severities and the release gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "Severity",
    "RowCheck",
    "AggregateCheck",
    "GroupCheck",
    "FrameCheck",
    "run_checks",
    "with_severity",
    "gate_decision",
]


@dataclass(frozen=True)
class Severity:
    """Failure counts above these limits warn or block; ``None`` switches a level off."""

    error_above: int | None = 0
    warn_above: int | None = 0


@dataclass(frozen=True)
class RowCheck:
    """Counts rows where ``bad`` is true; all row checks of a table share one scan."""

    name: str
    bad: Column
    row_condition: Column | None = None
    severity: Severity = field(default_factory=Severity)


@dataclass(frozen=True)
class AggregateCheck:
    """Fails once when ``rule(observed)`` is false; shares the scan of the row checks."""

    name: str
    observed: Column
    rule: Callable[[Column], Column]
    severity: Severity = field(default_factory=Severity)


@dataclass(frozen=True)
class GroupCheck:
    """Counts groups whose aggregate breaks the rule; checks with the same grouping share a shuffle.

    ``GroupCheck(name, (key,), F.count(F.lit(1)), lambda n: n <= 1)`` is a uniqueness check.
    """

    name: str
    group_by: tuple[str, ...]
    observed: Column
    rule: Callable[[Column], Column]
    severity: Severity = field(default_factory=Severity)


@dataclass(frozen=True)
class FrameCheck:
    """Any relation of violations: joins, key checks, custom checks."""

    name: str
    violations: DataFrame
    measure: Column | None = None
    severity: Severity = field(default_factory=Severity)


def run_checks(df: DataFrame | None, checks: Sequence) -> DataFrame:
    """Summary ``(check_name, failures, status)`` of all checks.

    Row and aggregate checks become columns of a single aggregation over ``df``, however many there
    are; group checks become one aggregation per grouping. Frame checks add jobs of their own.
    """
    fused = [c for c in checks if isinstance(c, (RowCheck, AggregateCheck))]
    frames = [c for c in checks if isinstance(c, FrameCheck)]
    grains: dict[tuple[str, ...], list[GroupCheck]] = {}
    for check in checks:
        if isinstance(check, GroupCheck):
            grains.setdefault(tuple(check.group_by), []).append(check)
    if df is None and (fused or grains):
        raise ValueError("only frame checks work without a table")
    parts: list[DataFrame] = []
    if fused:
        measures = []
        for i, check in enumerate(fused):
            if isinstance(check, RowCheck):
                bad = check.bad if check.row_condition is None else check.row_condition & check.bad
                measures.append(F.count_if(bad).alias(f"m{i}"))
            else:
                measures.append(check.observed.alias(f"m{i}"))
        row = df.agg(*measures)
        entries = []
        for i, check in enumerate(fused):
            value = F.col(f"m{i}")
            if isinstance(check, AggregateCheck):
                # an unknown result is no violation
                value = F.when(~check.rule(value), F.lit(1)).otherwise(F.lit(0))
            entries.append(_entry(check, value))
        parts.append(_entries(row, entries))
    for grain, members in grains.items():
        groups = df.groupBy(*grain).agg(*[c.observed.alias(f"m{i}") for i, c in enumerate(members)])
        row = groups.agg(*[F.count_if(~c.rule(F.col(f"m{i}"))).alias(f"m{i}") for i, c in enumerate(members)])
        parts.append(_entries(row, [_entry(c, F.col(f"m{i}")) for i, c in enumerate(members)]))
    for check in frames:
        measure = check.measure if check.measure is not None else F.count(F.lit(1))
        counted = check.violations.agg(F.coalesce(measure, F.lit(0)).alias("_n"))
        parts.append(_entries(counted, [_entry(check, F.col("_n"))]))
    return reduce(DataFrame.unionByName, parts)


def _entries(row: DataFrame, entries: list[Column]) -> DataFrame:
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _entry(check, failures: Column) -> Column:
    failures = failures.cast("bigint")
    return F.struct(
        F.lit(check.name).alias("check_name"),
        failures.alias("failures"),
        _status(failures, check.severity).alias("status"),
    )


def _status(failures: Column, severity: Severity) -> Column:
    status = F.lit("passed")
    if severity.warn_above is not None:
        status = F.when(failures > severity.warn_above, "warn").otherwise(status)
    if severity.error_above is not None:
        status = F.when(failures > severity.error_above, "failed").otherwise(status)
    return status


def with_severity(
    summary: DataFrame, error_above: int | None = 0, warn_above: int | None = 0
) -> DataFrame:
    """Set the status of all checks anew from their failure counts."""
    return summary.withColumn("status", _status(F.col("failures"), Severity(error_above, warn_above)))


def gate_decision(summary: DataFrame, skippable: Sequence[str] = ()) -> DataFrame:
    """One row: ``allow`` when every check passed or warned, else ``block`` with the failed names.

    ``skipped`` counts as passed only for checks named in ``skippable``. No check at all blocks.
    """
    good = F.col("status").isin("passed", "warn")
    if skippable:
        good = good | ((F.col("status") == "skipped") & F.col("check_name").isin(*skippable))
    return summary.agg(
        F.coalesce(F.bool_and(good), F.lit(False)).alias("_ok"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~good).alias("failed_checks"),
        # bounded by the number of checks, not by data
        F.array_join(F.sort_array(F.collect_set(F.when(~good, F.col("check_name")))), ", ").alias("failed_names"),
    ).select(
        F.when(F.col("_ok"), "allow").otherwise("block").alias("decision"),
        "checks",
        "failed_checks",
        "failed_names",
    )
