"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. All queries run once cold, then all
again ``BENCH_REPEAT`` times; the best warm time is reported, since the targets are about a running
service. ``serve_*`` queries read a mart that was built before, as a metrics reader would, and the log queries read change messages that
were landed before: writing them is the source's work.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import inputs as I  # noqa: E402
from tidemark.plans import metrics as K  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.workload import ALL  # noqa: E402

HEADLINE = (
    "kpis_daily_v1",
    "user_segments",
    "users_with_order_count",
    "overpaid_orders",
    "orphan_payments",
    "parse_envelopes",
    "latest_events",
    "merge_orders",
    "contract_violations",
    "check_suite",
    "kpi_contract_conformance",
    "check_unique_combination",
    "check_relationships",
    "check_sequential_values",
    "check_exclusive_ranges",
    "check_median_between",
    "check_within_n_moving_stdevs",
    "check_match_regex_flags",
    "symmetric_difference",
    "deduplicate",
    "unpivot",
    "calendar_with_fiscal",
    "segments_upsert",
    "offset_gaps",
    "stream_log_append",
    "stream_entities",
)


def run(df) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    wanted = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    kpi_path, segment_path = scratch_path(spark, "kpis"), scratch_path(spark, "segments")
    plans = {name: (lambda n=name: ALL[n](spark, folder)) for name in HEADLINE}
    plans["serve_kpi_on_date"] = lambda: K.kpi_on(spark.read.parquet(kpi_path), "2000-01-21")
    plans["serve_kpi_range"] = lambda: K.kpi_range(spark.read.parquet(kpi_path), "2000-01-01", "2000-03-31")
    plans["serve_segment"] = lambda: K.users_in_segment(spark.read.parquet(segment_path), "high_value")
    if wanted:
        plans = {name: plan for name, plan in plans.items() if name in wanted}

    started = time.perf_counter()
    I.kpis(spark, folder).orderBy("kpi_date").write.partitionBy("metric_version").parquet(kpi_path)
    I.segments(spark, folder).write.partitionBy("segment_date").parquet(segment_path)
    cold["build_marts"] = round(time.perf_counter() - started, 3)
    for name in ("change_messages", "damaged_messages"):
        landed = scratch_path(spark, name)
        getattr(I, name)(spark, folder).repartition(int(cpus)).write.parquet(landed)
        setattr(I, name, lambda s, _, landed=landed: s.read.parquet(landed))
    for number in range(1 + repeat):
        for name, build in plans.items():
            started = time.perf_counter()
            run(build())
            took = round(time.perf_counter() - started, 3)
            if number == 0:
                cold[name] = took
            else:
                times[name] = min(took, times.get(name, took))
    for name in plans:
        print(f"{name}: cold {cold[name]} warm {times.get(name)}", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "warm seconds over headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
