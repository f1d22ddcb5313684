"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the cores. Every query is
built and fully computed into a sink that discards its rows. The whole list is run ``BENCH_RUNS`` times (default 2,
the first round warms up) and the best time of each query counts. The given tables are single small files, which one
task each would read; ``BENCH_SPREAD`` (default: the cores) deals them to so many partitions first, ``""`` does not.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdcflow.plans import registry  # noqa: E402
from cdcflow.plans.testdata import SPREAD  # noqa: E402
from cdcflow.session import local_session  # noqa: E402

HEADLINE = [
    "q_parse_envelope",
    "q_current_state",
    "q_audit",
    "q_audit_hot_keys",
    "q_unpivot_tags",
    "q_resolve_names",
    "q_flatten_wide",
    "q_flatten_repeated_keys",
    "q_large_lookup",
    "q_account_view",
    "q_flatten_events",
    "q_virtual_columns",
    "q_trace",
    "q_first_visibility",
    "q_report_by_op",
    "q_report_by_workload",
    "q_report_leg_share",
    "q_merge_upsert",
    "q_merge_files",
    "q_delete_vectors",
    "q_snapshot_diff",
    "q_capture_trace",
    "q_stream_current_state",
    "q_stream_upsert",
    "q_stream_flatten",
    "q_stream_flatten_events",
    "q_stream_audit",
    "q_stream_trace",
]


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    conf = {"spark.checkpoint.dir": scratch, SPREAD: os.environ.get("BENCH_SPREAD", cpus)}
    spark = local_session("bench", cpus, memory=os.environ.get("BENCH_MEMORY", "12g"), conf=conf)
    spark.sparkContext.setLogLevel("OFF")
    all_queries = registry.queries()
    names = sys.argv[1:] or HEADLINE
    rounds = [{name: seconds(spark, all_queries[name], sf_dir) for name in names} for _ in range(runs)]
    times = {name: round(min(r[name] for r in rounds), 3) for name in names}
    # Whole tables per second, for the operators whose input is one of them.
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "events")}
    rates = {
        f"{name}_{table}_per_sec": round(sizes[table] / times[name])
        for name, table in (
            ("q_flatten_wide", "orders"),
            ("q_account_view", "orders"),
            ("q_current_state", "events"),
            ("q_audit", "events"),
            ("q_trace", "events"),
            ("q_stream_flatten", "events"),
            ("q_stream_audit", "events"),
        )
        if name in times
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
