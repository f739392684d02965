"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and run to a ``noop`` sink (every column computed, no
output written): one warm-up, then the median of three timed runs.  Build
time is included, because stage materialisation is part of each job.

Besides wall time it reports, per query, the rows out (an observed metric of
the write, no extra job) and the shuffle bytes written by the median run,
read from Spark's event log in a fresh scratch folder (jobs are attributed
to a run by submission time, so background stage jobs count too).
Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.registry import REGISTRY, clear_shared  # noqa: E402
from tillroll.plans.session import build_session  # noqa: E402

HEADLINE = [
    "profit_by_title",
    "items",
    "retail_sales_by_item",
    "not_received_all",
    "not_received_cdc",
    "not_received_vendor",
]


def run_once(spark, name: str, sf_dir: str) -> tuple[float, float, float, int]:
    """(seconds, start ms, end ms, rows out) of one cold build-and-run."""
    fn, _ = REGISTRY[name]
    clear_shared()
    obs = Observation(f"bench_rows_{name}_{time.time_ns()}")
    start = time.time() * 1000
    t0 = time.perf_counter()
    fn(spark, sf_dir).observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    sec = time.perf_counter() - t0
    return sec, start, time.time() * 1000, int(obs.get["rows"])


def shuffle_bytes_by_window(event_dir: str, windows: dict[str, tuple[float, float]]) -> dict[str, int]:
    """Shuffle bytes written by the jobs submitted inside each time window."""
    files = [f for f in glob.glob(f"{event_dir}/**/*", recursive=True) if os.path.isfile(f) and "events" in os.path.basename(f)]
    files += [f for f in glob.glob(f"{event_dir}/*") if os.path.isfile(f)]
    stage_job, job_time, stage_bytes = {}, {}, {}
    for path in sorted(set(files)):
        with open(path, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                try:
                    e = json.loads(line)
                except ValueError:
                    continue
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    job_time[e["Job ID"]] = e.get("Submission Time", 0)
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = e["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    sid = e.get("Stage ID")
                    stage_bytes[sid] = stage_bytes.get(sid, 0) + int(m.get("Shuffle Bytes Written", 0))
    out = {name: 0 for name in windows}
    for sid, nbytes in stage_bytes.items():
        t = job_time.get(stage_job.get(sid), -1)
        for name, (lo, hi) in windows.items():
            if lo <= t <= hi:
                out[name] += nbytes
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    event_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": event_dir,
            "spark.eventLog.compress": "false",
        },
    )
    secs, rows, windows = {}, {}, {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        runs = sorted(run_once(spark, name, sf_dir) for _ in range(reps))
        median = runs[len(runs) // 2]
        secs[name] = round(statistics.median(r[0] for r in runs), 3)
        rows[name] = median[3]
        windows[name] = (median[1], median[2])
    spark.stop()  # flush the event log
    shuffle = shuffle_bytes_by_window(event_dir, windows)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_sec",
                "value": round(sum(secs.values()), 3),
                "unit": "sec",
                "queries": secs,
                "sf": sf,
                "cpus": int(cpus),
                "rows_out": rows,
                "shuffle_bytes": shuffle,
            }
        )
    )


if __name__ == "__main__":
    main()
