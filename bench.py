"""Benchmark the headline jobs at one scale factor; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each job: one warm-up, then the median of BENCH_RUNS runs.  A run builds the DataFrame (including
any surrogate-key bookkeeping jobs) from an empty cache and executes it fully into Spark's no-op
sink.  Rows out and
shuffle bytes written (per run, from Spark's event log in a fresh scratch folder) are reported
next to the times.
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

from healthmart import queries as Q  # noqa: E402
from healthmart.plans import facts as FT  # noqa: E402
from healthmart.plans import warehouse as W  # noqa: E402
from healthmart.session import build_session  # noqa: E402
from healthmart.operators.keys import release_scratch  # noqa: E402
from healthmart.sources.roles import role_views  # noqa: E402
from tests.naive import fact_disease_outcome_no_country_naive  # noqa: E402

HEADLINE = ["c6_profit_per_company", "c3_patients_per_company", "c1_target_patients", "c2_other_patients",
            "b1_fact_disease_outcome", "b2_fact_outcome_no_country", "s1j_fact_restated",
            "r1_medical_records_doctor", "r6_patient_own_record", "a10_enrich_outcomes_batch",
            "m9_dim_diseased_patient", "c11_after_merger_profit_per_company"]


def b2_naive(spark, d):
    v = role_views(spark, d)
    person, cond = v.person(), v.condition()
    cells = FT.person_cells(person, cond, W.dim_disease(cond), W.dim_gender(person))
    return fact_disease_outcome_no_country_naive(v.outcome(), cells, v.indication(), v.profit())


def run(build, spark, sf_dir, label: str) -> float:
    # Persisted frames of an earlier run have the same plans and would be reused: every run
    # starts from an empty cache so it recomputes everything.
    spark.catalog.clearCache()
    release_scratch(spark)
    spark.sparkContext.setJobDescription(label)
    t0 = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job description, summed over that description's stages."""
    stage_label: dict[int, str] = {}
    written: dict[str, int] = {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    label = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_label[sid] = label
                elif kind == "SparkListenerTaskEnd":
                    label = stage_label.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if label:
                        written[label] = written.get(label, 0) + int(m.get("Shuffle Bytes Written", 0))
    return written


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    jobs = {name: Q.REGISTRY[name].build for name in HEADLINE}
    jobs["b2_naive_join_comparison"] = b2_naive
    if only:
        jobs = {k: v for k, v in jobs.items() if any(o in k for o in only)}
    conf = {"spark.driver.memory": "16g"}

    # Phase 1: timings (no event log, so nothing but the jobs is measured).
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="healthmart-bench", extra=conf)
    times = {}
    for name, build in jobs.items():
        run(build, spark, sf_dir, f"{name}:warmup")
        times[name] = round(statistics.median(run(build, spark, sf_dir, f"{name}:run{i}") for i in range(runs)), 3)
    spark.stop()

    # Phase 2: one more run per job in a session with an event log in a fresh scratch folder,
    # for rows out and shuffle bytes written.
    rows_out, shuffle = {}, {}
    if os.environ.get("BENCH_EVENT_LOG", "1") == "1":
        log_dir = tempfile.mkdtemp(prefix="healthmart-eventlog-")
        spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="healthmart-bench-metrics",
                              extra={**conf, "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                     "spark.eventLog.compress": "false"})
        for name, build in jobs.items():
            run(build, spark, sf_dir, f"{name}:measured")
            spark.catalog.clearCache()
            spark.sparkContext.setJobDescription(f"{name}:count")
            rows_out[name] = build(spark, sf_dir).count()
        spark.stop()
        written = shuffle_bytes(log_dir)
        shuffle = {name: written.get(f"{name}:measured", 0) for name in jobs}

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    headline = {k: v for k, v in times.items() if k != "b2_naive_join_comparison"}
    print(json.dumps({"metric": "sum of median job seconds (headline jobs)", "value": round(sum(headline.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "shuffle_partitions": cpus, "runs": runs, "rows_out": rows_out,
                      "shuffle_bytes_per_run": shuffle}))


if __name__ == "__main__":
    main()
