"""Headline-query benchmark. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_ONLY (comma list), BENCH_EVENT_LOG (directory for
Spark's event log). Raw and bronze layers are written once beforehand; each query
gets one warm-up and the median of BENCH_RUNS timed runs. Results are executed in
full with the ``noop`` sink (or collected when they are a page / a suite result),
so no time is spent moving rows into Python.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from monthlake.session import build_session, scratch_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times without the UI
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(f"local[{cpus}]", max(8, cpus * 2), app="monthlake-bench", extra=extra)

    from monthlake import queries as Qs
    from monthlake.operators import serve as SV
    from monthlake.plans import pipeline as PL
    from monthlake.plans import warehouse as W
    from monthlake.plans.checks import WAREHOUSE_CHECKS
    from monthlake.plans.fact import build_fact
    from monthlake.plans.mart import build_mart
    from monthlake.plans.staging import stage
    from monthlake.sources.ingest import read_periods
    from monthlake import schemas

    # Layers written beforehand (not timed): raw period files, bronze, fact, dims.
    W.bronze(spark, sf_dir)
    raw_dir = W.layer_path(spark, sf_dir, "raw")
    W.fact(spark, sf_dir)
    for d in ("dim_terceirizados", "dim_orgaos_superiores"):
        W.dim(spark, sf_dir, d)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def q_staging():
        noop(stage(read_periods(spark, raw_dir, schema=schemas.RAW), run_ts=W.FIXED_RUN_TS))

    def q_fact():
        noop(build_fact(W.bronze(spark, sf_dir)))

    def q_upsert():
        noop(Qs.QUERIES["upsert_scd1"](spark, sf_dir))

    def q_fact_incremental():
        noop(Qs.QUERIES["fact_incremental"](spark, sf_dir))

    def q_mart():
        noop(build_mart(W.fact(spark, sf_dir), W.dim(spark, sf_dir, "dim_terceirizados"),
                        W.dim(spark, sf_dir, "dim_orgaos_superiores"), W.newest(spark, sf_dir)))

    def q_page():
        path = Qs._bronze_pages(spark, sf_dir)  # written once, in page order
        first = SV.page(spark, path, "id_terceirizado", 0, 20).collect()
        deep = SV.page(spark, path, "id_terceirizado", 100_000, 200).collect()
        total = SV.total_rows(spark, path)
        assert first and total and (deep or total <= 100_000)

    def q_dq():
        rows = Qs.QUERIES["dq_suite"](spark, sf_dir).collect()
        assert len(rows) == len(WAREHOUSE_CHECKS)

    def q_pipeline():
        PL.run(spark, scratch_path(spark, "bench-run"), "*", run_ts=W.FIXED_RUN_TS, raw=raw_dir).count()

    benches = {
        "staging_typed": q_staging,
        "fact_build": q_fact,
        "upsert_scd1": q_upsert,
        "fact_incremental": q_fact_incremental,
        "mart_latest": q_mart,
        "page_list": q_page,
        "dq_suite": q_dq,
        "pipeline_end_to_end": q_pipeline,
    }
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    out = {}
    for name, fn in benches.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
