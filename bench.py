"""Benchmark: build the star schema once, then time each report on it.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4).
Prints one JSON line. Stages are forced with the `noop` sink (full
computation, nothing collected); marts are written as Parquet to a scratch
folder under the session's checkpoint dir and read back, as a deployment
would serve reports from stored tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from groundwork.operators import quality  # noqa: E402
from groundwork.plans import reports as R  # noqa: E402
from groundwork.plans.pipeline import Pipeline  # noqa: E402
from groundwork.session import local_session  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="groundwork-bench")
    scratch = tempfile.mkdtemp(prefix="groundwork-bench-")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    # the bench writes each stage itself, so the pipeline stores none
    p = Pipeline(spark, sf_dir, store=False)
    # L1: numbered answers -> raw rows (parse only)
    timed("l1_raw_build", lambda: run(p.raw_from_answers()))
    # the wide raw table, for the quality suite; L2-L4 + marts, written once
    paths = {n: os.path.join(scratch, n) for n in
             ["raw", "stg", "dim_builders", "dim_projects", "dim_companies", "fct", "fsl", "dbc"]}
    p.raw().write.mode("overwrite").parquet(paths["raw"])
    timed("l2_l4_staging_write", lambda: p.staging().write.mode("overwrite").parquet(paths["stg"]))
    stg = spark.read.parquet(paths["stg"])
    from groundwork.operators import marts
    from groundwork.sources import fixture

    def build_marts():
        db = marts.dim_builders(stg, p.dictionary())
        dp = marts.dim_projects(stg)
        dc = marts.dim_companies(stg)
        db.write.mode("overwrite").parquet(paths["dim_builders"])
        dp.write.mode("overwrite").parquet(paths["dim_projects"])
        dc.write.mode("overwrite").parquet(paths["dim_companies"])
        db, dp, dc = (spark.read.parquet(paths[n]) for n in ("dim_builders", "dim_projects", "dim_companies"))
        f = marts.fact(stg, db, dp, dc)
        f.write.mode("overwrite").parquet(paths["fct"])
        f = spark.read.parquet(paths["fct"])
        fsl = marts.fct_service_lines(f, fixture.service_line_source(spark, sf_dir))
        fsl.write.mode("overwrite").partitionBy("work_date").parquet(paths["fsl"])
        marts.dim_builders_conformed(f, db).write.mode("overwrite").parquet(paths["dbc"])

    timed("l5_l6_marts_write", build_marts)
    fsl = spark.read.parquet(paths["fsl"])
    dbc = spark.read.parquet(paths["dbc"])
    dp = spark.read.parquet(paths["dim_projects"])
    tables = {
        "stg_work_orders": stg,
        "dim_builders": spark.read.parquet(paths["dim_builders"]),
        "dim_projects": dp,
        "dim_companies": spark.read.parquet(paths["dim_companies"]),
        "fct_work_orders": spark.read.parquet(paths["fct"]),
        "raw_work_orders": spark.read.parquet(paths["raw"]),
    }
    timed("l7_work_orders", lambda: run(R.work_orders(fsl, dbc, dp, fct=spark.read.parquet(paths["fct"]))))
    timed("l8_builders", lambda: run(R.builders(fsl, dbc)))
    timed("l9_projects", lambda: run(R.projects(fsl, dp)))
    timed("l10_dashboard_30d", lambda: run(R.dashboard(fsl, dbc, days=30)))
    timed("l10_dashboard_365d", lambda: run(R.dashboard(fsl, dbc, days=365)))
    timed("l11_quality_suite", lambda: run(quality.run_suite(tables, quality.DEFAULT_SUITE)))
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_pipeline_and_reports", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
