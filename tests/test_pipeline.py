"""Star-schema invariants on the smallest test tables."""
import datetime as dt

from pyspark.sql import functions as F

from groundwork.operators import incremental, quality, staging
from groundwork.plans import reports as R
from groundwork.plans.pipeline import Pipeline


def test_fact_keeps_one_row_per_order(spark, small_dir):
    p = Pipeline(spark, small_dir)
    stg, fct = p.staging(), p.fact()
    n_stg = stg.count()
    assert fct.count() == n_stg == fct.select("work_order_id").distinct().count()
    bad = stg.filter((F.col("data_completeness_score") < 0) | (F.col("data_completeness_score") > 1)).count()
    assert bad == 0
    # every fact key resolves to exactly one conformed dim row
    dbc = p.dim_builders_conformed()
    assert dbc.count() == dbc.select("builder_key").distinct().count()


def test_reports_run_and_bounds(spark, small_dir):
    p = Pipeline(spark, small_dir)
    fsl, dbc, dp = p.service_lines(), p.dim_builders_conformed(), p.dim_projects()
    assert R.work_orders(fsl, dbc, dp, limit=7, offset=3).count() == 7
    d = R.dashboard(fsl, dbc, days=365).first()
    assert d.total_orders_30d >= 0 and len(d.top_builders) <= 10
    assert [x.work_date for x in d.daily_trend] == sorted(x.work_date for x in d.daily_trend)


def test_upsert_idempotent_and_slices_equal_full(spark, small_dir):
    p = Pipeline(spark, small_dir)
    stg = p.staging().select("work_order_id", "extracted_at", "data_completeness_score")
    cut = F.lit(dt.datetime(1999, 1, 1))
    first = stg.filter(F.col("extracted_at") <= cut)
    second = stg.filter(F.col("extracted_at") > cut)
    t1 = incremental.upsert(None, first, "work_order_id", "extracted_at")
    new = incremental.newer_than(stg, t1, "extracted_at")
    assert new.count() == second.count()
    t2 = incremental.upsert(t1, new, "work_order_id", "extracted_at")
    t3 = incremental.upsert(t2, new, "work_order_id", "extracted_at")
    full = incremental.upsert(None, stg, "work_order_id", "extracted_at")
    assert t2.exceptAll(full).count() == 0 and full.exceptAll(t2).count() == 0
    assert t3.exceptAll(t2).count() == 0 and t2.count() == t3.count()


def test_empty_target_mark_lets_nothing_through(spark, small_dir):
    stg = Pipeline(spark, small_dir).staging().select("work_order_id", "extracted_at")
    empty = stg.limit(0)
    assert incremental.newer_than(stg, empty, "extracted_at").count() == 0
    assert incremental.newer_than(stg, empty, "extracted_at", bootstrap=True).count() == stg.count()


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    out = {r.k: r.v for r in incremental.latest(df, "k", ["t"]).collect()}
    assert out == {"a": "y", "b": "z"}


def test_update_column(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, x string")
    s = spark.createDataFrame([("1", "cat")], "id string, ml string")
    out = {r.id: r.ml for r in incremental.update_column(t, s, "id", ["ml"]).collect()}
    assert out == {"1": "cat", "2": None}


def test_quality_suite_and_gate(spark, small_dir):
    p = Pipeline(spark, small_dir)
    tables = {"stg_work_orders": p.staging(), "dim_builders": p.dim_builders(), "dim_projects": p.dim_projects(),
              "dim_companies": p.dim_companies(), "fct_work_orders": p.fact(), "raw_work_orders": p.raw()}
    res = quality.run_suite(tables, quality.DEFAULT_SUITE).collect()
    assert len(res) == sum(len(v) for v in quality.DEFAULT_SUITE.values())
    by = {(r.model, r.check_name): r for r in res}
    assert by[("stg_work_orders", "unique(work_order_id)")].passed
    assert by[("stg_work_orders", "not_null(work_order_number)")].passed  # a marker is no NULL
    assert not by[("stg_work_orders", "accepted_range(year)")].passed  # orders before 2000
    assert not by[("dim_builders", "unique(builder_key)")].passed  # several raw names share a corrected key
    try:
        quality.gate(quality.run_suite(tables, quality.DEFAULT_SUITE))
        raised = False
    except ValueError:
        raised = True
    assert raised
    pc = {r.check_name: r.passed for r in quality.pipeline_checks(p.raw(), p.fact(), p.with_ml()).collect()}
    assert all(pc.values()) and len(pc) == 3


def test_flags_see_nulls_only(spark):
    rows = [(None, None), ("N/A", ""), ("1", "B")]
    df = staging.flags(spark.createDataFrame(rows, "work_order_number string, builder_name string"))
    assert [(r.missing_wo_number, r.missing_builder) for r in df.collect()] == [(True, True), (False, True), (False, False)]


def test_page_is_cut_before_lines_are_summed(spark, small_dir):
    p = Pipeline(spark, small_dir)
    fsl, dbc, dp = p.service_lines(), p.dim_builders_conformed(), p.dim_projects()
    whole = R.work_orders(fsl, dbc, dp, limit=1000, fct=p.fact()).collect()
    assert whole == R.work_orders(fsl, dbc, dp, limit=1000).collect()
    assert R.work_orders(fsl, dbc, dp, limit=5, offset=3, fct=p.fact()).collect() == whole[3:8]
