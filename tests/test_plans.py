"""Plan checks: no Python evaluation or cartesian products in the flagship paths."""
from groundwork.plans import reports as R
from groundwork.plans.pipeline import Pipeline


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plans(spark, small_dir):
    p = Pipeline(spark, small_dir)
    for df in [p.staging(), p.fact(), R.builders(p.service_lines(), p.dim_builders_conformed())]:
        t = plan_text(df)
        assert "BatchEvalPython" not in t and "ArrowEvalPython" not in t
        assert "CartesianProduct" not in t


def test_scan_prunes_columns(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/lineitem.parquet").select("l_orderkey").filter("l_orderkey < 10")
    t = plan_text(df)
    assert "PushedFilters: [IsNotNull(l_orderkey), LessThan(l_orderkey,10)]" in t
    assert "ReadSchema: struct<l_orderkey:bigint>" in t
