"""What a run holds on disk: shuffle files go with their stage, stages are written in slices, only the marts stay for reports."""
import random
import time

import pytest
from groundwork.operators import correct, incremental
from groundwork.plans import pipeline
from groundwork.plans.pipeline import Pipeline
from groundwork.sources import files
from groundwork.sources.tables import Table
from pyspark.sql import functions as F


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Orders that come twice or have no key, lines without an order, orders without lines and one of 30 lines."""
    rng = random.Random(3)
    orders = [(k, (k or 0) % 5 + 1, "2001-03-04") for k in [*range(1, 41), 7, 7, 8, None, None]]
    keys = [k for k in [*range(1, 36), None, 99] for _ in range(rng.randint(1, 6))] + [9] * 30
    lines = [(k, rng.randint(1, 4), rng.randint(1, 9), rng.randint(1, 4), 1.0, 10.0, 0.1, 0.0, rng.choice("ANR"), rng.choice("FO"), "2001-05-06") for k in keys]
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderdate string", orders),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string", [(k, f"p{k}", f"b{k % 2}", "t") for k in range(4)]),
        "customer": ("c_custkey long", [(k,) for k in range(6)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate string", lines),
    }
    for name, (schema, rows) in tables.items():
        df = spark.createDataFrame(rows, schema)
        for c in df.columns:
            df = df.withColumn(c, F.col(c).cast("timestamp")) if c.endswith("date") else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}


def gone(spark, before):
    """Files are removed in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_shuffle_files_go_when_a_stage_is_written(spark, odd_tables):
    p, before = Pipeline(spark, odd_tables), shuffle_files(spark)
    p.raw()
    p.category_answers()
    assert gone(spark, before)


def test_slices_hold_the_rows_of_the_whole(spark, odd_tables, monkeypatch):
    monkeypatch.setattr(pipeline, "SLICE_ORDERS", 10)
    p, whole = Pipeline(spark, odd_tables), Pipeline(spark, odd_tables, store=False)
    n = p.with_ml().count()
    assert p._slices() == 3 and len(files.names(spark, f"{p._folder}/raw_work_orders")) == 3
    assert same_rows(p.raw(), whole.raw()) and same_rows(p.with_ml(), whole.with_ml())
    assert same_rows(p.service_lines().drop("line_no"), whole.service_lines().drop("line_no"))
    assert n == p.raw().count() and {p.counts[t] for t in Pipeline.TABLES[:3]} == {n}


def test_few_names_are_broadcast(spark, odd_tables):
    """The wide rows are not shuffled by name."""
    p = Pipeline(spark, odd_tables)
    assert "strategy=broadcast" in p.corrected()._jdf.queryExecution().optimizedPlan().toString()
    assert same_rows(p.corrected(), correct.correct(p.raw(), p.dictionary(), p.run_ts))


def test_reports_keep_the_marts_alone(spark, odd_tables):
    p = Pipeline(spark, odd_tables)
    want = p.raw().orderBy("work_order_id").collect()
    p.keep_marts()
    assert files.names(spark, p._folder) == ["dim_builders", "dim_companies", "dim_projects", "fct_work_orders"]
    assert p.service_lines().count() > 0 and p.row_counts()["raw_work_orders"] == len(want)
    assert p.raw().orderBy("work_order_id").collect() == want and p.with_ml().count() == p.counts["raw_work_orders"] == len(want)


def test_newest_moves_a_row_once(spark):
    """The maximum of a key's rows is its newest row, as a plain loop finds it: NULL times first, ties by the other columns."""
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]), rng.choice([None, 0.5, 1.5])) for _ in range(60)]
    df = spark.createDataFrame(rows, "v string, t int, k string, w double")
    best = incremental.newest(df, "k", "t")
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and best.columns == ["v", "t", "k", "w"]
    order = lambda r: [(x is not None, x) if x is not None else (False,) for x in (r[1], r[0], r[3])]
    want = {k: max((r for r in rows if r[2] == k), key=order) for k in (None, "x", "y")}
    assert {r.k: tuple(r) for r in best.collect()} == want


def test_a_merge_leaves_no_shuffle_files(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", "k", "t", "t", "day")
    rows = lambda *days: spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k int, t string").withColumn("t", F.col("t").cast("timestamp"))
    before = shuffle_files(spark)
    assert table.merge(rows("2001-01-01", "2001-01-02", None)) == ["2001-01-01", "2001-01-02", "__HIVE_DEFAULT_PARTITION__"]
    assert table.merge(rows("2001-01-03")) == ["2001-01-01", "2001-01-03"]
    assert {r.k: r.t and str(r.t)[:10] for r in table.read().collect()} == {0: "2001-01-03", 1: "2001-01-02", 2: None}
    kept = {f.split("_")[1] for f in shuffle_files(spark) - before}
    assert len(kept) <= 8  # of collected partition names alone, whatever the rows are
