"""Schema contract (K7, G3), rejects and tally (B12, D16), answer scan (A4), quantile sketches (D17), stored stages (D13, D14), names."""
import tempfile

import pytest
from pyspark.sql import functions as F

from groundwork.functions import clean
from groundwork.operators import extract, names, quality
from groundwork.plans import pipeline
from groundwork.sources import files
from groundwork.sources import io as IO

CONTRACT = (quality.Field("id", "STRING", required=True), quality.Field("n", "INTEGER"), quality.Field("at", "TIMESTAMP", required=True))


def test_schema_contract(spark):
    good = spark.createDataFrame([("a", 1, None, "x")], "id string, n long, at timestamp, more string")
    checks = {r.check_name: (r.failures, r.passed) for r in quality.schema_contract(good, "t", CONTRACT).collect()}
    assert checks == {
        "column_present(id)": (0, True), "column_type(id)": (0, True), "column_present(n)": (0, True), "column_type(n)": (0, True),
        "column_present(at)": (0, True), "column_type(at)": (0, True), "not_null(id)": (0, True), "not_null(at)": (1, False),
    }
    bad = spark.createDataFrame([(1, "x"), (None, "y")], "id int, n string")
    failed = {r.check_name: r.failures for r in quality.schema_contract(bad, "t", CONTRACT).where("NOT passed").collect()}
    assert failed == {"column_type(id)": 1, "column_type(n)": 1, "column_present(at)": 1, "not_null(id)": 1, "not_null(at)": 2}
    assert quality.missing_columns(bad, CONTRACT) == ["at"]
    empty = spark.createDataFrame([], "id string, n int, at timestamp_ntz")
    assert quality.schema_contract(empty, "t", CONTRACT).where("NOT passed").count() == 0
    assert quality.missing_columns(spark.range(1).select(F.lit(1).alias("id")), CONTRACT) == ["n", "at"]


def test_contract_reads_required_columns_only(spark, small_dir):
    base = tempfile.mkdtemp(prefix="gw-contract-")
    spark.createDataFrame([("a", 1, None, "x")], "id string, n long, at timestamp, more string").write.parquet(f"{base}/t")
    plan = quality.schema_contract(spark.read.parquet(f"{base}/t"), "t", CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,at:timestamp>" in plan


def test_gate_names_contract_failures(spark):
    bad = spark.createDataFrame([("a", 1)], "id string, n long")
    with pytest.raises(ValueError, match=r"column_present\(at\)"):
        quality.gate(quality.schema_contract(bad, "t", CONTRACT))


ANSWERS = [
    ('{"year": "1999", "builder_name": "B"}', True), ('```json\n{"year": 0}\n```', True), ("{}", True),
    ('{"a": 1} trailing', False), ('{"a": 1} {"b": 2}', False), ('{"a": 1}, {"b": 2}', False), ("[1]", False), ("7", False),
    ('{"a": ', False), ("", False), (None, False), ('```json\n{"a": 1}\n``` and more', False),
]


def test_answers_are_one_object(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ANSWERS)], "i int, answer_text string")
    got = {r.i: r for r in extract.parse_json(df).select("i", "is_valid", "reject_reason", "corrupt_record", F.col("answer").isNotNull().alias("has")).collect()}
    for i, (text, ok) in enumerate(ANSWERS):
        assert got[i].is_valid == ok == got[i].has and (got[i].reject_reason is None) == ok
        assert got[i].corrupt_record == (None if ok else text)
    assert got[10].reject_reason == "no answer" and got[9].reject_reason == "empty answer"


def test_score_counts_values_as_filled_by_their_type(spark):
    texts = ['{"year": 0, "month": "0"}', '{"year": "0"}', '{"year": 0.0, "month": "", "builder_name": false}', '{"year": 1999, "description": " "}', '{"services": [{"service_type": 0}, {"service_type": "x", "hours": 2}]}']
    df = extract.parse_json(spark.createDataFrame([(t,) for t in texts], "answer_text string"))
    rows = df.select(F.round(extract.extraction_score(F.col("answer")) * 7, 6).alias("s"), clean.year(extract.text_of(F.col("answer.year"))).alias("y"),
                     F.size(extract.normalize_services(F.col("answer.services"))).alias("n")).collect()
    assert [r.s for r in rows] == [1, 1, 0, 2, 0.7] and rows[4].n == 1 and rows[3].y == 1999


def test_scan_answers_whole_files_and_records(spark):
    base = tempfile.mkdtemp(prefix="gw-answers-")
    texts = [t for t, _ in ANSWERS if t]
    for k, t in enumerate(texts):
        with open(f"{base}/a{k:02}.txt", "w") as f:
            f.write(t)
    valid = sum(ok for t, ok in ANSWERS if t)
    whole = IO.scan_answers(spark, base)
    assert whole.count() == len(texts) and whole.where("is_valid").count() == valid
    one = tempfile.mkdtemp(prefix="gw-answers-")
    with open(f"{one}/all", "w") as f:
        f.write("\x1e".join(texts))
    assert IO.scan_answers(spark, one, "\x1e").where("is_valid").count() == valid


def test_write_split_and_tally(spark):
    base = tempfile.mkdtemp(prefix="gw-split-")
    df = spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "i int, reject_reason string")
    valid, rejects, tally = quality.write_split(df, f"{base}/t")
    assert sorted(r.i for r in valid.collect()) == [1, 3] and valid.columns == ["i"]
    assert [(r.i, r.reject_reason) for r in rejects.collect()] == [(2, "bad")]
    assert tally == {"successful": 2, "failed": 1, "total": 3}
    assert tuple(quality.run_summary(spark, tally).first()) == (2, 1, 3)
    for name, some in (("none", df.limit(0)), ("good", df.where("reject_reason IS NULL"))):
        valid, rejects, tally = quality.write_split(some, f"{base}/{name}")
        assert rejects.count() == 0 and valid.count() == tally["successful"] == tally["total"]


def test_sketches_merge_within_their_rank_error(spark, small_dir):
    ev = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("stage"), (F.xxhash64("id") % 100_000 / 97.0).alias("duration_s"),
                                     (F.col("id") % 9 != 0).alias("success"), (F.col("id") % 24).alias("hour"))
    hourly = quality.stage_sketches(ev, ["hour"])
    assert hourly.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    merged = quality.merge_profiles(hourly)
    exact = quality.stage_profile(ev)
    same = [c for c in exact.columns if c not in ("p50", "p95", "p99", "avg_duration")]
    assert merged.select(same).exceptAll(exact.select(same)).count() == 0
    errors = quality.rank_errors(ev, merged).collect()
    assert len(errors) == 6 and all(r.rank_error <= 0.01 for r in errors)
    assert all(r.rank_error <= 1e-4 for r in quality.rank_errors(ev, exact).collect())
    assert quality.merge_profiles(quality.stage_sketches(ev.limit(0), ["hour"])).count() == 0


def test_counts_come_with_the_writes(spark, small_dir):
    p = pipeline.Pipeline(spark, small_dir)
    counts = p.row_counts()
    assert list(counts) == list(p.TABLES)
    assert counts["raw_work_orders"] == counts["raw_work_orders_corrected"] == p.raw().count() == p.corrected().count()
    for name, df in (("stg_work_orders", p.staging()), ("dim_projects", p.dim_projects()), ("fct_work_orders", p.fact())):
        assert counts[name] == df.count() == quality.stored_rows(spark, f"{p._folder}/{name}")
        plan = df.groupBy().count()._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and "ReadSchema: struct<>" in plan
    status = {r.table_name: r.status for r in quality.table_status(spark, {"a": 3, "b": 0, "c": None}).collect()}
    assert status == {"a": "LIVE", "b": "EMPTY", "c": "MISSING"}
    assert not quality.reconcile(spark, 3, 3, 2).first().counts_match and not quality.reconcile(spark, 0, 0, 0).first().counts_match
    folder = p._folder
    p.drop()
    assert files.names(spark, folder) == []


def test_name_candidates_do_not_grow_with_a_shared_prefix(spark):
    """500 names that share a long prefix: candidates per name stay near the pairs that are truly near."""
    rows = []
    for n in (250, 500):
        own = [f"BUILDER GROUP {''.join(chr(65 + (k * 7919 * m) % 26) for m in (1, 3, 5, 11, 17, 29, 31))} {k % 10}" for k in range(n)]
        dk = spark.createDataFrame([(x,) for x in sorted(set(own))], "_dkey string")
        nk = spark.createDataFrame([(x.replace("GROUP", "GRUP"),) for x in sorted(set(own))], "_nkey string")
        pairs = names.neighbours(nk, dk, 1)
        true = names.fuzzy_candidates(nk, dk, 1).count()
        rows.append((dk.count(), pairs.count(), true))
    for size, found, true in rows:
        assert true >= size and found <= 2 * true and found < 10 * size < size * size / 2
