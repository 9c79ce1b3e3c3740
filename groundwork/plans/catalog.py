"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

given tables (through the fixture mapping) and runs over all of their rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.plans import reports as R
from groundwork.plans.pipeline import Pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(spark, sf_dir)


def _served(spark: SparkSession, sf_dir: str) -> Pipeline:
    """A run of which only the marts are read any more."""
    p = _p(spark, sf_dir)
    p.keep_marts()
    return p


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


@register("l1_raw_build")
def l1_raw_build(spark, d):
    return _p(spark, d).raw_from_answers()


@register("l1_from_documents")
def l1_from_documents(spark, d):
    """Raw rows of documents: the model hook reads them (J1), its answers are parsed (H6, B1)."""
    p = _p(spark, d)
    return p.raw_and_rejects(p.read_documents(FX.documents(spark, d), extract.text_document))[0]


@register("l1_unread_documents")
def l1_unread_documents(spark, d):
    """The documents that the model hook could not read, with the kind of error."""
    p = _p(spark, d)
    rejects = p.raw_and_rejects(p.read_documents(FX.documents(spark, d), extract.text_document))[1]
    return rejects.select("work_order_id", "file_url", F.substring_index("error", ":", 1).alias("error"))


@register("l2_corrected")
def l2_corrected(spark, d):
    return _p(spark, d).corrected()


@register("l3_categorized")
def l3_categorized(spark, d):
    return _p(spark, d).categories()


@register("l4_staging")
def l4_staging(spark, d):
    return _p(spark, d).staging()


@register("l5_dim_builders")
def l5_dim_builders(spark, d):
    return _no_audit(_p(spark, d).dim_builders())


@register("l5_dim_projects")
def l5_dim_projects(spark, d):
    return _no_audit(_p(spark, d).dim_projects())


@register("l5_dim_companies")
def l5_dim_companies(spark, d):
    return _no_audit(_p(spark, d).dim_companies())


@register("l5_dim_builders_conformed")
def l5_dim_builders_conformed(spark, d):
    return _p(spark, d).dim_builders_conformed()


@register("l6_fact")
def l6_fact(spark, d):
    return _no_audit(_p(spark, d).fact())


@register("l6_service_lines")
def l6_service_lines(spark, d):
    return _served(spark, d).service_lines()


@register("l7_work_orders")
def l7_work_orders(spark, d):
    p = _served(spark, d)
    return R.work_orders(p.service_lines(), p.dim_builders_conformed(), p.dim_projects(), fct=p.fact())


@register("l7_work_orders_filtered")
def l7_work_orders_filtered(spark, d):
    p = _served(spark, d)
    return R.work_orders(p.service_lines(), p.dim_builders_conformed(), p.dim_projects(),
                         start=_dt.date(1998, 1, 1), end=_dt.date(1999, 12, 31),
                         builder_name="group", project_name="brand#1", limit=50, offset=20, fct=p.fact())


@register("l8_builders")
def l8_builders(spark, d):
    p = _served(spark, d)
    return R.builders(p.service_lines(), p.dim_builders_conformed())


@register("l8_builders_platinum_active")
def l8_builders_platinum_active(spark, d):
    p = _served(spark, d)
    return R.builders(p.service_lines(), p.dim_builders_conformed(), tier="Platinum",
                      activity_status="Active", limit=20)


@register("l9_projects")
def l9_projects(spark, d):
    p = _served(spark, d)
    return R.projects(p.service_lines(), p.dim_projects())


def _window_queries(days: int):
    @register(f"d8_daily_trend_{days}d")
    def _trend(spark, d):
        return R.daily_trend(_served(spark, d).service_lines(), days=days)

    @register(f"d9_service_breakdown_{days}d")
    def _svc(spark, d):
        return R.service_breakdown(_served(spark, d).service_lines(), days=days)

    @register(f"d10_top_builders_{days}d")
    def _top(spark, d):
        p = _served(spark, d)
        return R.top_builders(p.service_lines(), p.dim_builders_conformed(), days=days)

    @register(f"d11_kpis_{days}d")
    def _kpi(spark, d):
        return R.kpis(_served(spark, d).service_lines(), days=days)


    @register(f"l10_dashboard_{days}d")
    def _dashboard(spark, d):
        """The nested dashboard (D12), its arrays written as text in their order."""
        p = _served(spark, d)
        two = lambda c: F.format_string("%.2f", F.coalesce(c, F.lit(0.0)))
        text = lambda name, *parts: F.array_join(F.transform(name, lambda x: F.concat_ws("|", *[f(x) for f in parts])), ";").alias(name)
        board = R.dashboard(p.service_lines(), p.dim_builders_conformed(), days=days)
        nested = ("daily_trend", "service_breakdown", "top_builders")
        return board.select(
            *[c for c in board.columns if c not in nested],
            text("daily_trend", lambda x: F.date_format(x["work_date"], "yyyy-MM-dd"), lambda x: x["daily_orders"].cast("string"),
                 lambda x: two(x["daily_hours"]), lambda x: two(x["daily_value"])),
            text("service_breakdown", lambda x: F.coalesce(x["service_category"], F.lit("-")), lambda x: x["service_count"].cast("string"),
                 lambda x: two(x["total_hours"]), lambda x: two(x["total_value"])),
            text("top_builders", lambda x: x["builder_name"], lambda x: x["order_count"].cast("string"), lambda x: two(x["total_value"])))


for _days in (30, 365):
    _window_queries(_days)


# ---- operator-level queries -------------------------------------------------

from groundwork.functions import clean  # noqa: E402
from groundwork.operators import extract, incremental, quality, staging  # noqa: E402
from groundwork.session import shared_path  # noqa: E402
from groundwork.sources import fixture as FX  # noqa: E402
from groundwork.sources import io as IO  # noqa: E402
from groundwork.sources.tables import Table  # noqa: E402
from groundwork.streaming import stream  # noqa: E402

CUT = _dt.datetime(1999, 1, 1)


@register("c7_fuzzy_builders")
def c7_fuzzy_builders(spark, d):
    c = _p(spark, d).corrected()
    return c.select("builder_name_raw", F.col("builder_name").alias("builder_name_corrected")).distinct()


@register("h8_service_lines")
def h8_service_lines(spark, d):
    return extract.service_lines(_p(spark, d).raw())


@register("k8_pipeline_checks")
def k8_pipeline_checks(spark, d):
    p = _p(spark, d)
    return quality.pipeline_checks(p.raw(), p.fact(), p.with_ml())


def _tables(p: Pipeline) -> dict:
    return {"stg_work_orders": p.staging(), "dim_builders": p.dim_builders(), "dim_projects": p.dim_projects(),
            "dim_companies": p.dim_companies(), "fct_work_orders": p.fact(), "raw_work_orders": p.raw()}


@register("k_quality_suite")
def k_quality_suite(spark, d):
    return quality.run_suite(_tables(_p(spark, d)), quality.DEFAULT_SUITE)


@register("d13_table_status")
def d13_table_status(spark, d):
    return quality.table_status(spark, _p(spark, d).row_counts())


@register("d14_reconcile")
def d14_reconcile(spark, d):
    n = _p(spark, d).row_counts()
    return quality.reconcile(spark, n["raw_work_orders"], n["raw_work_orders_corrected"], n["raw_work_orders_with_ml"])


@register("d15_coverage")
def d15_coverage(spark, d):
    return quality.coverage(_p(spark, d).with_ml(), ["work_order_number", "description", "ml_categorization",
                                                     "builder_name", "month", "year"])


@register("d17_stage_profile")
def d17_stage_profile(spark, d):
    return quality.stage_profile(FX.stage_events(spark, d))


@register("d17_stage_sketches")
def d17_stage_sketches(spark, d):
    """Daily quantile sketches merged per stage; are the quantiles within 1 % of their ranks?"""
    ev = FX.stage_events(spark, d)
    daily = quality.stage_sketches(ev.withColumn("day", F.to_date("ts")), ["day"])
    profile = quality.merge_profiles(daily)
    errors = quality.rank_errors(ev, profile).groupBy("stage").agg((F.max("rank_error") <= 0.01).alias("within_rank"))
    return profile.drop("p50", "p95", "p99").join(errors, "stage")


@register("a14_retention")
def a14_retention(spark, d):
    f = _p(spark, d).fact()
    r = IO.split_by_age(f, "extracted_at", _dt.date(2001, 7, 31), expire_days=90, cold_days=None)
    return r.groupBy("retention").agg(F.count(F.lit(1)).alias("work_orders"))


@register("a8_upsert_incremental")
def a8_upsert_incremental(spark, d):
    stg = _p(spark, d).staging().select("work_order_id", "extracted_at", "data_completeness_score",
                                        "ml_categorization")
    first = stg.filter(F.col("extracted_at") <= F.lit(CUT))
    t1 = incremental.upsert(None, first, "work_order_id", "extracted_at")
    new = incremental.newer_than(stg, t1, "extracted_at")
    return incremental.upsert(t1, new, "work_order_id", "extracted_at")


@register("b3_newer_than")
def b3_newer_than(spark, d):
    stg = _p(spark, d).staging().select("work_order_id", "extracted_at")
    target = stg.filter(F.col("extracted_at") <= F.lit(CUT))
    return incremental.newer_than(stg, target, "extracted_at")


@register("e1_latest_event_per_user")
def e1_latest_event_per_user(spark, d):
    ev = FX.read(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return incremental.latest(ev, "user_id", [F.col("ts").desc(), F.col("event_id").desc()])


@register("f4_latest_sample")
def f4_latest_sample(spark, d):
    return R.latest(_p(spark, d).with_ml(), n=3)


@register("f6_categorized_sample")
def f6_categorized_sample(spark, d):
    return R.sample(_p(spark, d).with_ml().select("work_order_id", "company_name_standardized",
                                                  "ml_categorization"), "ml_categorization", n=3)


@register("c9_keyword_categories")
def c9_keyword_categories(spark, d):
    from groundwork.operators import categorize as cat
    return cat.categorize(_p(spark, d).corrected(), answers=None)


def _scratch(spark: SparkSession, name: str) -> str:
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("i1_stream_dedup")
def i1_stream_dedup(spark, d):
    """Redelivered events, in many micro-batches and out of order -> each event id exactly once, none dropped."""
    base = _scratch(spark, "i1")
    schema = FX.redelivered_events(spark, d, f"{base}/src")
    stream.ingest(stream.source(spark, f"{base}/src", schema, files_per_batch=4), f"{base}/store", f"{base}/checkpoint",
                  key="event_id", ts_col="ts")
    return stream.ingested(spark, f"{base}/store", schema).drop(stream.ROUTE)


@register("i2_refresh")
def i2_refresh(spark, d):
    """A day-partitioned table refreshed by two streams, the second with a checkpoint of its own and newer versions."""
    base = _scratch(spark, "i2")
    ev = FX.read(spark, d, "events")
    table = Table(spark, f"{base}/table", "event_id", "ts", "ts", "day", ("user_id",))
    half = F.col("event_id") % 2 == 0
    ev.where(half).repartition(2).write.parquet(f"{base}/src1")
    FX.changed_events(ev).unionByName(ev.where(~half)).repartition(2).write.parquet(f"{base}/src2")
    for n, per in ((1, 2), (2, 1)):
        stream.refresh(stream.source(spark, f"{base}/src{n}", ev.schema, files_per_batch=per), table, f"{base}/checkpoint{n}")
    return table.read()


@register("a15_publish")
def a15_publish(spark, d):
    """Events published as messages by a stream and decoded again."""
    base = _scratch(spark, "a15")
    ev = FX.read(spark, d, "events")
    ev.repartition(3).write.parquet(f"{base}/src")
    stream.publish_stream(stream.source(spark, f"{base}/src", ev.schema, files_per_batch=1), f"{base}/sink",
                          f"{base}/checkpoint", "event_id", ["event_type"])
    sent = stream.published(spark, f"{base}/sink")
    body = stream.decode(sent.select("value"), ev.schema)
    keys = sent.select(F.col("key").cast("bigint").alias("event_id"), F.col("attributes")["event_type"].alias("attribute"))
    return body.join(keys, "event_id")


@register("h7_json_answers")
def h7_json_answers(spark, d):
    """H7 parse + H9 services + D20 score + B13 missing fields of every answer, rejects with their reason."""
    a = extract.parse_json(FX.json_answers(spark, d))
    return a.select("work_order_id", "is_valid", "reject_reason", *_answer_columns())


def _answer_columns() -> list:
    answer = F.col("answer")
    valid = lambda c: F.when(F.col("is_valid"), c)
    return [
        extract.text_of(answer["work_order_number"]).alias("work_order_number"),
        extract.text_of(answer["project_name"]).alias("project_name"),
        F.size(extract.normalize_services(answer["services"])).alias("n_services"),
        valid(F.round(extract.extraction_score(answer), 6)).alias("score"),
        valid(F.array_join(extract.missing_fields(answer), ",")).alias("missing"),
    ]


def _split(spark, d):
    a = extract.parse_json(FX.json_answers(spark, d)).select("work_order_id", "answer_text", "reject_reason")
    return quality.write_split(a, f"{_scratch(spark, 'b12')}/answers")


@register("b12_valid")
def b12_valid(spark, d):
    return _split(spark, d)[0].select("work_order_id")


@register("b12_rejects")
def b12_rejects(spark, d):
    return _split(spark, d)[1]


@register("d16_run_summary")
def d16_run_summary(spark, d):
    return quality.run_summary(spark, _split(spark, d)[2])


@register("a4_answer_scan")
def a4_answer_scan(spark, d):
    """Answers read from files of records: validity, and the score and year of each, by the JSON types of its values."""
    path = f"{_scratch(spark, 'a4')}/answers"
    FX.write_answer_records(spark, d, path)
    a = IO.scan_answers(spark, path, FX.RECORD_END)
    year = F.col("answer.year")
    zero = ~F.schema_of_variant(year).isin("STRING") & (F.try_variant_get(year, "$", "double") == 0)
    return a.select(
        F.regexp_extract("answer_text", r'"work_order_number":"(\w[^"]*)"', 1).alias("number_text"),
        "is_valid", "reject_reason",
        F.when(~F.coalesce(zero, F.lit(False)), clean.year(extract.text_of(year))).alias("year"),
        F.when(F.col("is_valid"), F.round(extract.extraction_score(F.col("answer")), 6)).alias("score"),
        (F.col("corrupt_record") == F.col("answer_text")).alias("kept_text"))


@register("k7_schema_contract")
def k7_schema_contract(spark, d):
    """The raw table against its declared columns, and a damaged copy of it."""
    raw = _p(spark, d).raw()
    return quality.schema_contract(raw, "raw_work_orders", quality.RAW_CONTRACT).unionByName(
        quality.schema_contract(_damaged(raw), "raw_damaged", quality.RAW_CONTRACT))


def _damaged(raw: DataFrame) -> DataFrame:
    """Without h8 and extracted_at, the year as text, no id on every 101st row."""
    k = FX.order_key()
    return raw.drop("h8", "extracted_at").withColumn("year", F.col("year").cast("string")).withColumn(
        "work_order_id", F.when(k % 101 != 0, F.col("work_order_id")))


@register("g3_missing_columns")
def g3_missing_columns(spark, d):
    """Declared columns that a damaged raw table lacks, and the NULLs of its required ones."""
    checks = quality.schema_contract(_damaged(_p(spark, d).raw()), "raw_damaged", quality.RAW_CONTRACT)
    return checks.where(~F.col("passed")).select("check_name", "failures")


@register("a12_clustered")
def a12_clustered(spark, d):
    """The fact, written by month and clustered by its keys, read back."""
    p = _p(spark, d)
    table = p.fact_table(f"{_scratch(spark, 'a12')}/fact")
    table.merge(p.fact())
    return _no_audit(table.read())


@register("l4_incremental")
def l4_incremental(spark, d):
    """Staging in two runs: all up to the cut, then what is newer, second extractions of old orders included.

    By month of extraction: the test tables spread few orders over 2,400 days, a folder each by the default grain.
    """
    p = _p(spark, d)
    table = p.staging_table(f"{_scratch(spark, 'l4')}/staging", "month")
    p.keep_ml()
    ml = p.with_ml()
    p.refresh_staging(table, ml.where(F.col("extracted_at") <= F.lit(CUT)))
    p.refresh_staging(table, ml.unionByName(FX.revised(ml, CUT)))
    return table.read()


@register("l6_incremental")
def l6_incremental(spark, d):
    """The fact by month in two runs; second extractions move orders to other months."""
    p = _p(spark, d)
    table = p.fact_table(f"{_scratch(spark, 'l6')}/fact")
    p.keep_ml()
    dims = p.dim_builders(), p.dim_projects(), p.dim_companies()
    old = p.staging()
    new = staging.stage(FX.revised(p.with_ml(), CUT), p.run_ts)
    p.refresh_fact(table, old.where(F.col("extracted_at") <= F.lit(CUT)), *dims)
    p.refresh_fact(table, old.unionByName(new), *dims)
    return _no_audit(table.read())


@register("a8_upsert_replaces")
def a8_upsert_replaces(spark, d):
    """New versions replace old ones: later ones, ties decided by the other columns, and a column the old table lacks."""
    stg = _p(spark, d).staging().select("work_order_id", "extracted_at", "month")
    k = FX.order_key()
    later = stg.where(k % 3 == 0).withColumn("month", F.concat("month", F.lit("-2"))).withColumn(
        "extracted_at", F.col("extracted_at") + F.expr("INTERVAL 1 DAY"))
    tied = later.where(k % 2 == 0).withColumn("month", F.concat("month", F.lit("-3")))
    return incremental.upsert(stg, later.unionByName(tied).withColumn("version", F.lit(2)), "work_order_id", "extracted_at")


@register("a9_update_column")
def a9_update_column(spark, d):
    """The last answer of an order sets its column, NULL included; orders without one keep theirs."""
    stg = _p(spark, d).staging().select("work_order_id", "month", "extracted_at")
    k = FX.order_key()
    at = F.explode(F.array(F.lit(1), F.lit(2)))
    src = stg.where(k % 3 == 0).select("work_order_id", at.alias("n"), k.alias("k")).select(
        "work_order_id", "n", F.when((F.col("n") == 2) & (F.col("k") % 2 == 0), None).otherwise(F.concat_ws("/", F.lit("M"), "n")).alias("month"),
        F.concat_ws("/", F.lit("note"), "n").alias("note"))
    return incremental.update_column(stg, src, "work_order_id", ["month", "note"], "n")


@register("k9_thresholds")
def k9_thresholds(spark, d):
    return quality.thresholds(_p(spark, d).staging(), "data_completeness_score", ["work_order_number", "description", "work_date"]).select(
        F.round("avg_score", 6).alias("avg_score"), F.round("max_null_share", 6).alias("max_null_share"), "score_ok", "nulls_ok")


@register("f5_by_key")
def f5_by_key(spark, d):
    return R.by_key(_p(spark, d).with_ml())


@register("h26_document_id")
def h26_document_id(spark, d):
    """Raw rows of answers without an id: the id comes from number and extraction time."""
    a = FX.answer_texts(spark, d).drop("work_order_id")
    return extract.to_raw_row(a).select("work_order_id", "file_url")


@register("h9_services")
def h9_services(spark, d):
    """The normalized services of valid answers, one row each (H9, H4, H5)."""
    a = extract.parse_json(FX.json_answers(spark, d))
    return a.select("work_order_id", F.posexplode(extract.normalize_services(F.col("answer.services"))).alias("pos", "s")).select("work_order_id", "pos", "s.*")


@register("a13_csv_export")
def a13_csv_export(spark, d):
    """Dimensions exported as CSV and loaded again with their types."""
    p = _p(spark, d)
    out = _scratch(spark, "a13")
    dim = p.dim_projects().select("project_key", "project_name_corrected", "total_work_orders", "first_work_date")
    IO.export_csv({"dim_projects": dim}, out)
    return IO.load_seed(spark, f"{out}/dim_projects", dim.schema)


@register("a5_append")
def a5_append(spark, d):
    """Raw rows appended in two loads, fully refreshed once, read with their declared columns."""
    base = _scratch(spark, "a5")
    raw = _p(spark, d).raw()
    early = F.col("extracted_at") <= F.lit(CUT)
    IO.replace(raw.limit(0), base)
    IO.append(raw.where(early), base)
    IO.append(raw.where(~early), base)
    name = f"raw_{uuid.uuid4().hex}"
    IO.as_view(IO.scan_table(spark, base, raw.schema), name)
    return spark.table(name).select("work_order_id", "builder_name", "extracted_at", "d8", "q8")
