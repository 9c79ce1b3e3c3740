"""Data-quality operators.

Every check yields rows (model, check_name, severity, failures, passed).
Row-level checks of one table (not_null, accepted_values, accepted_range,
expression_is_true) are fused into a single aggregate pass; unique and
relationships need their own aggregate / anti-join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from groundwork.functions import clean

RESULT_COLS = ["model", "check_name", "severity", "failures", "passed"]


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | accepted_values | accepted_range | expression | unique | relationships
    column: str | None = None
    values: tuple = ()
    min_value: Any = None
    max_value: Any = None
    expression: str | None = None
    to: str | None = None  # parent model name for relationships
    severity: str = "warn"

    @property
    def name(self) -> str:
        if self.kind == "expression":
            return f"expression_is_true({self.expression})"
        return f"{self.kind}({self.column})"


def _failing(c: Check) -> Column:
    """Predicate that is TRUE on a failing row (NULLs pass all but not_null)."""
    col = F.col(c.column) if c.column else None
    if c.kind == "not_null":
        return col.isNull()
    if c.kind == "accepted_values":
        return col.isNotNull() & ~col.isin(list(c.values))
    if c.kind == "accepted_range":
        bad = F.lit(False)
        if c.min_value is not None:
            bad = bad | (col < F.lit(c.min_value))
        if c.max_value is not None:
            bad = bad | (col > F.lit(c.max_value))
        return col.isNotNull() & bad
    if c.kind == "expression":
        return ~F.coalesce(F.expr(c.expression), F.lit(True))
    raise ValueError(c.kind)


ROW_KINDS = {"not_null", "accepted_values", "accepted_range", "expression"}


def row_checks(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """All row-level checks of a table in one aggregate, unpivoted to rows."""
    cs = [c for c in checks if c.kind in ROW_KINDS]
    aggs = [F.count_if(_failing(c)).alias(f"c{i}") for i, c in enumerate(cs)]
    one = df.agg(*aggs)
    items = [
        F.struct(F.lit(model).alias("model"), F.lit(c.name).alias("check_name"),
                 F.lit(c.severity).alias("severity"), F.col(f"c{i}").cast("bigint").alias("failures"))
        for i, c in enumerate(cs)
    ]
    return one.select(F.inline(F.array(*items))).withColumn("passed", F.col("failures") == 0)


def unique(df: DataFrame, model: str, column: str, severity: str = "warn") -> DataFrame:
    """K1: number of non-NULL values that occur more than once."""
    dup = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(f"unique({column})").alias("check_name"),
        F.lit(severity).alias("severity"), "failures", (F.col("failures") == 0).alias("passed"))


def relationships(child: DataFrame, parent: DataFrame, model: str, column: str, parent_column: str | None = None,
                  severity: str = "warn") -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    pc = parent_column or column
    orphans = child.filter(F.col(column).isNotNull()).join(
        parent.select(F.col(pc).alias(column)).distinct(), column, "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(f"relationships({column})").alias("check_name"),
        F.lit(severity).alias("severity"), "failures", (F.col("failures") == 0).alias("passed"))


def run_suite(tables: dict[str, DataFrame], suite: dict[str, list[Check]]) -> DataFrame:
    """Every check of every model, unioned into one result table."""
    parts = []
    for model, checks in suite.items():
        df = tables[model]
        if any(c.kind in ROW_KINDS for c in checks):
            parts.append(row_checks(df, model, checks))
        for c in checks:
            if c.kind == "unique":
                parts.append(unique(df, model, c.column, c.severity))
            elif c.kind == "relationships":
                parts.append(relationships(df, tables[c.to], model, c.column, severity=c.severity))
    return reduce(lambda a, b: a.unionByName(b), parts)


def nn(col, sev="warn"):
    return Check("not_null", col, severity=sev)


# The 40 declared data tests (staging at severity error, marts warn).
DEFAULT_SUITE: dict[str, list[Check]] = {
    "stg_work_orders": [
        Check("unique", "work_order_id", severity="error"), nn("work_order_id", "error"),
        nn("work_order_number", "error"), nn("builder_name", "error"), nn("project_name", "error"),
        nn("month", "error"), Check("accepted_values", "month", values=tuple(clean.MONTHS), severity="error"),
        nn("year", "error"), Check("accepted_range", "year", min_value=2000, max_value=2030, severity="error"),
        nn("work_date", "error"), nn("data_completeness_score", "error"),
        Check("accepted_range", "data_completeness_score", min_value=0, max_value=1, severity="error"),
    ],
    "dim_builders": [
        Check("expression", expression="total_work_orders >= 0"),
        Check("unique", "builder_key"), nn("builder_key"), nn("builder_name_corrected"),
        Check("accepted_values", "builder_tier", values=("Platinum", "Gold", "Silver", "Bronze")),
        Check("accepted_values", "activity_status", values=("Active", "Moderate", "Low Activity", "Inactive")),
    ],
    "dim_projects": [Check("unique", "project_key"), nn("project_key"), nn("project_name_corrected")],
    "dim_companies": [Check("unique", "company_key"), nn("company_key"), nn("company_name_corrected")],
    "fct_work_orders": [
        Check("expression", expression="data_completeness_score >= 0.5"),
        Check("unique", "work_order_id"), nn("work_order_id"), nn("work_order_number"), nn("work_date"),
        nn("builder_key"), Check("relationships", "builder_key", to="dim_builders"),
        nn("project_key"), Check("relationships", "project_key", to="dim_projects"),
        nn("company_key"), Check("relationships", "company_key", to="dim_companies"),
        nn("data_completeness_score"),
        Check("accepted_range", "data_completeness_score", min_value=0, max_value=1),
    ],
    "raw_work_orders": [Check("unique", "work_order_id"), nn("work_order_id"), nn("extracted_at")],
}


# ---- schema contract (K7), column difference (G3) ----------------------------

@dataclass(frozen=True)
class Field:
    """A declared column: STRING, INTEGER, FLOAT or TIMESTAMP; required columns have no NULL."""

    name: str
    kind: str
    required: bool = False


# Spark types that fulfil a declared one.
KINDS = {
    "STRING": {"string"},
    "INTEGER": {"int", "bigint"},
    "FLOAT": {"double", "float"},
    "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}

# The declared columns of the raw table.
RAW_CONTRACT = (
    Field("work_order_id", "STRING", required=True), Field("work_order_number", "STRING"),
    Field("builder_name", "STRING"), Field("project_name", "STRING"), Field("month", "STRING"),
    Field("year", "INTEGER"), Field("company_name", "STRING"), Field("description", "STRING"),
    Field("file_url", "STRING"), Field("extracted_at", "TIMESTAMP", required=True),
    *(f for k in range(1, 5) for f in (
        Field(f"service{k}", "STRING"),
        *(g for i in (2 * k - 1, 2 * k) for g in (Field(f"d{i}", "STRING"), Field(f"q{i}", "FLOAT"), Field(f"h{i}", "FLOAT"))))),
)


def missing_columns(df: DataFrame, contract: tuple[Field, ...]) -> list[str]:
    """Declared columns that the table lacks, in declared order (metadata only)."""
    return [f.name for f in contract if f.name not in df.columns]


def schema_contract(df: DataFrame, model: str, contract: tuple[Field, ...], severity: str = "error") -> DataFrame:
    """K7 + G3 as check rows: each declared column is present, has its type, and holds no NULL where required.

    Presence and types come from the table's metadata and read nothing. A column that is missing fails its presence
    check and, if required, its NULL check for every row; it has no type check. The NULL counts of all required
    columns are one aggregate over those columns alone. Columns beyond the declared ones are allowed.
    """
    held = dict(df.dtypes)
    facts = []
    for f in contract:
        facts.append((f"column_present({f.name})", 0 if f.name in held else 1))
        if f.name in held:
            facts.append((f"column_type({f.name})", 0 if held[f.name] in KINDS[f.kind] else 1))
    known = df.sparkSession.createDataFrame(facts, "check_name string, failures bigint").select(
        F.lit(model).alias("model"), "check_name", F.lit(severity).alias("severity"), "failures")
    known = known.withColumn("passed", F.col("failures") == 0)
    required = [f.name for f in contract if f.required]
    if not required:
        return known
    whole = df.select(*[F.col(n) if n in held else F.lit(None).cast("string").alias(n) for n in required])
    return known.unionByName(row_checks(whole, model, [nn(n, severity) for n in required]))


# ---- pipeline gate (K8, D21), thresholds (K9) -------------------------------

def pipeline_checks(raw: DataFrame, fct: DataFrame, with_ml: DataFrame, min_avg: float = 0.8) -> DataFrame:
    """The three run gates as rows (check, value, passed); one pass per table.

    An empty fact has a NULL average, reported as a failed check.
    """
    a = raw.agg(F.count_if(F.col("work_order_number").isNull()).cast("double").alias("value")).select(
        F.lit("no_null_work_order_numbers").alias("check_name"), "value", (F.col("value") == 0).alias("passed"))
    b = fct.agg(F.avg("data_completeness_score").alias("value")).select(
        F.lit("data_completeness_above_80_percent").alias("check_name"), "value",
        F.coalesce(F.col("value") >= F.lit(min_avg), F.lit(False)).alias("passed"))
    c = with_ml.agg(F.count_if(F.col("ml_categorization").isNull()).cast("double").alias("value")).select(
        F.lit("all_records_have_ml_categorization").alias("check_name"), "value", (F.col("value") == 0).alias("passed"))
    return a.unionByName(b).unionByName(c)


def thresholds(df: DataFrame, score_col: str, cols: list[str], min_score: float = 0.7,
               max_null_share: float = 0.1) -> DataFrame:
    """K9: average score and the worst NULL share against declared limits (one pass)."""
    null_shares = [F.avg(F.col(c).isNull().cast("double")) for c in cols]
    return df.agg(
        F.avg(score_col).alias("avg_score"),
        F.greatest(*null_shares).alias("max_null_share") if len(null_shares) > 1 else null_shares[0].alias("max_null_share"),
    ).select(
        "avg_score", "max_null_share",
        F.coalesce(F.col("avg_score") >= F.lit(min_score), F.lit(False)).alias("score_ok"),
        F.coalesce(F.col("max_null_share") <= F.lit(max_null_share), F.lit(False)).alias("nulls_ok"),
    )


def gate(results: DataFrame) -> None:
    """Fail the run when an error-severity check failed, and name every failed one.

    Results have one row per declared check. Checks without a severity are errors, those
    without a model are checks of the pipeline.
    """
    severity = F.col("severity") if "severity" in results.columns else F.lit("error")
    model = F.col("model") if "model" in results.columns else F.lit("pipeline")
    bad = results.filter(~F.coalesce("passed", F.lit(False)) & (severity == "error"))
    rows = bad.select(model.alias("model"), "check_name").orderBy("model", "check_name").collect()
    if rows:
        raise ValueError(f"data quality checks failed: {[(r.model, r.check_name) for r in rows]}")


# ---- table status, reconciliation, coverage (D13-D15, K10) ------------------

def table_status(spark: SparkSession, counts: dict[str, int | None]) -> DataFrame:
    """Row count per table; LIVE, EMPTY or MISSING (None).

    The counts were gathered while the tables were written (`plans.pipeline`), so nothing is read here.
    """
    rows = spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")
    return rows.withColumn("status", F.when(F.col("row_count").isNull(), "MISSING")
                           .when(F.col("row_count") == 0, "EMPTY").otherwise("LIVE"))


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a stored table that was written without counting: Parquet footers only, no column."""
    return spark.read.parquet(path).count()


def reconcile(spark: SparkSession, raw_count: int, corrected_count: int, categorized_count: int) -> DataFrame:
    """raw = corrected = categorized row counts, all > 0, from the counts gathered while writing."""
    match = raw_count == corrected_count == categorized_count and raw_count > 0
    return spark.createDataFrame([(raw_count, corrected_count, categorized_count, match)],
                                 "raw_count bigint, corrected_count bigint, categorized_count bigint, counts_match boolean")


def coverage(df: DataFrame, cols: list[str]) -> DataFrame:
    """COUNT(*) against COUNT(col) for each column, one pass, unpivoted."""
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"n_{c}") for c in cols])
    items = [F.struct(F.lit(c).alias("column_name"), F.col("total").alias("total_rows"),
                      F.col(f"n_{c}").alias("non_null_rows")) for c in cols]
    return one.select(F.inline(F.array(*items))).withColumn(
        "coverage", F.round(F.col("non_null_rows") / F.nullif(F.col("total_rows"), F.lit(0)), 6))


# ---- valid / rejected split, run tally, stage profile (B12, D16, D17) -------

def write_split(df: DataFrame, path: str, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """B12 + D16: valid rows and rejects (rows with a reason) as two stored tables, from one evaluation of `df`.

    Returns both tables and the run's tally (successful, failed, total), observed while the rows were written.
    """
    seen = Observation("split")
    good = F.col(reason_col).isNull()
    tally = seen_counts(good)
    marked = df.observe(seen, *tally).withColumn("outcome", F.when(good, F.lit("valid")).otherwise(F.lit("reject")))
    marked.write.mode("errorifexists").partitionBy("outcome").parquet(path)
    # both folders may not exist: the schema is given and the outcome is a partition filter
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    valid = stored.where(F.col("outcome") == "valid").drop("outcome", reason_col)
    return valid, stored.where(F.col("outcome") == "reject").drop("outcome"), dict(seen.get)


def seen_counts(good: Column) -> list[Column]:
    return [F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"), F.count(F.lit(1)).alias("total")]


def run_summary(spark: SparkSession, tally: dict[str, int]) -> DataFrame:
    """Successful / failed / total of a run, from the tally of `write_split`."""
    return spark.createDataFrame([(tally["successful"], tally["failed"], tally["total"])],
                                 "successful bigint, failed bigint, total bigint")


# Duration histogram bucket edges in seconds.
DURATION_BUCKETS = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0]


QUANTILES = ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))
SKETCH_K = 400  # a sketch's size parameter: its ranks are within about 0.5 % of the true ones


def _bucket(d: Column) -> Column:
    bucket = F.lit(len(DURATION_BUCKETS))
    for i in range(len(DURATION_BUCKETS) - 1, -1, -1):
        bucket = F.when(d <= DURATION_BUCKETS[i], F.lit(i)).otherwise(bucket)
    return bucket


def _histogram(d: Column) -> list[Column]:
    return [F.count_if(_bucket(d) == i).alias(f"le_{i}") for i in range(len(DURATION_BUCKETS) + 1)]


def stage_profile(events: DataFrame) -> DataFrame:
    """Per stage count, success share, exact P50/P95/P99 and a duration histogram.

    Exact quantiles hold a stage's distinct durations in one task; `stage_sketches` doesn't.
    """
    d = F.col("duration_s")
    return events.groupBy("stage").agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.avg(F.col("success").cast("double")), 6).alias("success_share"),
        F.round(F.avg(d), 6).alias("avg_duration"),
        *[F.round(F.percentile(d, p), 6).alias(n) for p, n in QUANTILES],
        *_histogram(d),
    )


def stage_sketches(events: DataFrame, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """D17 in bounded memory: per stage and `by` the counts, sums, histogram and a mergeable quantile sketch (a few KB)."""
    d = F.col("duration_s")
    return events.groupBy("stage", *by).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("success")).alias("successes"),
        F.sum(d).alias("total_duration"),
        F.kll_sketch_agg_double(d, F.lit(k)).alias("sketch"),
        *_histogram(d),
    )


def merge_profiles(sketches: DataFrame, by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """D17 from stored sketches: any periods merged into one profile per stage (and `by`), no event is read again."""
    merged = sketches.groupBy("stage", *(by or [])).agg(
        F.sum("events").alias("events"),
        F.sum("successes").alias("successes"),
        F.sum("total_duration").alias("total_duration"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        *[F.sum(f"le_{i}").alias(f"le_{i}") for i in range(len(DURATION_BUCKETS) + 1)],
    )
    return merged.select(
        "stage", *(by or []), "events",
        F.round(F.col("successes") / F.col("events"), 6).alias("success_share"),
        F.round(F.col("total_duration") / F.col("events"), 6).alias("avg_duration"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for p, n in QUANTILES],
        *[f"le_{i}" for i in range(len(DURATION_BUCKETS) + 1)],
    )


def rank_errors(events: DataFrame, profile: DataFrame) -> DataFrame:
    """How far each quantile of a profile is from its rank: stage, quantile, share of events at or below it less its share.

    Where equal durations straddle the rank, the distance is to the nearer end of their run.
    """
    q = F.explode(F.array(*[F.struct(F.lit(n).alias("quantile"), F.lit(p).alias("p"), F.col(n).alias("at")) for p, n in QUANTILES]))
    wanted = F.broadcast(profile.select("stage", q.alias("q")).select("stage", "q.*"))  # three rows a stage
    d = F.col("duration_s")
    counted = events.where(d.isNotNull()).join(wanted, "stage").groupBy("stage", "quantile", "p").agg(
        (F.count_if(d < F.col("at")) / F.count(F.lit(1))).alias("below"), (F.count_if(d <= F.col("at")) / F.count(F.lit(1))).alias("up_to"))
    return counted.select("stage", "quantile", F.greatest(F.col("below") - F.col("p"), F.col("p") - F.col("up_to"), F.lit(0.0)).alias("rank_error"))
