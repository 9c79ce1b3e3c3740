"""Star schema (L5, L6): dimensions, fact and the service-line fact.

Dimensions are grouped by the normalized name (UPPER(TRIM())), the same key
the fact joins on, so each fact row finds at most one dimension row and the
fact keeps exactly one row per work order.  The smallest raw spelling names
the group.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions import clean, keys
from groundwork.operators import names

# Tier thresholds (orders) and activity limits (days).
TIERS = [(100, "Platinum"), (50, "Gold"), (20, "Silver")]
ACTIVITY = [(30, "Active"), (90, "Moderate"), (180, "Low Activity")]

AS_OF = _dt.date(2001, 7, 31)
RUN_TS = _dt.datetime(2001, 7, 31, 0, 0, 0)


def builder_tier(total, tiers=TIERS) -> Column:
    out = F.lit("Bronze")
    for limit, name in reversed(tiers):
        out = F.when(total >= limit, F.lit(name)).otherwise(out)
    return out


def activity(last_date, as_of: _dt.date = AS_OF, limits=ACTIVITY) -> Column:
    days = F.datediff(F.lit(as_of), last_date)
    out = F.lit("Inactive")
    for limit, name in reversed(limits):
        out = F.when(days <= limit, F.lit(name)).otherwise(out)
    return out


def _audit(run_ts) -> list[Column]:
    ts = F.lit(run_ts or RUN_TS).cast("timestamp_ntz")
    return [ts.alias("created_at"), ts.alias("updated_at")]


def dim_builders(stg: DataFrame, dictionary: DataFrame, as_of: _dt.date = AS_OF, run_ts=None) -> DataFrame:
    """D1 + C1 + H21 + H23 + H24, one row per normalized raw builder name."""
    g = (
        stg.filter(F.col("builder_name_raw").isNotNull())
        .groupBy(clean.norm("builder_name_raw").alias("builder_nkey"))
        .agg(
            F.min("builder_name_raw").alias("builder_name_raw"),
            F.countDistinct("work_order_id").alias("total_work_orders"),
            F.countDistinct("project_name").alias("total_projects"),
            F.min("work_date").alias("first_work_date"),
            F.max("work_date").alias("last_work_date"),
            F.avg("data_completeness_score").alias("avg_data_quality"),
        )
    )
    m = names.apply_dictionary(g, "builder_name_raw", dictionary,
                               out_col="builder_name_corrected", conf_col="match_confidence")
    return m.select(
        keys.surrogate("builder_name_corrected").alias("builder_key"),
        "builder_nkey",
        "builder_name_raw",
        "builder_name_corrected",
        "match_confidence",
        "total_work_orders",
        "total_projects",
        "first_work_date",
        "last_work_date",
        F.datediff("last_work_date", "first_work_date").alias("days_active"),
        "avg_data_quality",
        builder_tier(F.col("total_work_orders")).alias("builder_tier"),
        activity(F.col("last_work_date"), as_of).alias("activity_status"),
        *_audit(run_ts),
    )


def dim_projects(stg: DataFrame, run_ts=None) -> DataFrame:
    """D2 + H21, one row per normalized project name."""
    g = (
        stg.filter(F.col("project_name").isNotNull())
        .groupBy(clean.norm("project_name").alias("project_nkey"))
        .agg(
            F.min("project_name").alias("project_name_raw"),
            F.countDistinct("work_order_id").alias("total_work_orders"),
            F.countDistinct("builder_name_raw").alias("total_builders"),
            F.min("work_date").alias("first_work_date"),
            F.max("work_date").alias("last_work_date"),
        )
    )
    return g.select(
        keys.surrogate("project_name_raw").alias("project_key"),
        "project_nkey",
        "project_name_raw",
        F.col("project_name_raw").alias("project_name_corrected"),
        "total_work_orders",
        "total_builders",
        "first_work_date",
        "last_work_date",
        F.datediff("last_work_date", "first_work_date").alias("project_duration_days"),
        *_audit(run_ts),
    )


def dim_companies(stg: DataFrame, run_ts=None) -> DataFrame:
    """D3 + H21, one row per normalized company name."""
    g = (
        stg.filter(F.col("company_name").isNotNull())
        .groupBy(clean.norm("company_name").alias("company_nkey"))
        .agg(
            F.min("company_name").alias("company_name_raw"),
            F.countDistinct("work_order_id").alias("total_work_orders"),
            F.min("work_date").alias("first_work_date"),
            F.max("work_date").alias("last_work_date"),
        )
    )
    return g.select(
        keys.surrogate("company_name_raw").alias("company_key"),
        "company_nkey",
        "company_name_raw",
        F.col("company_name_raw").alias("company_name_corrected"),
        "total_work_orders",
        "first_work_date",
        "last_work_date",
        *_audit(run_ts),
    )


FACT_COLUMNS = ["work_order_id", "work_order_number", "work_date", "extracted_at", "description",
                "ml_categorization", "data_completeness_score", "file_url",
                "builder_key", "project_key", "company_key"]


def fact(stg: DataFrame, db: DataFrame, dp: DataFrame, dc: DataFrame, run_ts=None) -> DataFrame:
    """Staging left-joined to the three dims on normalized names.

    The keys are projected once as columns; dims are small per key and AQE
    turns these into broadcast joins when their runtime size allows.
    """
    s = stg.select(
        *[c for c in FACT_COLUMNS if c in stg.columns],
        clean.norm("builder_name_raw").alias("builder_nkey"),
        clean.norm("project_name").alias("project_nkey"),
        clean.norm("company_name").alias("company_nkey"),
    )
    j = (
        s.join(db.select("builder_nkey", "builder_key"), "builder_nkey", "left")
        .join(dp.select("project_nkey", "project_key"), "project_nkey", "left")
        .join(dc.select("company_nkey", "company_key"), "company_nkey", "left")
    )
    return j.select(*FACT_COLUMNS, *_audit(run_ts))


def fct_service_lines(fct: DataFrame, lines: DataFrame) -> DataFrame:
    """Fact at service-line grain: every line of an order with the order's keys.

    An order without lines keeps one row with NULL line columns, so reports
    over this table see every work order.  Both sides are keyed by
    work_order_id, so this is one co-partitioned shuffle join.
    """
    f = fct.select("work_order_id", "work_order_number", "work_date", "builder_key", "project_key",
                   "company_key", "data_completeness_score")
    l = lines.select("work_order_id", "line_no", "service_category", "quantity",
                     "total_service_hours", "estimated_service_value")
    return f.join(l, "work_order_id", "left")


def dim_builders_conformed(fct: DataFrame, db: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """One row per builder_key, measures recomputed from the order-grain fact
    (not summed over raw-name rows, whose distinct counts would double count)."""
    g = (
        fct.filter(F.col("builder_key").isNotNull())
        .groupBy("builder_key")
        .agg(
            F.countDistinct("work_order_id").alias("total_work_orders"),
            F.countDistinct("project_key").alias("total_projects"),
            F.min("work_date").alias("first_work_date"),
            F.max("work_date").alias("last_work_date"),
        )
    )
    name = db.groupBy("builder_key").agg(F.min("builder_name_corrected").alias("builder_name_corrected"))
    return g.join(name, "builder_key", "inner").select(
        "builder_key",
        "builder_name_corrected",
        "total_work_orders",
        "total_projects",
        "first_work_date",
        "last_work_date",
        builder_tier(F.col("total_work_orders")).alias("builder_tier"),
        activity(F.col("last_work_date"), as_of).alias("activity_status"),
    )
