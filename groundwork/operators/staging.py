"""Staging build (L4): B2 projection, H15 work date, B10 flags, H22 score."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions import clean

SCORED_FIELDS = ["work_order_number", "builder_name", "project_name", "month", "year",
                 "company_name", "description"]


def completeness(*cols) -> Column:
    """Share of non-NULL fields as a DOUBLE ('' and 'N/A' count as filled)."""
    names = cols or SCORED_FIELDS
    total = None
    for c in names:
        term = F.col(c).isNotNull().cast("int")
        total = term if total is None else total + term
    return total.cast("double") / F.lit(float(len(names)))


def flags(df: DataFrame) -> DataFrame:
    """missing_wo_number: NULL only; missing_builder: NULL or empty."""
    return df.withColumn("missing_wo_number", F.col("work_order_number").isNull()).withColumn(
        "missing_builder", F.coalesce(F.col("builder_name").isNull() | (F.col("builder_name") == ""), F.lit(False))
    )


def stage(with_ml: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """raw_work_orders_with_ml -> stg_work_orders."""
    run_ts = run_ts or _dt.datetime(2001, 7, 31, 0, 0, 0)
    df = with_ml.select(
        "work_order_id",
        "work_order_number",
        "builder_name",
        "builder_name_raw",
        "project_name",
        "project_name_raw",
        clean.work_date("month", "year").alias("work_date"),
        "month",
        "month_raw",
        "year",
        "year_raw",
        F.col("company_name_standardized").alias("company_name"),
        "company_name_raw",
        clean.strip_ws("description").alias("description"),
        "ml_categorization",
        "file_url",
        "extracted_at",
        "corrected_at",
        F.lit(run_ts).cast("timestamp_ntz").alias("processed_at"),
    )
    return flags(df).withColumn("data_completeness_score", completeness())
