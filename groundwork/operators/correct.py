"""Correction build (L2): raw -> corrected, keeping every *_raw column."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.functions import clean
from groundwork.operators import names

CORRECTED_EXTRA = ["builder_name_raw", "project_name_raw", "month_raw", "year_raw",
                   "company_name_raw", "company_name_standardized", "corrected_at"]


def correct(raw: DataFrame, dictionary: DataFrame, run_ts: _dt.datetime | None = None,
            max_dist: int = 2, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Month, year, company, project and builder cleanup.

    The in-band 'N/A' of the extractor stays as it is: only NULL is missing, so
    an order with a marker counts as filled and is categorized like any other.
    """
    run_ts = run_ts or _dt.datetime(2001, 7, 31, 0, 0, 0)
    df = raw.select(
        *[c for c in raw.columns if c not in ("work_order_number", "description", "builder_name",
                                              "project_name", "month", "year")],
        "work_order_number",
        "description",
        F.col("builder_name").alias("builder_name_raw"),
        F.col("builder_name"),
        F.col("project_name").alias("project_name_raw"),
        clean.project("project_name").alias("project_name"),
        F.col("month").alias("month_raw"),
        clean.month("month").alias("month"),
        F.col("year").alias("year_raw"),
        clean.year("year").alias("year"),
        F.col("company_name").alias("company_name_raw"),
        clean.company("company_name").alias("company_name_standardized"),
        F.lit(run_ts).cast("timestamp_ntz").alias("corrected_at"),
    )
    return names.fuzzy_match(df, "builder_name", dictionary, max_dist=max_dist, keep=keep)
