"""Parameterized reports (L7-L10) over the service-line fact.

Parameters are bound as literals in column expressions (never pasted into
SQL text).  Aggregations run below joins; joins go to one-row-per-key dims.
Every ordering ends with a key so LIMIT/OFFSET pages are deterministic.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AS_OF = _dt.date(2001, 7, 31)


def all_of(*conds: Column | None) -> Column:
    """AND of the given optional predicates (B9); TRUE when none."""
    return reduce(lambda a, b: a & b, [c for c in conds if c is not None], F.lit(True))


def contains_ci(col, text: str | None) -> Column | None:
    """Case-insensitive literal substring match (B6), or None when no filter."""
    if text is None:
        return None
    return F.upper(F.col(col)).contains(F.lit(text.upper()))


def page(df: DataFrame, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    """ORDER BY ... LIMIT l OFFSET o with 1 <= l <= 1000, o >= 0."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be in 1..1000 and offset >= 0")
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out.limit(limit)


def in_window(as_of: _dt.date, days: int) -> Column:
    """work_date >= as_of - days."""
    return F.col("work_date") >= F.date_sub(F.lit(as_of), days)


def work_orders(fsl: DataFrame, dbc: DataFrame, dp: DataFrame, start: _dt.date | None = None,
                end: _dt.date | None = None, builder_name: str | None = None,
                project_name: str | None = None, limit: int = 100, offset: int = 0,
                fct: DataFrame | None = None) -> DataFrame:
    """One row per work order with hours, value, categories and quality.

    The page is cut first, on the fact at order grain (`fct`; from the lines' own orders if it is not given); only the
    lines of its at most 1000 orders are then aggregated (an order without lines has one row of NULLs among them).
    """
    grain = ["work_order_id", "work_order_number", "work_date", "builder_key", "project_key", "data_completeness_score"]
    orders = fct.select(*grain) if fct is not None else fsl.select(*grain).distinct()
    f = orders.filter(all_of(
        F.col("work_date") >= F.lit(start) if start else None,
        F.col("work_date") <= F.lit(end) if end else None,
    ))
    b = dbc.select("builder_key", F.col("builder_name_corrected").alias("builder_name"))
    p = dp.select("project_key", F.col("project_name_corrected").alias("project_name"))
    j = f.join(b, "builder_key", "left").join(p, "project_key", "left")
    j = j.filter(all_of(contains_ci("builder_name", builder_name), contains_ci("project_name", project_name)))
    order = [F.col("work_date").desc_nulls_last(), F.col("work_order_id").asc()]
    top = page(j, order, limit, offset)
    lines = fsl.select("work_order_id", "total_service_hours", "estimated_service_value", "service_category")
    own = lines.join(F.broadcast(top.drop("builder_key", "project_key")), "work_order_id")  # a page: at most 1000 rows
    return own.groupBy("work_order_id", "work_order_number", "builder_name", "project_name", "work_date",
                       F.round("data_completeness_score", 6).alias("data_quality_score")).agg(
        F.round(F.sum("total_service_hours"), 2).alias("total_hours"),
        F.round(F.sum("estimated_service_value"), 2).alias("total_value"),
        F.array_sort(F.collect_set("service_category")).alias("service_categories"),
    ).orderBy(*order)


def builder_revenue(fsl: DataFrame, dbc: DataFrame) -> DataFrame:
    """Aggregate per builder key first, then keep keys present in the dim."""
    agg = fsl.filter(F.col("builder_key").isNotNull()).groupBy("builder_key").agg(
        F.sum("estimated_service_value").alias("total_revenue"),
        F.countDistinct("work_order_id").alias("order_count"),
        F.max("work_date").alias("last_order_date"),
    )
    return agg.join(dbc.select("builder_key"), "builder_key", "left_semi")


def builders(fsl: DataFrame, dbc: DataFrame, tier: str | None = None, activity_status: str | None = None,
             limit: int = 50) -> DataFrame:
    """Builder metrics by revenue."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be in 1..500")
    br = builder_revenue(fsl, dbc)
    b = dbc.filter(all_of(
        F.col("builder_tier") == F.lit(tier) if tier else None,
        F.col("activity_status") == F.lit(activity_status) if activity_status else None,
    ))
    j = b.join(br, "builder_key", "left")
    out = j.select(
        F.col("builder_name_corrected").alias("builder_name"),
        "builder_tier",
        "total_work_orders",
        "total_projects",
        F.round(F.coalesce(F.col("total_revenue"), F.lit(0.0)), 2).alias("total_revenue"),
        F.round(F.coalesce(F.col("total_revenue") / F.nullif(F.col("order_count"), F.lit(0)), F.lit(0.0)), 2)
        .alias("avg_order_value"),
        "activity_status",
        "last_order_date",
    )
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("builder_name").asc()).limit(limit)


def projects(fsl: DataFrame, dp: DataFrame, min_orders: int = 10, limit: int = 50) -> DataFrame:
    """Project metrics with HAVING on the order count."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be in 1..500")
    agg = fsl.filter(F.col("project_key").isNotNull()).groupBy("project_key").agg(
        F.countDistinct("work_order_id").alias("total_work_orders"),
        F.countDistinct("builder_key").alias("total_builders"),
        F.sum("total_service_hours").alias("total_hours"),
        F.sum("estimated_service_value").alias("total_value"),
        F.min("work_date").alias("start_date"),
        F.max("work_date").alias("end_date"),
    )
    j = agg.join(dp.select("project_key", F.col("project_name_corrected").alias("project_name")), "project_key")
    out = j.filter(F.col("total_work_orders") >= min_orders).select(
        "project_name",
        "total_work_orders",
        "total_builders",
        F.round("total_hours", 2).alias("total_hours"),
        F.round("total_value", 2).alias("total_value"),
        "start_date",
        "end_date",
        F.datediff("end_date", "start_date").alias("duration_days"),
    )
    return out.orderBy(F.col("total_value").desc_nulls_last(), F.col("project_name").asc()).limit(limit)


def daily_trend(fsl: DataFrame, as_of: _dt.date = AS_OF, days: int = 30) -> DataFrame:
    """Per work date in the window."""
    return fsl.filter(in_window(as_of, days)).groupBy("work_date").agg(
        F.countDistinct("work_order_id").alias("daily_orders"),
        F.round(F.sum("total_service_hours"), 2).alias("daily_hours"),
        F.round(F.sum("estimated_service_value"), 2).alias("daily_value"),
    )


def service_breakdown(fsl: DataFrame, as_of: _dt.date = AS_OF, days: int = 30) -> DataFrame:
    """Per category in the window (an order without lines counts under NULL)."""
    return fsl.filter(in_window(as_of, days)).groupBy("service_category").agg(
        F.count(F.lit(1)).alias("service_count"),
        F.round(F.sum("total_service_hours"), 2).alias("total_hours"),
        F.round(F.sum("estimated_service_value"), 2).alias("total_value"),
    )


def top_builders(fsl: DataFrame, dbc: DataFrame, as_of: _dt.date = AS_OF, days: int = 30,
                 k: int = 10) -> DataFrame:
    """D10 + F3: builders by value in the window, top k."""
    f = fsl.filter(in_window(as_of, days) & F.col("builder_key").isNotNull())
    per_key = f.groupBy("builder_key").agg(
        F.countDistinct("work_order_id").alias("order_count"),
        F.sum("estimated_service_value").alias("total_value"),
    )
    j = per_key.join(dbc.select("builder_key", F.col("builder_name_corrected").alias("builder_name")), "builder_key")
    out = j.select("builder_name", "order_count", F.round("total_value", 2).alias("total_value"))
    return out.orderBy(F.col("total_value").desc_nulls_last(), F.col("builder_name").asc()).limit(k)


def kpis(fsl: DataFrame, as_of: _dt.date = AS_OF, days: int = 30) -> DataFrame:
    """Four scalars in one pass over the window."""
    return fsl.filter(in_window(as_of, days)).agg(
        F.countDistinct("work_order_id").alias("total_orders_30d"),
        F.round(F.coalesce(F.sum("estimated_service_value"), F.lit(0.0)), 2).alias("total_value_30d"),
        F.countDistinct("builder_key").alias("active_builders_30d"),
        F.countDistinct("project_key").alias("active_projects_30d"),
    )


def dashboard(fsl: DataFrame, dbc: DataFrame, as_of: _dt.date = AS_OF, days: int = 30) -> DataFrame:
    """KPI scalars plus three arrays of already aggregated rows, one row.

    Only aggregated rows are collected (days in the window, categories, top
    ten builders), so each array is small by construction.
    """
    def nested(df: DataFrame, name: str, sort_first: str | None) -> DataFrame:
        cols = df.columns
        if sort_first:
            cols = [sort_first] + [c for c in cols if c != sort_first]
        arr = F.array_sort(F.collect_list(F.struct(*cols)))
        return df.agg(F.coalesce(arr, F.array()).alias(name))

    k = kpis(fsl, as_of, days)
    trend = nested(daily_trend(fsl, as_of, days), "daily_trend", "work_date")
    svc = nested(service_breakdown(fsl, as_of, days), "service_breakdown", "service_category")
    top = nested(top_builders(fsl, dbc, as_of, days).select(
        (-F.col("total_value")).alias("neg_value"), "builder_name", "order_count", "total_value"),
        "top_builders", None)
    top = top.select(F.transform("top_builders", lambda x: F.struct(
        x["builder_name"].alias("builder_name"), x["order_count"].alias("order_count"),
        x["total_value"].alias("total_value"))).alias("top_builders"))
    # four one-row frames: the cross joins are 1 x 1
    return k.crossJoin(trend).crossJoin(svc).crossJoin(top)


def latest(df: DataFrame, n: int = 3, order_col: str = "extracted_at", key: str = "work_order_id") -> DataFrame:
    """newest n rows with a 50-character category preview."""
    return df.select(
        key, "builder_name", "project_name", order_col,
        F.substring("ml_categorization", 1, 50).alias("category_preview"),
    ).orderBy(F.col(order_col).desc_nulls_last(), F.col(key).asc()).limit(n)


def by_key(df: DataFrame, key: str = "work_order_id") -> DataFrame:
    """rows with a description in key order (range-partitioned sort)."""
    return df.filter(F.col("description").isNotNull()).select(
        key, "description", "company_name_standardized").orderBy(key)


def sample(df: DataFrame, col: str, n: int = 3, key: str = "work_order_id") -> DataFrame:
    """n rows where `col` is set; ordered by key for determinism."""
    return df.filter(F.col(col).isNotNull()).orderBy(key).limit(n)
