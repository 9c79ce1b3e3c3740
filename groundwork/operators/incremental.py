"""Incremental maintenance on plain Parquet.

Parquet has no MERGE, so an upsert is a keyed anti-join plus a union written
to a new table version; the caller swaps versions.  Every step is a
DataFrame job partitioned by the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: list[Column] | list[str]) -> DataFrame:
    """The last row per key (largest order value; ties broken by later columns)."""
    cols = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(key).orderBy(*cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def high_water_mark(target: DataFrame, col: str) -> DataFrame:
    return target.agg(F.max(col).alias("_hwm"))


def newer_than(src: DataFrame, target: DataFrame | None, col: str, bootstrap: bool = False) -> DataFrame:
    """Rows with `col` strictly greater than the target's maximum.

    An empty target has a NULL mark and lets nothing through (the reference's
    behaviour) unless `bootstrap` is set.  The mark is a one-row aggregate,
    so the broadcast is size-bounded.
    """
    if target is None:
        return src
    hwm = F.broadcast(high_water_mark(target, col))
    cond = F.col(col) > F.col("_hwm")
    if bootstrap:
        cond = cond | F.col("_hwm").isNull()
    return src.crossJoin(hwm).filter(cond).drop("_hwm")


def newest(df: DataFrame, key: str, order_col: str, ties: list[str] | None = None) -> DataFrame:
    """One whole row per key: the last by `order_col`, then by `ties` (all other columns unless given).

    A map-side combined maximum, so a key with very many versions is reduced before the shuffle. Rows without a key
    are versions of one row. Without `order_col` (NULL) a row is older than any with it.
    """
    if ties is None:
        # the order holds all columns but the key, so its maximum is the row: each is shuffled once, not twice
        rest = [c for c in df.columns if c not in (key, order_col)]
        best = df.groupBy(key).agg(F.max(F.struct(*dict.fromkeys([order_col, *rest]))).alias("_row"))
        return best.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])
    whole = F.struct(*df.columns)
    best = df.groupBy(key).agg(F.max_by(whole, F.struct(order_col, *ties)).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def upsert(target: DataFrame | None, new: DataFrame, key: str, order_col: str,
           ties: list[str] | None = None) -> DataFrame:
    """A8 + G1: new rows replace same-key target rows; others are appended.

    `new` is first reduced to its latest row per key, so replaying the same
    batch is idempotent. Equal times are decided by `ties` (all other columns
    unless given), so the result does not depend on the order of rows. Columns
    that only one side has are kept, NULL in the other's rows.
    """
    fresh = newest(new, key, order_col, ties)
    if target is None:
        return fresh
    kept = target.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def ensure_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """A10: add a NULL column of the given type when absent."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def update_column(target: DataFrame, src: DataFrame, key: str, cols: list[str],
                  order_col: str | None = None) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET cols, as one left join.

    The source is reduced to one row per key: the last by `order_col`, then by the values, always whole. Without
    `order_col` no row is the last one, so a key that comes twice fails the job. A match sets its values, NULL
    included; unmatched target rows keep theirs (NULL for a new column).
    """
    t = target
    for c in cols:
        t = ensure_column(t, c, dict(src.dtypes)[c])
    if order_col:
        s = src.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(order_col, *cols)).alias("_src"))
    else:
        once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"{key} comes twice and there is no order column")).cast("boolean"))
        s = src.groupBy(key).agg(F.any_value(F.struct(*cols)).alias("_src"), once.alias("_once")).where(F.col("_once").isNull()).drop("_once")
    j = t.join(s, key, "left")
    out = [F.when(F.col("_src").isNotNull(), F.col("_src")[c]).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in t.columns]
    return j.select(*out)
