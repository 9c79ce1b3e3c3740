"""Sources and sinks.

Plain DataFrameReader/Writer calls with declared schemas; no driver-side
loops over files or rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_SCHEMA = T.StructType([
    T.StructField("original_name", T.StringType()),
    T.StructField("corrected_name", T.StringType()),
    T.StructField("confidence_score", T.DoubleType()),
])


def scan_documents(spark: SparkSession, path: str, suffix: str = "*.pdf", with_content: bool = True) -> DataFrame:
    """A1: every file under `path` whose name matches `suffix` (case-sensitive).

    Without content only the manifest (path, length, modificationTime) is
    read; Spark prunes the bytes column.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", suffix)
          .option("recursiveFileLookup", "true").load(path))
    return df if with_content else df.select("path", "length", "modificationTime")


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A2: a Parquet table with its declared columns (no inference)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def load_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """A3: typed CSV dictionary with a header row."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def scan_answers(spark: SparkSession, path: str, record_end: str | None = None) -> DataFrame:
    """A4: answers as (path, answer_text, answer, is_valid, reject_reason, corrupt_record).

    One answer (JSON text, possibly fenced) per file, or per record of larger files when `record_end` is given. The read
    is permissive: what is not one JSON object as a whole stays as a row with its text in `corrupt_record`.
    """
    from groundwork.operators.extract import parse_json

    texts = spark.read.text(path, lineSep=record_end) if record_end else spark.read.text(path, wholetext=True)
    return parse_json(texts.select(F.input_file_name().alias("path"), F.col("value").alias("answer_text")))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A5: add rows to a table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh (CREATE OR REPLACE TABLE AS SELECT)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Staging as a view."""
    df.createOrReplaceTempView(name)
    return df


def partitioned(df: DataFrame, col: str, grain: str = "day", out_col: str | None = None) -> DataFrame:
    """Derived partition column (day of a timestamp, or month of a date)."""
    from groundwork.sources.tables import period

    return df.withColumn(out_col or f"{col}_{grain}", period(F.col(col), grain))


def clustered(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the clustering columns so Parquet
    row-group min/max statistics let readers skip data."""
    out = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return out.sortWithinPartitions(*cols)


def export_csv(tables: dict[str, DataFrame], out_dir: str) -> None:
    """One CSV folder per table (parallel part files, header row)."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", "true").csv(f"{out_dir}/{name}")


def split_by_age(df: DataFrame, ts_col: str, as_of: _dt.date, expire_days: int | None = 90,
                 cold_days: int | None = None) -> DataFrame:
    """Age in days and a retention class per row: 'expired' past
    expire_days, 'cold' past cold_days, else 'hot' (either rule optional)."""
    age = F.datediff(F.lit(as_of), F.to_date(ts_col))
    cls = F.lit("hot")
    if cold_days is not None:
        cls = F.when(age > cold_days, F.lit("cold")).otherwise(cls)
    if expire_days is not None:
        cls = F.when(age > expire_days, F.lit("expired")).otherwise(cls)
    return df.withColumn("age_days", age).withColumn("retention", cls)
