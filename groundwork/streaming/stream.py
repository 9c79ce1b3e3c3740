"""Structured Streaming pieces.

Every stream runs what is available now, in micro-batches. A batch has a name of its own for ever: the stream's id,
which Spark keeps in the checkpoint and draws anew for a new checkpoint, and the batch's number. What a batch writes
goes under its name, so a repeated batch replaces its own files and a new checkpoint never meets old ones.

I1: at-least-once events -> exactly-once rows. The ids seen are the stored rows themselves, by day of event; a batch is
reduced to one row per id, then anti-joined with the stored days that it touches. That state outlives any watermark, so
no row is dropped for being late, and the rows stored don't depend on the size of micro-batches. Late rows and rows
without an id are kept on routes of their own.
I2: incremental refresh: each batch is merged into a partitioned table (`sources.tables`); only touched partitions are
rewritten.
A15/H30: events are encoded as messages and published batch by batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundwork.sources import files
from groundwork.sources.tables import Table

MAIN, LATE, UNKEYED = "main", "late", "unkeyed"
NO_DAY = "none"
# Partition columns of the store.
ROUTE, DAY = "ingest_route", "ingest_day"
# Bodies keep microseconds, and nulls as nulls.
JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def encode(df: DataFrame, key: str, attrs: list[str] | None = None) -> DataFrame:
    """message = key, JSON body of all columns (nulls included), string attributes."""
    attrs = attrs or []
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON).alias("value"),
        F.create_map(*[x for a in attrs for x in (F.lit(a), F.col(a).cast("string"))]).alias("attributes")
        if attrs else F.create_map().cast("map<string,string>").alias("attributes"),
    )


def decode(msgs: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON body back to typed columns."""
    return msgs.select(F.from_json("value", schema, JSON).alias("m")).select("m.*")


def source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
           files_per_batch: int | None = None) -> DataFrame:
    """A folder of files as a stream, with at most `files_per_batch` files a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def run_batches(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, str], None]) -> None:
    """Hand everything available now to `apply(batch, name)`, a micro-batch at a time, then stop."""
    spark = stream.sparkSession
    found: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        if not found:  # the stream's id is in the checkpoint before its first batch
            found.append(spark.read.json(f"{checkpoint}/metadata").first()["id"])
        apply(batch, f"{found[0]}-{number:09d}")

    query = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


# ---- I1: complete ingest -----------------------------------------------------

def ingest(stream: DataFrame, store: str, checkpoint: str, key: str, ts_col: str, late_days: int = 1) -> None:
    """Every message of the stream exactly once, by `key`, into the store.

    A message is redelivered with its own event time, so its id is looked up in the stored rows of that day alone.
    Of equal ids in a batch the earliest row stays (then the smallest by hash). Rows more than `late_days` before the
    newest stored day are routed as late, rows without a key as unkeyed (each is kept); neither is dropped.
    """

    def apply(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        day = F.coalesce(F.date_format(F.col(ts_col).cast("timestamp_ntz"), "yyyy-MM-dd"), F.lit(NO_DAY))
        dated = batch.withColumn(DAY, day)
        stored = _folders(spark, store, name)
        newest = max((d for d in stored if d != NO_DAY), default=None)
        days = [r[DAY] for r in dated.where(F.col(key).isNotNull()).select(DAY).distinct().collect()]  # a row per day
        first = dated.where(F.col(key).isNotNull()).groupBy(key, DAY).agg(
            F.min_by(F.struct(*batch.columns), F.struct(ts_col, F.xxhash64(*batch.columns))).alias("row"))
        rows = first.select("row.*", DAY)
        known = [f for d in days for f in stored.get(d, [])]
        if known:
            rows = rows.join(spark.read.schema(batch.schema).parquet(*known).select(key), key, "left_anti")
        late = F.datediff(F.lit(newest).cast("date"), F.col(DAY).try_cast("date")) > late_days if newest else F.lit(False)
        routed = rows.withColumn(ROUTE, F.when(late, F.lit(LATE)).otherwise(F.lit(MAIN)))
        loose = dated.where(F.col(key).isNull()).withColumn(ROUTE, F.lit(UNKEYED))
        both = routed.select(*batch.columns, ROUTE, DAY).unionByName(loose.select(*batch.columns, ROUTE, DAY))
        both.write.mode("overwrite").partitionBy(ROUTE, DAY).parquet(f"{store}/batch={name}")

    run_batches(stream, checkpoint, apply)


def _folders(spark: SparkSession, store: str, without: str = "") -> dict[str, list[str]]:
    """The folders of each stored day, in finished batches only (a listing, no data is read)."""
    found: dict[str, list[str]] = {}
    for batch in files.names(spark, store):
        at = f"{store}/{batch}"
        if batch == f"batch={without}" or not files.complete(spark, at):
            continue
        for route in files.names(spark, at):
            if route in (f"{ROUTE}={MAIN}", f"{ROUTE}={LATE}"):
                for day in files.names(spark, f"{at}/{route}"):
                    found.setdefault(day.removeprefix(f"{DAY}="), []).append(f"{at}/{route}/{day}")
    return found


def ingested(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished batches, with their `ingest_route`."""
    done = [f"{store}/{b}" for b in files.names(spark, store) if files.complete(spark, f"{store}/{b}")]
    held = T.StructType([*schema.fields, T.StructField(ROUTE, T.StringType()), T.StructField(DAY, T.StringType())])
    if not done:
        return spark.createDataFrame([], held).drop(DAY)
    return spark.read.schema(held).option("basePath", store).parquet(*done).drop(DAY, "batch")


# ---- I2: incremental refresh -------------------------------------------------

def refresh(stream: DataFrame, table: Table, checkpoint: str) -> None:
    """Merge everything available now into the table, a micro-batch at a time.

    The checkpoint decides what is new, so rows of equal or late times are not lost; a new checkpoint on an existing
    table merges the source again, which leaves the newest row of each key as it is.
    """
    run_batches(stream, checkpoint, table.merge)


# ---- A15: publish ------------------------------------------------------------

def publish_stream(stream: DataFrame, sink: str, checkpoint: str, key: str, attrs: list[str] | None = None) -> None:
    """One message per row of the stream, a folder of JSON lines per batch (a message bus in production).

    A repeated batch replaces its own folder, so nothing is published twice.
    """

    def apply(batch: DataFrame, name: str) -> None:
        encode(batch, key, attrs).write.mode("overwrite").json(f"{sink}/batch={name}")

    run_batches(stream, checkpoint, apply)


MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])


def published(spark: SparkSession, sink: str) -> DataFrame:
    """The messages of all finished batches."""
    done = [f"{sink}/{b}" for b in files.names(spark, sink) if files.complete(spark, f"{sink}/{b}")]
    return spark.read.schema(MESSAGE).json(done) if done else spark.createDataFrame([], MESSAGE)
