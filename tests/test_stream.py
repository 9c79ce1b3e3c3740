"""Streaming ingest with redelivered messages, and availableNow refresh."""
import os
import tempfile

from pyspark.sql import functions as F

from groundwork.sources.tables import Table
from groundwork.streaming import stream


def test_ingest_dedup_and_refresh(spark, small_dir):
    base = tempfile.mkdtemp(prefix="gw-stream-")
    ev = spark.read.parquet(f"{small_dir}/events.parquet")
    src = os.path.join(base, "src")
    ev.write.mode("append").parquet(src)
    ev.filter(F.col("event_id") % 3 == 0).write.mode("append").parquet(src)  # redelivery
    schema = spark.read.parquet(src).schema
    store = os.path.join(base, "store")
    stream.ingest(stream.source(spark, src, schema), store, os.path.join(base, "ck1"), key="event_id", ts_col="ts")
    got = stream.ingested(spark, store, schema)
    assert got.count() == ev.count() == got.select("event_id").distinct().count()

    table = Table(spark, os.path.join(base, "tbl"), "event_id", "ts", "ts", "month")
    stream.refresh(stream.source(spark, src, schema), table, os.path.join(base, "ck2"))
    assert table.read().count() == ev.count()


def test_encode_decode_roundtrip(spark, small_dir):
    ev = spark.read.parquet(f"{small_dir}/events.parquet").select("event_id", "event_type", "value")
    msgs = stream.encode(ev, "event_id", ["event_type"])
    back = stream.decode(msgs, ev.schema)
    assert back.exceptAll(ev).count() == 0
