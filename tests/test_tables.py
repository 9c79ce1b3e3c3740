"""Partitioned tables (A8, A11, A12, L4, L6) and streams (I1, I2, A15): nothing lost, nothing twice, little rewritten."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from groundwork.operators import incremental
from groundwork.sources import files
from groundwork.sources.tables import NULL_PARTITION, Table
from groundwork.streaming import stream

SCHEMA = "id long, at timestamp_ntz, v string"


def forget_commit(checkpoint, batch):
    """As if the stream had stopped before it noted the end of a batch."""
    for name in (f"{batch}", f".{batch}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def day(n, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def table(spark):
    return Table(spark, f"{tempfile.mkdtemp(prefix='gw-table-')}/t", "id", "at", "at", "day", ("v",))


def content(t):
    return sorted((r.id, r.at, r.v) for r in t.read().collect())


def held_files(t):
    return {f"{d}/{f}" for d in files.names(t.spark, t.path) if "=" in d for f in files.names(t.spark, f"{t.path}/{d}")}


def test_merge_rewrites_touched_partitions_only(spark, table):
    table.merge(rows(spark, (1, day(0), "a"), (2, day(1), "b"), (3, day(2), "c")))
    before = held_files(table)
    touched = table.merge(rows(spark, (2, day(3), "b2"), (4, day(3), "d")))
    assert touched == ["2024-01-02", "2024-01-04"]
    assert content(table) == [(1, day(0), "a"), (2, day(3), "b2"), (3, day(2), "c"), (4, day(3), "d")]
    after = held_files(table)
    untouched = {f for f in before if "2024-01-01" in f or "2024-01-03" in f}
    assert untouched and untouched <= after
    assert not any("2024-01-02" in f for f in after)  # the emptied partition is gone


def test_merge_order_and_repeats_do_not_matter(spark, table):
    new, old = rows(spark, (1, day(5), "new")), rows(spark, (1, day(0), "old"), (2, day(0), "x"))
    table.merge(new)
    table.merge(old)
    table.merge(old)
    assert content(table) == [(1, day(5), "new"), (2, day(0), "x")]


def test_merge_null_partition_key_and_new_column(spark, table):
    table.merge(rows(spark, (1, None, "a"), (None, day(0), "k"), (2, day(0), "b")))
    assert sorted((r.id or 0, r.v) for r in table.read().collect()) == [(0, "k"), (1, "a"), (2, "b")]
    touched = table.merge(rows(spark, (1, day(1), "a2")).withColumn("extra", F.lit(7)))
    assert set(touched) == {NULL_PARTITION, "2024-01-02"}
    got = {r.v: r.extra for r in table.read().collect()}
    assert got == {"k": None, "b": None, "a2": 7}


def test_unfinished_changes(spark, table):
    """A change whose list is written is applied later; one without its list is dropped."""
    table.merge(rows(spark, (1, day(0), "a")))
    work = f"{table.pending}/half"
    table.write_rows(table.with_part(rows(spark, (1, day(0), "lost"))), f"{work}/rows")
    table.finish()
    assert content(table) == [(1, day(0), "a")] and files.names(spark, table.pending) == []
    table.write_rows(table.with_part(rows(spark, (1, day(1), "done"))), f"{work}/rows")
    files.write_lines(spark, ["2024-01-01", "2024-01-02"], f"{work}/touched")
    table.finish()
    assert content(table) == [(1, day(1), "done")]
    assert table.merge(rows(spark)) == []
    assert content(table) == [(1, day(1), "done")]


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().startswith("Scan"):
            m = node.metrics()
            found.append((m.apply("numFiles").value(), m.apply("numOutputRows").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(plan)
    return found[0]


def test_layout_prunes(spark, small_dir):
    """A filter on the partition reads fewer files, one on the clustering columns fewer rows."""
    base = tempfile.mkdtemp(prefix="gw-layout-")
    ev = spark.read.parquet(f"{small_dir}/events.parquet")
    t = Table(spark, f"{base}/t", "event_id", "ts", "ts", "month", ("user_id",))
    big = ev.select("event_id", "ts", "user_id").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(400)))).withColumn("event_id", F.col("event_id") * 1000 + F.col("n")).drop("n")
    spark.conf.set("parquet.block.size", 1 << 18)
    try:
        t.merge(big.withColumn("user_id", F.col("event_id") % 100_003))
    finally:
        spark.conf.unset("parquet.block.size")
    whole, few = t.read(with_part=True), spark.read.parquet(t.path).where("user_id = 17")
    all_files, all_rows = scanned_rows(whole.select("event_id"))
    assert all_rows == big.count()
    part_files, _ = scanned_rows(spark.read.parquet(t.path).where("ts_month = DATE'1999-01-01'"))
    assert part_files < all_files
    _, read = scanned_rows(few)
    assert 0 < read < all_rows / 2


# ---- I1 -----------------------------------------------------------------------------------------------------------

EVENTS = "id long, ts timestamp_ntz, v string"


def write_files(spark, path, *batches):
    for b in batches:
        spark.createDataFrame(b, EVENTS).coalesce(1).write.mode("append").parquet(path)


BATCHES = [
    [(1, day(20), "a"), (2, day(20), "b"), (1, day(20), "a")],
    [(2, day(20), "b"), (3, day(0), "very late"), (None, day(20), "loose"), (5, None, "undated")],
    [(3, day(0), "very late"), (4, day(21), "d"), (5, None, "undated"), (1, day(20), "a")],
]


@pytest.mark.parametrize("per", [1, 2, 3])
def test_ingest_is_complete_for_any_batch_size(spark, per):
    base = tempfile.mkdtemp(prefix="gw-ingest-")
    write_files(spark, f"{base}/src", *BATCHES)
    schema = spark.createDataFrame([], EVENTS).schema
    for n in (1, 2):  # the second run has a checkpoint of its own: everything is redelivered
        stream.ingest(stream.source(spark, f"{base}/src", schema, files_per_batch=per), f"{base}/store", f"{base}/ck{n}", "id", "ts")
        got = sorted((r.id or 0, r.v) for r in stream.ingested(spark, f"{base}/store", schema).collect())
        assert got == [(0, "loose")] * n + [(1, "a"), (2, "b"), (3, "very late"), (4, "d"), (5, "undated")]


def test_ingest_routes_late_rows_and_replaces_a_repeated_batch(spark):
    base = tempfile.mkdtemp(prefix="gw-ingest-")
    schema = spark.createDataFrame([], EVENTS).schema
    src = lambda: stream.source(spark, f"{base}/src", schema, files_per_batch=1)
    write_files(spark, f"{base}/src", BATCHES[0])
    stream.ingest(src(), f"{base}/store", f"{base}/ck", "id", "ts")
    write_files(spark, f"{base}/src", BATCHES[1])
    stream.ingest(src(), f"{base}/store", f"{base}/ck", "id", "ts")
    routes = {r.v: r.ingest_route for r in stream.ingested(spark, f"{base}/store", schema).collect()}
    assert routes == {"a": "main", "b": "main", "very late": "late", "loose": "unkeyed", "undated": "main"}
    # the last batch was stored, then the stream stopped before it noted that: it runs again
    forget_commit(f"{base}/ck", 1)
    stream.ingest(src(), f"{base}/store", f"{base}/ck", "id", "ts")
    assert stream.ingested(spark, f"{base}/store", schema).count() == 5
    assert stream.ingested(spark, f"{base}/none", schema).count() == 0


# ---- I2, A15 ------------------------------------------------------------------------------------------------------

def test_refresh_with_a_new_checkpoint_loses_nothing(spark, table):
    base = tempfile.mkdtemp(prefix="gw-refresh-")
    schema = rows(spark).schema
    write = lambda path, *data: rows(spark, *data).coalesce(1).write.mode("append").parquet(path)
    write(f"{base}/s1", (1, day(0), "a"), (2, day(1), "b"))
    stream.refresh(stream.source(spark, f"{base}/s1", schema), table, f"{base}/ck1")
    before = held_files(table)
    write(f"{base}/s2", (3, day(2), "c"))
    stream.refresh(stream.source(spark, f"{base}/s2", schema), table, f"{base}/ck2")
    assert [r[2] for r in content(table)] == ["a", "b", "c"] and before <= held_files(table)
    write(f"{base}/s2", (1, day(3), "a2"))
    stream.refresh(stream.source(spark, f"{base}/s2", schema), table, f"{base}/ck2")
    assert [r[2] for r in content(table)] == ["a2", "b", "c"]


def test_publish_is_replay_safe(spark, small_dir):
    base = tempfile.mkdtemp(prefix="gw-publish-")
    ev = spark.read.parquet(f"{small_dir}/events.parquet").withColumn("props", F.when(F.col("event_id") % 2 == 0, F.col("props")))
    ev.repartition(2).write.parquet(f"{base}/src")
    run = lambda: stream.publish_stream(stream.source(spark, f"{base}/src", ev.schema, files_per_batch=1), f"{base}/sink", f"{base}/ck", "event_id", ["event_type"])
    run()
    forget_commit(f"{base}/ck", 1)
    run()
    back = stream.decode(stream.published(spark, f"{base}/sink"), ev.schema)
    assert back.count() == ev.count() and back.exceptAll(ev).count() == 0
    assert stream.published(spark, f"{base}/none").count() == 0


def test_update_without_order_needs_unique_keys(spark):
    t = spark.createDataFrame([("1", "a")], "id string, x string")
    s = spark.createDataFrame([("1", "b", 1), ("1", "c", 2)], "id string, x string, n int")
    assert incremental.update_column(t, s, "id", ["x"], "n").first().x == "c"
    with pytest.raises(Exception, match="comes twice"):
        incremental.update_column(t, s, "id", ["x"]).collect()
