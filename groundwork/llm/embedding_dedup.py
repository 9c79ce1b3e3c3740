"""Embedding near-duplicates by cross-polytope hashing (operator 10).

Equal vectors of a label are one class first, so groups of copies are one row. Each class vector is turned by three
rounds of random signs and a fast Hadamard transform; the index and sign of the largest coordinate are a
cross-polytope hash, two of them are a bucket of one table. Besides its own bucket a vector probes those with the
second-best coordinate of either hash. A bucket's rows are compared exactly, in double precision.

A vector is scaled by a power of two first, so that its squares neither overflow nor vanish and no digit is lost; it is
one class with those that differ by such a factor only. Buckets are found from codes alone: a vector is fetched for those
that hold another row.

Buckets are dealt by key. One with more than `BLOCK` rows is cut into blocks, and each pair of blocks is a task's
group of its own, so no bucket has to fit in one task and none is cut off. A pair that meets in several tables counts
in the first only. A group emits sums of links and a spanning forest of its links, never its pairs.

Labels are compared as they are, of whatever atomic type (NaN equals NaN, 0.0 equals -0.0).

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label,
have no links and are their own component. Vectors of different lengths never link. Rows with the same id are vectors
of their own; a null id is never a component's smallest. Extra columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import staged, table
from groundwork.llm.components import components

THRESHOLD = 0.98
TABLES = 8
BLOCK = 512
SEED = 20240


class CrossPolytope:
    """Codes and probes of vectors of one length: `tables` tables of two hashes each."""

    def __init__(self, dim: int, tables: int, seed: int = SEED):
        self.size = 1 << max(1, (dim - 1).bit_length())
        self.tables = tables
        self.signs = np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, 2, 3, self.size))

    def turned(self, x: np.ndarray, table: int, k: int) -> np.ndarray:
        for signs in self.signs[table, k]:
            x = hadamard(x * signs)
        return x

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(n, tables, 3): the own bucket and two probed ones."""
        x = np.zeros((len(vectors), self.size))
        x[:, : vectors.shape[1]] = vectors
        out = np.empty((len(x), self.tables, 3), np.int32)
        rows = np.arange(len(x))
        for t in range(self.tables):
            best, second = [], []
            for k in range(2):
                y = self.turned(x, t, k)
                size = np.abs(y)
                i = size.argmax(1)
                size[rows, i] = -1
                j = size.argmax(1)
                best.append(2 * i + (y[rows, i] < 0))
                second.append(2 * j + (y[rows, j] < 0))
            wide = 2 * self.size
            out[:, t, 0] = best[0] * wide + best[1]
            out[:, t, 1] = second[0] * wide + best[1]
            out[:, t, 2] = best[0] * wide + second[1]
        return out


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, up to scale."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x


def usable(vector: list | None) -> np.ndarray | None:
    """The vector with its largest component scaled to 0.5 to 1 by a power of two; None where it links with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1]) if np.isfinite(v).all() and v.any() else None


def _classing(id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raw = [], []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                v = usable(vector) if label is not None else None
                raw.append(None if v is None else (v + 0.0).tobytes())
                keys.append(None if v is None else xxhash.xxh3_128_digest(raw[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["id", "label", "key", "vec"])

    return run


def _coding(tables: int):
    """Adds the length of each vector and its codes, three for each table: the own bucket and two probed ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[int, CrossPolytope] = {}
        for batch in batches:
            raw = batch.column("vec").to_pylist()
            dims = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
            codes = np.zeros((len(raw), tables * 3), np.int32)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                cp = hashes.setdefault(dim, CrossPolytope(dim, tables))
                codes[own] = cp.codes(np.frombuffer(b"".join(raw[i] for i in own), np.float64).reshape(len(own), dim)).reshape(len(own), -1)
            offsets = pa.array(np.arange(len(raw) + 1) * tables * 3, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))],
                names=[*batch.schema.names, "dim", "codes"],
            )

    return run


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys from sorted batches; a run may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([*held, batch]).combine_chunks()
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield t.slice(a, b - a)
        held = t.slice(cuts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _comparing(threshold: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["t", "dim", "label", "code", "cell"]):
            if group.num_rows < 2:
                continue
            a, b, n = compare(group, threshold, tables)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    return run


def compare(group: pa.Table, threshold: float, tables: int) -> tuple[list[int], list[int | None], list[int]]:
    """Link counts (a, null, n) and forest edges (a, b, 0) of one cell."""
    ids, copies = group.column("id").to_numpy(), group.column("n").to_numpy()
    probe, block = group.column("probe").to_numpy(zero_copy_only=False), group.column("block").to_numpy()
    t, code = group.column("t")[0].as_py(), group.column("code")[0].as_py()
    low, high = divmod(group.column("cell")[0].as_py(), 1 << 32)
    x = np.frombuffer(b"".join(group.column("vec").to_pylist()), np.float64).reshape(len(ids), -1)
    norm = np.sqrt((x * x).sum(1))
    i, j = np.flatnonzero(block == low), np.flatnonzero(block == high)
    linked = x[i] @ x[j].T >= (threshold * norm[i])[:, None] * norm[j][None, :]
    p, q = np.nonzero(linked)
    p, q = i[p], j[q]
    keep = (ids[p] != ids[q]) & ~(probe[p] & probe[q])
    keep &= p < q if low == high else True
    p, q = p[keep], q[keep]
    if not len(p):
        return [], [], []
    codes = pc.list_flatten(group.column("codes")).to_numpy().reshape(len(ids), tables, 3)
    a, b = codes[p], codes[q]
    a_in_b = (a[:, :, :1] == b[:, :, 1:]).any(2)
    b_in_a = (b[:, :, :1] == a[:, :, 1:]).any(2)
    same = a[:, :, 0] == b[:, :, 0]
    keep = ~(same | a_in_b | b_in_a)[:, :t].any(1)
    # in this table: the common bucket, else the probed one, the smaller if either probes the other
    least = np.where(a_in_b[:, t] & b_in_a[:, t], np.minimum(a[:, t, 0], b[:, t, 0]), np.where(a_in_b[:, t], a[:, t, 0], b[:, t, 0]))
    keep &= np.where(same[:, t], ~probe[p] & ~probe[q], least == code)
    p, q = p[keep], q[keep]
    sums = np.bincount(p, copies[q], len(ids)) + np.bincount(q, copies[p], len(ids))
    at = np.flatnonzero(sums)
    root = list(range(len(ids)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    ea, eb = [], []
    for u, v in zip(p.tolist(), q.tolist(), strict=True):
        if (u := top(u)) != (v := top(v)):
            root[u] = v
            ea.append(int(ids[u]))
            eb.append(int(ids[v]))
    return ids[at].tolist() + ea, [None] * len(at) + eb, sums[at].astype(int).tolist() + [0] * len(ea)


def dedup_embeddings(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, tables: int = TABLES, block: int = BLOCK) -> DataFrame:
    """id, n_links, component_id and kept of every row; see the module's docstring for the defined cases."""
    kind = vectors.schema[id_col].dataType.simpleString()
    label = F.col(label_col)
    if vectors.schema[label_col].dataType.simpleString() in ("float", "double"):
        label = label + F.lit(0).cast(vectors.schema[label_col].dataType)
    elif vectors.schema[label_col].dataType.simpleString() == "binary":
        label = F.hex(label)
    mine = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.col(vec_col).alias("vec"))
    rows = staged(mine.mapInArrow(_classing(kind), "id long, label string, key binary, vec binary"), "vectors")
    linkable = rows.where("key IS NOT NULL AND id IS NOT NULL")
    classes = linkable.groupBy("label", "key").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    schema = "label string, key binary, id long, n long, vec binary, dim int, codes array<int>"
    classes = staged(classes.mapInArrow(_coding(tables), schema), "classes")
    coded = classes.select("label", "key", "id", "dim", F.posexplode("codes").alias("nth", "code"))
    buckets = coded.select("label", "key", "id", "dim", F.floor(F.col("nth") / 3).cast("int").alias("t"), "code", (F.col("nth") % 3 > 0).alias("probe"))
    bucket = ["t", "dim", "label", "code"]
    sizes = buckets.groupBy(*bucket).agg(F.count("*").alias("size"), F.count_if(~F.col("probe")).alias("own"))
    sizes = sizes.where("size > 1 AND own > 0").select(*bucket, F.ceil(F.col("size") / block).cast("long").alias("blocks"))
    met = buckets.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    cells = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.withColumn("cell", F.least("block", "other") * F.lit(1 << 32) + F.greatest("block", "other")).drop("other", "blocks", "id", "dim")
    cells = cells.join(classes, ["label", "key"])
    dealt = cells.repartition(*bucket, "cell").sortWithinPartitions(*bucket, "cell")
    found = staged(dealt.mapInArrow(_comparing(threshold, tables), "a long, b long, n long"), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    reach = components(found.where("b IS NOT NULL").select("a", "b"))
    known = classes.select("label", "key", "id", "n").join(links, "id", "left").join(reach, "id", "left")
    known = known.select("label", "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("id", "label", "key").join(known, ["label", "key"], "left")
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id"))
    return out.select(F.col("id").cast(kind).alias(id_col), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_embeddings(table(spark, sf_dir, "embeddings"))
