"""Near-duplicate documents by a chosen-path similarity join (operator 8).

Documents with equal shingle sets are one class, represented by the smallest id. Each representative gets minwise
tokens (the minimum of `TOKENS` seeded hashes over its set). In each of `TREES` independent trees a node chooses some
of those tokens, seeded by its own path, and the document branches along the value of each chosen one. With one token
always and a second with probability 1/similarity - 1, a pair at the threshold is expected to share as many paths
at any depth, as the chosen-path method asks. `DEPTH` levels are expanded at once; documents of a node that still has
more than `NODE` rows besides copies of its smallest document branch on, level by level, until nodes are small.

Nodes are compared exhaustively, in two turns, so that a group of copies never emits all its pairs. First every
document is checked against the smallest of each of its nodes; links found so far are closed into components. Then
rows of each node that are still in different components are compared, block by block where a node stays large (a
dense group that no branching parts), and each block gives one link from a document to a component. A 64-bit sketch (one bit of each minwise token) leaves
out pairs far below the threshold; every link is confirmed by the exact overlap of the full sets.

Defined results: null and empty texts, and texts without words, have 0 shingles and stand alone. A text with fewer
words than a shingle has its whole sequence as the one shingle. Rows with the same id are one document whose set is
the one of each row in turn: all its rows get the smallest id any of them reaches. A null id is never linked and keeps
a null component. Extra columns are kept or ignored by the caller's choice; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import pieces_of, staged, table
from groundwork.llm.components import components
from groundwork.llm.embedding_dedup import grouped
from groundwork.llm.rolling import BASE, mixed, word_hashes

TOKENS = 64
TREES = 12
DEPTH = 4
MORE_LEVELS = 4
NODE = 256
BLOCK = 512
FAR_BITS = 20  # of 64; a pair at similarity 0.8 differs in 6.4 on average, with deviation 2.4
# a pair at 0.8 differs in 6.4 bits on average, one such pair in twenty in more than this
COPY_BITS = 10
SEED = 88172645463325252
BATCH_BYTES = 1 << 20


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct hashed shingles of each text."""
    hashes, counts = word_hashes([t.encode("utf-8", "surrogatepass") for t in texts])
    ends = np.cumsum(counts)
    joined = chained([hashes[j : len(hashes) - size + 1 + j] for j in range(size)]) if len(hashes) >= size else hashes[:0]
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(joined[a : b - size + 1]))
        else:  # fewer words: the whole sequence as one
            out.append(chained([hashes[k : k + 1] for k in range(a, b)]) if b > a else hashes[:0])
    return out


def chained(columns: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for h in columns:
        out = mixed(out * np.uint64(BASE) + h)
    return out


def multipliers(tokens: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 31, (tokens, 1)) * 2 + 1).astype(np.uint32), rng.integers(0, 1 << 32, (tokens, 1)).astype(np.uint32)


def minwise(shingles: np.ndarray, by: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of each seeded 32-bit hash over the set, a bounded part of it at a time."""
    out = np.full(len(by[0]), np.iinfo(np.uint32).max, np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 4096):
        h = high[None, at : at + 4096] * by[0]
        h += by[1]
        np.minimum(out, h.min(1), out=out)
    return out


def branch(paths: np.ndarray, rows: np.ndarray, tokens: np.ndarray, extra: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of paths of documents (rows of `tokens`): one chosen token, and with probability `extra` a second."""
    seeds = mixed(paths * np.uint64(0xA24BAED4963EE407) + np.uint64(1))
    n = np.uint64(tokens.shape[1])
    first = (seeds >> np.uint64(8)) % n
    second = (first + np.uint64(1) + (seeds >> np.uint64(24)) % (n - np.uint64(1))) % n
    more = (seeds >> np.uint64(40)) % np.uint64(1 << 20) < np.uint64(int(extra * (1 << 20)))
    grow = lambda own, at, token: mixed((own ^ (token + np.uint64(1))) * np.uint64(BASE) + mixed(tokens[at, token] + np.uint64(1 << 33)))
    children = np.concatenate([grow(paths, rows, first), grow(paths[more], rows[more], second[more])])
    return children, np.concatenate([rows, rows[more]])


def sketches(tokens: np.ndarray) -> np.ndarray:
    """One bit of each of 64 minwise tokens, as a long per row."""
    return np.packbits(mixed(tokens.astype(np.uint64)).astype(np.uint8) & 1, axis=1)[:, :8].copy().view(np.int64)[:, 0]


def _signing(size: int, similarity: float, trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = multipliers(TOKENS)
        roots = mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        for whole in batches:
            for batch in pieces_of(whole, "text", BATCH_BYTES):
                sets = shingle_sets([t or "" for t in batch.column("text").to_pylist()], size)
                some = np.flatnonzero([len(x) for x in sets])
                tokens = np.array([minwise(sets[i], by) for i in some], np.uint32).reshape(len(some), TOKENS)
                rows, paths = np.repeat(np.arange(len(some)), trees), np.tile(roots, len(some))
                for _ in range(depth):
                    paths, rows = branch(paths, rows, tokens, 1 / similarity - 1)
                order = np.argsort(rows, kind="stable")
                own_paths = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[order], np.arange(len(some) + 1)), pa.int32()), pa.array(paths[order].view(np.int64)))
                at = np.full(len(sets), -1)
                at[some] = np.arange(len(some))
                take = pa.array(at, pa.int64(), mask=at < 0)
                digests = pa.array([xxhash.xxh3_128_digest(sets[i].tobytes()) for i in some], pa.binary())
                raw = pa.array([t.tobytes() for t in tokens], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([len(x) for x in sets], pa.int64()), digests.take(take), pa.array(sketches(tokens), pa.int64()).take(take), own_paths.take(take), raw.take(take)],
                    names=["id", "n", "digest", "bits", "paths", "tokens"],
                )

    return run


def _branching(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("tokens").to_pylist()
            tokens = np.frombuffer(b"".join(raw), np.uint32).reshape(len(raw), TOKENS)
            nodes = batch.column("nodes")
            paths = nodes.flatten().to_numpy().view(np.uint64)
            out, at = branch(paths, np.repeat(np.arange(len(raw)), nodes.value_lengths().to_numpy()), tokens, 1 / similarity - 1)
            rows = batch.take(pa.array(at, pa.int64()))
            out = out.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), rows.column("id"), rows.column("bits")], names=["node", "id", "bits"])

    return run


def _confirming(size: int, similarity: float):
    per_cent = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "ta", BATCH_BYTES):
                left = shingle_sets(batch.column("ta").to_pylist(), size)
                right = shingle_sets(batch.column("tb").to_pylist(), size)
                keep = []
                for a, b in zip(left, right, strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= per_cent * (len(a) + len(b) - both))
                rows = batch.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b")], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    left, right = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(_confirming(size, similarity), "a long, b long")


def across(rows: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links between the odd rows of a node and its other rows of other components, compared block by block.

    A node's odd rows and other rows are cut into blocks of about `BLOCK`; each pair of blocks is a group of its own,
    of bounded size, that gives a spanning forest of its links.
    """
    blocks = rows.groupBy("node").agg(F.ceil(F.count_if("odd") / BLOCK).cast("int").alias("odds"), F.ceil(F.count_if(~F.col("odd")) / BLOCK).cast("int").alias("rest"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("odd"), F.col("odds")).otherwise(F.col("rest"))).cast("int")
    met = rows.join(blocks.where("odds > 0 AND rest > 0"), "node").withColumn("own", own)
    cells = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("odd"), F.col("rest")).otherwise(F.col("odds")) - 1)))
    cells = cells.select("node", "id", "part", "odd", F.when(F.col("odd"), F.col("own")).otherwise(F.col("other")).alias("i"), F.when(F.col("odd"), F.col("other")).otherwise(F.col("own")).alias("j"))
    dealt = cells.join(texts, "id").repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    return dealt.mapInArrow(_crossing(size, similarity), "a long, b long")


def _crossing(size: int, similarity: float):
    per_cent = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["node", "i", "j"]):
            ids, part = group.column("id").to_numpy(), group.column("part").to_numpy()
            odd = group.column("odd").to_numpy(zero_copy_only=False)
            if odd.all() or not odd.any():
                continue
            sets = shingle_sets(group.column("text").to_pylist(), size)
            sizes = np.array([len(x) for x in sets])
            i, j = np.flatnonzero(odd), np.flatnonzero(~odd)
            both = overlaps([sets[k] for k in i], [sets[k] for k in j])
            linked = (100 * both >= per_cent * (sizes[i][:, None] + sizes[j][None, :] - both)) & (part[i][:, None] != part[j][None, :])
            # one link from an odd row to each component: the component's own links are known
            p, q = np.nonzero(linked)
            if len(p):
                a, b = ids[i][p], ids[j][q]
                keep = np.unique(np.stack([p, part[j][q]]), axis=1, return_index=True)[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], names=["a", "b"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set: exact counts, by shared elements."""
    out = np.zeros((len(left), len(right)), np.int64)
    values = np.concatenate(right)
    owner = np.repeat(np.arange(len(right)), [len(x) for x in right])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    for k, own in enumerate(left):
        low, high = np.searchsorted(values, own), np.searchsorted(values, own, side="right")
        n = high - low
        if total := int(n.sum()):
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(total)
            out[k] = np.bincount(owner[at], minlength=len(right))
    return out


def near(x, y, most: int = FAR_BITS):
    return F.bit_count(x.bitwiseXOR(y)) <= most


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, trees: int = TREES, depth: int = DEPTH, node: int = NODE) -> DataFrame:
    """id, n_shingles, component_id and kept of every row; see the module's docstring for the defined cases."""
    kind = docs.schema[id_col].dataType.simpleString()
    mine = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = staged(mine.mapInArrow(_signing(shingle, similarity, trees, depth), "id long, n long, digest binary, bits long, paths array<long>, tokens binary"), "signed")
    classes = staged(signed.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")), "classes")
    only = signed.select("id", "digest", "bits", "paths", "tokens").join(classes, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"])
    only = staged(only, "representatives")

    nodes = staged(met(only.select(F.explode("paths").alias("node"), "id", "bits")), "nodes")
    rows = nodes.where(F.col("size") <= node)
    for level in range(MORE_LEVELS):
        # copies of a node's smallest document would stay together at every depth; a node counts by the rest
        big = nodes.where(F.col("size") > node)
        apart = big.where(~near(F.col("bits"), F.col("lead_bits"), COPY_BITS)).groupBy("node").agg(F.count("*").alias("apart"))
        crowded = staged(apart.where(F.col("apart") > node).select("node"), "crowded")
        rows = rows.union(staged(big.join(crowded, "node", "left_anti").select(*nodes.columns), "copies"))
        # a row per document: its nodes are at most its own paths, some dozens
        large = big.join(crowded, "node", "left_semi").groupBy("id", "bits").agg(F.collect_list("node").alias("nodes"))
        if crowded.isEmpty():
            break
        grown = large.join(only.select("id", "tokens"), "id").mapInArrow(_branching(similarity), "node long, id long, bits long").distinct()
        nodes = staged(met(grown), "nodes")
        rows = rows.union(nodes if level == MORE_LEVELS - 1 else nodes.where(F.col("size") <= node))

    # every document with a near one in some node, and its text; nothing else is compared
    beside = (F.col("id") != F.col("lead")) & near(F.col("bits"), F.col("lead_bits"))
    led = rows.where(beside).select(F.col("lead").alias("a"), F.col("id").alias("b"))
    odd = rows.where((F.col("id") != F.col("lead")) & ~near(F.col("bits"), F.col("lead_bits"))).select("node", F.col("id").alias("a"), F.col("bits").alias("x"))
    # each side of those near pairs once: a group's pairs are not made
    x, y = odd.select(F.col("node").alias("n"), "a", "x"), rows.select("node", "id", "bits")
    meet = (F.col("n") == F.col("node")) & (F.col("a") != F.col("id")) & near(F.col("x"), F.col("bits"))
    some = led.select(F.col("a").alias("id")).union(led.select("b"))
    some = some.union(x.join(y, meet, "left_semi").select("a")).union(y.join(x, meet, "left_semi").select("id")).distinct()
    texts = mine.where("id IS NOT NULL AND text IS NOT NULL").join(some, "id", "left_semi")
    texts = staged(texts.dropDuplicates(["id"]), "texts")

    # first turn: each document against the smallest of each of its nodes
    links = staged(confirmed(led.distinct(), texts, shingle, similarity), "links")
    reach = components(links)

    # second turn: what is still apart in a node, against the node's smallest component and each other
    parts = staged(rows.select("node", "id", "bits").join(texts.select("id"), "id", "left_semi").join(reach, "id", "left").select("node", "id", "bits", F.coalesce("component", "id").alias("part")), "parts")
    lowest = parts.groupBy("node").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("node", "lo")
    members = parts.join(lowest, "node")
    x = members.where("part <> lo").select(F.col("node").alias("n"), F.col("id").alias("a"), F.col("bits").alias("x"), F.col("part").alias("own"))
    meet = (F.col("n") == F.col("node")) & (F.col("own") != F.col("part")) & near(F.col("x"), F.col("bits"))
    others = x.join(members, meet, "left_semi").select(F.col("n").alias("node"), F.col("a").alias("id"), F.col("own").alias("part"), F.lit(True).alias("odd"))
    them = members.join(x, meet, "left_semi").select("node", "id", "part", F.lit(False).alias("odd"))
    more = across(others.union(them), texts, shingle, similarity)
    linked = links.union(more)
    # a class's other ids hang on its representative
    reach = components(linked)
    out = signed.select("id", "n", "digest").join(classes.select("digest", F.col("id").alias("lead")), "digest", "left")
    out = out.join(reach.select(F.col("id").alias("lead"), "component"), "lead", "left")
    component = F.coalesce("component", "lead", "id")
    return out.select(F.col("id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).cast(kind).alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def met(rows: DataFrame) -> DataFrame:
    """Rows of nodes with at least two documents, with the node's size, smallest id and that one's sketch."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("id").alias("lead"), F.min_by("bits", "id").alias("lead_bits")).where("size > 1")
    return rows.join(sizes, "node")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, similarity=0.8)
