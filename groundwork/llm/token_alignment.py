"""Cross-tokenizer alignment over inverted pair bitmaps (operator 12).

Tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback) cut the same bytes; the byte offsets where
tokens of both end cut them into groups, and each A-B pair of token occurrences of one group is a link. For every id
pair the documents that hold it form a posting list:

  blocks    a task numbers its documents within blocks of at most 65,536; a block ends earlier when its postings fill
            the task's buffer, so a block is a bounded piece of work whatever the corpus
  bitmaps   per (block, pair) one compressed bitmap: the sorted 16-bit numbers of its documents, or 65,536 bits where
            that is smaller. Each slice of texts gives its own postings; they are OR-merged when the block is written
  planes    plane 0 holds the documents of the pair; plane p the documents in whose multiplicity, less one, bit p-1 is
            set. So links are popcount(plane 0) + sum of 2^(p-1) * popcount(plane p)
  counts    popcounts are summed over blocks per pair, after a partial sum in each task: document and link counts
  scores    each block learns the counts of its own pairs, and its postings hand them back to its documents

Both tokenizers cut before a blank that follows another character and stands before a visible one: A's pattern starts
a pre-token there, and no piece of B holds a blank after another character (checked when B is loaded; otherwise texts
are not cut). So a text is encoded chunk by chunk, by the libraries, and each chunk's alignment is kept in a bounded
memo.

Defined results: null and empty texts, and texts whose joined token bytes of A or B differ from blank+text, have zeros
and '' as their groups' digest. Special strings inside a text are plain text. Every input row is a document of its own:
repeated rows and ids count once each. Null ids are kept. Only the id and text columns are read, so extra columns don't
matter; an empty table gives an empty result. Texts are read whole, whatever their length.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundwork.llm.common import pieces_of, staged, table

BLOCK_DOCS = 1 << 16  # documents have 16-bit numbers in their block
BLOCK_ENTRIES = 1_000_000  # postings a task holds before it ends the block
BITMAP_BYTES = BLOCK_DOCS // 8
SLICE_BYTES = 2 << 20
MEMO_ENTRIES = 50_000  # chunks of each of the memo's two generations
MEMO_CHARS = 64
ROWS = 100_000
GROUP_LINKS = 4096  # links of one group that are listed one by one
# A blank after another character and before a visible one.
CUT = re.compile(r"(?<=[^ ]) (?=\S)")
# Blanks that don't stand before a visible character.
UNSAFE = re.compile(r" (?:\s|\Z)")

_workers: dict[tuple[str, str], "Aligner"] = {}


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligner:
    """One worker's tokenizers and its memo: chunk -> (A ids, B ids, groups, links, digest text, pairs, times), None if the bytes differ.

    A pair may stand in `pairs` several times; without `times` each stands for one link.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_bytes: list[bytes] = []
        for i in range(self.a.get_vocab_size()):
            token = self.a.id_to_token(i)
            self.a_bytes.append(bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.ids = [f"{i}{mark}" for mark in ",|;" for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def chunks(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        return CUT.split(text) if text[0] == " " or UNSAFE.search(text) else text.split(" ")

    def learn(self, lists: list[list[str]]) -> dict[str, tuple | None]:
        """The records of all chunks of a slice; new ones are encoded in one call of each library."""
        own: dict[str, tuple | None] = {}
        new = []
        for c in set().union(*lists):
            if c in self.young:
                own[c] = self.young[c]
            elif c in self.old:
                own[c] = self.young[c] = self.old[c]
            else:
                new.append(c)
        if new:
            encoded = [e.ids for e in self.a.encode_batch_fast([" " + c for c in new], add_special_tokens=False)]
            for c, record in zip(new, self.align(new, encoded, self.b.encode(new, num_threads=1)), strict=True):
                own[c] = record
                if len(c) <= MEMO_CHARS:
                    self.young[c] = record
        if len(self.young) > MEMO_ENTRIES:  # chunks in use come back from the older half
            self.old, self.young = self.young, {}
        return own

    def align(self, chunks: list[str], a: list[list[int]], b: list[list[int]]) -> list[tuple | None]:
        """The records of new chunks. Their tokens are laid end to end, so that all are aligned at once."""
        raw = [(" " + c).encode() for c in chunks]
        same = [b"".join([self.a_bytes[i] for i in x]) == r == b"".join([self.b_bytes[i] for i in y]) for r, x, y in zip(raw, a, b, strict=True)]
        good = [k for k, ok in enumerate(same) if ok]
        out: list[tuple | None] = [None] * len(chunks)
        if not good:
            return out
        n_a, n_b = (np.fromiter((len(x[k]) for k in good), np.int64, len(good)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x[k] for k in good), np.int64) for x in (a, b))
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        last_a, last_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        links = in_a * in_b
        chunk_of = np.repeat(np.arange(len(good)), n_a)[last_a]  # of each group
        groups = np.bincount(chunk_of, minlength=len(good))
        n_links = np.diff(np.cumsum(links)[np.cumsum(groups) - 1], prepend=0)
        # digest texts: ids in order with the mark that follows each
        width = len(self.ids) // 3
        sides = [(ids_a, np.where(last_a, width, 0), group_a * 2), (ids_b, np.where(last_b, 2 * width, 0), group_b * 2 + 1)]
        order = np.argsort(np.concatenate([x[2] for x in sides]), kind="stable")
        marked = np.concatenate([ids + mark for ids, mark, _ in sides])[order].tolist()
        told = list(map(self.ids.__getitem__, marked))
        ends = np.cumsum(n_a + n_b).tolist()
        # links one by one, but for groups with very many
        few = np.minimum(links, 1) * (links <= GROUP_LINKS)
        times = in_b[group_a] * few[group_a]
        first_b = np.cumsum(in_b) - in_b
        at = np.repeat(first_b[group_a] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        pairs = (np.repeat(ids_a, times) << 16 | ids_b[at]).astype(np.uint32).tobytes()
        pair_ends = (4 * np.cumsum(np.bincount(chunk_of, weights=links * few, minlength=len(good)).astype(np.int64))).tolist()
        start = pair_start = 0
        for k, na, nb, ng, nl, end, pair_end in zip(good, n_a.tolist(), n_b.tolist(), groups.tolist(), n_links.tolist(), ends, pair_ends, strict=True):
            out[k] = (na, nb, ng, nl, "".join(told[start:end])[:-1], pairs[pair_start:pair_end], b"")
            start, pair_start = end, pair_end
        for k in dict.fromkeys(chunk_of[links > GROUP_LINKS].tolist()):
            mine = np.flatnonzero(chunk_of == k)
            out[good[k]] = (*out[good[k]][:5], *self.tallied([(ids_a[group_a == g], ids_b[group_b == g]) for g in mine]))
        return out

    @staticmethod
    def tallied(groups: list[tuple[np.ndarray, np.ndarray]]) -> tuple[bytes, bytes]:
        """Pairs and times of groups by their distinct ids, without a list of all links."""
        links: Counter[int] = Counter()
        for own, other in groups:
            times = Counter(other.tolist())
            for x, n in Counter(own.tolist()).items():
                for y, m in times.items():
                    links[x << 16 | y] += n * m
        return np.fromiter(links.keys(), np.uint32, len(links)).tobytes(), np.fromiter(links.values(), np.int64, len(links)).tobytes()


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _workers:
        _workers[a_path, b_path] = Aligner(a_path, b_path)
    return _workers[a_path, b_path]


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal rows begins in sorted columns."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def postings(number: np.ndarray, records: list[tuple], flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, document's number, multiplicity) of a slice of texts, each pair and document once.

    `flat` are the record numbers of the documents' chunks, `sizes` how many each document has.
    """
    pair = np.frombuffer(b"".join(r[5] for r in records), np.uint32)
    n_pairs = np.fromiter((len(r[5]) // 4 for r in records), np.int64, len(records))
    starts = np.cumsum(n_pairs) - n_pairs
    times = np.ones(len(pair), np.int64)
    for k, r in enumerate(records):
        if r[6]:
            times[starts[k] : starts[k] + n_pairs[k]] = np.frombuffer(r[6], np.int64)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    key = np.sort(docs * len(records) + flat)  # each distinct chunk of a document once, with its times
    at = runs(key)
    often = np.diff(np.append(at, len(key)))
    docs, flat = np.divmod(key[at], max(len(records), 1))
    n = n_pairs[flat]
    index = np.repeat(starts[flat] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    joined = np.repeat(docs, n) << 32 | pair[index].astype(np.int64)
    weight = times[index] * np.repeat(often, n)
    order = np.argsort(joined)
    joined, weight = joined[order], weight[order]
    at = runs(joined)
    if len(at):
        weight = np.add.reduceat(weight, at)
    joined = joined[at]
    return (joined & 0xFFFFFFFF).astype(np.uint32), number[joined >> 32], weight


def plane_rows(pair: np.ndarray, number: np.ndarray, plane: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(pairs, plane, bitmaps) of rows sorted by pair and number, some pairs at a time."""
    at = np.append(runs(pair), len(pair))
    for lo in range(0, len(at) - 1, ROWS):
        cut = at[lo : lo + ROWS + 1]
        data = number[cut[0] : cut[-1]].astype("<u2")
        bounds = (cut - cut[0]) * 2
        dense = np.flatnonzero(np.diff(bounds) >= BITMAP_BYTES)
        if len(dense):
            held = [data[a // 2 : b // 2].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for k in dense:
                flags = np.zeros(BLOCK_DOCS, np.uint8)
                flags[np.frombuffer(held[k], "<u2")] = 1
                held[k] = np.packbits(flags, bitorder="little").tobytes()
            bits = pa.array(held, pa.binary())
        else:
            bits = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
        yield pair[cut[:-1]].astype(np.int64), np.full(len(cut) - 1, plane, np.int32), bits


def containers(pair: np.ndarray, number: np.ndarray, times: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """The compressed bitmaps of a block: all its slices' postings OR-merged, plane by plane."""
    order = np.argsort(pair.astype(np.int64) << 16 | number)
    pair, number, rest = pair[order], number[order], times[order] - 1
    yield from plane_rows(pair, number, 0)
    plane = 1
    while (more := rest > 0).any():
        pair, number, rest = pair[more], number[more], rest[more]
        held = rest & 1 == 1
        yield from plane_rows(pair[held], number[held], plane)
        rest, plane = rest >> 1, plane + 1


POSTINGS = "block long, number int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, plane int, bits binary"


def index_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: rows of documents (pair null) with their block and number, and the bitmaps of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small objects without cycles: looking through them costs a third of the time
        try:
            yield from aligned(batches)
        finally:
            gc.enable()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part = aligner(a_path, b_path), TaskContext.get().partitionId()
        blocks = docs_in = entries = 0
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        kind = None

        def close() -> Iterator[pa.RecordBatch]:
            for pair, plane, bits in containers(*(np.concatenate(x) for x in zip(*kept, strict=True))) if kept else ():
                n = len(pair)
                none = [pa.nulls(n, t) for t in (pa.int32(), *[pa.int64()] * 4, pa.string())]
                yield pa.RecordBatch.from_arrays([pa.nulls(n, kind), pa.array(np.full(n, part << 32 | blocks)), *none, pa.array(pair), pa.array(plane), bits], names=names)

        for whole in batches:
            kind = whole.column(0).type
            for batch in pieces_of(whole, whole.schema.names[1], SLICE_BYTES):
                for lo in range(0, batch.num_rows, BLOCK_DOCS):
                    own = batch.slice(lo, BLOCK_DOCS)
                    if docs_in + own.num_rows > BLOCK_DOCS or entries > BLOCK_ENTRIES:
                        yield from close()
                        kept, docs_in, entries, blocks = [], 0, 0, blocks + 1
                    texts = [v.as_py() for v in own.column(1)]
                    lists = [both.chunks(t) if t else [] for t in texts]
                    found = both.learn(lists)
                    bad = {c for c, r in found.items() if r is None}
                    if bad:
                        lists = [[] if not bad.isdisjoint(x) else x for x in lists]
                    place = {c: k for k, c in enumerate(c for c in found if c not in bad)}
                    records = [found[c] for c in place]
                    told = [r[4] for r in records]
                    lists = [list(map(place.__getitem__, x)) for x in lists]
                    digests = [hashlib.sha256(";".join([told[k] for k in x]).encode()).hexdigest() if x else "" for x in lists]
                    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
                    ends = np.append(0, np.cumsum(sizes))
                    digits = []
                    for column in list(zip(*(r[:4] for r in records), strict=True)) or [()] * 4:
                        sums = np.append(0, np.cumsum(np.array(column, np.int64)[flat]))
                        digits.append(pa.array(sums[ends[1:]] - sums[ends[:-1]]))
                    n = own.num_rows
                    number = np.arange(docs_in, docs_in + n)
                    pair, held, times = postings(number, records, flat, sizes)
                    kept.append((pair, held.astype(np.uint16), times))
                    entries, docs_in = entries + len(pair), docs_in + n
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0), pa.array(np.full(n, part << 32 | blocks)), pa.array(number, pa.int32()), *digits, pa.array(digests, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                        names=names,
                    )
        yield from close()

    names = [id_col, *[f.split()[0] for f in POSTINGS.split(", ")]]
    own = docs.select(F.col(id_col), F.col(text_col))
    return staged(own.mapInArrow(run, f"`{id_col}` {own.schema[0].dataType.simpleString()}, {POSTINGS}"), "alignment")


def pair_counts(index: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best): popcounts of each id pair over all blocks, and whether it is its A id's most frequent."""
    size = F.octet_length("bits")
    held = F.when(size == BITMAP_BYTES, F.bitmap_count("bits")).otherwise((size / 2).cast("long"))
    worth = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counts = index.where("pair IS NOT NULL").groupBy("pair").agg(F.sum(F.when(F.col("plane") == 0, held)).alias("n_docs"), F.sum(held * worth).alias("n_links"))
    named = counts.withColumn("a", F.shiftright("pair", 16).cast("int")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFF)).cast("int"))
    return named.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def block_scores(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block's bitmaps and the counts of its pairs -> (block, number, n_best, count_sum) of its documents."""
    n_best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
    known, count, best = (right.column(c).to_numpy() for c in ("known", "n_docs", "best"))
    order = np.argsort(known)
    known, count, best = known[order], count[order].astype(np.int64), best[order].astype(np.int64)
    for batch in left.select(["pair", "plane", "bits"]).to_batches():
        at = np.searchsorted(known, batch.column(0).to_numpy())
        worth = np.left_shift(np.int64(1), np.maximum(batch.column(1).to_numpy().astype(np.int64) - 1, 0))
        bits = [x.as_py() for x in batch.column(2)]
        sizes = np.fromiter(map(len, bits), np.int64, len(bits))
        dense = np.flatnonzero(sizes == BITMAP_BYTES)
        for k in dense:
            number = np.flatnonzero(np.unpackbits(np.frombuffer(bits[k], np.uint8), bitorder="little"))
            n_best[number] += worth[k] * best[at[k]]
            total[number] += worth[k] * count[at[k]]
        sizes[dense] = 0
        number = np.frombuffer(b"".join(b for b, n in zip(bits, sizes, strict=True) if n), "<u2")
        np.add.at(n_best, number, np.repeat(worth * best[at], sizes // 2))
        np.add.at(total, number, np.repeat(worth * count[at], sizes // 2))
    number = np.flatnonzero(total)
    block = left.column("block")[0].as_py()
    return pa.table({"block": np.full(len(number), block), "number": number.astype(np.int32), "n_best": n_best[number], "count_sum": total[number]})


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; see the module's docstring."""
    index = index_documents(docs, a_path, b_path, id_col, text_col)
    held = index.where("pair IS NOT NULL").select("block", "pair", "plane", "bits")
    own = held.where("plane = 0").select(F.col("block").alias("of"), F.col("pair").alias("known"))
    counted = own.join(pair_counts(index).select(F.col("pair").alias("known"), "n_docs", "best"), "known")
    scores = held.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(block_scores, "block long, number int, n_best long, count_sum long")
    rows = index.where("pair IS NULL").drop("pair", "plane", "bits")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(scores, ["block", "number"], "left").select(id_col, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_documents(table(spark, sf_dir, "documents"), a, b)
