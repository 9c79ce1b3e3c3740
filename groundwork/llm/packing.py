"""Best-fit packing by minimum bin slack (operator 1).

Documents are tokenized, cut into pieces of at most `capacity` tokens and packed into sequences. Packing only needs
the histogram of piece lengths, at most `capacity` rows whatever the corpus, so the driver plans on that alone: seeded
with the longest piece left, a bitset subset-sum over the available lengths finds the fullest feasible combination for
one sequence. The same combination stays the fullest until one of its lengths runs out (the choice only shrinks), so
it is removed as often as the counts allow at once. The plan has at most one combination per exhausted length.

Tasks number the pieces of each length while they write them; offsets of (task, length) come from a window over those
counts; a piece's number in its length then names its combination, sequence and offset.

Defined results: null and empty texts are documents of one id, the separator 0. Repeated rows and equal texts are
packed each on its own; documents with the same id are told apart by nothing but their rows. An empty table gives an
empty result. Only the id and text columns are read. Sequence numbers are dense longs, without further meaning.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundwork.llm.common import merging_only, pieces_of, staged, table

CAPACITY = 2048
SEPARATOR_ID = 0
MEMO_ENTRIES = 300_000  # chunks of each of the memo's two generations, beyond one slice of texts
SLICE_BYTES = 2 << 20
# Fixed value: the split pattern of the vocabulary file, applied to its lower-cased text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_workers: dict[str, "WordIds"] = {}


class WordIds:
    """Token ids of a text from memoized ids of its words; every word's ids come from the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = regex.compile(WORDS)
        self.merger = merging_only(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, as the library gives them.

        Texts whose normalising is lower-casing alone go chunk by chunk (no word of the pattern holds white space) through
        the memo; all new chunks of the texts are encoded together. The memo's older half is dropped when the younger is
        full, and chunks in use come back from it.
        """
        plain = [simple(t) and not any(s in t for s in self.special) for t in texts]
        chunks = [t.lower().split() if ok else [] for t, ok in zip(texts, plain, strict=True)]
        self.learn(set().union(*chunks).difference(self.young))
        own = self.young
        out = [
            b"".join(map(own.__getitem__, c)) if ok else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t, c, ok in zip(texts, chunks, plain, strict=True)
        ]
        if len(own) > MEMO_ENTRIES:
            self.old, self.young = own, {}
        return out

    def learn(self, chunks: set[str]) -> None:
        """Put the ids of these chunks into the younger half: from the older one, or from their words.

        A word is itself a chunk of one word, so words and chunks share the memo; the library merges each new word once.
        """
        young, old = self.young, self.old
        back = chunks & old.keys()
        young.update((c, old[c]) for c in back)
        split = {c: self.words.findall(c) for c in chunks - back}
        new = []
        for w in {w for words in split.values() for w in words}:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        if new:
            e = self.merger.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, "<u4").tobytes()
            ends = (np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(new))) * 4).tolist()
            young.update((w, ids[a:b]) for w, a, b in zip(new, [0, *ends[:-1]], ends, strict=True))
        for c, words in split.items():
            if len(words) != 1 or words[0] != c:
                young[c] = b"".join([young[w] for w in words])


# Beyond Latin-1 and these, normalising may do more than lower-case letter by letter.
_OTHER = re.compile("[^\\x00-\\xff\u0100-\u012f\u0131-\u024f\u2010-\u2027]")
# Characters that Python takes for white space and the pattern does not.
_CONTROLS = "\x1c\x1d\x1e\x1f"


def simple(text: str) -> bool:
    """Whether normalising the text is lower-casing alone, and its white space is Python's."""
    if any(c in text for c in _CONTROLS):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _OTHER.search(text) is None
    return True


def word_ids(path: str) -> WordIds:
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path]


def cut_pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """One row per piece, numbered within its task and length (`part`, `nth`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = word_ids(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([SEPARATOR_ID], "<u4").tobytes()
        for batch in (own for whole in batches for own in pieces_of(whole, whole.schema.names[1], SLICE_BYTES)):
            row, piece, start, length, crc, nth = [], [], [], [], [], []
            for i, ids in enumerate(words.ids([value.as_py() or "" for value in batch.column(1)])):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    nth.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, nth)), pa.array([part] * len(row), pa.int32())],
                names=[id_col, "piece", "start", "length", "ids_crc32", "nth", "part"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, nth long, part int")


def fullest(counts: list[int], room: int) -> list[tuple[int, int]]:
    """The (length, times) whose sum comes closest to `room` from below; longer lengths are tried first."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in range(min(room, len(counts) - 1), 0, -1):
        left = min(counts[length], room // length)
        times = 1
        while left > 0:  # powers of two, then the rest: any number up to `left` can be made
            k = min(times, left)
            grown = reach | (reach << (k * length)) & mask
            if grown != reach:
                steps.append((length, k, reach))
                reach = grown
            left -= k
            times *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            out.append((length, k))
            total -= k * length
    merged: dict[int, int] = {}
    for length, k in out:
        merged[length] = merged.get(length, 0) + k
    return sorted(merged.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Combinations [(length, times)] and how many sequences each fills, for pieces shorter than `capacity`."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    plan = []
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            uses = dict(fullest(counts, capacity - longest))
            counts[longest] += 1
            uses[longest] = uses.get(longest, 0) + 1
            bins = min(counts[length] // k for length, k in uses.items())
            for length, k in uses.items():
                counts[length] -= k * bins
            plan.append((sorted(uses.items(), reverse=True), bins))
    return plan


def plan_arrays(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first number, times per sequence, first sequence, offset of its first copy)."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for uses, bins in plan:
        offset = 0
        for length, k in uses:
            rows.setdefault(length, []).append((taken.get(length, 0), k, sequence, offset))
            taken[length] = taken.get(length, 0) + k * bins
            offset += k * length
        sequence += bins
    return {length: np.array(x, np.int64) for length, x in rows.items()}


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and offset; see the module's docstring for the defined cases."""
    cut = staged(cut_pieces(docs, tokenizer_path, id_col, text_col, capacity), "pieces")
    counts = cut.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-offsets")
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = plan_arrays(plan_bins(histogram, capacity))
    sent = docs.sparkSession.sparkContext.broadcast(places)  # at most `capacity` combinations of at most 2 * sqrt(capacity) lengths

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("nth").to_numpy() + batch.column("base").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                n = int(length[own[0]])
                rows = sent.value[n]
                first, times, bins, at = rows[np.searchsorted(rows[:, 0], number[own], side="right") - 1].T
                sequence[own] = bins + (number[own] - first) // times
                offset[own] = at + (number[own] - first) % times * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (id_col, "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    placed = cut.join(offsets.select("part", "length", "base"), ["part", "length"])
    return placed.mapInArrow(place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
