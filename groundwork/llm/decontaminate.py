"""Benchmark decontamination by template canonicalisation (operator 9).

Words are lower-cased and stripped of punctuation; numbers, names and units after a number become typed placeholders.
Each text has three forms: names are the words capitalised inside a sentence, all capitalised words (a name that begins
a sentence is one), or none (copies in other case). Windows of `WINDOW` template words of the benchmark items are
hash-joined with the same windows of the same form of the documents; a window with fewer than `MIN_WORDS` words that are
not placeholders is doubled until it has them, or is the item. A hit fixes an alignment of item and document: its words are compared as written,
placeholders must carry equal types, and within a run of places each item value must stand for one document value, so
that a question with other numbers or names is caught; a slot out of line ends a run, and the places before and after it
are judged as runs of their own. A document is contaminated by an item if consistent runs cover `COVERAGE` of its words,
or one has `RUN` of them.

The item index goes to the tasks in blocks of at most `most_index_bytes`; documents are read once for each block
(one, unless the benchmark is very large), so no size of the benchmark is a limit.

Defined results: null and empty texts are not contaminated. Items with null or no text, or with fewer than
`MIN_WORDS` words that are not placeholders in a form, never match in it. Equal items are all listed. Every row gives one row,
repeated rows included; extra columns are not read; empty tables give an empty or a clean result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import pieces_of, table

WINDOW = 8
MIN_WORDS = 5
RUN = 13
COVERAGE = 0.6
INDEX_BYTES = 32 << 20
BATCH_BYTES = 1 << 20
MEMO_ENTRIES = 200_000
# Units of measure that count as units after a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms oz lb lbs pound pounds ton tons ml l liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent % degrees meter meters metre metres "
    "kilometer kilometers kilometre kilometres mph kmh kw kwh watt watts volt volts".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?\Z")
EDGES = "!\"#&'()*,./:;<=>?@[\\]^_`{|}~«»‘’“”„…–—¿¡"  # punctuation around a word; + - % and currency can be part of a number
NUM, NAME, UNIT = 1, 2, 3  # codes of placeholders
CAPITAL, ENDS, IS_NUM, IS_UNIT = 1, 2, 4, 8  # flags in a packed word's low bits
ODD = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Packed words: a hash with its low four bits replaced by flags, memoized per worker."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def pack(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        try:
            return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        except KeyError:
            pass
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = packed(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def packed(word: str) -> int:
    core = word if word[0].isalnum() and word[-1].isalnum() else word.strip(EDGES) or word
    lower = core.lower()
    flags = CAPITAL if core != lower and core[0].isupper() and not core.isupper() else 0
    if not word[-1].isalnum() and word.rstrip("\"')]")[-1:] in (".", "!", "?", ":"):
        flags |= ENDS
    if (core[0].isdigit() or core[0] in "+-$€£") and NUMBER.match(core):
        flags |= IS_NUM
    if lower in UNITS:
        flags |= IS_UNIT
    return xxhash.xxh3_64_intdigest(lower) & ~15 | flags


def template(words: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Template codes of each form (a placeholder's small number or the word's hash) and word values. first: where a text begins."""
    flags, value = words & np.uint64(15), words & ~np.uint64(15)
    before = np.concatenate([[np.uint64(0)], flags[:-1]]) if len(words) else flags
    starts = first | (before & np.uint64(ENDS) > 0)
    number = flags & np.uint64(IS_NUM) > 0
    after_number = np.concatenate([[False], number[:-1]]) & ~first if len(words) else first
    name = (flags & np.uint64(CAPITAL) > 0) & ~number
    unit = (flags & np.uint64(IS_UNIT) > 0) & after_number
    blind = np.where(number, np.uint64(NUM), np.where(unit, np.uint64(UNIT), value))
    named = name & ~unit
    return [np.where(named & ~starts, np.uint64(NAME), blind), np.where(named, np.uint64(NAME), blind), blind], value


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of `size` codes, from those of its halves."""
    if len(codes) < size:
        return np.zeros(0, np.uint64)
    if size == 1:
        return (codes ^ (codes >> np.uint64(29))) * ODD
    half = size // 2
    left = window_hashes(codes, half)
    right = left if 2 * half == size else window_hashes(codes, size - half)
    n = len(codes) - size + 1
    out = left[:n] * ODD + right[half : half + n]
    return out ^ (out >> np.uint64(31))


class Index:
    """Template windows of a block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int | None, str]]):
        words = Words()
        self.ids, self.codes, self.values = [], [], []
        found: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
        for item_id, text in items:
            own = words.pack((text or "").split())
            codes, values = template(own, np.arange(len(own)) == 0)
            used = [form for form in range(len(codes)) if np.count_nonzero(codes[form] > 15) >= MIN_WORDS]
            for form in used:
                self.add(found, form, codes[form])
            if used:
                self.ids.append(item_id)
                self.codes.append(codes)
                self.values.append(values)
        self.sizes = {}
        for which, rows in found.items():
            rows = sorted(rows)
            hashes = np.array([r[0] for r in rows], np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.sizes[which] = (hashes, np.array([r[1:] for r in rows], np.int64), seen)

    def add(self, found: dict[tuple[int, int], set[tuple[int, int, int]]], form: int, codes: np.ndarray) -> None:
        """Windows of the next item in a form, each doubled while it is sparse (the last ones end with the item)."""
        size, n = min(WINDOW, len(codes)), len(codes)
        todo = np.arange(n - size + 1)
        while len(todo):
            hashes = window_hashes(codes, size)
            literal = np.convolve(codes > 15, np.ones(size, int), "valid")[todo]
            for at in todo[literal >= MIN_WORDS].tolist():
                found.setdefault((form, size), set()).add((int(hashes[at]), len(self.ids), at))
            size = min(2 * size, n)
            todo = np.unique(np.minimum(todo[literal < MIN_WORDS], n - size))

    def hits(self, codes: list[np.ndarray], last: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(position, item, item's position, size, form) of windows that begin in the codes; last: words left in the text."""
        for (form, size), (hashes, where, seen) in self.sizes.items():
            own = window_hashes(codes[form], size)
            at = np.flatnonzero(seen[(own >> np.uint64(44)).astype(np.int64)])
            at = at[last[at] >= size]
            low, high = np.searchsorted(hashes, own[at]), np.searchsorted(hashes, own[at], side="right")
            for p, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                for item, start in where[a:b].tolist():
                    yield p, item, start, size, form

    def matched(self, codes: list[np.ndarray], values: np.ndarray, hits: list[tuple[int, int, int, int, int]]) -> dict[int, float]:
        """Items that contaminate a text, with their coverage."""
        lines: dict[int, dict[tuple[int, int], set[int]]] = {}
        for p, item, start, size, form in hits:
            lines.setdefault(item, {}).setdefault((form, p - start), set()).update(range(start, start + size))
        out = {}
        for item, by_shift in lines.items():
            n = len(self.values[item])
            covered: set[int] = set()
            longest = 0
            for (form, shift), places in by_shift.items():
                at = np.array(sorted(places))
                for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                    for a, b in consistent(self.codes[item][form][run], self.values[item][run], codes[form][run + shift], values[run + shift]):
                        longest = max(longest, b - a)
                        if b - a >= min(WINDOW, n):
                            covered.update(run[a:b].tolist())
            share = len(covered) / n
            if share >= COVERAGE or longest >= RUN:
                out[item] = share
        return out


def consistent(item_codes: np.ndarray, item_values: np.ndarray, doc_codes: np.ndarray, doc_values: np.ndarray) -> Iterator[tuple[int, int]]:
    """The longest stretches [from, to) of equal templates in which each slot value of the item has one value in the document."""
    begin = 0
    there: dict[tuple[int, int], tuple[int, int]] = {}  # value in the document, last place with another one
    last: dict[tuple[int, int], int] = {}
    for at, (kind, other, a, b) in enumerate(zip(item_codes.tolist(), doc_codes.tolist(), item_values.tolist(), doc_values.tolist(), strict=True)):
        start = begin
        if kind != other:
            start = at + 1
        elif kind <= 15:
            value, before = there.get((kind, a), (b, -1))
            if value != b:
                before = last[kind, a]
            there[kind, a], last[kind, a] = (b, before), at
            start = max(begin, before + 1)
        if start > begin:
            if at > begin:
                yield begin, at
            begin = start
    if len(item_codes) > begin:
        yield begin, len(item_codes)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    block, size = [], 0
    for r in benchmark.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        n = 16 * len(r[1])
        if block and size + n > most_bytes:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most_index_bytes: int = INDEX_BYTES) -> DataFrame:
    """All columns of `docs` and contaminated, item_ids, coverage; see the module's docstring for the defined cases."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    out = docs.toDF(*names).select("*", F.lit(False).alias("found"), F.array().cast("array<bigint>").alias("ids"), F.lit(0.0).alias("share"))
    schema = out.schema
    for block in item_blocks(benchmark, item_col, item_text_col, most_index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)  # at most most_index_bytes
        out = out.mapInArrow(_finding(sent, names, at), schema)
    return out.toDF(*docs.columns, "contaminated", "item_ids", "coverage")


def _finding(sent, names: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = Index(sent.value), Words()
        for whole in batches:
            for batch in pieces_of(whole, names[at], BATCH_BYTES):
                found = leaks(index, memo, [t or "" for t in batch.column(at).to_pylist()])
                k = len(names)
                flags, ids, share = (batch.column(k + i).to_pylist() for i in range(3))
                for i, items in found.items():
                    flags[i] = True
                    ids[i] = sorted({*ids[i], *(x for j in items if (x := index.ids[j]) is not None)})
                    share[i] = max(share[i], *items.values())
                yield pa.RecordBatch.from_arrays([*batch.columns[:k], pa.array(flags, pa.bool_()), pa.array(ids, pa.list_(pa.int64())), pa.array(share, pa.float64())], names=[*names, "found", "ids", "share"])

    return run


def leaks(index: Index, memo: Words, texts: list[str]) -> dict[int, dict[int, float]]:
    """For each contaminated text, its items and their coverage."""
    rows = [memo.pack(t.split()) for t in texts]
    sizes = np.array([len(r) for r in rows], np.int64)
    ends = np.cumsum(sizes)
    words = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(len(words)) - np.repeat(ends - sizes, sizes)
    codes, values = template(words, place == 0)
    hits: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for hit in index.hits(codes, np.repeat(ends, sizes) - np.arange(len(words))):
        hits.setdefault(int(owner[hit[0]]), []).append(hit)
    out = {}
    for i, own in hits.items():
        if items := index.matched(codes, values, own):
            out[i] = items
    return out


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.size("item_ids").alias("n_items"), "item_ids", "coverage")
