"""Language identification by cross-parsing entropy (operator 6).

For each labelled language a suffix automaton of sample text is built. A document is cross-parsed against it: from
each phrase start the automaton is followed as far as it goes, which is the longest match with the sample, and the
next phrase begins there. Phrases times log2 of the sample's length per character estimate the cross entropy, so
languages with samples of different sizes compare; the lowest wins.

Learning uses a bounded sample: `docs_per_lang` documents of each language, chosen by a hash of their id among those
that are not held out, with at most `chars_per_doc` characters each. The sample (a few hundred kB) goes to the tasks;
each worker builds the automata once. Prediction reads every text whole, many stretches of `STRETCH` symbols abreast.

Defined results: null text and text without a letter give `und` and score 0, as does any text when nothing could be
learned. Ties go to the language first in the alphabet. A row with a null id is not held out and not learned from.
The score is the runner-up's entropy over the sum of both (1 with one language). Every row gives one row; repeated
rows, extra columns and empty tables need nothing special. `und` as a label is not learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundwork.llm.common import pieces_of, table

DOCS_PER_LANG = 200
CHARS_PER_DOC = 300
STRETCH = 256
BATCH_BYTES = 512 << 10
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

_workers: dict[tuple, "Languages"] = {}


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring; state 0 is its start."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        state = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = state
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return nexts


class Languages:
    """Dense automata of all learned languages, each over its own alphabet; 0 stands for a missing transition."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in samples]
        letters = sorted({c for _, text in samples for c in text.lower() if LETTER.match(c) and ord(c) < 0x10000})
        # symbol 0: a letter that no sample has; 1: whatever separates words
        self.symbol = np.ones(0x110000, np.uint16)
        is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.symbol[is_letter] = 0
        for i, c in enumerate(letters):
            self.symbol[ord(c)] = i + 2
        self.tables, self.own, self.widths, self.bits = [], [], [], []
        for _, text in samples:
            symbols, _ = self.encode([text])
            mine = np.union1d(symbols[symbols > 1], [])
            own = np.zeros(len(letters) + 2, np.int64)  # the language's number of each symbol
            own[1], own[mine.astype(np.int64)] = 1, np.arange(len(mine)) + 2
            width = len(mine) + 2
            nexts = suffix_automaton(own[symbols].tolist())
            dense = np.zeros((len(nexts), width), np.int32)
            for i, moves in enumerate(nexts):
                for c, j in moves.items():
                    if c:
                        dense[i, c] = j
            self.tables.append(dense.ravel())
            self.own.append(own)
            self.widths.append(width)
            self.bits.append(np.log2(max(2, len(symbols))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts on end, runs of separators as one, and the length of each."""
        lower = [t.lower() for t in texts]
        symbols = self.symbol[np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.fromiter(map(len, lower), np.int64, len(lower))
        first = np.zeros(len(symbols) + 1, bool)
        first[np.cumsum(sizes) - sizes] = True
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1) | first[1:-1]
        owner = np.repeat(np.arange(len(lower)), sizes)
        return symbols[keep], np.bincount(owner[keep], minlength=len(lower))

    def phrases(self, texts: list[str], stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text (rows) in each language (columns), and the texts' lengths in symbols.

        Stretches of a text are parsed abreast, each as if a phrase began with it. Then those whose predecessor ends
        inside a phrase are parsed again from its state, as far as the result differs, until every stretch began with
        the state that its predecessor ended in; the result does not depend on the cuts.
        """
        symbols, sizes = self.encode(texts)
        starts = np.cumsum(sizes) - sizes
        counts = -(-sizes // stretch)
        owner = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = starts[owner] + nth * stretch
        end = begin + np.minimum(stretch, sizes[owner] - nth * stretch)
        order = np.argsort(begin - end, kind="stable")
        active = np.searchsorted((begin - end)[order], -np.arange(stretch), side="left")  # stretches longer than t
        text_of = np.repeat(np.arange(len(texts)), sizes)
        later = np.flatnonzero(nth > 0)
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        for k, dense in enumerate(self.tables):
            codes, width = self.own[k][symbols], self.widths[k]
            states, opens = np.zeros(len(symbols), np.int32), np.zeros(len(symbols), bool)

            def step(at, state):
                c = codes[at]
                moved = dense[state * width + c]
                ended = moved == 0
                state = np.where(ended, dense[c], moved).astype(np.int64)
                return state, ended

            # a phrase begins wherever the last one can't go on, and after a letter that the sample lacks
            state = np.zeros(len(begin), np.int64)
            for t in range(stretch):
                n = active[t]
                if not n:
                    break
                at = begin[order[:n]] + t
                opens[at] = state[:n] == 0
                state[:n], ended = step(at, state[:n])
                opens[at] |= ended
                states[at] = state[:n]
            assumed = np.zeros(len(begin), np.int64)
            while len(later):
                now = states[begin[later] - 1].astype(np.int64)
                todo = now != assumed[later]
                if not todo.any():
                    break
                assumed[later] = now
                at, stop, state = begin[later[todo]], end[later[todo]], now[todo]
                while len(at):
                    fresh = state == 0
                    state, ended = step(at, state)
                    opens[at] = fresh | ended
                    more = (states[at] != state) & (at + 1 < stop)
                    states[at] = state
                    at, stop, state = at[more] + 1, stop[more], state[more]
            out[:, k] = np.bincount(text_of[opens], minlength=len(texts))
        return out, sizes

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Estimated cross entropy per symbol: a row per text, a column per language."""
        counts, sizes = self.phrases(texts)
        return counts * np.array(self.bits) / np.maximum(sizes, 1)[:, None]


def languages(samples: tuple[tuple[str, str], ...]) -> Languages:
    if samples not in _workers:
        _workers.clear()
        _workers[samples] = Languages(samples)
    return _workers[samples]


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int, chars_per_doc: int) -> tuple[tuple[str, str], ...]:
    """The bounded training sample: (language, text) in alphabetical order."""
    mine = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    mine = mine.where(F.col("id").isNotNull() & ~held_out("id") & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}"))
    free = F.greatest(F.length("text") - chars_per_doc + 1, F.lit(1))
    stretch = F.substr("text", (F.pmod(F.xxhash64("text"), free) + 1).cast("int"), F.lit(chars_per_doc))
    mine = mine.select("lang", stretch.alias("text"), F.xxhash64("id").alias("h"), "id")
    by_hash = Window.partitionBy("lang").orderBy("h", "id", "text")
    rows = mine.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= docs_per_lang).select("lang", "n", "text").collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return tuple((lang, " ".join(own)) for lang, own in sorted(texts.items()))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG, chars_per_doc: int = CHARS_PER_DOC, samples: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """All columns of `docs` and lang_pred, score; see the module's docstring for the defined cases."""
    samples = learn(docs, id_col, text_col, lang_col, docs_per_lang, chars_per_doc) if samples is None else samples
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    plain = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = languages(samples) if samples else None
        for whole in batches:
            for batch in pieces_of(whole, names[at], BATCH_BYTES):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                preds, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                rows = [i for i, t in enumerate(texts) if LETTER.search(t)]
                if known is not None and rows:
                    h = known.entropies([texts[i] for i in rows])
                    best = h.argmin(1)
                    for i, k, own in zip(rows, best.tolist(), h, strict=True):
                        preds[i] = known.names[k]
                        scores[i] = 1.0 if len(own) == 1 else float((s := np.partition(own, 1)[1]) / (s + own[k]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=[*names, "p_lang", "p_score"])

    schema = plain.select("*", F.lit("").alias("p_lang"), F.lit(0.0).alias("p_score")).schema
    return plain.mapInArrow(run, schema).toDF(*docs.columns, "lang_pred", "score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = learn(docs, "doc_id", "text", "lang", DOCS_PER_LANG, CHARS_PER_DOC)
    found = identify(docs.select("doc_id", "text"), samples=samples)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
