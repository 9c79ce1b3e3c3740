"""Token counts with a whole-token shortcut (operator 7).

The tokenizer splits a text into pre-tokens and merges each on its own, so a count is a sum over pre-tokens. Offline,
every vocabulary string that is a single pre-token is encoded once; those that come back as one token are proven to
count one wherever they stand. A document's pre-tokens are tallied, proven ones are counted directly and only the rest
is merged, each distinct string once per worker (a bounded memo).

Defined results: null and empty text have 0 bytes and 0 tokens. Special strings inside a text are one token each, as
the library counts them by default. Texts of any length are read whole, in slices cut between pre-tokens. Every input
row gives one output row, repeated rows and ties included; only the id and text columns are read, so extra columns
don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import merging_only, table

# Fixed value: the byte-level split pattern of the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Blanks that don't stand before a visible character.
UNSAFE = regex.compile(r" (?:\s|\Z)")
SLICE_CHARS = 1 << 20
MEMO_ENTRIES = 200_000
LIMIT = 1024

_workers: dict[str, "Counting"] = {}


class Counting:
    """One worker's tokenizer, its proven single tokens and its memo of blank-delimited chunks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PATTERN)
        self.special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.one = prove_single(self.tokenizer, self.split)
        self.merger = merging_only(path)
        self.memo: dict[str, int] = {}

    def count(self, text: str) -> int:
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def plain(self, text: str) -> int:
        """A blank before a visible character always begins a pre-token, so chunks cut there add up."""
        chunks = text.split(" ")
        if len(chunks) < 2 or UNSAFE.search(text):
            return self.whole(text)
        head = self.whole(chunks[0])
        try:
            return head + sum(map(self.memo.__getitem__, chunks[1:]))
        except KeyError:
            pass
        seen = Counter(chunks[1:])
        new = [c for c in seen if c not in self.memo]
        if len(self.memo) + len(new) > MEMO_ENTRIES:
            self.memo.clear()
            new = list(seen)
        total, at = head, 0
        while at < len(new):  # a text with more distinct chunks than the memo holds goes in turns
            own = new[at : at + MEMO_ENTRIES]
            at += MEMO_ENTRIES
            counted = dict(zip(own, self.tally([self.split.findall(" " + c) for c in own]), strict=True))
            if len(self.memo) + len(own) > MEMO_ENTRIES:
                total += sum(n * counted[c] for c, n in seen.items() if c in counted)
                for c in own:
                    del seen[c]
            else:
                self.memo.update(counted)
        return total + sum(n * self.memo[c] for c, n in seen.items())

    def whole(self, text: str) -> int:
        """Pre-tokens of a text that chunks don't cut safely, a bounded number at a time."""
        if len(text) <= SLICE_CHARS:
            return self.tally([self.split.findall(text)])[0] if text else 0
        total, own = 0, []
        for m in self.split.finditer(text):
            own.append(m.group())
            if len(own) >= MEMO_ENTRIES:
                total += self.tally([own])[0]
                own = []
        return total + self.tally([own])[0]

    def tally(self, groups: list[list[str]]) -> list[int]:
        """Tokens of each group of pre-tokens: proven ones count one, the rest is merged by the library."""
        one = self.one
        rest = list(dict.fromkeys(t for g in groups for t in g if t not in one))
        merged = dict(zip(rest, self.merge(rest), strict=True))
        return [sum(merged.get(t, 1) for t in g) for g in groups]

    def merge(self, rest: list[str]) -> list[int]:
        if not rest:
            return []
        e = self.merger.encode(rest, is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(e.word_ids, np.int64), minlength=len(rest)).tolist()


def prove_single(tokenizer, split) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and that the tokenizer itself encodes as exactly one token."""
    ids = range(tokenizer.get_vocab_size())
    strings = [s for s in tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False) if s and "�" not in s]
    whole = [s for s in strings if (m := split.match(s)) and m.end() == len(s)]
    encoded = tokenizer.encode_batch_fast(whole, add_special_tokens=False)
    return frozenset(s for s, e in zip(whole, encoded, strict=True) if len(e.ids) == 1)


def counting(path: str) -> Counting:
    if path not in _workers:
        _workers[path] = Counting(path)
    return _workers[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row's text; see the module's docstring for the defined cases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counting(tokenizer_path)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(counts.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
