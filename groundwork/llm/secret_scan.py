"""Secret scans by dictionary-primed novelty (operator 11).

Three base patterns find secrets by their form; a fourth kind, `novel`, finds those without one. Its candidates are
strings of 12 or more of the characters that keys are written in, which stand within 48 characters after a sensitive
word, on the same line. A candidate's novelty is its marginal compressed size: zstandard, primed with a dictionary of the
identifiers most frequent in the whole corpus, compresses the text around the candidate with and without it (in its place or at the end, whichever costs less).
Words, paths, identifiers and numbers that the dictionary or the surroundings hold cost few bytes; a random string costs
nearly all of its own. Candidates at `MIN_BYTES` marginal bytes or more and `MIN_SHARE` of their length are reported.

The dictionary: words of 4 to 24 letters and underscores are counted over all documents (each once a document), in a
map-side combined aggregate; the `DICTIONARY_WORDS` most frequent (ties: smaller word) are the dictionary, at most
`DICTIONARY_WORDS` x 25 bytes, the only thing that is collected and broadcast. Strings with digits never enter it, so
that a key copied into many documents stays novel. A candidate's own copies are taken out of its surroundings for the
same reason.

Spans are in code points of the text, end exclusive, and are those of whole matches: a base match of `assign` includes
its word. A novel span that overlaps a base span is left out, as the base one stays.

Defined results: null and empty texts have no spans, 0 counts and the digest of the empty string. Texts are scanned
whole, whatever their length. Every row gives one row, repeated rows and ids included; null ids are kept. Only the id
and text columns are read, so extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import table

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_CHARS = 12
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")  # a run is taken whole, so a least length in the pattern drops what is shorter
HEX = re.compile("[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")

# Words that make what follows them sensitive, and the form of a candidate.
SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "credential", "private_key", "access_key", "auth", "bearer", "signature")
SENSITIVE_AT = re.compile("|".join(sorted(SENSITIVE, key=len, reverse=True)), re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
REACH = 48  # characters between a sensitive word and a candidate
AROUND = 512  # characters of the text on each side that the compressor sees
MIN_BYTES = 9
MIN_SHARE = 0.7
DICTIONARY_WORDS = 4096
WORD = r"\b[A-Za-z_]{4,24}\b"
LEVEL = 9


def identifiers(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The words held by most documents of the whole corpus, most frequent first."""
    each = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)))).alias("word"))
    ranked = each.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [r["word"] for r in ranked.collect()]


class Novelty:
    """Marginal compressed bytes of a string in a text, with the dictionary as the compressor's past."""

    def __init__(self, words: list[str]):
        import zstandard

        raw = " ".join(reversed(words)).encode()  # the most frequent stand nearest to the text
        primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.packer.compress(text.encode()))

    def of(self, text: str, start: int, end: int) -> int:
        own = text[start:end]
        before, after = text[max(0, start - AROUND) : start].replace(own, ""), text[end : end + AROUND].replace(own, "")
        return min(self.size(before + own + after), self.size(before + after + own)) - self.size(before + after)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and without overlaps within a kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return spans + [(*m.span(), "hex") for m in HEX.finditer(text)]


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Strings that may be keys, after a sensitive word on their line, each once and in order."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return
    done = 0
    for word in SENSITIVE_AT.finditer(text):
        line = text.find("\n", word.end(), word.end() + REACH)
        stop = word.end() + REACH if line < 0 else line
        at = max(done, word.end())
        while at < stop and (m := CANDIDATE.search(text, at)) and m.start() < stop:
            done = at = m.end()
            yield m.span()


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty: Novelty) -> list[tuple[int, int, str]]:
    taken = sorted(base)
    out = []
    for start, end in candidates(text):
        if any(a < end and start < b for a, b, _ in taken):
            continue
        if (size := novelty.of(text, start, end)) >= MIN_BYTES and size >= MIN_SHARE * (end - start):
            out.append((start, end, "novel"))
    return out


def spelled(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, n_novel, base_sha256 and spans; see the module's docstring."""
    words = docs.sparkSession.sparkContext.broadcast(identifiers(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words.value)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                every = base + novel_spans(text, base, novelty)
                kinds = [k for _, _, k in every]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(every)))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *out])

    out = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans"]
    types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
    own = docs.select(F.col(id_col), F.col(text_col))
    kind = own.schema[0].dataType.simpleString()
    return own.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} {'long' if t == pa.int64() else 'string'}" for c, t in zip(out, types, strict=True)))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
