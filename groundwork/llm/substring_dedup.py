"""Removal of repeated 100-byte strings with a run-length index (operator 4).

A window is a string of `LENGTH` bytes; all but its first occurrence, by document id and place, are marked, and every
byte under a marked window goes. The corpus is far too large for one index, so windows that can be equal are brought
together first: each window is anchored at the smallest hashed `GRAM`-byte string in it, hence equal windows have
equal anchors at the same offset. Neighbouring windows of one anchor are a stretch, which is handled as a whole:

1. Stretches are dealt by anchor and sorted; of equal stretches only the first place stays in play. One whose anchor
   no other stretch has holds first occurrences only.
2. Stretches that share an anchor are matched by content. A task joins the bytes of some anchors' stretches, in
   document order, into a text; builds its Burrows-Wheeler transform run by run; and keeps only samples at the run
   heads: the text position, the position before it in suffix order, and the length both have in common. All other
   positions follow from the sample before them (the neighbour moves on by one, the match shrinks by one), so matching
   statistics stream out of the samples; windows whose match is long enough are chained to their equals, and
   the earliest of each chain is the first occurrence.
3. An anchor with more than `HOT` stretches (a frequent phrase with ever other surroundings) would make one task large;
   its windows are dealt one by one, by a 128-bit digest of their bytes, with a map-side minimum.
4. Each document gets the places of its first windows; all its other windows are repeats. Only those places travel,
   never pairs, and copies of a hot passage are reduced to one row per batch before the first shuffle.

Defined results: null and empty texts have 0 bytes, and the digest of no bytes. Documents under `LENGTH` bytes are
kept whole. A null id counts as the smallest. Rows with the same id and text are one document, each row with its
result; rows with the same id and other texts are ordered by place alone. Extra columns are not read; an empty table
gives an empty result. Texts of any length are read whole, in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import pieces_of, staged, table
from groundwork.llm.embedding_dedup import grouped
from groundwork.llm.rolling import mixed, powers, prefix_sums

LENGTH = 100
GRAM = 32
HOT = 2000
PIECE = 1 << 20
INDEX_BYTES = 256 << 10
NULL_ID = -(1 << 63)
# A place in one long: start 31 bits, windows 7, anchor's offset 7, shared 1, hot 1, tag of the text 16.
START, WINDOWS, OFFSET, SHARED, HOTBIT, TAG = 32, 25, 18, 17, 16, (1 << 16) - 1


def tag_of(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) & TAG


def stretches(texts: list[bytes], ids: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, digest, id, place) of each stretch of each text; equal stretches of a piece once."""
    for buffer, doc, offset, ends in pieces(texts, length):
        data = np.frombuffer(buffer, np.uint8)
        if len(data) < length:
            continue
        sums, back = prefix_sums(data), powers(len(data))[1]
        n = len(data) - gram + 1
        grams = mixed((sums[gram : gram + n] - sums[:n]) * back[:n])
        keys = grams & ~np.uint64((1 << 24) - 1) | np.arange(n, dtype=np.uint64)  # ties go to the left
        width, span = 1, length - gram + 1
        least = keys
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: n - span + 1], least[span - width : n - width + 1])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        starts = np.arange(len(at))
        of = np.searchsorted(ends, starts, side="right")
        valid = starts + length <= ends[np.minimum(of, len(ends) - 1)]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | ~valid[:-1] | (of[1:] != of[:-1])
        new &= valid
        last = np.ones(len(at), bool)
        last[:-1] = new[1:] | ~valid[1:]
        last &= valid
        first = np.flatnonzero(new)
        count = np.flatnonzero(last) - first + 1
        anchor = grams[at[first]]
        digest = mixed((sums[first + count - 1 + length] - sums[first]) * back[first] + count.astype(np.uint64)) ^ (at[first] - first).astype(np.uint64)
        text = doc[of[first]]
        place = (first - offset[of[first]]) << START | count << WINDOWS | (at[first] - first) << OFFSET
        order = np.lexsort((place, ids[text], digest, anchor))
        same = np.zeros(len(order), bool)
        same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (digest[order][1:] == digest[order][:-1])
        keep = order[~same]
        yield anchor[keep].view(np.int64), digest[keep].view(np.int64), text[keep], place[keep]


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about PIECE bytes: the text of each part, the buffer place of that text's byte 0, the part's end."""
    parts: list[bytes] = []
    doc: list[int] = []
    offset: list[int] = []
    ends: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text if len(text) <= PIECE else text[at : at + PIECE + length - 1]
            if size and size + len(part) > PIECE + length:
                yield b"".join(parts), np.array(doc), np.array(offset), np.array(ends)
                parts, doc, offset, ends, size = [], [], [], [], 0
            parts.append(part)
            doc.append(i)
            offset.append(size - at)
            size += len(part)
            ends.append(size)
    if parts:
        yield b"".join(parts), np.array(doc), np.array(offset), np.array(ends)


def utf8(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _stretching(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in pieces_of(whole, "text", 4 * PIECE)):
            ids, texts = batch.column("id").to_numpy(), utf8(batch.column("text"))
            tags = np.array([tag_of(t) if len(t) >= length else 0 for t in texts], np.int64)
            for anchor, digest, text, place in stretches(texts, ids, length, gram):
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(digest), pa.array(ids[text]), pa.array(place | tags[text])], names=["anchor", "digest", "id", "place"])

    return run


def _first_places(hot: int):
    """The first place of each distinct stretch, with the flags of its anchor's group; rows come sorted."""

    def flagged(anchor: np.ndarray, ids: np.ndarray, place: np.ndarray, known_hot: int | None) -> pa.RecordBatch:
        _, group, sizes = np.unique(anchor, return_inverse=True, return_counts=True)
        size = sizes[group]
        is_hot = size > hot
        if known_hot is not None:
            is_hot |= anchor == known_hot
        place = place | ((size > 1) | is_hot).astype(np.int64) << SHARED | is_hot.astype(np.int64) << HOTBIT
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(place)], names=["id", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64),) * 3
        before: tuple[int, int] | None = None
        hot_anchor: int | None = None
        for batch in batches:
            anchor, digest, ids, place = (batch.column(c).to_numpy() for c in ("anchor", "digest", "id", "place"))
            if not len(anchor):
                continue
            first = np.ones(len(anchor), bool)
            first[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
            first[0] = before != (anchor[0], digest[0])
            before = (anchor[-1], digest[-1])
            rows = tuple(np.concatenate([h, x[first]]) for h, x in zip(held, (anchor, ids, place), strict=True))
            if not len(rows[0]):
                continue
            # the last group may go on: hold it back unless it is hot already
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if len(rows[0]) - cut > hot or rows[0][-1] == hot_anchor:
                out, held, next_hot = rows, (np.zeros(0, np.int64),) * 3, int(rows[0][-1])
            else:
                out, held, next_hot = tuple(x[:cut] for x in rows), tuple(x[cut:] for x in rows), hot_anchor
            if len(out[0]):
                yield flagged(*out, hot_anchor)
            hot_anchor = next_hot
        if len(held[0]):
            yield flagged(*held, hot_anchor)

    return run


def _shared_bytes(length: int, gram: int):
    """The bytes of a document's shared stretches, with their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in pieces_of(whole, "text", 4 * PIECE)):
            anchor, ids, place, raw = [], [], [], []
            for i, text, places in zip(batch.column("id").to_pylist(), utf8(batch.column("text")), batch.column("places"), strict=True):
                own = mine(places, text, length)
                for p in own[own >> SHARED & 1 == 1].tolist():
                    start, n, at = p >> START, p >> WINDOWS & 127, p >> OFFSET & 127
                    ids.append(i)
                    place.append(p)
                    raw.append(text[start : start + n - 1 + length])
                    anchor.append(xxhash.xxh3_64_intdigest(text[start + at : start + at + gram]) - (1 << 63))
            yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(ids, pa.int64()), pa.array(place, pa.int64()), pa.array(raw, pa.binary())], names=["anchor", "id", "place", "raw"])

    return run


def mine(places: pa.ListScalar, text: bytes, length: int) -> np.ndarray:
    """Those of an id's places that belong to this text."""
    if places.values is None or len(text) < length:
        return np.zeros(0, np.int64)
    own = places.values.to_numpy()
    return own[(own & TAG) == tag_of(text)]


class RunIndex:
    """Samples at the run heads of a text's Burrows-Wheeler transform."""

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        before = text[order - 1]
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        position = order[heads]
        neighbour = np.where(heads > 0, order[heads - 1], -1)
        by_place = np.argsort(position)
        self.position, self.neighbour = position[by_place], neighbour[by_place]
        self.common = common_length(text, self.position, self.neighbour)
        self.size = len(text)

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position the one before it in suffix order, and the length they have in common."""
        i = np.arange(self.size)
        k = np.searchsorted(self.position, i, side="right") - 1
        on = i - self.position[k]
        return self.neighbour[k] + on, self.common[k] - on


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array, by doubling; the text ends with a symbol that is found nowhere else."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    width = 1
    while True:
        key = rank.astype(np.int64) * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or width >= n:
            return order
        width *= 2


def common_length(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    active = np.flatnonzero(b >= 0)
    step = 0
    while len(active):
        i, j = a[active] + step, b[active] + step
        inside = np.maximum(i, j) < len(text)
        active, i, j = active[inside], i[inside], j[inside]
        active = active[text[i] == text[j]]
        out[active] += 1
        step += 1
    return out


def first_windows(raws: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string, which of its windows occur in none of those before it and not earlier in itself."""
    sizes = np.array([len(r) + 1 for r in raws])
    ends = np.cumsum(sizes)
    text = np.zeros(ends[-1], np.int32)
    text[np.arange(len(text))] = np.frombuffer(b"\0".join(raws) + b"\0", np.uint8)
    text[ends - 1] = 256 + np.arange(len(raws))  # no match goes beyond a string
    neighbour, common = RunIndex(text).statistics()
    link = np.where(common >= length, neighbour, np.arange(len(text)))
    while not np.array_equal(further := link[link], link):
        link = further
    earliest = np.empty(len(text), np.int64)
    earliest[link[::-1]] = np.arange(len(text))[::-1]
    first = earliest[link] == np.arange(len(text))
    return [first[e - n : e - length] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def runs_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], first, [False]])))
    return edge[::2], edge[1::2] - edge[::2]


def _indexing(length: int):
    """Runs of first windows of shared stretches, as places; groups of anchors come one after the other."""

    def matched(tables: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(tables)
        ids, place = rows.column("id").to_numpy(), rows.column("place").to_numpy()
        out_ids, out = [], []
        for i, p, first in zip(ids.tolist(), place.tolist(), first_windows(rows.column("raw").to_pylist(), length), strict=True):
            for at, n in zip(*runs_of(first), strict=True):
                out_ids.append(i)
                out.append(((p >> START) + int(at)) << START | int(n) << WINDOWS | p & TAG)
        return pa.RecordBatch.from_arrays([pa.array(out_ids, pa.int64()), pa.array(out, pa.int64())], names=["id", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in grouped(batches, ["anchor"]):
            held.append(group)
            size += sum(map(len, group.column("raw").to_pylist()))
            if size >= INDEX_BYTES:
                yield matched(held)
                held, size = [], 0
        if held:
            yield matched(held)

    return run


def _windows(length: int):
    """Every window of hot stretches by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, ids, place = [], [], [], []
            for i, p, raw in zip(batch.column("id").to_pylist(), batch.column("place").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                for at in range(len(raw) - length + 1):
                    h, m = divmod(xxhash.xxh3_128_intdigest(raw[at : at + length]), 1 << 64)
                    high.append(h - (1 << 63))
                    low.append(m - (1 << 63))
                    ids.append(i)
                    place.append(((p >> START) + at) << START | 1 << WINDOWS | p & TAG)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (high, low, ids, place)], names=["high", "low", "id", "place"])

    return run


def _removing(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in pieces_of(whole, "text", 4 * PIECE)):
            n_bytes, n_removed, n_spans, digests = [], [], [], []
            for text, places, more in zip(utf8(batch.column("text")), batch.column("places"), batch.column("more"), strict=True):
                n = len(text)
                n_bytes.append(n)
                gone = np.zeros(0, bool)
                if n >= length:
                    own, found = mine(places, text, length), mine(more, text, length)
                    own = np.concatenate([own[own >> SHARED & 1 == 0], found])
                    edge = np.zeros(n - length + 2, np.int32)
                    np.add.at(edge, own >> START, 1)
                    np.add.at(edge, (own >> START) + (own >> WINDOWS & 127), -1)
                    repeat = np.cumsum(edge[:-1]) == 0
                    over = np.zeros(n + 1, np.int32)
                    over[: len(repeat)] += repeat
                    over[length : length + len(repeat)] -= repeat
                    gone = np.cumsum(over[:-1]) > 0
                removed = int(np.count_nonzero(gone))
                n_removed.append(removed)
                n_spans.append(len(runs_of(gone)[0]) if removed else 0)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if removed else text
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row; see the module's docstring for the defined cases."""
    if not 8 <= gram < length <= 127:
        raise ValueError("8 <= gram < length <= 127")
    kind = docs.schema[id_col].dataType.simpleString()
    mine = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("text"))
    rows = mine.mapInArrow(_stretching(length, gram), "anchor long, digest long, id long, place long")
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", "digest", "id", "place")
    firsts = staged(dealt.mapInArrow(_first_places(hot), "id long, place long"), "first-places")
    with_places = mine.join(firsts.groupBy("id").agg(F.collect_list("place").alias("places")), "id", "left")
    # the join is written the same way each time, so that its two shuffles are made once and reused
    with_places = with_places.select("id", "text", "places")
    shared = with_places.mapInArrow(_shared_bytes(length, gram), "anchor long, id long, place long, raw binary")
    is_hot = F.col("place").bitwiseAND(1 << HOTBIT) != 0
    indexed = shared.where(~is_hot).repartition("anchor").sortWithinPartitions("anchor", "id", "place").mapInArrow(_indexing(length), "id long, place long")
    windows = shared.where(is_hot).select("id", "place", "raw").mapInArrow(_windows(length), "high long, low long, id long, place long")
    one_by_one = windows.groupBy("high", "low").agg(F.min(F.struct("id", "place")).alias("f")).select("f.id", "f.place")
    more = indexed.union(one_by_one).groupBy("id").agg(F.collect_list("place").alias("more"))
    out = with_places.join(more, "id", "left").select("id", "text", "places", "more").mapInArrow(_removing(length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).cast(kind).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))
