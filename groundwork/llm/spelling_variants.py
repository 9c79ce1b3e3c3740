"""Spelling variants by k-d trees over letter counts (operator 13).

Words are counted over the whole corpus first, in DataFrame functions with a map-side combined aggregate. Two words are
near if they differ by exactly one inserted, deleted or replaced code point. One edit changes the letter counts by at
most one letter more and one letter less (an L1 distance of at most two), so near words are found by range searches in
trees over count vectors, for each pair of lengths (L, L) and (L, L + 1):

  upper tree   per length, splits (letter, count) chosen on a sample of at most `SAMPLE` words with the smallest hashes;
               its boxes hold about `BOX_WORDS` words each. Every word goes to its own box, and as a query to the boxes
               of both lengths that its counts can reach with one letter more and one less
  lower tree   a task builds the k-d tree of each box, with the tight bounds of every node, and walks it with all the
               queries of the box at once; a node drops the queries that its bounds put out of reach
  leaves       pairs in range are verified by the order of their letters: one place differs, or the shorter word is the
               longer one without one place

Letters beyond a-z share `FOLDED` counters, which can only bring words closer, so no near pair is lost. A task reports
per word and box the number of near words and the best of them, no pairs; these are reduced per word. Forms have at
least five times the count of their word, so chains are short, and roots come from pointer doubling: the rounds follow
from the largest count.

Defined results: null texts hold no words; a null id is written as ''. Repeated rows count each. Words are single rows
whatever their ties: among near words of equal counts the smallest in code-point order is the form. A corpus without
words gives an empty result. Only the id and text columns are read, so extra columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import staged, table

# Fixed values of the contract: runs of letters, the slip rule's divisor, least length, least count and a form's factor.
RUNS = r"[A-Za-zÀ-ÿ]+"
SLIP = 199
MIN_LETTERS = 6
MIN_COUNT = 5
FACTOR = 5

FOLDED = 6
LETTERS = 26 + FOLDED
SAMPLE = 20_000
BOX_WORDS = 8_000
LEAF_WORDS = 24
PAIRS_AT_ONCE = 1 << 18


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs in lower-case A-Z, with the slips of the contract, of MIN_LETTERS and MIN_COUNT or more."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    run = F.explode(F.regexp_extract_all(F.translate(F.col(text_col), upper, lower), F.lit(RUNS), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    length = F.length("run")
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % length).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length))
    word = F.when(h % SLIP == 0, cut).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= MIN_LETTERS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


# ---- letter counts and trees ---------------------------------------------------------------------------------------

def letters_of(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts: a-z each, others folded into FOLDED counters (differences stay in reach, they can only shrink)."""
    plain = letters - 97
    slot = np.where(plain < 26, plain, 26 + letters % FOLDED).astype(np.int64)
    n = len(letters)
    flat = np.bincount((np.arange(n)[:, None] * LETTERS + slot).ravel(), minlength=n * LETTERS)
    return flat.reshape(n, LETTERS).astype(np.int16)


def split_of(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that part words most evenly (`count <= cut` to the left); None if all counts are equal."""
    best, n = None, len(counts)
    for letter in range(LETTERS):
        own = np.bincount(counts[:, letter])
        left = np.cumsum(own)[:-1]
        if len(left):
            at = int(np.argmin(np.abs(left - n / 2)))
            uneven = abs(float(left[at]) - n / 2)
            if 0 < left[at] < n and (best is None or uneven < best[0]):
                best = (uneven, letter, at)
    return best and best[1:]


def upper_tree(counts: np.ndarray, share: float, path: str = "") -> dict | str:
    """Splits until a box holds about BOX_WORDS of all words (`share` words stand behind each of the sample)."""
    split = split_of(counts) if len(counts) * share > BOX_WORDS and len(counts) >= 8 else None
    if split is None:
        return path or "-"
    left = counts[:, split[0]] <= split[1]
    return {"split": split, "left": upper_tree(counts[left], share, path + "0"), "right": upper_tree(counts[~left], share, path + "1")}


def own_box(tree: dict | str, count: np.ndarray) -> str:
    while not isinstance(tree, str):
        letter, cut = tree["split"]
        tree = tree["left"] if count[letter] <= cut else tree["right"]
    return tree


def reached(tree: dict | str, count: list[int], more: int, less: int) -> Iterator[str]:
    """Boxes that `count` can reach with `more` letters added at most and `less` taken away at most, a letter each."""
    if isinstance(tree, str):
        yield tree
        return
    letter, cut = tree["split"]
    here = count[letter]
    if here <= cut:
        yield from reached(tree["left"], count, more, less)
        if here + more > cut:  # the added letter is spent on this one
            yield from reached(tree["right"], [*count[:letter], cut + 1, *count[letter + 1 :]], more - (cut + 1 - here), less)
    else:
        yield from reached(tree["right"], count, more, less)
        if here - less <= cut:
            yield from reached(tree["left"], [*count[:letter], cut, *count[letter + 1 :]], more, less - (here - cut))


class Tree:
    """The k-d tree of a box: words in leaf order, nodes with tight bounds of their counts."""

    def __init__(self, counts: np.ndarray):
        self.order = np.arange(len(counts))
        self.counts = counts
        self.root = self.build(0, len(counts)) if len(counts) else None

    def build(self, lo: int, hi: int) -> tuple:
        own = self.counts[self.order[lo:hi]]
        low, high = own.min(0), own.max(0)
        split = split_of(own) if hi - lo > LEAF_WORDS else None
        if split is None:
            return low, high, lo, hi, ()
        left = own[:, split[0]] <= split[1]
        part = self.order[lo:hi]
        self.order[lo:hi] = np.concatenate([part[left], part[~left]])
        mid = lo + int(left.sum())
        return low, high, lo, hi, (self.build(lo, mid), self.build(mid, hi))

    def search(self, queries: np.ndarray, less: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query numbers, word numbers) of pairs in reach: one letter more, and `less` letters less, than the query has."""
        stack = [(self.root, np.arange(len(queries)))] if self.root else []
        while stack:
            (low, high, lo, hi, parts), alive = stack.pop()
            own = queries[alive]
            near = (np.maximum(low - own, 0).sum(1) <= 1) & (np.maximum(own - high, 0).sum(1) <= less)
            alive = alive[near]
            if not len(alive):
                continue
            if parts:
                stack += [(p, alive) for p in parts]
                continue
            most = max(1, PAIRS_AT_ONCE // LEAF_WORDS)
            words = self.order[lo:hi]  # more than LEAF_WORDS only where all counts are equal
            for w in range(0, len(words), LEAF_WORDS):
                block = words[w : w + LEAF_WORDS]
                target = self.counts[block]
                for q in range(0, len(alive), most):
                    some = alive[q : q + most]
                    apart = target[None, :, :] - queries[some][:, None, :]
                    hit = (np.maximum(apart, 0).sum(2) <= 1) & (np.maximum(-apart, 0).sum(2) <= less)
                    a, b = np.nonzero(hit)
                    if len(a):
                        yield some[a], block[b]


def one_place_differs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_place_more(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each long word is its short one with one place inserted: as long a common start as possible, then the rest shifted."""
    length = short.shape[1]
    start = (np.cumprod(short == long[:, :length], axis=1)).sum(1)
    tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return start + tail >= length


# ---- the search as Spark jobs ---------------------------------------------------------------------------------------

def route(words: DataFrame, trees: dict[int, dict | str]) -> DataFrame:
    """(length, box, word, n, role): each word in its own box as a point (0), and as a query of equal (1) or longer (2) words."""
    sent = words.sparkSession.sparkContext.broadcast(trees)  # splits of boxes of BOX_WORDS words: far smaller than the words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple[int, str, int, int]] = []
            by_length: dict[int, list[int]] = {}
            for i, w in enumerate(names):
                by_length.setdefault(len(w), []).append(i)
            for length, own in by_length.items():
                same, longer = sent.value.get(length, "-"), sent.value.get(length + 1, "-")
                for i, count in zip(own, counts_of(letters_of([names[i] for i in own], length)).tolist(), strict=True):
                    box = own_box(same, count)
                    out.append((length, box, i, 0))
                    # a pair of two boxes is found in the later one only
                    out += [(length, b, i, 1) for b in dict.fromkeys(reached(same, count, 1, 1)) if b >= box]
                    out += [(length + 1, b, i, 2) for b in dict.fromkeys(reached(longer, count, 1, 0))]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array([names[i] for i in columns[2]], pa.string()), pa.array([ns[i] for i in columns[2]], pa.int64()), pa.array(columns[3], pa.int32())],
                names=["length", "box", "word", "n", "role"],
            )

    return words.select("word", "n").mapInArrow(run, "length int, box string, word string, n long, role int")


class Best:
    """Number of near words, and the best of them, for words numbered from 0."""

    def __init__(self, size: int):
        self.near = np.zeros(size, np.int64)
        self.n = np.zeros(size, np.int64)
        self.rank = np.full(size, np.iinfo(np.int64).max)

    def add(self, own: np.ndarray, n: np.ndarray, rank: np.ndarray) -> None:
        """Near words by their counts and ranks in code-point order."""
        np.add.at(self.near, own, 1)
        order = np.lexsort((rank, -n, own))
        own, n, rank = own[order], n[order], rank[order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        own, n, rank = own[first], n[first], rank[first]
        better = (n > self.n[own]) | (n == self.n[own]) & (rank < self.rank[own])
        self.n[own[better]], self.rank[own[better]] = n[better], rank[better]


def near_in_box(group: pa.Table) -> pa.Table:
    """Per word of a box: how many near words its pairs of this box give, and the best one."""
    length = group.column("length")[0].as_py()
    words = np.array(group.column("word").to_pylist(), object)
    role, n = group.column("role").to_numpy(), group.column("n").to_numpy()
    names = sorted(set(words.tolist()))  # Python sorts by code points
    rank = {w: i for i, w in enumerate(names)}
    number = np.fromiter((rank[w] for w in words), np.int64, len(words))
    count = np.zeros(len(names), np.int64)
    count[number] = n
    best = Best(len(names))
    points = number[role == 0]
    if len(points):
        point_letters = letters_of([names[i] for i in points], length)
        tree = Tree(counts_of(point_letters))
        boxed = np.zeros(len(names), bool)
        boxed[points] = True
        for kind, size in ((1, length), (2, length - 1)):
            asked = number[role == kind]
            if not len(asked):
                continue
            letters = letters_of([names[i] for i in asked], size)
            for q, p in tree.search(counts_of(letters), 1 if kind == 1 else 0):
                if kind == 1:
                    true = one_place_differs(letters[q], point_letters[p])
                    true &= ~boxed[asked[q]] | (asked[q] < points[p])  # both words in this box: once
                else:
                    true = one_place_more(letters[q], point_letters[p])
                a, b = asked[q[true]], points[p[true]]
                if len(a):
                    best.add(a, count[b], b)
                    best.add(b, count[a], a)
    own = np.flatnonzero(best.near)
    return pa.table({"word": pa.array([names[i] for i in own], pa.string()), "n_near": best.near[own], "best_n": best.n[own], "best": pa.array([names[i] for i in best.rank[own]], pa.string())})


def sample_trees(words: DataFrame) -> dict[int, dict | str]:
    """The upper tree of each length, from the SAMPLE words with the smallest hashes (a bounded collect)."""
    total = words.count()
    rows = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).collect()
    by_length: dict[int, list[str]] = {}
    for r in rows:
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    share = total / max(1, len(rows))
    return {length: upper_tree(counts_of(letters_of(own, length)), share) for length, own in by_length.items()}


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table (word, n) of distinct words; see the module's docstring."""
    words = staged(words.select("word", "n"), "words")
    routed = route(words, sample_trees(words))
    boxes = routed.groupBy("length", "box").applyInArrow(near_in_box, "word string, n_near long, best_n long, best string")
    best = boxes.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("b"))
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))
    fit = F.col("best_n") >= FACTOR * F.col("n")
    formed = staged(found.select("word", "n", "n_near", F.when(fit, F.col("best")).alias("form"), F.when(fit, F.col("best_n")).alias("form_n")), "forms")
    up = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(rounds(formed)):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("far"))
        up = staged(up.join(further, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
    return formed.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def rounds(formed: DataFrame) -> int:
    """Doubling rounds that the longest chain can need: each step up multiplies the count by FACTOR at least."""
    least, most = formed.agg(F.min("n"), F.max("form_n")).first()
    if most is None:
        return 0
    steps, n = 0, least
    while n * FACTOR <= most:
        n, steps = n * FACTOR, steps + 1
    return math.ceil(math.log2(steps)) if steps > 1 else 0


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(table(spark, sf_dir, "documents")))
