"""Line deduplication by content-defined chunks of lines (operator 3), in DataFrame functions only.

A rolling hash over the hashes of `min_lines` neighbouring lines is taken at every line. Where it is the smallest among
`REACH` neighbours on either side a chunk ends, so that a passage is cut alike wherever it stands and every chunk has
`min_lines` lines or more. Chunks are grouped over the whole corpus by hash, and those with a hash at two places or more
are compared by their bytes: all but the first place (document id, then line) of a chunk are repeats.

Repeated runs begin and end inside chunks too. Each match is therefore extended over equal neighbouring lines: the windows
of `min_lines` lines that stand in no repeated chunk, those over a boundary among them, are matched in the same way, by
hash and then by bytes. A window's first place is always among them (were its chunk a repeat, it would stand earlier), so
exactly the lines of repeated runs of `min_lines` or more lines go, and each line stays at its first place in the corpus.

Defined results: null texts stay null and empty ones empty, with 0 lines removed. A window without a visible character
is no repeat. A run that repeats inside a document is removed there as well. A null id sorts first. Rows with the same
id count as one place when they hold the same lines at the same line, so exact repeats of a row are treated alike.
All columns of the input are kept, whatever their names; an empty table gives an empty result.

A hot chunk or window is reduced to one row per task before the shuffle, and a document only learns which of its own came
first, so no group of copies meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import table

MIN_LINES = 2
REACH = 2
LINE_BITS = 0xFFFFFFFF  # of a key, the first line; the other bits are its hash's


def key(line: Column, h: Column) -> Column:
    return h.bitwiseAND(F.lit(~LINE_BITS)).bitwiseOR(line.cast("bigint"))


def line_of(k: Column) -> Column:
    return k.bitwiseAND(F.lit(LINE_BITS)).cast("int")


def with_chunks(docs: DataFrame, text: str, size: int, reach: int) -> DataFrame:
    """Adds `x_lines`, their hashes `x_hashes`, `x_windows` (first lines of windows with a visible character), `x_chunks` [(first line from 0, hash)] and, for every line, the end of its chunk `x_end`.

    Lambdas name an array twice: named once, the optimizer may put its expression into the lambda and work it out for each element.
    """
    lines = docs.withColumn("x_lines", F.split(F.coalesce(text, F.lit("")), "\n", -1))
    hashed = lines.withColumn("x_hashes", F.transform("x_lines", lambda x: F.xxhash64(x))).withColumn("x_seen", F.transform("x_lines", lambda x: x.rlike(r"\S")))
    n = F.size("x_hashes")
    upto = lambda a, b: F.when(b >= a, F.sequence(a, F.greatest(a, b))).otherwise(F.array().cast("array<int>"))
    starts = upto(F.lit(0), n - size)
    rolled = hashed.withColumn("x_roll", F.transform(starts, lambda i: F.xxhash64(*[F.get("x_hashes", i + k) for k in range(size)])))
    rolled = rolled.withColumn("x_windows", F.filter(starts, lambda i: F.greatest(*[F.get("x_seen", i + k) for k in range(size)])))
    at = lambda i: F.get("x_roll", i)
    highest = F.lit((1 << 63) - 1)
    before = lambda i: F.least(highest, *[at(i - k) for k in range(1, reach + 1)])
    after = lambda i: F.least(highest, *[at(i + k) for k in range(1, reach + 1)])
    cuts = rolled.withColumn("x_cuts", F.filter(upto(F.lit(size), n - size), lambda c: (at(c - 1) < before(c - 1)) & (at(c - 1) <= after(c - 1))))
    first = F.when(n >= size, F.concat(F.array(F.lit(0)), "x_cuts")).otherwise(F.array().cast("array<int>"))
    last = F.when(n >= size, F.concat("x_cuts", F.array(n))).otherwise(F.array().cast("array<int>"))
    ends = F.flatten(F.zip_with(first, last, lambda s, e: F.array_repeat(e, e - s)))
    chunks = F.zip_with(first, last, lambda s, e: F.struct(s.alias("line"), F.xxhash64(F.slice("x_hashes", s + 1, e - s), F.get("x_hashes", s)).alias("h")))
    return cuts.withColumn("x_end", ends).withColumn("x_chunks", chunks).drop("x_cuts", "x_roll", "x_seen")


def each(docs: DataFrame, id_col: str, structs: str) -> DataFrame:
    """A row for each struct of an array. As an outer explode, since the optimizer adds a filter before an inner one, in which it works out the array anew for each line."""
    return docs.select(F.col(id_col).alias("id"), F.explode_outer(structs).alias("w")).where("w IS NOT NULL").select("id", "w.*")


def firsts(rows: DataFrame, *same: str) -> DataFrame:
    """For each id, the keys of chunks or windows (rows id, line, h) that come first among those equal in `same`, and of the shared ones."""
    place = F.struct("id", "line")
    by = rows.groupBy(*same).agg(F.min(place).alias("f"), F.max(place).alias("l"))
    k = key(F.col("f.line"), F.col("h"))
    one = by.select(F.col("f.id").alias("id"), k.alias("k"), F.when(~F.col("f").eqNullSafe(F.col("l")), k).alias("s"))
    return one.groupBy("id").agg(F.collect_list("k").alias("x_first"), F.collect_list("s").alias("x_shared"))


def met(rows: DataFrame, first: DataFrame, own: str) -> DataFrame:
    return rows.join(first, F.col(own).eqNullSafe(F.col("id")), "left").drop("id")


def repeats(joined: DataFrame, own: str, structs: str, text: Callable[[Column], Column], out: str) -> DataFrame:
    """Adds the keys `out` of those `structs` (line, h) that stand at an earlier place. `joined` has the `firsts` by hash, which settle what stands at one place only; `text` gives the bytes that begin with a line."""
    none = F.array().cast("array<bigint>")
    keys = joined.withColumn("x_keys", F.transform(structs, lambda w: key(w["line"], w["h"])))
    open_ = F.array_union(F.array_except("x_keys", F.coalesce("x_first", none)), F.array_intersect("x_keys", F.coalesce("x_shared", none)))
    parted = keys.withColumn("x_open", open_).drop("x_first", "x_shared", "x_keys")
    shared = parted.withColumn("x_texts", F.transform("x_open", lambda k: F.struct(line_of(k).alias("line"), k.alias("h"), text(line_of(k)).alias("bytes"))))
    by_bytes = each(shared, own, "x_texts").withColumn("h", F.col("h").bitwiseAND(F.lit(~LINE_BITS)))
    true = firsts(by_bytes, "h", "bytes").select("id", F.col("x_first").alias("x_true"))
    return met(parted, true, own).withColumn(out, F.array_except("x_open", F.coalesce("x_true", none))).drop("x_open", "x_true")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, reach: int = REACH) -> DataFrame:
    """All columns of `docs` with repeated runs of lines removed from the text, and n_lines, n_removed."""
    if min_lines < 2:
        raise ValueError("a run has two lines or more")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    own, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    reach = max(reach, min_lines - 1)
    first = firsts(each(with_chunks(plain.select(own, text), text, min_lines, reach), own, "x_chunks"), "h")
    # the texts move alone, their lines are split again after the join
    rows = with_chunks(met(plain, first, own), text, min_lines, reach)
    end = lambda i: F.get("x_end", i)
    part = lambda i: F.concat(F.get("x_lines", i), F.lit("\n"), F.array_join(F.slice("x_lines", i + 2, end(i) - i - 1), "\n"))
    rows = repeats(rows, own, "x_chunks", part, "x_again")
    inside = F.flatten(F.transform("x_again", lambda k: F.when(end(line_of(k)).isNotNull(), F.sequence(line_of(k), end(line_of(k)) - min_lines)).otherwise(F.array().cast("array<int>"))))
    rows = rows.withColumn("x_inside", F.array_intersect("x_windows", inside)).drop("x_again", "x_end", "x_chunks")
    rows = rows.withColumn("x_others", F.array_except("x_windows", "x_inside")).drop("x_windows")
    window = lambda i: F.struct(i.alias("line"), F.xxhash64(*[F.get("x_hashes", i + k) for k in range(min_lines)]).alias("h"))
    rows = rows.withColumn("x_rest", F.transform("x_others", window)).drop("x_others", "x_hashes")
    rows = met(rows, firsts(each(rows, own, "x_rest"), "h"), own)
    rows = repeats(rows, own, "x_rest", lambda i: F.concat_ws("\n", *[F.get("x_lines", i + k) for k in range(min_lines)]), "x_gone")
    lines_of = lambda i: F.sequence(i, i + min_lines - 1)
    starts = F.concat("x_inside", F.transform("x_gone", line_of))
    drop = rows.withColumn("x_drop", F.flatten(F.transform(starts, lines_of)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("x_lines") - 1), "x_drop")
    drop = drop.withColumn("x_left", F.when(F.size("x_drop") > 0, stay))
    new = F.when(F.size("x_drop") == 0, F.col(text)).otherwise(F.array_join(F.transform("x_left", lambda i: F.coalesce(F.get("x_lines", i), F.get("x_lines", i + 1))), "\n"))
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size("x_lines"))
    kept = F.when(F.size("x_drop") == 0, count).otherwise(F.size("x_left"))
    out = drop.select(*[new.alias(n) if n == text else F.col(n) for n in names], count.alias("n_lines"), (count - kept).alias("n_removed"))
    return out.toDF(*docs.columns, "n_lines", "n_removed")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")
