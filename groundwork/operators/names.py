"""Name normalization joins (C1 dictionary join, C7 fuzzy best match).

Both work on the *distinct* names of the input (a small, map-side reduced
set), and join the answer back by name, so the cost follows the number of
distinct names rather than the number of work orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions import clean
from groundwork.plans.sizing import broadcast_if_small

NA = clean.NA


def dictionary_by_key(dictionary: DataFrame) -> DataFrame:
    """One dictionary row per normalized original name (smallest corrected name wins)."""
    d = dictionary.select(
        clean.norm("original_name").alias("_dkey"),
        "original_name", "corrected_name", F.col("confidence_score").cast("double").alias("confidence_score"),
    )
    return d.groupBy("_dkey").agg(
        F.min_by(F.struct("corrected_name", "confidence_score", "original_name"),
                 F.struct("corrected_name", "original_name")).alias("m")
    ).select("_dkey", "m.corrected_name", "m.confidence_score", "m.original_name")


def apply_dictionary(df: DataFrame, name_col: str, dictionary: DataFrame,
                     out_col: str = "name_corrected", conf_col: str = "match_confidence") -> DataFrame:
    """Left join on UPPER(TRIM()) keys; a miss keeps the name with confidence 1.0."""
    d = broadcast_if_small(dictionary_by_key(dictionary))
    j = df.withColumn("_dkey", clean.norm(F.col(name_col))).join(d.drop("original_name"), "_dkey", "left")
    return j.select(
        *[F.col(c) for c in df.columns],
        F.coalesce(F.col("corrected_name"), F.col(name_col)).alias(out_col),
        F.coalesce(F.col("confidence_score"), F.lit(1.0)).alias(conf_col),
    )


def without_one(texts) -> Column:
    """array<string> -> the same texts and each of them without one character, all distinct."""
    def shorter(t: Column) -> Column:
        n = F.length(t)
        cut = lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, n))
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), cut)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(texts, F.flatten(F.transform(texts, shorter))))


def neighbourhood(keys: DataFrame, col: str, dist: int) -> DataFrame:
    """(col, rest): every key with the hash of each text left after deleting up to `dist` of its characters."""
    texts = F.array(F.col(col))
    for _ in range(dist):
        texts = without_one(texts)
    return keys.select(col, F.explode(F.transform(texts, lambda t: F.xxhash64(t))).alias("rest"))


def neighbours(names: DataFrame, dict_keys: DataFrame, dist: int) -> DataFrame:
    """Pairs (_nkey, _dkey) that may be within `dist` edits: none that is, is left out.

    Two texts within `dist` edits leave the same text once up to `dist` characters are deleted from each, so the
    deletion neighbourhoods of both sides meet in an equi-join on that text (by hash). A pair that meets shares all but
    a few characters, whatever prefix the names have in common; a name has at most about length^dist / dist! texts.
    """
    left, right = neighbourhood(names, "_nkey", dist), neighbourhood(dict_keys, "_dkey", dist)
    return left.join(right, "rest").select("_nkey", "_dkey").distinct()


def fuzzy_candidates(names: DataFrame, dict_keys: DataFrame, max_dist: int) -> DataFrame:
    """(_nkey, _dkey, dist) for every pair within `max_dist` edits."""
    pairs = neighbours(names, dict_keys, max_dist)
    return pairs.withColumn("dist", F.levenshtein("_nkey", "_dkey", max_dist)).filter(F.col("dist") >= 0)


def fuzzy_nearest(names: DataFrame, dict_keys: DataFrame, max_dist: int) -> DataFrame:
    """(_nkey, _dkey): the nearest dictionary key within `max_dist` edits of each name (ties: the smaller key).

    Distances are searched from 1 up, each among the names that no smaller one answered, so the larger neighbourhoods
    are made for the few names that need them.
    """
    todo, found = names, None
    for dist in range(1, max_dist + 1):
        pairs = fuzzy_candidates(todo, dict_keys, dist)  # none below `dist` is left
        best = pairs.groupBy("_nkey").agg(F.min("_dkey").alias("_dkey"))
        found = best if found is None else found.unionByName(best)
        todo = todo.join(best, "_nkey", "left_anti")
    return found


def fuzzy_match(df: DataFrame, name_col: str, dictionary: DataFrame, max_dist: int = 2,
                out_col: str | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Exact dictionary hit, else the nearest dictionary name within `max_dist`
    edits (ties: smaller key), else the name itself; falsy names become 'N/A'.

    `keep` stores the answers, one row per distinct name, and marks them for broadcast where they are few: AQE alone
    finds that out when the rows of `df` are already shuffled by name, one task for a frequent one.
    """
    out_col = out_col or name_col
    base = clean.builder_base(F.col(name_col))
    keyed = df.withColumn("_nname", base).withColumn("_nkey", clean.norm("_nname"))
    dkeys = dictionary_by_key(dictionary)
    names = keyed.select("_nkey").filter(F.col("_nkey") != NA).distinct()
    exact = names.join(dkeys.select("_dkey"), names._nkey == dkeys._dkey, "left_semi")
    todo = names.join(dkeys.select("_dkey"), names._nkey == dkeys._dkey, "left_anti")
    matched = exact.select("_nkey", F.col("_nkey").alias("_dkey"))
    if max_dist > 0:
        matched = matched.unionByName(fuzzy_nearest(todo, dkeys.select("_dkey"), max_dist))
    answer = matched.join(dkeys.select("_dkey", "corrected_name"), "_dkey").select("_nkey", "corrected_name")
    out = keyed.join(keep(answer) if keep else answer, "_nkey", "left")
    corrected = F.when(F.col("_nname") == NA, F.lit(NA)).otherwise(F.coalesce("corrected_name", "_nname"))
    keep = [c for c in df.columns if c != out_col]
    return out.select(*keep, corrected.alias(out_col))
