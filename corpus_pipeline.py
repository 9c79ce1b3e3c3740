"""The corpus pipeline: five stages over `documents`, each on all that the stage before it kept.

language ID -> line dedup -> near dedup -> decontamination -> packing. Every stage but the last returns the columns of
documents (extra columns are carried along); the last returns the packed pieces.

Defined results: documents without a predicted language (null text, no letter) go in the first stage; where nothing can be learned (no usable label, no lang column) those
with a letter stay. Extra columns keep their values, also under names that the operators use themselves. A document that
loses every line to earlier documents goes in the second; `n_chars` follows the remaining text. The third keeps the
document with the smallest id of each group of near duplicates (five words, 0.8); exact repeats of a row leave one.
The fourth drops documents that hold a benchmark item. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundwork.llm.common import staged, table
from groundwork.llm.decontaminate import find_leaks
from groundwork.llm.language_id import CHARS_PER_DOC, DOCS_PER_LANG, UNKNOWN, identify, learn
from groundwork.llm.line_dedup import dedup_lines
from groundwork.llm.minhash_dedup import near_duplicates
from groundwork.llm.packing import pack


def judged(found: DataFrame, docs: DataFrame, *added: str) -> DataFrame:
    """An operator's rows with plain names: c0, c1, ... for the columns of `docs`, then those it added, whatever names clash."""
    return found.toDF(*[f"c{i}" for i in range(len(docs.columns))], *added)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    samples = learn(docs, "doc_id", "text", "lang", DOCS_PER_LANG, CHARS_PER_DOC) if "lang" in docs.columns else ()
    if not samples:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = judged(identify(docs, samples=samples), docs, "pred", "likely")
    return found.where(F.col("pred") != UNKNOWN).drop("pred", "likely").toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = judged(dedup_lines(docs), docs, "lines", "gone")
    text = f"c{docs.columns.index('text')}"
    done = done.where((F.col("gone") == 0) | (F.col(text) != ""))
    if "n_chars" in docs.columns:
        own, kind = f"c{docs.columns.index('n_chars')}", docs.schema["n_chars"].dataType
        done = done.withColumn(own, F.when(F.col("gone") > 0, F.length(text).cast(kind)).otherwise(F.col(own)))
    return done.drop("lines", "gone").toDF(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return named.join(kept, "doc_id", "left_semi").select(*docs.columns).union(docs.where("doc_id IS NULL"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = judged(find_leaks(docs, table(spark, sf_dir, "benchmark")), docs, "leaked", "items", "share")
    return found.where(~F.col("leaked")).drop("leaked", "items", "share").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near), ("decontamination", decontaminated), ("packing", packed)]
# Language models, minwise paths and subset sums are not SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
