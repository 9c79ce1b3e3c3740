"""Service categorization.

The categorizer's answer ("Service: ...\\nBlocks/Lots/Units: ...") is parsed,
renamed, validated and consolidated per work order.  The consolidation is an
ordered fold whose state is the ordered list of (service, blocks) entries; it
runs as `aggregate()` over the row's own block array, so it is exact
(first-appearance order, substring merge, numbered repeats) and needs no
shuffle: the work stays in the partition that holds the work order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundwork.functions import clean
from groundwork.functions.util import as_col, let
from groundwork.operators import vocab as V

_BLOCK_SPLIT = r"\n\n(?=Service:)"
_SERVICE_RE = r"(?d)Service:\s*(.*?)(?:\n|$)"
_BLOCKS_RE = r"(?d)Blocks/Lots/Units:\s*(.*?)(?:\n|$)"

ENTRY = "array<struct<s:string,b:string>>"


def route(company) -> Column:
    """'strict' / 'tiered' / NULL (no categorizer) by standardized company."""
    c = as_col(company)
    return F.when(c == V.STRICT_COMPANY, F.lit("strict")).when(c == V.TIERED_COMPANY, F.lit("tiered"))


def unrouted_text(company) -> Column:
    name = F.coalesce(as_col(company), F.lit("None"))
    return F.concat(F.lit("Service: Miscellaneous (No categorizer for "), name,
                    F.lit(")\nBlocks/Lots/Units: Not specified"))


def parse_blocks(text) -> Column:
    """Answer text -> array<struct<s, b>> of blocks that name a service."""
    blocks = F.split(let(F.trim(as_col(text)), clean.strip_trimmed), _BLOCK_SPLIT)
    found = F.transform(
        blocks,
        lambda b: F.struct(
            F.when(b.contains("Service:"), F.trim(F.regexp_extract(b, _SERVICE_RE, 1))).alias("s"),
            F.when(b.contains("Blocks/Lots/Units:"), F.trim(F.regexp_extract(b, _BLOCKS_RE, 1)))
            .otherwise(F.lit(V.NOT_SPECIFIED))
            .alias("b"),
        ),
    )
    return F.transform(
        F.filter(found, lambda x: x["s"].isNotNull()),
        lambda x: F.struct(clean.strip_trimmed(x["s"]).alias("s"), clean.strip_trimmed(x["b"]).alias("b")),
    )


def substitute(service) -> Column:
    """Tiered renames."""
    s = as_col(service)
    out = s
    for src, dst in reversed(list(V.TIERED_RENAMES.items())):
        out = F.when(s == src, F.lit(dst)).otherwise(out)
    return out


def validate(service, mode) -> Column:
    """Out-of-vocabulary names become 'Miscellaneous (<name>)' (H13)."""
    s = as_col(service)
    m = as_col(mode)
    strict_ok = s.startswith(V.SETTLEMENT) | s.startswith(V.MISC) | s.isin(V.STRICT_CATEGORIES)
    tiered_ok = s.startswith(V.MISC) | s.isin(V.TIERED_CATEGORIES)
    ok = F.when(m == "strict", strict_ok).otherwise(tiered_ok)
    return F.when(ok, s).otherwise(F.concat(F.lit("Miscellaneous ("), s, F.lit(")")))


def _merge_blocks(cur: Column, new: Column) -> Column:
    """Keep a real value over 'Not specified'; append unless a substring."""
    ns = F.lit(V.NOT_SPECIFIED)
    return (
        F.when((new != ns) & (cur != ns),
               F.when(cur.contains(new), cur).otherwise(F.concat(cur, F.lit(", "), new)))
        .when(new != ns, new)
        .otherwise(cur)
    )


def consolidate(entries, mode) -> Column:
    """Ordered fold of (service, blocks) entries (D18 strict, D19 tiered, E2, E3)."""
    m = as_col(mode)

    def step(acc: Column, x: Column) -> Column:
        present = F.exists(acc, lambda e: e["s"] == x["s"])
        # smallest n >= 1 such that 'Settlement Repairs<n>' is not yet a key
        free_n = F.element_at(
            F.filter(
                F.sequence(F.lit(1), F.size(acc) + 1),
                lambda i: ~F.exists(acc, lambda e: e["s"] == F.concat(F.lit(V.SETTLEMENT), i.cast("string"))),
            ),
            1,
        )
        numbered = F.struct(F.concat(F.lit(V.SETTLEMENT), free_n.cast("string")).alias("s"), x["b"].alias("b"))
        merged = F.transform(
            acc,
            lambda e: F.when(e["s"] == x["s"], F.struct(e["s"].alias("s"), _merge_blocks(e["b"], x["b"]).alias("b")))
            .otherwise(e),
        )
        settle = (m == "strict") & x["s"].startswith(V.SETTLEMENT)
        return (
            F.when(settle & present, F.array_append(acc, numbered))
            .when(present, merged)
            .otherwise(F.array_append(acc, x))
        )

    return F.aggregate(as_col(entries), F.array().cast(ENTRY), step)


def format_entries(entries) -> Column:
    """H12: 'Service: s\\nBlocks/Lots/Units: b' joined by blank lines."""
    def text(e: Column) -> Column:
        lines = F.transform(e, lambda x: F.concat(F.lit("Service: "), x["s"], F.lit("\nBlocks/Lots/Units: "), x["b"]))
        return F.when(F.size(e) > 0, F.array_join(lines, "\n\n")).otherwise(F.lit(V.ERROR_TEXT))

    return let(entries, text)  # the entries' whole fold is behind them


def categorize_text(text, mode) -> Column:
    """Full answer post-processing for one routed row."""
    m = as_col(mode)
    renamed = F.transform(
        parse_blocks(text),
        lambda x: F.struct(F.when(m == "tiered", substitute(x["s"])).otherwise(x["s"]).alias("s"), x["b"].alias("b")),
    )
    cleaned = F.transform(renamed, lambda x: F.struct(validate(x["s"], m).alias("s"), x["b"].alias("b")))
    return format_entries(consolidate(cleaned, m))


# ---- native keyword categorizer (C9, J3): the default hook -----------------

def _vocab_array(names: list[str]) -> Column:
    """The names but 'Miscellaneous', each with its lower-case form: a literal, made once for all rows."""
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(n.lower()).alias("key")) for n in names if n != V.MISC])


def keyword_entries(description, mode) -> Column:
    """Categories whose name occurs (case-insensitively) in the description.

    strict: every hit, in vocabulary order.  tiered: the single most specific
    hit (lowest level, then longest name, then vocabulary order), else
    'Miscellaneous'.  Blocks are 'Not specified'.  The vocabulary is a literal
    array of ~100 names evaluated per row, so there is no join at all; the
    tiered one lies in the order of specificity, so its first hit is the answer.
    """
    m = as_col(mode)
    ranked = [name for lv in sorted(V.TIERED_LEVELS) for name in sorted(V.TIERED_LEVELS[lv], key=len, reverse=True)]
    hits = lambda names: lambda d: F.filter(_vocab_array(names), lambda v: d.contains(v["key"]))
    text = F.lower(F.coalesce(as_col(description), F.lit("")))
    found = F.when(m == "strict", let(text, hits(V.STRICT_CATEGORIES))).otherwise(F.slice(let(text, hits(ranked)), 1, 1))
    ns = F.lit(V.NOT_SPECIFIED)
    entries = F.transform(found, lambda v: F.struct(v["name"].alias("s"), ns.alias("b")))
    misc = F.array(F.struct(F.lit(V.MISC).alias("s"), ns.alias("b")))
    return let(entries, lambda e: F.when(F.size(e) > 0, e).otherwise(misc))


def keyword_text(description, mode) -> Column:
    """Keyword hits rendered as an answer text (what a hook would return)."""
    return format_entries(keyword_entries(description, mode))


def categorize(corrected: DataFrame, answers: DataFrame | None = None,
               company_col: str = "company_name_standardized") -> DataFrame:
    """(work_order_id, ml_categorization) for rows with a description (L3).

    `answers` (work_order_id, answer_text) is the output of an external
    categorizer; without it the native keyword categorizer answers.  Routing,
    parsing and consolidation are the same either way.
    """
    rows = corrected.filter(F.col("description").isNotNull()).select(
        "work_order_id", "description", F.col(company_col).alias("_company")
    )
    rows = rows.withColumn("_mode", route(F.col("_company")))
    if answers is not None:
        rows = rows.join(answers.select("work_order_id", "answer_text"), "work_order_id", "left")
        text = F.col("answer_text")
    else:
        text = keyword_text(F.col("description"), F.col("_mode"))
    result = F.when(F.col("_mode").isNull(), unrouted_text(F.col("_company"))).otherwise(
        categorize_text(F.coalesce(text, F.lit("")), F.col("_mode"))
    )
    return rows.select("work_order_id", result.alias("ml_categorization"))


def with_categories(corrected: DataFrame, answers: DataFrame | None = None,
                    company_col: str = "company_name_standardized") -> DataFrame:
    """The corrected table plus `ml_categorization` in one pass (L3 + A9).

    Same result as joining `categorize()` back on the key (rows without a
    description keep NULL), without reading the corrected table twice.
    """
    df = corrected
    if answers is not None:
        df = df.join(answers.select("work_order_id", F.col("answer_text").alias("_answer")), "work_order_id", "left")
        text = F.col("_answer")
    else:
        text = None
    company = F.col(company_col)
    mode = route(company)
    if text is None:
        text = keyword_text(F.col("description"), mode)
    result = F.when(F.col("description").isNull(), F.lit(None).cast("string")).when(
        mode.isNull(), unrouted_text(company)).otherwise(categorize_text(F.coalesce(text, F.lit("")), mode))
    out = df.withColumn("ml_categorization", result)
    return out.drop("_answer") if answers is not None else out
