"""Answer parsing and the raw work-order row.

All parsing is per row: functions over the answer text, and Arrow arrays of
a batch's lines for the numbered answers, so a document never leaves its
partition: no explode, no regroup, no shuffle.
"""

from __future__ import annotations

import re
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundwork.functions import clean, keys
from groundwork.functions.util import as_col

N_FIELDS = 35
NA = clean.NA


def _strip(c: Column) -> Column:
    return clean.strip_ws(c)


# A line up to its value: an integer between blanks, then ':' at once or after a '.' and any text. Group 1 holds the
# digits of a number above 0 without leading zeros, group 2 any other integer.
_LABEL = rf"{clean.BLANKS_IN_LINE}(?:\+?0*+([1-9][0-9]*+)|([+-]?[0-9]++)){clean.BLANKS_IN_LINE}(?:\.[^:\n]*+)?:"


def field_numbers(text, group: int = 1) -> Column:
    """A group of `_LABEL` for every line of an answer, in order; '' where a line has none. One search over the text."""
    lines = F.concat(F.lit("\n"), as_col(text))
    return F.regexp_extract_all(lines, F.lit(rf"\n(?:{_LABEL})?[^\n]*+"), F.lit(group))


def _value(line: Column) -> Column:
    """What a line says after its first ':'."""
    return _strip(F.substr(line, F.instr(line, ":") + 1))


def parse_fields(text) -> Column:
    """Answer text -> array<struct<num int, value string>> in line order.

    A line counts when, after stripping, it is non-empty and has a ':'; the
    field number is the text before the first '.' of the part before the
    first ':'.  Lines whose number is not an integer are dropped.
    """
    lines = F.split(as_col(text), "\n")
    number = F.zip_with(field_numbers(text), field_numbers(text, 2), lambda a, b: F.concat(a, b).try_cast("int"))
    parsed = F.zip_with(number, lines, lambda n, line: F.struct(n.alias("num"), _value(line).alias("value")))
    return F.filter(parsed, lambda x: x["num"].isNotNull())


def by_position(parsed) -> Column:
    """Parsed fields as two arrays, numbers and values, the last line first: a field is then one search for its number."""
    back = F.reverse(as_col(parsed))
    return F.struct(back["num"].alias("nums"), back["value"].alias("texts"))


def field(fields, k: int | Column, default: str | None = NA) -> Column:
    """Value of field k of `by_position`; the last occurrence wins; absent -> default."""
    own = as_col(fields)
    v = F.get(own["texts"], F.array_position(own["nums"], k).cast("int") - 1)
    return F.coalesce(v, F.lit(default)) if default is not None else v


# field number of the first line of service K (K = 1..4): 8, 15, 22, 29
def _service_base(k: int) -> int:
    return 8 + 7 * (k - 1)


# the date of each line of the form; its quantity and hours follow
FIRST_OF_LINE = [_service_base(k) + 1 + j for k in range(1, 5) for j in (0, 3)]

FIELDS = T.StructType([T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("quantities", T.ArrayType(T.DoubleType())),
                       T.StructField("hours", T.ArrayType(T.DoubleType()))])

_NUMBER, _FLOAT = re.compile(r"\+?0*([1-9][0-9]*)"), re.compile(clean.FLOAT_RE[1:-1])


def _field_number(label: str) -> int:
    """The field that a label (the text before a line's first ':') names, 0 for none."""
    m = _NUMBER.fullmatch(label.split(".", 1)[0].strip(clean.WS_CHARS))
    return int(m[1]) if m and len(m[1]) <= 2 and int(m[1]) <= N_FIELDS else 0


def _float(text: str, units: tuple[str, ...] = ()) -> float | None:
    """`clean.float_or_null` of a text without the units."""
    for unit in units:
        text = text.replace(unit, "")
    m = _FLOAT.fullmatch(text.strip(clean.WS_CHARS))
    return float(m[0]) if m else None


def _of_distinct(texts: pa.Array, fn: Callable[[str], float | int | None], kind: pa.DataType) -> pa.Array:
    """fn of every text, computed once for each distinct one."""
    coded = texts.dictionary_encode()
    return pa.array([fn(t) for t in coded.dictionary.to_pylist()], kind).take(coded.indices)


def _in_rows(values: pa.Array, per_row: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, per_row, dtype=np.int32)), values)


def _fields_of_lines(lines: pa.Array) -> pa.Array:
    """The lines of a batch of answers -> `FIELDS`: the text of every field, quantity and hours of every line."""
    parts = pc.split_pattern(lines.flatten(), ":", max_splits=1)
    labelled = pc.equal(pc.list_value_length(parts), 2)
    row = pc.list_parent_indices(lines).filter(labelled).to_numpy(zero_copy_only=False)
    halves = parts.filter(labelled).flatten()
    label, value = (halves.take(pa.array(np.arange(i, len(halves), 2))) for i in (0, 1))
    number = _of_distinct(label, _field_number, pa.int64()).to_numpy(zero_copy_only=False)
    known = np.flatnonzero(number)
    at = np.full(len(lines) * N_FIELDS, -1)
    at[row[known] * N_FIELDS + number[known] - 1] = known  # of several lines of a field the last one stays
    texts = pc.fill_null(pc.utf8_trim(value.take(pa.array(at, mask=at < 0)), characters=clean.WS_CHARS), NA)
    place = lambda j: pa.array((np.arange(len(lines))[:, None] * N_FIELDS + np.array(FIRST_OF_LINE) + j - 1).ravel())
    floats = [_of_distinct(texts.take(place(j)), lambda t: _float(t, units), pa.float64()) for j, units in ((1, ()), (2, clean.HOUR_UNITS))]
    return pa.StructArray.from_arrays([_in_rows(texts, N_FIELDS), *(_in_rows(f, len(FIRST_OF_LINE)) for f in floats)], FIELDS.names)


def to_raw_row(df: DataFrame, text_col: str = "answer_text") -> DataFrame:
    """Answer text -> the 38-column raw row.

    Keeps `work_order_id` when the input has one, else derives the document id
    from the number and the extraction time.
    """
    parsed = df.withColumn("_f", F.arrow_udf(_fields_of_lines, FIELDS)(F.split(F.col(text_col), "\n")))
    f = lambda k: F.get("_f.texts", F.lit(k - 1))
    if "work_order_id" in df.columns:
        wid = F.col("work_order_id")
    else:
        wid = keys.document_id(f(1), F.col("extracted_at"))
    cols = [
        wid.alias("work_order_id"),
        f(1).alias("work_order_number"),
        f(2).alias("builder_name"),
        f(3).alias("project_name"),
        f(4).alias("month"),
        clean.year(f(5)).alias("year"),
        f(6).alias("company_name"),
        f(7).alias("description"),
        F.col("file_url"),
        F.col("extracted_at"),
    ]
    for k in range(1, 5):
        cols.append(f(_service_base(k)).alias(f"service{k}"))
    for i, b in enumerate(FIRST_OF_LINE):
        cols += [f(b).alias(f"d{i + 1}"), F.get("_f.quantities", F.lit(i)).alias(f"q{i + 1}"), F.get("_f.hours", F.lit(i)).alias(f"h{i + 1}")]
    order = (
        ["work_order_id", "work_order_number", "builder_name", "project_name", "month", "year",
         "company_name", "description", "file_url", "extracted_at"]
        + [f"service{k}" for k in range(1, 5)]
        + [f"{p}{i}" for i in range(1, 9) for p in ("d", "q", "h")]
    )
    return parsed.select(*cols).select(*order)


SERVICE_LINE = T.StructType([
    T.StructField("line_no", T.IntegerType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("hours", T.DoubleType()),
])


def _set(c: Column) -> Column:
    return c.isNotNull() & (c != "") & (c != NA)


def service_array(df_cols=None) -> Column:
    """Wide service columns -> array<struct> of the lines that exist (H8)."""
    items = []
    for k in range(1, 5):
        svc = F.col(f"service{k}")
        a, b = 2 * k - 1, 2 * k
        first = _set(svc)
        second = first & _set(F.col(f"d{b}"))
        for line, keep in ((a, first), (b, second)):
            items.append(
                F.when(
                    keep,
                    F.struct(
                        F.lit(line).alias("line_no"),
                        svc.alias("service_type"),
                        F.col(f"d{line}").alias("date"),
                        F.col(f"q{line}").alias("quantity"),
                        F.col(f"h{line}").alias("hours"),
                    ),
                )
            )
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def service_lines(raw: DataFrame) -> DataFrame:
    """One row per service line present in the wide raw row (single pass)."""
    return raw.select(
        "work_order_id", F.explode(service_array()).alias("s")
    ).select("work_order_id", "s.*")


# ---- JSON answers (H7, H9, D20, B13) -------------------------------------

SERVICE_JSON = T.StructType([
    T.StructField("service_type", T.VariantType()),
    T.StructField("date", T.VariantType()),
    T.StructField("quantity", T.VariantType()),
    T.StructField("hours", T.VariantType()),
])

# Values keep the type they have in the answer, so that a number 0 is not the text "0".
ANSWER_JSON = T.StructType([
    T.StructField("work_order_number", T.VariantType()),
    T.StructField("builder_name", T.VariantType()),
    T.StructField("project_name", T.VariantType()),
    T.StructField("month", T.VariantType()),
    T.StructField("year", T.VariantType()),
    T.StructField("company_name", T.VariantType()),
    T.StructField("description", T.VariantType()),
    T.StructField("services", T.ArrayType(SERVICE_JSON)),
])


def text_of(value) -> Column:
    """The text of a JSON value: strings as they are, numbers and booleans as written, null and nothing as NULL."""
    return F.try_variant_get(as_col(value), "$", "string")


def filled(value) -> Column:
    """Whether a JSON value counts as filled: not absent, null, '', a zero of any type, false, [] or {}."""
    v = as_col(value)
    empty = F.to_json(v).isin('""', "null", "false", "[]", "{}") | (~F.schema_of_variant(v).isin("STRING", "BOOLEAN") & (F.try_variant_get(v, "$", "double") == 0))
    return F.coalesce(v.isNotNull() & ~F.coalesce(empty, F.lit(False)), F.lit(False))


def strip_fence(text) -> Column:
    """Strip, drop a leading ```json and a trailing ``` fence, strip again."""
    t = _strip(as_col(text))
    t = F.when(t.startswith("```json"), F.substring(t, 8, 1 << 30)).otherwise(t)
    t = F.when(t.endswith("```"), F.substr(t, F.lit(1), F.length(t) - 3)).otherwise(t)
    return _strip(t)


def parse_json(df: DataFrame, text_col: str = "answer_text") -> DataFrame:
    """Adds `answer` (typed struct), `is_valid`, `reject_reason` and `corrupt_record`.

    The whole cleaned text must be one JSON object: cut-short JSON, other values, several objects and trailing text are
    rejects, with the answer's text in `corrupt_record` and no `answer`. Fields of another shape are NULL.
    """
    cleaned = strip_fence(F.col(text_col))
    # a text that is one value stays one element of an array around it; anything after the value breaks the array
    one = F.json_array_length(F.concat(F.lit("["), F.col("_clean"), F.lit("]"))) == 1
    is_object = F.col("_clean").startswith("{") & F.json_object_keys("_clean").isNotNull()
    reason = (
        F.when(F.col(text_col).isNull(), F.lit("no answer"))
        .when(F.col("_clean") == "", F.lit("empty answer"))
        .when(~F.coalesce(one & is_object, F.lit(False)), F.lit("not one JSON object"))
    )
    return (
        df.withColumn("_clean", cleaned)
        .withColumn("reject_reason", reason)
        .withColumn("is_valid", F.col("reject_reason").isNull())
        .withColumn("answer", F.when(F.col("is_valid"), F.from_json("_clean", ANSWER_JSON)))
        .withColumn("corrupt_record", F.when(~F.col("is_valid"), F.col(text_col)))
        .drop("_clean")
    )


def normalize_services(services) -> Column:
    """Keep services with a truthy type; parse date, quantity and hours (zero default)."""
    kept = F.filter(as_col(services), lambda s: filled(s["service_type"]))
    return F.transform(
        kept,
        lambda s: F.struct(
            text_of(s["service_type"]).alias("service_type"),
            clean.date_multi(text_of(s["date"])).alias("date"),
            clean.float_or_zero(text_of(s["quantity"])).alias("quantity"),
            clean.float_or_zero(text_of(s["hours"])).alias("hours"),
        ),
    )


QUALITY_FIELDS = ["work_order_number", "builder_name", "project_name", "month", "year",
                  "company_name", "description"]


def extraction_score(answer) -> Column:
    """filled/7 over truthy fields + min(#services/4, 1) * 0.2, capped at 1."""
    a = as_col(answer)
    n_filled = sum((filled(a[name]).cast("int") for name in QUALITY_FIELDS), F.lit(0))
    n_svc = F.coalesce(F.size(a["services"]), F.lit(0)).cast("double")
    base = n_filled.cast("double") / F.lit(7.0)
    bonus = F.least(n_svc / F.lit(4.0), F.lit(1.0)) * F.lit(0.2)
    return F.least(base + bonus, F.lit(1.0))


def missing_fields(answer, names=("work_order_number", "builder_name", "project_name")) -> Column:
    """Names of required fields that are absent or empty."""
    a = as_col(answer)
    return F.filter(F.array(*[F.when(~filled(a[n]), F.lit(n)) for n in names]), lambda x: x.isNotNull())


# ---- model hook (J1) -----------------------------------------------------

def apply_model(df: DataFrame, fn: Callable[[bytes, str], str | None],
                content_col: str = "content", name_col: str = "path") -> DataFrame:
    """Run a user extraction function over document bytes, batch by batch.

    `fn(content, file_name) -> answer text or None`; one Python worker per
    partition through Arrow batches.  Failures (None or an exception) become
    rows with `answer_text` NULL and an error message, for the reject split.
    """
    out_schema = T.StructType(
        [f for f in df.schema.fields if f.name != content_col]
        + [T.StructField("answer_text", T.StringType()), T.StructField("error", T.StringType())]
    )
    keep = [f.name for f in df.schema.fields if f.name != content_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            answers, errors = [], []
            for content, name in zip(pdf[content_col], pdf[name_col]):
                try:
                    r = fn(content, name)
                    answers.append(r)
                    errors.append(None if r is not None else "no answer")
                except Exception as e:  # the hook owns its retries
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            res = pdf[keep].copy()
            res["answer_text"] = answers
            res["error"] = errors
            yield res

    return df.mapInPandas(run, out_schema)


def text_document(content: bytes, name: str) -> str:
    """The hook's function for documents that are the answer's text themselves (UTF-8)."""
    return bytes(content).decode("utf-8")
