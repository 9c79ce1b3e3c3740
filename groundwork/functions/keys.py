"""Surrogate and document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundwork.functions.util import as_col

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate(*cols) -> Column:
    """md5 hex of the fields (NULL -> fixed token) joined with '-'."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def document_id(number, extracted_at) -> Column:
    """<number or UNKNOWN>_<epoch millis of extraction>; deterministic per row."""
    num = as_col(number)
    num = F.when(num.isNull() | (num == "") | (num == "N/A"), F.lit("UNKNOWN")).otherwise(num)
    millis = F.unix_millis(as_col(extracted_at).cast("timestamp"))
    return F.concat_ws("_", num, millis.cast("string"))
