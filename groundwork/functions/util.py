from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, fn) -> Column:
    """fn(value) with the value computed once, however often `fn` reads it."""
    return F.get(F.transform(F.array(as_col(value)), fn), F.lit(0))
