"""Scalar cleanup expressions (Column -> Column), all JVM-side built-ins.

Every function here is a pure expression builder: it never touches data,
so it composes into one `select` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundwork.functions.util import as_col

NA = "N/A"

# Calendar month names (upper case, January first).
MONTHS = [
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]

# Numeric text accepted by the Python parsers (Spark alone would also accept
# suffixes such as "10d", so the cast is guarded).
FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INT_RE = r"^[+-]?[0-9]+$"
_FLOAT = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_INT = r"[+-]?[0-9]+"


# Blanks removed by strip_ws: ASCII white space and the Unicode blanks that occur in text from documents.
WS_CHARS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c) -> Column:
    """Remove all leading/trailing whitespace (Python str.strip), no regex."""
    return F.btrim(as_col(c), F.lit(WS_CHARS))


def strip_trimmed(text: Column) -> Column:
    """`strip_ws` of a text without spaces around it. Between visible ASCII nothing is left to remove, so that most texts
    are not compared with every blank; the text is read several times and should be computed before."""
    visible = (text >= "!") & (text < "\x7f") & F.substring(text, -1, 1).between("!", "~")
    return F.when(visible, text).otherwise(strip_ws(text))


def strip_each(texts) -> Column:
    """`strip_ws` of every element of an array of texts."""
    return F.transform(F.transform(as_col(texts), lambda t: F.trim(t)), strip_trimmed)


# The same blanks as a regex class; visible ASCII, which most text is, is told apart first.
WS_RANGES = r" \t\n\x0b-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_CLASS = f"[[^!-~]&&[{WS_RANGES}]]"
BLANKS_IN_LINE = WS_CLASS.replace(r"\n", "") + "*+"


def _number_text(c, number: str) -> Column:
    """The text of a number between blanks, '' where the text is no such number: one search instead of strip and match."""
    text = as_col(c).cast("string")
    return F.when(text != NA, F.regexp_extract(text, rf"\A{WS_CLASS}*+({number}){WS_CLASS}*+\z", 1))  # the marker needs no search


def norm(c) -> Column:
    """Comparison key UPPER(TRIM(x)); TRIM strips any whitespace."""
    return F.upper(strip_ws(c))


def is_falsy_text(c) -> Column:
    """NULL, '' or the in-band 'N/A' marker."""
    c = as_col(c)
    return c.isNull() | (c == "") | (c == NA)


def na_to_null(c) -> Column:
    """'N/A' / '' / NULL -> NULL, otherwise the trimmed text."""
    t = strip_ws(as_col(c))
    return F.when(~is_falsy_text(t), t)


def year(c) -> Column:
    """Year text/number -> int; values below 100 get 2000 added; junk -> NULL."""
    t = _number_text(c, _INT)
    # the type is known while the query is planned: an int column is read as it is
    v = F.when(F.typeof(as_col(c)) == "int", as_col(c).try_cast("int")).otherwise(F.when(t != "", t.try_cast("int")))
    # a number 0 is no year; the text "0" is 2000
    v = F.when((F.typeof(as_col(c)) != "string") & (v == 0), None).otherwise(v)
    return F.when(v < 100, v + 2000).otherwise(v)


# Unit suffixes of hours, in the reference's order.
HOUR_UNITS = (" each", " /each", "/each", " man", " /man", "/man")


def hours_text(c) -> Column:
    """Strip unit suffixes from an hours value, in the reference's order."""
    text = as_col(c)
    out = text
    for token in HOUR_UNITS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return F.when(text.contains("each") | text.contains("man"), out).otherwise(text)  # most texts name no unit


def float_text(c) -> Column:
    """The text of a number, '' or NULL where there is none."""
    return _number_text(c, _FLOAT)


def float_of(text) -> Column:
    """The double of a `float_text`."""
    t = as_col(text)
    return F.when(t != "", t.try_cast("double"))


def float_or_null(c) -> Column:
    """Falsy, 'N/A' or non-numeric text -> NULL, else double."""
    return float_of(float_text(c))


def float_or_zero(c) -> Column:
    return F.coalesce(float_or_null(c), F.lit(0.0))


def int_or_zero(c) -> Column:
    t = strip_ws(as_col(c).cast("string"))
    return F.coalesce(F.when(t.rlike(INT_RE), t.try_cast("bigint")), F.lit(0).cast("bigint"))


def date_multi(c) -> Column:
    """First format that parses wins: ISO, US, day-first, long English form; there is no year 0."""
    t = as_col(c)
    return F.coalesce(
        F.when(t.rlike(r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$"), F.try_to_date(t, "M/d/yyyy")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$"), F.try_to_date(t, "d/M/yyyy")),
        F.when(t.rlike(r"^[A-Za-z]+ \d{1,2}, (?!0000)\d{4}$"), F.try_to_date(t, "MMMM d, yyyy")),
    )


def month(c) -> Column:
    """Abbreviated or full month name in any case -> full upper-case name."""
    u = F.upper(strip_ws(as_col(c)))
    spellings = {s: name for name in MONTHS for s in (name, name[:3])} | {"SEPT": "SEPTEMBER"}
    # one literal map: a chain of conditions made the generated method too long to be compiled
    out = F.try_element_at(F.create_map(*[F.lit(x) for item in spellings.items() for x in item]), u)
    # unknown text passes through unchanged, empty text is NULL
    return F.when(u == "", F.lit(None)).otherwise(F.coalesce(out, u))


def month_number(c) -> Column:
    """Full upper-case month name -> 1..12, else NULL."""
    u = as_col(c)
    out = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(MONTHS, start=1))):
        out = F.when(u == name, F.lit(i)).otherwise(out)
    return out


# Company keyword rules, evaluated in this order.
COMPANY_RULES = [
    (["AE3", "AES EXCAVATING"], "AE3 Excavating"),
    (["AEON"], "Aeon Landscaping"),
    (["ADEO", "ADO"], "ADEO Contracting"),
    (["ANTHONY"], "ANTHONY'S EXCAVATING & GRADING"),
]


def company(c) -> Column:
    u = F.upper(F.coalesce(as_col(c), F.lit("")))
    out = F.lit(NA)
    for keys, name in reversed(COMPANY_RULES):
        cond = None
        for k in keys:
            cond = u.contains(k) if cond is None else (cond | u.contains(k))
        out = F.when(cond, F.lit(name)).otherwise(out)
    return out


def project(c) -> Column:
    """Remove the literal 'Project/Phase', collapse whitespace runs, trim."""
    t = F.replace(as_col(c), F.lit("Project/Phase"), F.lit(""))
    return strip_ws(F.regexp_replace(t, r"\s+", " "))


def builder_base(c) -> Column:
    """Falsy builder text -> 'N/A'; otherwise the trimmed text (matching is separate)."""
    return F.when(is_falsy_text(strip_ws(as_col(c))), F.lit(NA)).otherwise(strip_ws(as_col(c)))


def work_date(month_col, year_col) -> Column:
    """First day of the month from a full month name and a year; else NULL."""
    m = month_number(month_col)
    y = as_col(year_col).cast("int")
    return F.when(m.isNotNull() & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def preview(c, n: int) -> Column:
    return F.substring(as_col(c), 1, n)
