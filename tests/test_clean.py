"""Reference assertion pairs for the scalar cleanup functions."""
import datetime as dt
import random

from conftest import one_col
from groundwork.functions import clean
from pyspark.sql import functions as F


def test_year(spark):
    got = one_col(spark, ["18", "14", "2018", "N/A", "", None, "99", " 7 ", "x18", "0"], clean.year)
    assert got == [2018, 2014, 2018, None, None, None, 2099, 2007, None, 2000]


def test_year_from_int(spark):
    assert one_col(spark, [18, 14, 99, 2018, None], clean.year, "int") == [2018, 2014, 2099, 2018, None]


def test_float(spark):
    got = one_col(spark, ["10.5", "10", "N/A", "", None, "X1", "10d", "1e3"], clean.float_or_null)
    assert got == [10.5, 10.0, None, None, None, None, None, 1000.0]


def test_float_zero(spark):
    assert one_col(spark, ["", "abc", "2.5"], clean.float_or_zero) == [0.0, 0.0, 2.5]


def test_hours(spark):
    got = one_col(spark, ["10 each", "10 /each", "10 man", "10", "10/man", "each"], clean.hours_text)
    assert got == ["10", "10", "10", "10", "10", "each"]


def test_month(spark):
    vals = ["JAN", "jan", "Jan", "FEB", "SEPT", "DEC", "JANUARY", "SEPTEMBER", None, ""]
    got = one_col(spark, vals, clean.month)
    assert got == ["JANUARY"] * 3 + ["FEBRUARY", "SEPTEMBER", "DECEMBER", "JANUARY", "SEPTEMBER", None, None]


def test_company(spark):
    vals = ["AE3 EXCAVATING", "AES EXCAVATING CORP", "ae3", "AEON", "aeon landscaping", "ADEO", "ado",
            "ANTHONY'S EXCAVATING", "anthony", "UNKNOWN COMPANY"]
    got = one_col(spark, vals, clean.company)
    assert got == ["AE3 Excavating"] * 3 + ["Aeon Landscaping"] * 2 + ["ADEO Contracting"] * 2 + \
        ["ANTHONY'S EXCAVATING & GRADING"] * 2 + ["N/A"]


def test_project(spark):
    got = one_col(spark, ["PINE  HURST", "PINEHURST Project/Phase 2", "PINEHURST PH 2"], clean.project)
    assert "  " not in got[0]
    assert "Project/Phase" not in got[1]
    assert "PH" in got[2].upper()


def test_dates(spark):
    got = one_col(spark, ["2024-01-05", "01/05/2024", "31/01/2024", "January 5, 2024", "24-01-05", "junk",
                          "0000-01-01", "01/01/0000", "January 1, 0000"], clean.date_multi)
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 31), dt.date(2024, 1, 5), None, None, None, None, None]


def test_work_date(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("MAY", 2018), ("FOO", 2018), ("MAY", None), ("DECEMBER", 20240)], "m string, y int")
    got = [r[0] for r in df.select(clean.work_date(F.col("m"), F.col("y"))).collect()]
    assert got == [dt.date(2018, 5, 1), None, None, None]


def test_norm_strips_all_whitespace(spark):
    assert one_col(spark, ["\t abc \n"], clean.norm) == ["ABC"]


def test_surrogate_key_matches_md5(spark):
    import hashlib
    from groundwork.functions import keys
    got = one_col(spark, ["Builder 1", None], keys.surrogate)
    assert got == [hashlib.md5(b"Builder 1").hexdigest(), hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()]


def test_strip_each_equals_strip_ws(spark):
    rng = random.Random(2)
    ends = [*clean.WS_CHARS, "", "!", "~", "\x7f", "\x00", "a", "é", "​", "\U0001f600"]
    texts = ["".join(rng.choices(ends, k=rng.randint(0, 3))) + rng.choice(["", "x", "x y", "é"]) + "".join(rng.choices(ends, k=rng.randint(0, 3))) for _ in range(1500)] + [None]
    got = one_col(spark, texts, lambda c: F.get(clean.strip_each(F.array(c)), 0))
    assert got == [t if t is None else t.strip(clean.WS_CHARS) for t in texts]
