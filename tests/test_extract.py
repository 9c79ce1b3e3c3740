"""Numbered-answer parsing (H6, B1, H8) and JSON answers."""
from pyspark.sql import functions as F

from groundwork.operators import extract


def test_parse_fields(spark, sample_answer):
    df = spark.createDataFrame([(sample_answer,)], "t string")
    p = df.select(extract.by_position(extract.parse_fields(F.col("t"))).alias("p"))
    r = p.select(*[extract.field(F.col("p"), k).alias(f"f{k}") for k in (1, 2, 4, 8, 10)]).first()
    assert (r.f1, r.f2, r.f4, r.f8, r.f10) == ("77-031", "NORTHGATE LIVING", "OCTOBER", "SKID STEER", "X1")


def test_last_duplicate_wins_and_junk_lines(spark):
    text = "Header: x\n02. Builder Name: DRAFT\nno colon here\n02. Builder Name: REAL\n 5 . Year: 18 \nab.c: 1"
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(extract.parse_fields(F.col("t")).alias("p")).withColumn("f", extract.by_position("p")).select(
        extract.field(F.col("f"), 2).alias("b"), extract.field(F.col("f"), 5).alias("y"),
        extract.field(F.col("f"), 9).alias("none"), extract.field(F.col("f"), 9, default=None).alias("null"),
        F.size("p").alias("n")).first()
    assert r.b == "REAL" and r.y == "18" and r.n == 3 and r.none == "N/A" and r.null is None
    empty = spark.createDataFrame([(None,), ("",)], "t string").select(extract.by_position(extract.parse_fields(F.col("t"))).alias("f"))
    assert [x.v for x in empty.select(extract.field(F.col("f"), 1).alias("v")).collect()] == ["N/A", "N/A"]


def test_to_raw_row(spark, sample_answer):
    df = spark.createDataFrame([("WO-1", sample_answer, "f.pdf")], "work_order_id string, answer_text string, file_url string")
    df = df.withColumn("extracted_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    r = extract.to_raw_row(df).first()
    assert len(r) == 38
    assert r.year == 2021 and r.q1 is None and r.h1 == 6.5 and r.service3 == "N/A" and r.d4 == "N/A"
    lines = extract.service_lines(extract.to_raw_row(df)).orderBy("line_no").collect()
    # service1 has two lines (D2 set), service2 one line (D4 is N/A)
    assert [(x.line_no, x.service_type) for x in lines] == [(1, "SKID STEER"), (2, "SKID STEER"), (3, "DUMP TRAILER")]


def test_parse_json(spark):
    good = '```json\n{"work_order_number": "7", "builder_name": "B", "project_name": "", "services": ' \
           '[{"service_type": "Grade", "date": "01/05/2024", "quantity": "2", "hours": "x"}, {"service_type": ""}]}\n```'
    df = spark.createDataFrame([(good,), ("not json",)], "answer_text string")
    out = extract.parse_json(df).select(
        "is_valid",
        extract.normalize_services(F.col("answer.services")).alias("s"),
        extract.missing_fields(F.col("answer")).alias("missing"),
        extract.extraction_score(F.col("answer")).alias("score"),
    ).collect()
    assert out[0].is_valid and not out[1].is_valid
    assert len(out[0].s) == 1 and out[0].s[0].quantity == 2.0 and out[0].s[0].hours == 0.0
    assert str(out[0].s[0].date) == "2024-01-05"
    assert out[0].missing == ["project_name"]
    assert abs(out[0].score - (2 / 7 + 0.1)) < 1e-9  # two raw services count toward the bonus


def test_apply_model_hook(spark):
    df = spark.createDataFrame([("a.pdf", b"12"), ("b.pdf", b"")], "path string, content binary")

    def fn(content, name):
        if not content:
            raise RuntimeError("empty")
        return f"01. WO NO.: {content.decode()}"

    out = extract.apply_model(df, fn).orderBy("path").collect()
    assert out[0].answer_text == "01. WO NO.: 12" and out[0].error is None
    assert out[1].answer_text is None and "empty" in out[1].error
