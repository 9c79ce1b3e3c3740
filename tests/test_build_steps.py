"""The shared steps of the raw build: fields parsed once, forms without a grouping, numbers without exceptions."""
import random
import re

from groundwork.functions import clean
from groundwork.operators import correct, extract
from groundwork.sources import fixture
from pyspark.sql import functions as F
from tests.conftest import one_col


def plain_fields(text):
    out = []
    for line in text.split("\n"):
        head, colon, value = line.partition(":")
        number = head.split(".")[0].strip(clean.WS_CHARS)
        if colon and number.lstrip("+-").isascii() and number.lstrip("+-").isdigit() and len(number.lstrip("+-")) >= len(number) - 1 and abs(int(number)) < 2**31:
            out.append((int(number), value.strip(clean.WS_CHARS)))
    return out


def test_fields_equal_a_plain_loop(spark):
    rng = random.Random(5)
    parts = [" ", "\t", "\n", "\r", "\xa0", "\u2003", "\x85", ".", ":", ":", "1", "07", "+", "-", "\u00e9", "N/A", "99999999999"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(800)]
    got = one_col(spark, texts, extract.parse_fields)
    assert [[(x.num, x.value) for x in r] for r in got] == [plain_fields(t) for t in texts]


def test_number_texts(spark):
    texts = ["3", "\xa0 4.5\r", ".5", "1e2", "5d", "N/A", "", " ", None, "1 2", "\x007"]
    assert one_col(spark, texts, clean.float_or_null) == [3.0, 4.5, 0.5, 100.0, None, None, None, None, None, None, None]
    assert one_col(spark, [" 21\t", "1999", "5.0", "", None, "99999999999"], clean.year) == [2021, 1999, None, None, None, None]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_is_split_once_for_all_fields(spark, sample_answer):
    df = spark.createDataFrame([("WO-1", sample_answer, "f.pdf")], "work_order_id string, answer_text string, file_url string")
    df = df.withColumn("extracted_at", F.lit("2024-01-01 00:00:00").cast("timestamp")).repartition(2)
    assert plan_of(extract.to_raw_row(df)).count("split(answer_text") == 1


def test_forms_need_no_grouping(spark, tmp_path):
    """19 lines of one order, shuffled, and lines without an order: forms of 8, 8 and 3 lines in their order."""
    n = 19
    rows = [(7, p, 1, k, 1.0, 10.0, 0.1, 0.0, "A", "F", "2024-01-01") for k, p in zip(range(n), range(101, 101 + n))] + [(None, 1, 1, 0, 1.0, 1.0, 0.1, 0.0, None, "F", None)]
    random.Random(1).shuffle(rows)
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    kinds = ["long", "long", "long", "int", "double", "double", "double", "double", "string", "string", "string"]
    df = spark.createDataFrame(rows, ", ".join(f"{a} {b}" for a, b in zip(names, kinds))).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/lineitem.parquet")
    wide = fixture._wide_lines(spark, str(tmp_path))
    assert "Aggregate" not in plan_of(wide)
    got = {r.form: [r[f"hv{i}"] for i in range(1, 9)] for r in wide.where("l_orderkey = 7").collect()}
    assert got == {0: [float(x) for x in range(8)], 1: [float(x) for x in range(8, 16)], 2: [16.0, 17.0, 18.0] + [None] * 5}
    answers = fixture.category_answers(spark, str(tmp_path))
    assert "Aggregate" not in plan_of(answers)
    blocks = {r.work_order_id: r.answer_text.split("\n\n") for r in answers.where("work_order_id is not null").collect()}
    assert {k: len(v) for k, v in blocks.items()} == {"WO-7": 8, "WO-7-2": 8, "WO-7-3": 3}
    assert blocks["WO-7-3"][0].endswith(f"Blocks/Lots/Units: Lot {117 % 20}")


def test_raw_rows_equal_a_plain_loop(spark):
    """The last line of a number wins, however the number is written; numbers no field has and other lines are left out."""
    rng = random.Random(9)
    heads = ["2", "02", "+2", " 002 ", "9", "09.", "9. D1", "0", "-2", "2.5", "22", "99999999999", "2x", "", "\xa02", "2\r. x"]
    texts = ["\n".join(f"{rng.choice(heads)}{rng.choice([':', ': ', ' ', '::'])}{rng.choice(['a', ' b ', 'N/A', '', 'c:d'])}" for _ in range(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame([(str(i), t, "f") for i, t in enumerate(texts)] + [("none", None, "f")], "work_order_id string, answer_text string, file_url string")
    df = df.withColumn("extracted_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = {r.work_order_id: (r.builder_name, r.d1) for r in extract.to_raw_row(df).collect()}
    assert got.pop("none") == ("N/A", "N/A")
    want = [dict(plain_fields(t)) for t in texts]
    assert [got[str(i)] for i in range(len(texts))] == [(w.get(2, "N/A"), w.get(9, "N/A")) for w in want]


def largest_method(spark, df):
    """Bytes of the largest method that Spark generates for a plan; the JVM compiles none of more than 8000."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan)))


def test_generated_methods_are_small_enough_to_be_compiled(spark, tmp_path, sample_answer):
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp", (1, 1, None)),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string", (1, "a", "b", "c")),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp", (1, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", None)),
    }
    for name, (schema, row) in tables.items():
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    answers = fixture.answer_texts(spark, str(tmp_path))
    assert largest_method(spark, answers) < 8000
    raw = extract.to_raw_row(answers)
    assert largest_method(spark, raw) < 8000
    raw.write.parquet(f"{tmp_path}/raw")
    dictionary = spark.createDataFrame([("B", "C", 1.0)], "original_name string, corrected_name string, confidence_score double")
    assert largest_method(spark, correct.correct(spark.read.parquet(f"{tmp_path}/raw"), dictionary)) < 8000
    assert [r.d1 for r in raw.collect()] == ["N/A"]


def test_labels_of_places():
    assert [fixture._place_labels(i) for i in (0, 3, 7)] == [
        ("08. Service1: ", "09. D1: ", "10. Q1: ", "11. H1: "), ("", "19. D4: ", "20. Q4: ", "21. H4: "), ("", "33. D8: ", "34. Q8: ", "35. H8: ")]


def test_fields_are_read_without_a_lambda_per_line(spark):
    """Fields, quantities and hours of random answers equal a plain loop; no interpreted lambda runs over the lines."""
    rng = random.Random(11)
    said = ["3", " 4.5\xa0", "2 each", "7 /man", "1e2", "5d", "X1", "N/A", "", "man", " .5", "1:2", "�"]
    texts = ["\n".join(f"{rng.choice(['', ' ', '0'])}{n}{rng.choice(['.', '. Q', ''])}:{rng.choice(said)}" for n in rng.choices(range(-1, 38), k=60)) for _ in range(200)]
    df = spark.createDataFrame([(str(i), t, "f") for i, t in enumerate([*texts, ""])] + [("none", None, "f")], "work_order_id string, answer_text string, file_url string")
    raw = extract.to_raw_row(df.withColumn("extracted_at", F.lit("2024-01-01 00:00:00").cast("timestamp")))
    assert "lambda" not in plan_of(raw)
    got = {r.work_order_id: r for r in raw.collect()}
    assert got["none"][1:8] == got[str(len(texts))][1:8] == ("N/A", "N/A", "N/A", "N/A", None, "N/A", "N/A")

    def number(text):
        for unit in (" each", " /each", "/each", " man", " /man", "/man"):
            text = text.replace(unit, "")
        text = text.strip(clean.WS_CHARS)
        return float(text) if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", text) else None

    for i, t in enumerate(texts):
        fields, r = dict(plain_fields(t)), got[str(i)]
        assert [r.project_name, r.service4, r.d8] == [fields.get(k, "N/A") for k in (3, 29, 33)]
        for line in range(1, 9):
            base = 9 + 7 * ((line - 1) // 2) + 3 * ((line - 1) % 2)
            q, h = (fields.get(base + j, "N/A") for j in (1, 2))
            assert (r[f"q{line}"], r[f"h{line}"]) == (number(q) if q[-1:] not in ("h", "n") else None, number(h))


def test_fields_of_no_lines():
    import pyarrow as pa
    got = extract._fields_of_lines(pa.array([], pa.list_(pa.string())))
    assert len(got) == 0
    one = extract._fields_of_lines(pa.array([None, []], pa.list_(pa.string()))).to_pylist()
    assert one == [{"texts": ["N/A"] * 35, "quantities": [None] * 8, "hours": [None] * 8}] * 2
