"""Work-order tables derived from the driver's TPC-H-style parquet tables.

Mapping (see FIXTURES.md §2): one work order per order, project from the
order's part, service lines from the order's line items, builder from the
customer.  Everything is a lazy DataFrame over the given tables, so the work
grows with them; nothing here is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundwork.functions.clean import MONTHS, strip_ws

WIDE_LINES = 8  # four services x two lines on the paper form; longer orders go on to further forms

# Service category per (return flag, line status).
LINE_CATEGORY = {
    "AF": "Excavation",
    "AO": "Grading",
    "NF": "Hauling",
    "NO": "Backfill",
    "RF": "Sod Installation",
    "RO": "Snow Removal",
}

# Description phrases, picked by order key modulo their count.
DESCRIPTION_PHRASES = [
    "straw installation around lots",
    "haul to stockpile and spreading at stockpile",
    "basement excavation for new homes",
    "sod installation in rear yard",
    "snow clearing on road",
    "rough grade and releveling",
    "settlement repairs at curb",
    "driveway cut and concrete work",
    "general site cleanup",
    "grading work and topping up under structures",
    "loading fill from lots",
    "flagman for delivery",
]

# Service names a categorization model answers with, picked by
# (part key + line number) modulo their count.
ANSWER_SERVICES = [
    "Straw Installation",
    "Sod Installation",
    "Settlement Repairs",
    "Grading Work",
    "Haul From Lots",
    "Haul To Stockpile",
    "Loading Fill To Stockpile",
    "Basement Excavation",
    "Rough Grade",
    "Snow",
    "Miscellaneous",
    "Miscellaneous (debris)",
    "Tree Planting",
    "Settlement Repairs",
    "Loading Fill From Lots",
    "Concrete Work",
]

# Raw company spellings, picked by order key modulo 7.
COMPANY_SPELLINGS = [
    "AE3 EXCAVATING",
    "AES EXCAVATING CORP",
    "aeon landscaping",
    "AEON",
    "ado",
    "ANTHONY'S EXCAVATING",
    "UNKNOWN COMPANY",
]

DICTIONARY_MAX_BUILDER = 20  # builders 0..19 have a dictionary entry


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Slice:
    """One of `of` slices of a table's keys by their hash; the rows without a key are in one of them."""

    number: int
    of: int

    def has(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(self.of)) == self.number if self.of > 1 else F.lit(True)


def read_slice(spark: SparkSession, sf_dir: str, name: str, key: str, part: Slice | None) -> DataFrame:
    """The rows of a table whose key is in the slice; all without one."""
    df = read(spark, sf_dir, name)
    return df.where(part.has(key)) if part else df


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] (0-based) of a literal array; the last value for any other index or none."""
    return F.coalesce(F.get(F.array(*map(F.lit, values)), index.cast("int")), F.lit(values[-1]))


def line_category(flag: Column, status: Column) -> Column:
    known = F.create_map(*[F.lit(x) for item in sorted(LINE_CATEGORY.items()) for x in item])
    return F.try_element_at(known, F.concat(flag, status))


def line_order() -> WindowSpec:
    return Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )


def forms(lines: DataFrame, line: Column) -> tuple[DataFrame, list[Column]]:
    """The first line of each form, and `line` of the form's WIDE_LINES places in order (NULL where it has none).

    The lines after the first are read ahead in the window that ranks them, so a form is made without a grouping.
    """
    named = lines.withColumn("line", line)
    ahead = [F.lead("line", i).over(line_order()).alias(f"line{i + 1}") for i in range(1, WIDE_LINES)]
    first = named.select("*", *ahead).where((F.col("r") - 1) % WIDE_LINES == 0)
    return first, [F.col("line"), *[F.col(f"line{i + 1}") for i in range(1, WIDE_LINES)]]


def ranked_lines(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """Line items with their rank `r` in the order (a full tie-break), their `form` from 0 and the form's document id.

    A form has WIDE_LINES lines, so every line of an order stands on one of its forms.
    """
    li = read_slice(spark, sf_dir, "lineitem", "l_orderkey", part)
    ranked = li.withColumn("r", F.row_number().over(line_order()))
    return ranked.withColumn("form", F.floor((F.col("r") - 1) / WIDE_LINES).cast("int")).withColumn(
        "work_order_id", form_id(F.col("l_orderkey"), F.col("form")))


def form_id(order: Column, form: Column) -> Column:
    """WO-<order> for its first form (and orders without lines), WO-<order>-2 and so on for further ones."""
    more = F.when(form > 0, F.concat(F.lit("-"), (form + 1).cast("string"))).otherwise(F.lit(""))
    return F.concat(F.lit("WO-"), order.cast("string"), more)


def order_key(work_order_id: str = "work_order_id") -> Column:
    return F.regexp_extract(work_order_id, r"^WO-(\d+)", 1).cast("bigint")


def _order_base(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """Orders with their part (p_partkey = o_orderkey mod #parts)."""
    orders = read_slice(spark, sf_dir, "orders", "o_orderkey", part)
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    n_part = parts.agg(F.count(F.lit(1)).alias("n_part"))  # one row: broadcast is size-bounded
    o = orders.crossJoin(F.broadcast(n_part)).withColumn(
        "part_ref", F.col("o_orderkey") % F.col("n_part")
    )
    return o.join(parts, o.part_ref == parts.p_partkey, "left").drop("n_part", "part_ref")


def _order_fields(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    bn = F.floor(F.sqrt(c)).cast("bigint").cast("string")
    month_no = F.month("o_orderdate")
    full = _pick(month_no - 1, MONTHS)
    abbrev = F.when(month_no == 9, F.lit("SEPT")).otherwise(F.substring(full, 1, 3))
    yr = F.year("o_orderdate")
    base_project = F.concat_ws(" ", "p_brand", "p_type")
    return o.select(
        k.alias("o_orderkey"),
        F.when(k % 97 == 0, F.lit("N/A")).otherwise(k.cast("string")).alias("work_order_number"),
        F.when(k % 89 == 0, F.lit("N/A"))
        .otherwise(
            F.concat(
                F.when(k % 11 == 0, F.lit(" ")).otherwise(F.lit("")),
                F.when(c % 13 == 0, F.lit("Buildr ")).otherwise(F.lit("Builder ")),
                bn,
            )
        )
        .alias("builder_name"),
        F.when(k % 5 == 0, F.concat("p_brand", F.lit("  "), "p_type"))
        .when(k % 5 == 1, F.concat(base_project, F.lit(" Project/Phase")))
        .otherwise(base_project)
        .alias("project_name"),
        F.when(k % 2 == 1, full)
        .when(k % 4 == 0, F.lower(abbrev))
        .otherwise(abbrev)
        .alias("month"),
        yr.alias("year"),
        F.when((k % 3 == 0) & (yr >= 2000), F.lpad((yr % 100).cast("string"), 2, "0"))
        .otherwise(yr.cast("string"))
        .alias("year_text"),
        _pick(k % 7, COMPANY_SPELLINGS).alias("company_name"),
        F.when(k % 53 == 0, F.lit("N/A"))
        .otherwise(
            F.concat(
                F.when(k % 6 == 0, F.lit("  ")).otherwise(F.lit("")),
                F.col("p_name"),
                F.lit(": "),
                _pick(k % len(DESCRIPTION_PHRASES), DESCRIPTION_PHRASES),
            )
        )
        .alias("description"),
        F.concat(F.lit("files/wo_"), k.cast("string"), F.lit(".pdf")).alias("file_url"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(k % 86400).cast("decimal(18,6)"))).alias("extracted_at"),
    )


def _line_values() -> tuple[Column, Column, Column, Column]:
    """Category, date, quantity and hours of a line as the paper form has them."""
    cat = line_category(F.col("l_returnflag"), F.col("l_linestatus"))
    date_txt = F.date_format("l_shipdate", "yyyy-MM-dd")
    q_txt = F.when(F.col("l_partkey") % 10 == 0, F.lit("X1")).otherwise(
        F.col("l_quantity").cast("bigint").cast("string")
    )
    h_txt = F.concat(
        F.col("l_linenumber").cast("string"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit(" each")).otherwise(F.lit("")),
    )
    return cat, date_txt, q_txt, h_txt


def _wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per form: its ranked lines as columns."""
    li = ranked_lines(spark, sf_dir)
    cat, date_txt, q_txt, h_txt = _line_values()
    line = F.struct(
        cat.alias("cat"),
        date_txt.alias("dt"),
        q_txt.alias("qt"),
        h_txt.alias("ht"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity")).alias("qv"),
        F.col("l_linenumber").cast("double").alias("hv"),
    )
    per_form, places = forms(li, line)
    cols = [F.col("l_orderkey"), F.col("form")]
    for i, e in enumerate(places, 1):
        cols += [e[f].alias(f"{f}{i}") for f in ("cat", "dt", "qt", "ht", "qv", "hv")]
    return per_form.select(*cols)


def _place_labels(place: int) -> tuple[str, str, str, str]:
    """Labels of the service (with the first line of each two only), date, quantity and hours at a place from 0."""
    base = 8 + 7 * (place // 2)
    first = base + 1 + 3 * (place % 2)
    service = f"{base:02d}. Service{place // 2 + 1}: " if place % 2 == 0 else ""
    return (service, *(f"{first + j:02d}. {name}{place + 1}: " for j, name in enumerate("DQH")))


def _text_lines(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """One row per form: what the answer says of each of its places, as columns text1 to text8.

    A line's text is made before the forms are, so that one text per place moves with a form.
    """
    labels = [*zip(*map(_place_labels, range(WIDE_LINES)))]
    place = ((F.col("r") - 1) % WIDE_LINES).cast("int")
    label = lambda texts: F.get(F.array(*map(F.lit, texts)), place)
    cat, *values = _line_values()
    na = F.lit("N/A")
    said = [F.when(place % 2 == 0, F.concat(label(labels[0]), F.coalesce(cat, na)))]
    said += [F.concat(label(texts), F.coalesce(v, na)) for texts, v in zip(labels[1:], values)]
    per_form, places = forms(ranked_lines(spark, sf_dir, part), F.concat_ws("\n", *said))
    return per_form.select("l_orderkey", "form", *[p.alias(f"text{i + 1}") for i, p in enumerate(places)])


def _with_forms(spark: SparkSession, sf_dir: str, per_form: DataFrame, part: Slice | None = None) -> DataFrame:
    """The fields of every order with each of its forms."""
    o = _order_fields(_order_base(spark, sf_dir, part))
    j = o.join(per_form, o.o_orderkey == per_form.l_orderkey, "left").drop("l_orderkey")
    return j.withColumn("work_order_id", form_id(F.col("o_orderkey"), F.col("form"))).drop("form")


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_forms(spark, sf_dir, _wide_lines(spark, sf_dir))


RAW_COLUMNS = (
    ["work_order_id", "work_order_number", "builder_name", "project_name", "month", "year",
     "company_name", "description", "file_url", "extracted_at"]
    + [f"service{k}" for k in range(1, 5)]
    + [f"{p}{i}" for i in range(1, 9) for p in ("d", "q", "h")]
)


def raw_work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 38-column raw table, as the extraction step would have loaded it."""
    ow = _orders_with_lines(spark, sf_dir)
    cols = [F.col(c) for c in RAW_COLUMNS[:10]]
    for k in range(1, 5):
        cols.append(F.coalesce(F.col(f"cat{2 * k - 1}"), F.lit("N/A")).alias(f"service{k}"))
    for i in range(1, 9):
        cols += [
            F.coalesce(F.col(f"dt{i}"), F.lit("N/A")).alias(f"d{i}"),
            F.col(f"qv{i}").alias(f"q{i}"),
            F.col(f"hv{i}").alias(f"h{i}"),
        ]
    return ow.select(*cols)


def _field_line(num: int, label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{num:02d}. {label}: "), F.coalesce(value, F.lit("N/A")))


def answer_texts(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """Numbered answer text per document (what the extraction hook returns).

    Some answers carry a header line, a continuation line and an early
    duplicate of field 2 (the later value must win).
    """
    ow = _with_forms(spark, sf_dir, _text_lines(spark, sf_dir, part), part)
    k = F.col("o_orderkey")
    lines = [
        F.when(k % 10 == 3, F.lit("Here is the extracted data:")).otherwise(F.lit("")),
        F.when(k % 10 == 3, F.lit("02. Builder Name: DRAFT")).otherwise(F.lit("")),
        _field_line(1, "WO NO.", F.col("work_order_number")),
        _field_line(2, "Builder Name", F.col("builder_name")),
        _field_line(3, "Project Name", F.col("project_name")),
        _field_line(4, "Month", F.col("month")),
        _field_line(5, "Year", F.col("year_text")),
        _field_line(6, "Company", F.col("company_name")),
        _field_line(7, "Description", F.col("description")),
        F.when(k % 10 == 7, F.lit("   (continued on back)")).otherwise(F.lit("")),
    ]
    empty = ["\n".join(f"{label}N/A" for label in _place_labels(i) if label) for i in range(WIDE_LINES)]
    lines += [F.coalesce(f"text{i + 1}", F.lit(none)) for i, none in enumerate(empty)]
    text = F.concat_ws("\n", *lines)
    return ow.select(
        "work_order_id",
        "file_url",
        "extracted_at",
        text.alias("answer_text"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer texts as documents (bytes); every 43rd is no UTF-8."""
    a = answer_texts(spark, sf_dir)
    content = F.when(order_key() % 43 == 0, F.unhex(F.lit("FF"))).otherwise(F.encode("answer_text", "UTF-8"))
    return a.select("work_order_id", "file_url", "extracted_at", content.alias("content"))


def category_answers(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """Service-block answer per work order (what a categorization hook returns).

    Every line of the form is a block, in ranked order.
    """
    li = ranked_lines(spark, sf_dir, part)
    name = _pick((F.col("l_partkey") + F.col("l_linenumber")) % len(ANSWER_SERVICES), ANSWER_SERVICES)
    blocks = F.when(F.col("l_suppkey") % 5 == 0, F.lit("Not specified")).otherwise(
        F.concat(F.lit("Lot "), (F.col("l_partkey") % 20).cast("string"))
    )
    block = F.concat(
        F.lit("Service: "),
        name,
        F.when(F.col("l_suppkey") % 7 == 0, F.lit("")).otherwise(
            F.concat(F.lit("\nBlocks/Lots/Units: "), blocks)
        ),
    )
    per_form, places = forms(li, block)
    return per_form.select("work_order_id", F.concat_ws("\n\n", *places).alias("answer_text"))


def service_line_source(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """Every line item as a priced service line of its form."""
    li = ranked_lines(spark, sf_dir, part)
    return li.select(
        "work_order_id",
        F.col("l_linenumber").alias("line_no"),
        line_category(F.col("l_returnflag"), F.col("l_linestatus")).alias("service_category"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("total_service_hours"),
        # exact decimal arithmetic, rounded half-up to cents, then double
        F.round(F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(6,4)")), 2)
        .cast("double").alias("estimated_service_value"),
    )


def builder_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed-shaped dictionary over every builder name of the customer table.

    'Builder k' -> 'BUILDER GROUP k/2' (confidence 0.9) for k < 20, else the
    name itself (confidence 1.0); misspelled names are left to fuzzy matching.
    """
    cust = read(spark, sf_dir, "customer")
    k = F.floor(F.sqrt("c_custkey")).cast("bigint")
    ks = cust.select(k.alias("k")).distinct()
    name = F.concat(F.lit("Builder "), F.col("k").cast("string"))
    grouped = F.col("k") < DICTIONARY_MAX_BUILDER
    return ks.select(
        name.alias("original_name"),
        F.when(grouped, F.concat(F.lit("BUILDER GROUP "), (F.col("k") / 2).cast("bigint").cast("string")))
        .otherwise(name)
        .alias("corrected_name"),
        F.when(grouped, F.lit(0.9)).otherwise(F.lit(1.0)).alias("confidence_score"),
    )


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline stage log: stage = event type, duration = value, success unless error."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("stage"),
        F.col("value").alias("duration_s"),
        (F.col("event_type") != "error").alias("success"),
    )


def json_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-style extraction answers built from the raw work orders.

    Every 4th answer is wrapped in a ```json fence, every 19th is cut short
    (invalid JSON), and every 23rd has an empty project name.
    """
    from groundwork.operators.extract import service_array

    raw = raw_work_orders(spark, sf_dir)
    k = order_key()
    services = F.transform(service_array(), lambda s: F.struct(
        s["service_type"].alias("service_type"), s["date"].alias("date"),
        s["quantity"].cast("string").alias("quantity"), s["hours"].cast("string").alias("hours")))
    body = F.to_json(F.struct(
        F.col("work_order_number"), F.col("builder_name"),
        F.when(k % 23 == 0, F.lit("")).otherwise(F.col("project_name")).alias("project_name"),
        F.col("month"), F.col("year").cast("string").alias("year"), F.col("company_name"),
        F.col("description"), services.alias("services")))
    text = (F.when(k % 19 == 0, F.substring(body, 1, 40))
            .when(k % 4 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
            .otherwise(body))
    return raw.select("work_order_id", text.alias("answer_text"))


RECORD_END = "\x1e"


def write_answer_records(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The JSON answers as files of records, with text after the object (every 37th) and a number 0 as year (every 41st)."""
    a = json_answers(spark, sf_dir)
    k = order_key()
    text = (F.when(k % 37 == 0, F.concat("answer_text", F.lit(" trailing")))
            .when(k % 41 == 0, F.regexp_replace("answer_text", r'"year":"[0-9]*"', '"year":0'))
            .otherwise(F.col("answer_text")))
    a.select(text.alias("value")).write.option("lineSep", RECORD_END).text(path)


def revised(with_ml: DataFrame, cut) -> DataFrame:
    """A second extraction of every 50th order up to `cut`: extracted 4000 days later, for January, with another text."""
    k = order_key()
    old = with_ml.where((k % 50 == 0) & (F.col("extracted_at") <= F.lit(cut)))
    return old.withColumn("extracted_at", F.col("extracted_at") + F.expr("INTERVAL 4000 DAYS")).withColumn(
        "month", F.lit("JANUARY")).withColumn("description", F.concat(F.lit("REVISED "), strip_ws("description")))


def redelivered_events(spark: SparkSession, sf_dir: str, path: str, files: int = 8) -> T.StructType:
    """The events as files of a stream, in event order and out of it: every third one comes again in the next files."""
    ev = read(spark, sf_dir, "events")
    ev.repartitionByRange(files, F.col("event_id") % 7).write.mode("append").parquet(path)
    ev.where(F.col("event_id") % 3 == 0).repartitionByRange(files, F.col("ts").desc()).write.mode("append").parquet(path)
    return ev.schema


def changed_events(ev: DataFrame) -> DataFrame:
    """Later versions of every 7th event: a day later, with another type."""
    return ev.where(F.col("event_id") % 7 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).withColumn(
        "event_type", F.concat("event_type", F.lit("-changed")))
