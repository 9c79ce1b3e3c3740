"""Independent DuckDB SQL for every checked query.

Written directly in DuckDB SQL (window functions, unnest, list_reduce) from
the operator semantics, not generated from the Spark plans.  The shared part
is only the test-table mapping (which rows become which work orders).
Tables are the pre-registered views: orders, lineitem, part, customer, events.
"""

from __future__ import annotations

from groundwork.operators import vocab as V
from groundwork.sources import fixture as FX

AS_OF = "DATE '2001-07-31'"
RUN_TS = "TIMESTAMP '2001-07-31 00:00:00'"
NL = "chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ws(x: str) -> str:
    """Strip all leading/trailing whitespace."""
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _line_category(flag: str, status: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in FX.LINE_CATEGORY.items())
    return f"(CASE {flag} || {status} {whens} END)"


# ---------------------------------------------------------------- fixture --

def _fixture_ctes() -> list[str]:
    k = "o.o_orderkey"
    months = lst(["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST",
                  "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"])
    full = f"{months}[month(o.o_orderdate)]"
    abbrev = f"(CASE WHEN month(o.o_orderdate) = 9 THEN 'SEPT' ELSE substr({full}, 1, 3) END)"
    comp = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(FX.COMPANY_SPELLINGS))
    phrases = lst(FX.DESCRIPTION_PHRASES)
    yr = "year(o.o_orderdate)"
    ctes = [
        "np AS (SELECT count(*) AS n FROM part)",
        f"""ofx AS (
  SELECT {k} AS o_orderkey,
    'WO-' || CAST({k} AS VARCHAR) AS work_order_id,
    CASE WHEN {k} % 97 = 0 THEN 'N/A' ELSE CAST({k} AS VARCHAR) END AS work_order_number,
    CASE WHEN {k} % 89 = 0 THEN 'N/A' ELSE
      (CASE WHEN {k} % 11 = 0 THEN ' ' ELSE '' END)
      || (CASE WHEN o.o_custkey % 13 = 0 THEN 'Buildr ' ELSE 'Builder ' END)
      || CAST(CAST(floor(sqrt(o.o_custkey)) AS BIGINT) AS VARCHAR) END AS builder_name,
    CASE WHEN {k} % 5 = 0 THEN p.p_brand || '  ' || p.p_type
         WHEN {k} % 5 = 1 THEN p.p_brand || ' ' || p.p_type || ' Project/Phase'
         ELSE p.p_brand || ' ' || p.p_type END AS project_name,
    CASE WHEN {k} % 2 = 1 THEN {full} WHEN {k} % 4 = 0 THEN lower({abbrev}) ELSE {abbrev} END AS month,
    CAST({yr} AS INTEGER) AS year,
    CASE WHEN {k} % 3 = 0 AND {yr} >= 2000 THEN lpad(CAST({yr} % 100 AS VARCHAR), 2, '0')
         ELSE CAST({yr} AS VARCHAR) END AS year_text,
    CASE {k} % 7 {comp} END AS company_name,
    CASE WHEN {k} % 53 = 0 THEN 'N/A' ELSE
      (CASE WHEN {k} % 6 = 0 THEN '  ' ELSE '' END) || p.p_name || ': '
      || {phrases}[CAST({k} % {len(FX.DESCRIPTION_PHRASES)} AS INTEGER) + 1] END AS description,
    'files/wo_' || CAST({k} AS VARCHAR) || '.pdf' AS file_url,
    o.o_orderdate + to_seconds(CAST({k} % 86400 AS BIGINT)) AS extracted_at
  FROM orders o CROSS JOIN np LEFT JOIN part p ON p.p_partkey = o.o_orderkey % np.n)""",
        """rl AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS r
  FROM lineitem)""",
        """rf AS (
  SELECT *, (r - 1) // 8 AS form, (r - 1) % 8 + 1 AS slot,
    'WO-' || CAST(l_orderkey AS VARCHAR) || CASE WHEN r > 8 THEN '-' || CAST((r - 1) // 8 + 1 AS VARCHAR) ELSE '' END AS form_id
  FROM rl)""",
    ]
    cat = _line_category("l_returnflag", "l_linestatus")
    cols = []
    for i in range(1, 9):
        cols += [
            f"max(CASE WHEN slot = {i} THEN {cat} END) AS cat{i}",
            f"max(CASE WHEN slot = {i} THEN strftime(l_shipdate, '%Y-%m-%d') END) AS dt{i}",
            f"max(CASE WHEN slot = {i} THEN (CASE WHEN l_partkey % 10 = 0 THEN 'X1' "
            f"ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END) END) AS qt{i}",
            f"max(CASE WHEN slot = {i} THEN CAST(l_linenumber AS VARCHAR) || "
            f"(CASE WHEN l_suppkey % 4 = 0 THEN ' each' ELSE '' END) END) AS ht{i}",
            f"max(CASE WHEN slot = {i} AND l_partkey % 10 <> 0 THEN l_quantity END) AS qv{i}",
            f"max(CASE WHEN slot = {i} THEN CAST(l_linenumber AS DOUBLE) END) AS hv{i}",
        ]
    ctes.append("wide AS (SELECT l_orderkey, form_id, " + ",\n  ".join(cols) + " FROM rf GROUP BY l_orderkey, form_id)")
    ctes.append("ow AS (SELECT ofx.* REPLACE (coalesce(wide.form_id, ofx.work_order_id) AS work_order_id), wide.* EXCLUDE (form_id)\n"
                "  FROM ofx LEFT JOIN wide ON ofx.o_orderkey = wide.l_orderkey)")
    # the raw table comes from parsed answers, whose values are stripped
    raw_cols = ["work_order_id", "work_order_number", f"{ws('builder_name')} AS builder_name", "project_name", "month", "year",
                "company_name", f"{ws('description')} AS description", "file_url", "extracted_at"]
    for s in range(1, 5):
        raw_cols.append(f"coalesce(cat{2 * s - 1}, 'N/A') AS service{s}")
    for i in range(1, 9):
        raw_cols += [f"coalesce(dt{i}, 'N/A') AS d{i}", f"qv{i} AS q{i}", f"hv{i} AS h{i}"]
    ctes.append("raw AS (SELECT " + ", ".join(raw_cols) + " FROM ow)")
    # category answers: every ranked line as a service block
    n_svc = len(FX.ANSWER_SERVICES)
    svc = f"{lst(FX.ANSWER_SERVICES)}[CAST((l_partkey + l_linenumber) % {n_svc} AS INTEGER) + 1]"
    blocks = "(CASE WHEN l_suppkey % 5 = 0 THEN 'Not specified' ELSE 'Lot ' || CAST(l_partkey % 20 AS VARCHAR) END)"
    block = (f"'Service: ' || {svc} || (CASE WHEN l_suppkey % 7 = 0 THEN '' "
             f"ELSE {NL} || 'Blocks/Lots/Units: ' || {blocks} END)")
    ctes.append(f"""cat_answers AS (
  SELECT form_id AS work_order_id, string_agg({block}, {NL} || {NL} ORDER BY r) AS answer_text
  FROM rf GROUP BY form_id)""")
    ctes.append(f"""dict AS (
  SELECT DISTINCT 'Builder ' || CAST(kk AS VARCHAR) AS original_name,
    CASE WHEN kk < {FX.DICTIONARY_MAX_BUILDER} THEN 'BUILDER GROUP ' || CAST(kk // 2 AS VARCHAR)
         ELSE 'Builder ' || CAST(kk AS VARCHAR) END AS corrected_name,
    CASE WHEN kk < {FX.DICTIONARY_MAX_BUILDER} THEN 0.9 ELSE 1.0 END AS confidence_score
  FROM (SELECT CAST(floor(sqrt(c_custkey)) AS BIGINT) AS kk FROM customer))""")
    ctes.append(f"""lines_src AS (
  SELECT form_id AS work_order_id, l_linenumber AS line_no,
    {cat} AS service_category, l_quantity AS quantity, CAST(l_linenumber AS DOUBLE) AS total_service_hours,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,4))), 2) AS DOUBLE) AS estimated_service_value
  FROM rf)""")
    return ctes


# ------------------------------------------------------------- pipeline ----

MONTH_SPELLINGS = [
    ("JANUARY", ["JANUARY", "JAN"]), ("FEBRUARY", ["FEBRUARY", "FEB"]), ("MARCH", ["MARCH", "MAR"]),
    ("APRIL", ["APRIL", "APR"]), ("MAY", ["MAY"]), ("JUNE", ["JUNE", "JUN"]), ("JULY", ["JULY", "JUL"]),
    ("AUGUST", ["AUGUST", "AUG"]), ("SEPTEMBER", ["SEPTEMBER", "SEP", "SEPT"]),
    ("OCTOBER", ["OCTOBER", "OCT"]), ("NOVEMBER", ["NOVEMBER", "NOV"]), ("DECEMBER", ["DECEMBER", "DEC"]),
]


def _month_sql(x: str) -> str:
    u = f"upper({ws(x)})"
    whens = " ".join(f"WHEN {u} IN {inlist(sp)} THEN {q(m)}" for m, sp in MONTH_SPELLINGS)
    return f"(CASE WHEN {u} = '' THEN NULL {whens} ELSE {u} END)"


def _company_sql(x: str) -> str:
    u = f"upper(coalesce({x}, ''))"
    return (f"(CASE WHEN contains({u}, 'AE3') OR contains({u}, 'AES EXCAVATING') THEN 'AE3 Excavating' "
            f"WHEN contains({u}, 'AEON') THEN 'Aeon Landscaping' "
            f"WHEN contains({u}, 'ADEO') OR contains({u}, 'ADO') THEN 'ADEO Contracting' "
            f"WHEN contains({u}, 'ANTHONY') THEN 'ANTHONY''S EXCAVATING & GRADING' ELSE 'N/A' END)")


def _year_sql(x: str) -> str:
    t = ws(f"CAST({x} AS VARCHAR)")
    v = f"(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS INTEGER) END)"
    return f"(CASE WHEN {v} < 100 THEN {v} + 2000 ELSE {v} END)"


def _pipeline_ctes(max_dist: int = 2) -> list[str]:
    base_b = f"(CASE WHEN builder_name IS NULL OR {ws('builder_name')} IN ('', 'N/A') THEN 'N/A' ELSE {ws('builder_name')} END)"
    ctes = [
        f"""c0 AS (
  SELECT raw.* EXCLUDE (work_order_number, description, builder_name, project_name, month, year),
    work_order_number, description,
    builder_name AS builder_name_raw,
    {base_b} AS b_base,
    project_name AS project_name_raw,
    {ws("regexp_replace(replace(project_name, 'Project/Phase', ''), '\\s+', ' ', 'g')")} AS project_name,
    month AS month_raw, {_month_sql('month')} AS month,
    year AS year_raw, {_year_sql('year')} AS year,
    company_name AS company_name_raw, {_company_sql('company_name')} AS company_name_standardized,
    CAST({RUN_TS} AS TIMESTAMP) AS corrected_at
  FROM raw)""",
        f"dkey AS (SELECT upper({ws('original_name')}) AS dk, min(corrected_name) AS corrected_name FROM dict GROUP BY 1)",
        "bnames AS (SELECT DISTINCT upper(b_base) AS nk FROM c0 WHERE upper(b_base) <> 'N/A')",
        f"""bmatch AS (
  SELECT n.nk, coalesce(e.corrected_name, (
      SELECT arg_min(d.corrected_name, [levenshtein(n.nk, d.dk)::VARCHAR, d.dk])
      FROM dkey d WHERE levenshtein(n.nk, d.dk) <= {max_dist}
        AND length(d.dk) BETWEEN length(n.nk) - {max_dist} AND length(n.nk) + {max_dist})) AS corrected_name
  FROM bnames n LEFT JOIN dkey e ON e.dk = n.nk)""",
        """corrected AS (
  SELECT c0.* EXCLUDE (b_base),
    CASE WHEN c0.b_base = 'N/A' THEN 'N/A' ELSE coalesce(m.corrected_name, c0.b_base) END AS builder_name
  FROM c0 LEFT JOIN bmatch m ON m.nk = upper(c0.b_base))""",
    ]
    ctes += _categorize_ctes("corrected", "cat_answers")
    ctes.append("""with_ml AS (
  SELECT c.*, k.ml_categorization FROM corrected c LEFT JOIN cats k USING (work_order_id))""")
    wd = " ".join(f"WHEN month = {q(m)} THEN make_date(year, {i}, 1)" for i, (m, _) in enumerate(MONTH_SPELLINGS, 1))
    score = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in
                       ["work_order_number", "builder_name", "project_name", "month", "year", "company_name",
                        "description"])
    ctes.append(f"""stg0 AS (
  SELECT work_order_id, work_order_number, builder_name, builder_name_raw, project_name, project_name_raw,
    CASE WHEN year BETWEEN 1 AND 9999 THEN (CASE {wd} END) END AS work_date,
    month, month_raw, year, year_raw, company_name_standardized AS company_name, company_name_raw,
    {ws('description')} AS description, ml_categorization, file_url, extracted_at, corrected_at,
    CAST({RUN_TS} AS TIMESTAMP) AS processed_at
  FROM with_ml)""")
    ctes.append(f"""stg AS (
  SELECT *, work_order_number IS NULL AS missing_wo_number,
    coalesce(builder_name IS NULL OR builder_name = '', false) AS missing_builder,
    CAST({score} AS DOUBLE) / 7.0 AS data_completeness_score
  FROM stg0)""")
    tier = ("CASE WHEN total_work_orders >= 100 THEN 'Platinum' WHEN total_work_orders >= 50 THEN 'Gold' "
            "WHEN total_work_orders >= 20 THEN 'Silver' ELSE 'Bronze' END")
    act = (f"CASE WHEN date_diff('day', last_work_date, {AS_OF}) <= 30 THEN 'Active' "
           f"WHEN date_diff('day', last_work_date, {AS_OF}) <= 90 THEN 'Moderate' "
           f"WHEN date_diff('day', last_work_date, {AS_OF}) <= 180 THEN 'Low Activity' ELSE 'Inactive' END")
    ctes.append(f"""dimb0 AS (
  SELECT upper({ws('builder_name_raw')}) AS builder_nkey, min(builder_name_raw) AS builder_name_raw,
    count(DISTINCT work_order_id) AS total_work_orders, count(DISTINCT project_name) AS total_projects,
    min(work_date) AS first_work_date, max(work_date) AS last_work_date,
    avg(data_completeness_score) AS avg_data_quality
  FROM stg WHERE builder_name_raw IS NOT NULL GROUP BY 1)""")
    ctes.append(f"""dkey_full AS (
  SELECT upper({ws('original_name')}) AS dk,
    arg_min(corrected_name, [corrected_name, original_name]) AS corrected_name,
    arg_min(CAST(confidence_score AS DOUBLE), [corrected_name, original_name]) AS confidence_score
  FROM dict GROUP BY 1)""")
    ctes.append(f"""dim_builders AS (
  SELECT md5(coalesce(CAST(coalesce(d.corrected_name, b.builder_name_raw) AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS builder_key,
    b.builder_nkey, b.builder_name_raw, coalesce(d.corrected_name, b.builder_name_raw) AS builder_name_corrected,
    coalesce(d.confidence_score, 1.0) AS match_confidence, b.total_work_orders, b.total_projects,
    b.first_work_date, b.last_work_date, CAST(date_diff('day', b.first_work_date, b.last_work_date) AS INTEGER) AS days_active,
    b.avg_data_quality, {tier} AS builder_tier, {act} AS activity_status
  FROM dimb0 b LEFT JOIN dkey_full d ON d.dk = b.builder_nkey)""")
    ctes.append(f"""dim_projects AS (
  SELECT md5(coalesce(project_name_raw, '_dbt_utils_surrogate_key_null_')) AS project_key, project_nkey,
    project_name_raw, project_name_raw AS project_name_corrected, total_work_orders, total_builders,
    first_work_date, last_work_date,
    CAST(date_diff('day', first_work_date, last_work_date) AS INTEGER) AS project_duration_days
  FROM (SELECT upper({ws('project_name')}) AS project_nkey, min(project_name) AS project_name_raw,
          count(DISTINCT work_order_id) AS total_work_orders, count(DISTINCT builder_name_raw) AS total_builders,
          min(work_date) AS first_work_date, max(work_date) AS last_work_date
        FROM stg WHERE project_name IS NOT NULL GROUP BY 1))""")
    ctes.append(f"""dim_companies AS (
  SELECT md5(coalesce(company_name_raw, '_dbt_utils_surrogate_key_null_')) AS company_key, company_nkey,
    company_name_raw, company_name_raw AS company_name_corrected, total_work_orders, first_work_date, last_work_date
  FROM (SELECT upper({ws('company_name')}) AS company_nkey, min(company_name) AS company_name_raw,
          count(DISTINCT work_order_id) AS total_work_orders, min(work_date) AS first_work_date,
          max(work_date) AS last_work_date
        FROM stg WHERE company_name IS NOT NULL GROUP BY 1))""")
    ctes.append(f"""fct AS (
  SELECT s.work_order_id, s.work_order_number, s.work_date, s.extracted_at, s.description, s.ml_categorization,
    s.data_completeness_score, s.file_url, b.builder_key, p.project_key, c.company_key
  FROM stg s
  LEFT JOIN dim_builders b ON b.builder_nkey = upper({ws('s.builder_name_raw')})
  LEFT JOIN dim_projects p ON p.project_nkey = upper({ws('s.project_name')})
  LEFT JOIN dim_companies c ON c.company_nkey = upper({ws('s.company_name')}))""")
    ctes.append("""fsl AS (
  SELECT f.work_order_id, f.work_order_number, f.work_date, f.builder_key, f.project_key, f.company_key,
    f.data_completeness_score, l.line_no, l.service_category, l.quantity, l.total_service_hours,
    l.estimated_service_value
  FROM fct f LEFT JOIN lines_src l USING (work_order_id))""")
    ctes.append(f"""dbc AS (
  SELECT g.builder_key, n.builder_name_corrected, g.total_work_orders, g.total_projects, g.first_work_date,
    g.last_work_date, {tier} AS builder_tier, {act} AS activity_status
  FROM (SELECT builder_key, count(DISTINCT work_order_id) AS total_work_orders,
          count(DISTINCT project_key) AS total_projects, min(work_date) AS first_work_date,
          max(work_date) AS last_work_date
        FROM fct WHERE builder_key IS NOT NULL GROUP BY 1) g
  JOIN (SELECT builder_key, min(builder_name_corrected) AS builder_name_corrected FROM dim_builders GROUP BY 1) n
    USING (builder_key))""")
    return ctes


def _categorize_ctes(src: str, answers: str | None) -> list[str]:
    """Grouped form: explode blocks, number repeats with windows, merge with list_reduce."""
    strict = inlist(V.STRICT_CATEGORIES)
    tiered = inlist(V.TIERED_CATEGORIES)
    renames = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in V.TIERED_RENAMES.items())
    text = "coalesce(answer_text, '')" if answers else "kw_text"
    ans_join = f"LEFT JOIN {answers} a USING (work_order_id)" if answers else ""
    ctes = [
        f"""cat_in AS (
  SELECT t.work_order_id, t.company_name_standardized AS company, t.description,
    CASE WHEN t.company_name_standardized = 'Aeon Landscaping' THEN 'strict'
         WHEN t.company_name_standardized = 'AE3 Excavating' THEN 'tiered' END AS mode
    {', a.answer_text' if answers else ''}
  FROM {src} t {ans_join.replace('USING', 'USING') if answers else ''}
  WHERE t.description IS NOT NULL)""",
        f"""cat_blocks AS (
  SELECT c.work_order_id, c.mode, b.block, b.pos
  FROM cat_in c,
    unnest(string_split(replace({ws(text)}, {NL} || {NL} || 'Service:', chr(1) || 'Service:'), chr(1)))
      WITH ORDINALITY AS b(block, pos)
  WHERE c.mode IS NOT NULL)""",
        f"""cat_p AS (
  SELECT work_order_id, mode, pos,
    {ws("regexp_extract(block, 'Service:\\s*(.*?)(?:\\n|$)', 1)")} AS s0,
    CASE WHEN contains(block, 'Blocks/Lots/Units:')
         THEN {ws("regexp_extract(block, 'Blocks/Lots/Units:\\s*(.*?)(?:\\n|$)', 1)")}
         ELSE 'Not specified' END AS b
  FROM cat_blocks WHERE contains(block, 'Service:'))""",
        f"""cat_r AS (
  SELECT *, CASE WHEN mode = 'tiered' THEN (CASE s0 {renames} ELSE s0 END) ELSE s0 END AS s1 FROM cat_p)""",
        f"""cat_v AS (
  SELECT *, CASE WHEN (mode = 'strict' AND (starts_with(s1, 'Settlement Repairs') OR starts_with(s1, 'Miscellaneous')
                                            OR s1 IN {strict}))
              OR (mode = 'tiered' AND (starts_with(s1, 'Miscellaneous') OR s1 IN {tiered}))
            THEN s1 ELSE 'Miscellaneous (' || s1 || ')' END AS s
  FROM cat_r)""",
        """cat_o AS (
  SELECT *, row_number() OVER (PARTITION BY work_order_id, s ORDER BY pos) AS occ FROM cat_v)""",
        """cat_o2 AS (
  SELECT *, (mode = 'strict' AND starts_with(s, 'Settlement Repairs') AND occ > 1) AS is_rep FROM cat_o)""",
        """cat_n AS (
  SELECT *, CASE WHEN is_rep THEN 'Settlement Repairs' ||
      CAST(row_number() OVER (PARTITION BY work_order_id, is_rep ORDER BY pos) AS VARCHAR) ELSE s END AS name,
    CASE WHEN is_rep THEN pos ELSE -1 END AS grp
  FROM cat_o2)""",
        """cat_g AS (
  SELECT work_order_id, name, grp, min(pos) AS first_pos,
    coalesce(list_reduce(list(b ORDER BY pos) FILTER (WHERE b <> 'Not specified'),
                         lambda acc, x: CASE WHEN contains(acc, x) THEN acc ELSE acc || ', ' || x END),
             'Not specified') AS merged
  FROM cat_n GROUP BY work_order_id, name, grp)""",
        f"""cat_fmt AS (
  SELECT work_order_id,
    string_agg('Service: ' || name || {NL} || 'Blocks/Lots/Units: ' || merged, {NL} || {NL} ORDER BY first_pos) AS txt
  FROM cat_g GROUP BY work_order_id)""",
        f"""cats AS (
  SELECT c.work_order_id,
    CASE WHEN c.mode IS NULL
         THEN 'Service: Miscellaneous (No categorizer for ' || coalesce(c.company, 'None') || ')' || {NL}
              || 'Blocks/Lots/Units: Not specified'
         ELSE coalesce(f.txt, 'Error in categorization') END AS ml_categorization
  FROM cat_in c LEFT JOIN cat_fmt f USING (work_order_id))""",
    ]
    return ctes


def with_ctes(select: str) -> str:
    return "WITH " + ",\n".join(_fixture_ctes() + _pipeline_ctes()) + "\n" + select


# ----------------------------------------------------------------- parse --

def _answer_text_cte() -> str:
    def fl(num, label, val):
        return f"'{num:02d}. {label}: ' || coalesce({val}, 'N/A')"
    k = "o_orderkey"
    parts = [
        f"(CASE WHEN {k} % 10 = 3 THEN 'Here is the extracted data:' ELSE '' END)",
        f"(CASE WHEN {k} % 10 = 3 THEN '02. Builder Name: DRAFT' ELSE '' END)",
        fl(1, "WO NO.", "work_order_number"), fl(2, "Builder Name", "builder_name"),
        fl(3, "Project Name", "project_name"), fl(4, "Month", "month"), fl(5, "Year", "year_text"),
        fl(6, "Company", "company_name"), fl(7, "Description", "description"),
        f"(CASE WHEN {k} % 10 = 7 THEN '   (continued on back)' ELSE '' END)",
    ]
    num = 8
    for s in range(1, 5):
        a, b = 2 * s - 1, 2 * s
        parts.append(fl(num, f"Service{s}", f"cat{a}"))
        for i, j in ((a, 0), (b, 3)):
            parts += [fl(num + 1 + j, f"D{i}", f"dt{i}"), fl(num + 2 + j, f"Q{i}", f"qt{i}"),
                      fl(num + 3 + j, f"H{i}", f"ht{i}")]
        num += 7
    body = f" || {NL} || ".join(parts)
    return f"answers AS (SELECT work_order_id, file_url, extracted_at, {body} AS answer_text FROM ow)"


def _float_sql(x: str) -> str:
    t = ws(x)
    return (f"(CASE WHEN {x} IS NOT NULL AND {x} NOT IN ('', 'N/A') AND "
            f"regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST({t} AS DOUBLE) END)")


def _hours_sql(x: str) -> str:
    out = x
    for tok in [" each", " /each", "/each", " man", " /man", "/man"]:
        out = f"replace({out}, {q(tok)}, '')"
    return out


def l1_sql(where: str = "true") -> str:
    line_parse = f"""pl AS (
  SELECT a.work_order_id, a.file_url, a.extracted_at, t.pos,
    {ws('t.line')} AS s
  FROM answers a, unnest(string_split(a.answer_text, {NL})) WITH ORDINALITY AS t(line, pos))"""
    fields = f"""pf AS (
  SELECT work_order_id, file_url, extracted_at, pos,
    TRY_CAST(CASE WHEN regexp_full_match({ws("split_part(" + ws("split_part(s, ':', 1)") + ", '.', 1)")}, '[+-]?[0-9]+')
                  THEN {ws("split_part(" + ws("split_part(s, ':', 1)") + ", '.', 1)")} END AS INTEGER) AS num,
    {ws("substr(s, strpos(s, ':') + 1)")} AS value
  FROM pl WHERE s <> '' AND contains(s, ':'))"""
    cols = []
    for n in range(1, 36):
        cols.append(f"arg_max(value, pos) FILTER (WHERE num = {n}) AS f{n}")
    piv = ("pv AS (SELECT a.work_order_id, a.file_url, a.extracted_at, " + ", ".join(cols) +
           " FROM answers a LEFT JOIN pf ON pf.work_order_id = a.work_order_id AND pf.num IS NOT NULL"
           " GROUP BY a.work_order_id, a.file_url, a.extracted_at)")
    sel = ["work_order_id", "coalesce(f1, 'N/A') AS work_order_number", "coalesce(f2, 'N/A') AS builder_name",
           "coalesce(f3, 'N/A') AS project_name", "coalesce(f4, 'N/A') AS month",
           f"{_year_sql('coalesce(f5, ' + chr(39) + chr(39) + ')')} AS year",
           "coalesce(f6, 'N/A') AS company_name", "coalesce(f7, 'N/A') AS description", "file_url",
           "extracted_at"]
    for s in range(1, 5):
        sel.append(f"coalesce(f{8 + 7 * (s - 1)}, 'N/A') AS service{s}")
    for s in range(1, 5):
        b = 8 + 7 * (s - 1)
        for j, line in ((0, 2 * s - 1), (3, 2 * s)):
            sel += [f"coalesce(f{b + 1 + j}, 'N/A') AS d{line}",
                    f"{_float_sql('coalesce(f' + str(b + 2 + j) + ', ' + chr(39) + chr(39) + ')')} AS q{line}",
                    f"{_float_sql(_hours_sql('coalesce(f' + str(b + 3 + j) + ', ' + chr(39) + chr(39) + ')'))} AS h{line}"]
    return ("WITH " + ",\n".join(_fixture_ctes() + [_answer_text_cte(), line_parse, fields, piv]) +
            "\nSELECT " + ", ".join(sel) + f" FROM pv WHERE {where}")


# --------------------------------------------------------------- queries --

def report_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out["l1_raw_build"] = l1_sql()
    out["l1_from_documents"] = l1_sql(f"{KEY} % 43 <> 0")
    out["l1_unread_documents"] = with_ctes(
        f"SELECT work_order_id, file_url, 'UnicodeDecodeError' AS error FROM raw WHERE {KEY} % 43 = 0")
    out["l2_corrected"] = with_ctes("SELECT * FROM corrected")
    out["l3_categorized"] = with_ctes("SELECT work_order_id, ml_categorization FROM cats")
    out["l4_staging"] = with_ctes("SELECT * FROM stg")
    out["l5_dim_builders"] = with_ctes("SELECT * FROM dim_builders")
    out["l5_dim_projects"] = with_ctes("SELECT * FROM dim_projects")
    out["l5_dim_companies"] = with_ctes("SELECT * FROM dim_companies")
    out["l6_fact"] = with_ctes("SELECT * FROM fct")
    out["l6_service_lines"] = with_ctes("SELECT * FROM fsl")
    out["l5_dim_builders_conformed"] = with_ctes("SELECT * FROM dbc")
    out["l7_work_orders"] = with_ctes(f"""
SELECT * FROM (
  SELECT f.work_order_id, f.work_order_number, b.builder_name_corrected AS builder_name,
    p.project_name_corrected AS project_name, f.work_date,
    round(sum(f.total_service_hours), 2) AS total_hours, round(sum(f.estimated_service_value), 2) AS total_value,
    coalesce(list_sort(list(DISTINCT f.service_category) FILTER (WHERE f.service_category IS NOT NULL)), []::VARCHAR[])
      AS service_categories,
    round(avg(f.data_completeness_score), 6) AS data_quality_score
  FROM fsl f LEFT JOIN dbc b ON f.builder_key = b.builder_key LEFT JOIN dim_projects p ON f.project_key = p.project_key
  GROUP BY 1, 2, 3, 4, 5)
ORDER BY work_date DESC NULLS LAST, work_order_id ASC LIMIT 100 OFFSET 0""")
    out["l7_work_orders_filtered"] = with_ctes(f"""
SELECT * FROM (
  SELECT f.work_order_id, f.work_order_number, b.builder_name_corrected AS builder_name,
    p.project_name_corrected AS project_name, f.work_date,
    round(sum(f.total_service_hours), 2) AS total_hours, round(sum(f.estimated_service_value), 2) AS total_value,
    coalesce(list_sort(list(DISTINCT f.service_category) FILTER (WHERE f.service_category IS NOT NULL)), []::VARCHAR[])
      AS service_categories,
    round(avg(f.data_completeness_score), 6) AS data_quality_score
  FROM fsl f LEFT JOIN dbc b ON f.builder_key = b.builder_key LEFT JOIN dim_projects p ON f.project_key = p.project_key
  WHERE f.work_date >= DATE '1998-01-01' AND f.work_date <= DATE '1999-12-31'
    AND contains(upper(b.builder_name_corrected), 'GROUP') AND contains(upper(p.project_name_corrected), 'BRAND#1')
  GROUP BY 1, 2, 3, 4, 5)
ORDER BY work_date DESC NULLS LAST, work_order_id ASC LIMIT 50 OFFSET 20""")
    builders_sql = """
WITH_BR
SELECT * FROM (
  SELECT b.builder_name_corrected AS builder_name, b.builder_tier, b.total_work_orders, b.total_projects,
    round(coalesce(br.total_revenue, 0.0), 2) AS total_revenue,
    round(coalesce(br.total_revenue / NULLIF(br.order_count, 0), 0.0), 2) AS avg_order_value,
    b.activity_status, br.last_order_date
  FROM dbc b LEFT JOIN (
    SELECT f.builder_key, sum(f.estimated_service_value) AS total_revenue,
      count(DISTINCT f.work_order_id) AS order_count, max(f.work_date) AS last_order_date
    FROM fsl f JOIN dbc d ON f.builder_key = d.builder_key GROUP BY 1) br ON b.builder_key = br.builder_key
  WHERE 1=1 FILTERS)
ORDER BY total_revenue DESC NULLS LAST, builder_name ASC LIMIT {limit}"""
    out["l8_builders"] = with_ctes(builders_sql.replace("WITH_BR", "").replace("FILTERS", "")
                                   .replace("{limit}", "50"))
    out["l8_builders_platinum_active"] = with_ctes(
        builders_sql.replace("WITH_BR", "")
        .replace("FILTERS", "AND b.builder_tier = 'Platinum' AND b.activity_status = 'Active'").replace("{limit}", "20"))
    out["l9_projects"] = with_ctes("""
SELECT * FROM (
  SELECT p.project_name_corrected AS project_name, count(DISTINCT f.work_order_id) AS total_work_orders,
    count(DISTINCT f.builder_key) AS total_builders, round(sum(f.total_service_hours), 2) AS total_hours,
    round(sum(f.estimated_service_value), 2) AS total_value, min(f.work_date) AS start_date,
    max(f.work_date) AS end_date, CAST(date_diff('day', min(f.work_date), max(f.work_date)) AS INTEGER) AS duration_days
  FROM fsl f JOIN dim_projects p ON f.project_key = p.project_key
  GROUP BY 1 HAVING count(DISTINCT f.work_order_id) >= 10)
ORDER BY total_value DESC NULLS LAST, project_name ASC LIMIT 50""")
    for days in (30, 365):
        win = f"work_date >= {AS_OF} - INTERVAL {days} DAY"
        out[f"d8_daily_trend_{days}d"] = with_ctes(f"""
SELECT work_date, count(DISTINCT work_order_id) AS daily_orders, round(sum(total_service_hours), 2) AS daily_hours,
  round(sum(estimated_service_value), 2) AS daily_value
FROM fsl WHERE {win} GROUP BY 1""")
        out[f"d9_service_breakdown_{days}d"] = with_ctes(f"""
SELECT service_category, count(*) AS service_count, round(sum(total_service_hours), 2) AS total_hours,
  round(sum(estimated_service_value), 2) AS total_value
FROM fsl WHERE {win} GROUP BY 1""")
        out[f"d10_top_builders_{days}d"] = with_ctes(f"""
SELECT * FROM (
  SELECT b.builder_name_corrected AS builder_name, count(DISTINCT f.work_order_id) AS order_count,
    round(sum(f.estimated_service_value), 2) AS total_value
  FROM fsl f JOIN dbc b ON f.builder_key = b.builder_key WHERE f.{win} GROUP BY 1)
ORDER BY total_value DESC NULLS LAST, builder_name ASC LIMIT 10""")
        out[f"d11_kpis_{days}d"] = with_ctes(f"""
SELECT count(DISTINCT work_order_id) AS total_orders_30d,
  round(coalesce(sum(estimated_service_value), 0.0), 2) AS total_value_30d,
  count(DISTINCT builder_key) AS active_builders_30d, count(DISTINCT project_key) AS active_projects_30d
FROM fsl WHERE {win}""")
    return out


# ------------------------------------------------------- operator queries --

def _suite_sql() -> str:
    from groundwork.operators import quality as Q
    src = {"stg_work_orders": "stg", "dim_builders": "dim_builders", "dim_projects": "dim_projects",
           "dim_companies": "dim_companies", "fct_work_orders": "fct", "raw_work_orders": "raw"}
    parts = []
    for model, checks in Q.DEFAULT_SUITE.items():
        t = src[model]
        for c in checks:
            if c.kind == "not_null":
                cnt = f"(SELECT count(*) FROM {t} WHERE {c.column} IS NULL)"
            elif c.kind == "accepted_values":
                cnt = f"(SELECT count(*) FROM {t} WHERE {c.column} IS NOT NULL AND {c.column} NOT IN {inlist(c.values)})"
            elif c.kind == "accepted_range":
                cnt = (f"(SELECT count(*) FROM {t} WHERE {c.column} IS NOT NULL AND "
                       f"({c.column} < {c.min_value} OR {c.column} > {c.max_value}))")
            elif c.kind == "expression":
                cnt = f"(SELECT count(*) FROM {t} WHERE NOT coalesce({c.expression}, false))"
            elif c.kind == "unique":
                cnt = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL "
                       f"GROUP BY 1 HAVING count(*) > 1))")
            else:
                p = src[c.to]
                cnt = (f"(SELECT count(*) FROM {t} x WHERE x.{c.column} IS NOT NULL AND NOT EXISTS "
                       f"(SELECT 1 FROM {p} y WHERE y.{c.column} = x.{c.column}))")
            parts.append(f"SELECT {q(model)} AS model, {q(c.name)} AS check_name, {q(c.severity)} AS severity, "
                         f"CAST({cnt} AS BIGINT) AS failures")
    return "SELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL\n".join(parts) + ")"


def _h8_sql() -> str:
    parts = []
    for k in range(1, 5):
        a, b = 2 * k - 1, 2 * k
        ok1 = f"(service{k} IS NOT NULL AND service{k} NOT IN ('', 'N/A'))"
        ok2 = f"({ok1} AND d{b} IS NOT NULL AND d{b} NOT IN ('', 'N/A'))"
        for line, cond in ((a, ok1), (b, ok2)):
            parts.append(f"SELECT work_order_id, {line} AS line_no, service{k} AS service_type, d{line} AS date, "
                         f"q{line} AS quantity, h{line} AS hours FROM raw WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


def _keyword_sql() -> str:
    rows = []
    for i, c in enumerate(V.STRICT_CATEGORIES):
        rows.append(f"('strict', {q(c)}, 1, {i})")
    i = 0
    for lv in sorted(V.TIERED_LEVELS):
        for c in V.TIERED_LEVELS[lv]:
            rows.append(f"('tiered', {q(c)}, {lv}, {i})")
            i += 1
    vocab = "vocab(mode, name, level, idx) AS (VALUES " + ", ".join(rows) + ")"
    return vocab + f""",
kw_in AS (
  SELECT work_order_id, company_name_standardized AS company, description,
    CASE WHEN company_name_standardized = 'Aeon Landscaping' THEN 'strict'
         WHEN company_name_standardized = 'AE3 Excavating' THEN 'tiered' END AS mode
  FROM corrected WHERE description IS NOT NULL),
kw_hits AS (
  SELECT k.work_order_id, k.mode, v.name, v.level, v.idx,
    row_number() OVER (PARTITION BY k.work_order_id ORDER BY v.level, length(v.name) DESC, v.idx) AS rk
  FROM kw_in k JOIN vocab v ON v.mode = k.mode AND contains(lower(k.description), lower(v.name))
    AND v.name <> 'Miscellaneous'),
kw_txt AS (
  SELECT work_order_id,
    string_agg('Service: ' || name || {NL} || 'Blocks/Lots/Units: Not specified', {NL} || {NL} ORDER BY idx) AS txt
  FROM kw_hits WHERE mode = 'strict' OR rk = 1 GROUP BY work_order_id)
SELECT k.work_order_id,
  CASE WHEN k.mode IS NULL
       THEN 'Service: Miscellaneous (No categorizer for ' || coalesce(k.company, 'None') || ')' || {NL}
            || 'Blocks/Lots/Units: Not specified'
       ELSE coalesce(t.txt, 'Service: Miscellaneous' || {NL} || 'Blocks/Lots/Units: Not specified') END
    AS ml_categorization
FROM kw_in k LEFT JOIN kw_txt t USING (work_order_id)"""


def operator_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out["c7_fuzzy_builders"] = with_ctes(
        "SELECT DISTINCT builder_name_raw, builder_name AS builder_name_corrected FROM corrected")
    out["h8_service_lines"] = with_ctes(_h8_sql())
    out["k8_pipeline_checks"] = with_ctes("""
SELECT 'no_null_work_order_numbers' AS check_name, CAST(count(*) FILTER (WHERE work_order_number IS NULL) AS DOUBLE) AS value,
  count(*) FILTER (WHERE work_order_number IS NULL) = 0 AS passed FROM raw
UNION ALL
SELECT 'data_completeness_above_80_percent', avg(data_completeness_score), coalesce(avg(data_completeness_score) >= 0.8, false) FROM fct
UNION ALL
SELECT 'all_records_have_ml_categorization', CAST(count(*) FILTER (WHERE ml_categorization IS NULL) AS DOUBLE),
  count(*) FILTER (WHERE ml_categorization IS NULL) = 0 FROM with_ml""")
    out["k_quality_suite"] = with_ctes(_suite_sql())
    tbls = [("raw_work_orders", "raw"), ("raw_work_orders_corrected", "corrected"),
            ("raw_work_orders_with_ml", "with_ml"), ("stg_work_orders", "stg"), ("dim_builders", "dim_builders"),
            ("dim_projects", "dim_projects"), ("dim_companies", "dim_companies"), ("fct_work_orders", "fct")]
    out["d13_table_status"] = with_ctes("SELECT *, CASE WHEN row_count IS NULL THEN 'MISSING' WHEN row_count = 0 "
                                        "THEN 'EMPTY' ELSE 'LIVE' END AS status FROM (" + " UNION ALL ".join(
                                            f"SELECT {q(n)} AS table_name, count(*) AS row_count FROM {t}"
                                            for n, t in tbls) + ")")
    out["d14_reconcile"] = with_ctes("""
SELECT r.raw_count, c.corrected_count, m.categorized_count,
  r.raw_count = c.corrected_count AND c.corrected_count = m.categorized_count AND r.raw_count > 0 AS counts_match
FROM (SELECT count(*) AS raw_count FROM raw) r, (SELECT count(*) AS corrected_count FROM corrected) c,
     (SELECT count(*) AS categorized_count FROM with_ml) m""")
    cov = ["work_order_number", "description", "ml_categorization", "builder_name", "month", "year"]
    out["d15_coverage"] = with_ctes(" UNION ALL ".join(
        f"SELECT {q(c)} AS column_name, count(*) AS total_rows, count({c}) AS non_null_rows, "
        f"round(count({c}) / NULLIF(count(*), 0), 6) AS coverage FROM with_ml" for c in cov))
    from groundwork.operators.quality import DURATION_BUCKETS
    bucket = "CASE " + " ".join(f"WHEN value <= {b} THEN {i}" for i, b in enumerate(DURATION_BUCKETS)) + \
        f" ELSE {len(DURATION_BUCKETS)} END"
    hist = ", ".join(f"count(*) FILTER (WHERE {bucket} = {i}) AS le_{i}" for i in range(len(DURATION_BUCKETS) + 1))
    out["d17_stage_profile"] = f"""
SELECT event_type AS stage, count(*) AS events,
  round(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END), 6) AS success_share,
  round(avg(value), 6) AS avg_duration,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99, {hist}
FROM events GROUP BY 1"""
    out["a14_retention"] = with_ctes(f"""
SELECT CASE WHEN date_diff('day', CAST(extracted_at AS DATE), {AS_OF}) > 90 THEN 'expired' ELSE 'hot' END AS retention,
  count(*) AS work_orders
FROM fct GROUP BY 1""")
    out["a8_upsert_incremental"] = with_ctes(
        "SELECT work_order_id, extracted_at, data_completeness_score, ml_categorization FROM stg")
    out["b3_newer_than"] = with_ctes("""
SELECT work_order_id, extracted_at FROM stg
WHERE extracted_at > (SELECT max(extracted_at) FROM stg WHERE extracted_at <= TIMESTAMP '1999-01-01 00:00:00')""")
    out["e1_latest_event_per_user"] = """
SELECT event_id, user_id, ts, event_type FROM (
  SELECT event_id, user_id, ts, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
    out["f4_latest_sample"] = with_ctes("""
SELECT work_order_id, builder_name, project_name, extracted_at, substr(ml_categorization, 1, 50) AS category_preview
FROM with_ml ORDER BY extracted_at DESC NULLS LAST, work_order_id LIMIT 3""")
    out["f6_categorized_sample"] = with_ctes("""
SELECT work_order_id, company_name_standardized, ml_categorization FROM with_ml
WHERE ml_categorization IS NOT NULL ORDER BY work_order_id LIMIT 3""")
    out["c9_keyword_categories"] = "WITH " + ",\n".join(_fixture_ctes() + _pipeline_ctes()) + ",\n" + _keyword_sql()
    return out


KEY = "CAST(regexp_extract(work_order_id, '^WO-(\\d+)', 1) AS BIGINT)"
CUT = "TIMESTAMP '1999-01-01 00:00:00'"
REJECT = "'not one JSON object'"


def _answers_sql() -> str:
    """One row per JSON answer: its key, number, name, year and number of services."""
    return f"""
SELECT r.work_order_id, r.k, r.work_order_number, CASE WHEN r.k % 23 = 0 THEN '' ELSE r.project_name END AS project_name,
  r.builder_name, r.year, coalesce(s.n, 0) AS n
FROM (SELECT *, {KEY} AS k FROM raw) r
LEFT JOIN (SELECT work_order_id, count(*) AS n FROM ({_h8_sql()}) GROUP BY 1) s ON s.work_order_id = r.work_order_id"""


def answer_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    base = _answers_sql()
    out["h7_json_answers"] = with_ctes(f"""
SELECT work_order_id, k % 19 <> 0 AS is_valid, CASE WHEN k % 19 = 0 THEN {REJECT} END AS reject_reason,
  CASE WHEN k % 19 <> 0 THEN work_order_number END AS work_order_number,
  CASE WHEN k % 19 <> 0 THEN project_name END AS project_name,
  CASE WHEN k % 19 <> 0 THEN CAST(n AS INTEGER) END AS n_services,
  CASE WHEN k % 19 <> 0 THEN
    round(least((CASE WHEN project_name = '' THEN 6 ELSE 7 END) / 7.0 + least(n / 4.0, 1.0) * 0.2, 1.0), 6) END AS score,
  CASE WHEN k % 19 <> 0 THEN (CASE WHEN project_name = '' THEN 'project_name' ELSE '' END) END AS missing
FROM ({base})""")
    out["b12_valid"] = with_ctes(f"SELECT work_order_id FROM raw WHERE {KEY} % 19 <> 0")
    out["b12_rejects"] = with_ctes(f"""
SELECT work_order_id, {REJECT} AS reject_reason,
  substr('{{"work_order_number":"' || work_order_number || '","builder_name":"' || builder_name, 1, 40) AS answer_text
FROM raw WHERE {KEY} % 19 = 0""")
    out["d16_run_summary"] = with_ctes(f"""
SELECT count(*) FILTER (WHERE {KEY} % 19 <> 0) AS successful, count(*) FILTER (WHERE {KEY} % 19 = 0) AS failed,
  count(*) AS total FROM raw""")
    ok = "(k % 19 <> 0 AND k % 37 <> 0)"
    out["a4_answer_scan"] = with_ctes(f"""
SELECT work_order_number AS number_text, {ok} AS is_valid, CASE WHEN NOT {ok} THEN {REJECT} END AS reject_reason,
  CASE WHEN {ok} AND k % 41 <> 0 THEN year END AS year,
  CASE WHEN {ok} THEN round(least(((CASE WHEN project_name = '' THEN 6 ELSE 7 END) - (CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END)) / 7.0
    + least(n / 4.0, 1.0) * 0.2, 1.0), 6) END AS score,
  CASE WHEN NOT {ok} THEN true END AS kept_text
FROM ({base})""")
    out["h9_services"] = with_ctes(f"""
SELECT work_order_id, CAST(row_number() OVER (PARTITION BY work_order_id ORDER BY line_no) - 1 AS INTEGER) AS pos, service_type,
  CASE WHEN date <> 'N/A' THEN CAST(date AS DATE) END AS date, coalesce(quantity, 0.0) AS quantity, coalesce(hours, 0.0) AS hours
FROM ({_h8_sql()}) WHERE {KEY} % 19 <> 0""")
    out["h26_document_id"] = with_ctes("""
SELECT CASE WHEN work_order_number = 'N/A' THEN 'UNKNOWN' ELSE work_order_number END || '_' || CAST(epoch_ms(extracted_at) AS VARCHAR)
  AS work_order_id, file_url FROM raw""")
    return out


def _contract_sql(body: str) -> str:
    from groundwork.operators.quality import RAW_CONTRACT
    spec = ", ".join(f"({q(f.name)}, {q(f.kind)}, {str(f.required).lower()})" for f in RAW_CONTRACT)
    kinds = ("CASE WHEN column_type = 'VARCHAR' THEN 'STRING' WHEN column_type IN ('INTEGER', 'BIGINT') THEN 'INTEGER' "
             "WHEN column_type IN ('DOUBLE', 'FLOAT') THEN 'FLOAT' WHEN column_type = 'TIMESTAMP' THEN 'TIMESTAMP' END")
    ctes = f"""damaged AS (
  SELECT raw.* EXCLUDE (h8, extracted_at, year, work_order_id), CAST(year AS VARCHAR) AS year,
    CASE WHEN {KEY} % 101 <> 0 THEN work_order_id END AS work_order_id FROM raw),
spec(name, kind, required) AS (VALUES {spec}),
held AS (
  SELECT 'raw_work_orders' AS model, column_name, {kinds} AS kind FROM (DESCRIBE SELECT * FROM raw)
  UNION ALL SELECT 'raw_damaged', column_name, {kinds} FROM (DESCRIBE SELECT * FROM damaged)),
wanted AS (SELECT * FROM (VALUES ('raw_work_orders'), ('raw_damaged')) m(model), spec),
checks AS (
  SELECT w.model, 'column_present(' || w.name || ')' AS check_name, CAST(CASE WHEN h.column_name IS NULL THEN 1 ELSE 0 END AS BIGINT) AS failures
  FROM wanted w LEFT JOIN held h ON h.model = w.model AND h.column_name = w.name
  UNION ALL
  SELECT w.model, 'column_type(' || w.name || ')', CAST(CASE WHEN h.kind = w.kind THEN 0 ELSE 1 END AS BIGINT)
  FROM wanted w JOIN held h ON h.model = w.model AND h.column_name = w.name
  UNION ALL SELECT 'raw_work_orders', 'not_null(work_order_id)', count(*) FILTER (WHERE work_order_id IS NULL) FROM raw
  UNION ALL SELECT 'raw_work_orders', 'not_null(extracted_at)', count(*) FILTER (WHERE extracted_at IS NULL) FROM raw
  UNION ALL SELECT 'raw_damaged', 'not_null(work_order_id)', count(*) FILTER (WHERE work_order_id IS NULL) FROM damaged
  UNION ALL SELECT 'raw_damaged', 'not_null(extracted_at)', count(*) FROM damaged)"""
    return "WITH " + ",\n".join(_fixture_ctes()) + ",\n" + ctes + "\n" + body


def _dashboard_sql(days: int) -> str:
    win = f"work_date >= {AS_OF} - INTERVAL {days} DAY"
    base = report_queries()
    two = lambda c: f"printf('%.2f', coalesce({c}, 0.0))"
    part = lambda name: base[name][base[name].index("\nSELECT") :]
    return with_ctes(f"""
SELECT k.*,
  (SELECT string_agg(strftime(work_date, '%Y-%m-%d') || '|' || daily_orders || '|' || {two('daily_hours')} || '|' || {two('daily_value')}, ';'
     ORDER BY work_date) FROM ({part(f'd8_daily_trend_{days}d')})) AS daily_trend,
  (SELECT string_agg(coalesce(service_category, '-') || '|' || service_count || '|' || {two('total_hours')} || '|' || {two('total_value')}, ';'
     ORDER BY service_category NULLS FIRST) FROM ({part(f'd9_service_breakdown_{days}d')})) AS service_breakdown,
  (SELECT string_agg(builder_name || '|' || order_count || '|' || {two('total_value')}, ';' ORDER BY total_value DESC, builder_name)
     FROM ({part(f'd10_top_builders_{days}d')})) AS top_builders
FROM ({part(f'd11_kpis_{days}d')}) k""")


def stored_queries() -> dict[str, str]:
    """Streams, incremental builds, layouts and contracts: what they must hold in the end."""
    out: dict[str, str] = {}
    out["i1_stream_dedup"] = "SELECT DISTINCT * FROM events"
    out["i2_refresh"] = """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts, user_id,
  CASE WHEN event_id % 7 = 0 THEN event_type || '-changed' ELSE event_type END AS event_type, value, props FROM events"""
    out["a15_publish"] = "SELECT *, event_type AS attribute FROM events"
    old = f"({KEY} % 50 = 0 AND extracted_at <= {CUT})"
    out["l4_incremental"] = with_ctes(f"""
SELECT * REPLACE (CASE WHEN {old} THEN extracted_at + INTERVAL 4000 DAY ELSE extracted_at END AS extracted_at,
  CASE WHEN {old} THEN 'JANUARY' ELSE month END AS month,
  CASE WHEN {old} THEN (CASE WHEN year BETWEEN 1 AND 9999 THEN make_date(year, 1, 1) END) ELSE work_date END AS work_date,
  CASE WHEN {old} THEN 'REVISED ' || description ELSE description END AS description)
FROM stg""")
    out["l6_incremental"] = with_ctes(f"""
SELECT fct.* REPLACE (CASE WHEN {old} THEN extracted_at + INTERVAL 4000 DAY ELSE extracted_at END AS extracted_at,
  CASE WHEN {old} THEN make_date(CAST(year(work_date) AS INTEGER), 1, 1) ELSE work_date END AS work_date,
  CASE WHEN {old} THEN 'REVISED ' || description ELSE description END AS description)
FROM fct""")
    out["a12_clustered"] = with_ctes("SELECT * FROM fct")
    out["a8_upsert_replaces"] = with_ctes(f"""
SELECT work_order_id, CASE WHEN {KEY} % 3 = 0 THEN extracted_at + INTERVAL 1 DAY ELSE extracted_at END AS extracted_at,
  CASE WHEN {KEY} % 6 = 0 THEN month || '-2-3' WHEN {KEY} % 3 = 0 THEN month || '-2' ELSE month END AS month,
  CASE WHEN {KEY} % 3 = 0 THEN CAST(2 AS INTEGER) END AS version FROM stg""")
    out["a9_update_column"] = with_ctes(f"""
SELECT work_order_id, CASE WHEN {KEY} % 6 = 0 THEN NULL WHEN {KEY} % 3 = 0 THEN 'M/2' ELSE month END AS month, extracted_at,
  CASE WHEN {KEY} % 3 = 0 THEN 'note/2' END AS note FROM stg""")
    out["a5_append"] = with_ctes("SELECT work_order_id, builder_name, extracted_at, d8, q8 FROM raw")
    out["a13_csv_export"] = with_ctes(
        "SELECT project_key, project_name_corrected, total_work_orders, first_work_date FROM dim_projects")
    out["f5_by_key"] = with_ctes(
        "SELECT work_order_id, description, company_name_standardized FROM with_ml WHERE description IS NOT NULL")
    shares = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in ("work_order_number", "description", "work_date"))
    out["k9_thresholds"] = with_ctes(f"""
SELECT round(avg_score, 6) AS avg_score, round(share, 6) AS max_null_share, avg_score >= 0.7 AS score_ok, share <= 0.1 AS nulls_ok
FROM (SELECT avg(data_completeness_score) AS avg_score, greatest({shares}) AS share FROM stg)""")
    out["k7_schema_contract"] = _contract_sql("SELECT model, check_name, 'error' AS severity, failures, failures = 0 AS passed FROM checks")
    out["g3_missing_columns"] = _contract_sql("SELECT check_name, failures FROM checks WHERE model = 'raw_damaged' AND failures > 0")
    for days in (30, 365):
        out[f"l10_dashboard_{days}d"] = _dashboard_sql(days)
    profile = operator_queries()["d17_stage_profile"]
    out["d17_stage_sketches"] = f"SELECT * EXCLUDE (p50, p95, p99), true AS within_rank FROM ({profile})"
    return out


def queries() -> dict[str, str]:
    """All queries' SQL, by the names of the registered queries."""
    return {**report_queries(), **operator_queries(), **answer_queries(), **stored_queries()}
