"""Queries over raw text rows: parsing, quality reports, value profiles, contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.fixed_values import OCCUPATION_FAMILIES
from jobtide.functions.codes import municipality_code, occupation_code, row_predicates
from jobtide.functions.numbers import brazilian_number, dotted_thousands_number
from jobtide.functions.periods import month_of, month_start, next_month, quarter_key
from jobtide.functions.text import comparable_value, snake_header_column
from jobtide.operators import cells, contracts, flow_silver, quality, stock
from jobtide.operators.joins import evaluate_once
from jobtide.plans import binding
from jobtide.plans.oracle_sql import STOCK, TEXT
from jobtide.plans.registry import query
from jobtide.sources import csv_export, flow_text, layout

_TECH = sorted(OCCUPATION_FAMILIES)


def silver(spark, sf_dir, whole=False):
    """All movements through the text path: header names, null words, typing, flags.

    With ``whole`` the text columns are built once for every row, as if they came from a file; a query that filters on
    parsed columns asks for it, one that aggregates a few columns does not.
    """
    raw = binding.flow_text_rows(spark, sf_dir)
    raw = evaluate_once(raw) if whole else raw
    context = ["file_kind", "ingest_competence"]
    names = flow_text.flow_names([c for c in raw.columns if c not in context])
    return flow_silver.flow_silver(raw.select(*flow_text.named_columns(names), *context))


@query(
    "flow_quality_report",
    f"""WITH {TEXT} SELECT kind AS file_kind, competence AS ingest_competence, COUNT(*) AS rows_read, COUNT(*) FILTER (NOT bad) AS rows_valid,
      COUNT(*) FILTER (bad) AS rows_rejected, COUNT(*) FILTER (tech) AS rows_tech, COUNT(*) FILTER (erro_uf) AS invalid_uf,
      COUNT(*) FILTER (erro_cbo) AS invalid_cbo, COUNT(*) FILTER (erro_saldo) AS invalid_saldo,
      COUNT(*) FILTER (erro_salario) AS invalid_salary, COUNT(*) FILTER (uf = 'NI') AS non_identified_uf_rows,
      round(COUNT(*) FILTER (NOT bad) / COUNT(*), 6) AS valid_rate FROM q GROUP BY kind, competence""",
)
def flow_quality_report(spark, sf_dir):
    return quality.flow_quality(silver(spark, sf_dir), _TECH, quality.FILE_KEYS)


@query(
    "national_audit",
    f"""WITH {TEXT} SELECT kind AS file_kind, competence AS ingest_competence, COUNT(*) AS rows,
      COUNT(*) FILTER (sgn = 1) AS admissions, COUNT(*) FILTER (sgn = -1) AS dismissals, CAST(COALESCE(SUM(sgn), 0) AS BIGINT) AS balance,
      COUNT(*) FILTER (sgn = 1 AND uf = 'NI') AS non_identified_admissions,
      COUNT(*) FILTER (sgn = -1 AND uf = 'NI') AS non_identified_dismissals,
      CAST(COALESCE(SUM(sgn) FILTER (uf = 'NI'), 0) AS BIGINT) AS non_identified_balance FROM q GROUP BY kind, competence""",
)
def national_audit(spark, sf_dir):
    return quality.national_audit(silver(spark, sf_dir), quality.FILE_KEYS)


@query(
    "adjustment_quality_report",
    f"""WITH {TEXT} SELECT kind AS file_kind, competence AS ingest_competence, COUNT(*) AS rows_read, COUNT(*) FILTER (NOT bad) AS rows_valid,
      COUNT(*) FILTER (bad) AS rows_rejected, COUNT(*) FILTER (tech) AS rows_tech,
      COALESCE(string_agg(DISTINCT competence, ',') FILTER (tech), '') AS effective_competencies,
      round(COUNT(*) FILTER (NOT bad) / COUNT(*), 6) AS valid_rate FROM q WHERE kind <> 'MOV' GROUP BY kind, competence""",
)
def adjustment_quality_report(spark, sf_dir):
    report = quality.adjustment_quality(silver(spark, sf_dir), _TECH)
    return report.withColumn("effective_competencies", F.array_join("effective_competencies", ","))


@query(
    "flow_validity_flags",
    f"WITH {TEXT} SELECT erro_uf, erro_cbo, erro_saldo, erro_salario, bad AS registro_invalido, COUNT(*) AS rows FROM q GROUP BY ALL",
)
def flow_validity_flags(spark, sf_dir):
    return silver(spark, sf_dir).groupBy(*flow_silver.FLAGS, "registro_invalido").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "flow_null_flags_as_read",
    f"""WITH {TEXT} SELECT CASE WHEN uf IS NULL THEN NULL ELSE erro_uf END AS erro_uf,
      CASE WHEN sgn IS NULL THEN NULL ELSE erro_saldo END AS erro_saldo, COUNT(*) AS rows,
      COUNT(*) FILTER (COALESCE(erro_cbo OR erro_salario OR CASE WHEN uf IS NULL THEN NULL ELSE erro_uf END
        OR CASE WHEN sgn IS NULL THEN NULL ELSE erro_saldo END, false)) AS rejected,
      COUNT(*) FILTER (COALESCE(NOT (erro_cbo OR erro_salario OR CASE WHEN uf IS NULL THEN NULL ELSE erro_uf END
        OR CASE WHEN sgn IS NULL THEN NULL ELSE erro_saldo END), false)) AS valid FROM q GROUP BY ALL""",
)
def flow_null_flags_as_read(spark, sf_dir):
    """The three-valued reading of the flags, in which a row with an unknown flag is neither valid nor rejected."""
    typed = silver(spark, sf_dir)
    flags = flow_silver.validity_flags(null_flags="reference")
    rows = typed.withColumns(flags)
    bad = F.col("erro_uf") | F.col("erro_cbo") | F.col("erro_saldo") | F.col("erro_salario")
    return rows.groupBy("erro_uf", "erro_saldo").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"), F.count_if(~bad).alias("valid")
    )


@query(
    "flow_scope_rows",
    f"""WITH {TEXT} SELECT uf, cbo AS cbo_codigo, fam AS cbo_familia, CASE sgn WHEN 1 THEN 'admissao' ELSE 'desligamento' END AS movimento,
      kind AS adjustment_kind, competence AS effective_competence, COUNT(*) AS rows, CAST(SUM(CASE WHEN sgn = 1 THEN fac ELSE 0 END) AS BIGINT) AS admissions_delta,
      CAST(SUM(CASE WHEN sgn = -1 THEN fac ELSE 0 END) AS BIGINT) AS dismissals_delta, CAST(SUM(sgn * fac) AS BIGINT) AS balance_delta,
      CAST(SUM(CAST(salary AS DECIMAL(18, 2))) AS DOUBLE) AS salary_sum, CAST(SUM(l_linenumber) AS BIGINT) AS types
    FROM q WHERE tech GROUP BY ALL""",
)
def flow_scope_rows(spark, sf_dir):
    scope = flow_silver.route_flow(silver(spark, sf_dir, whole=True)).scope
    keys = ["uf", "cbo_codigo", "cbo_familia", "movimento", "adjustment_kind", "effective_competence"]
    return scope.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("admissions_delta", "dismissals_delta", "balance_delta")],
        F.sum(F.col("salario_mensal").cast("decimal(18,2)")).alias("salary_sum"),
        F.sum("tipo_movimentacao").cast("bigint").alias("types"),
    )


@query(
    "number_parsers",
    f"""WITH {TEXT} SELECT kind AS file_kind, COUNT(salary) AS parsed, CAST(SUM(CAST(salary AS DECIMAL(18, 2))) AS DOUBLE) AS total,
      CAST(SUM(CAST(CASE WHEN l_tax = 0.01 THEN salary * 100 ELSE salary END AS DECIMAL(18, 2))) AS DOUBLE) AS dotted_total
    FROM (SELECT l_tax, CASE WHEN l_linenumber = 7 THEN 'FOR' WHEN l_linenumber = 6 AND l_quantity < 5 THEN 'EXC' ELSE 'MOV' END AS kind,
      CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.08 THEN -l_extendedprice ELSE l_extendedprice END AS salary FROM lineitem) GROUP BY kind""",
)
def number_parsers(spark, sf_dir):
    """The two number readings differ on plain decimals: one keeps the dot, the other drops it."""
    raw = binding.flow_text_rows(spark, sf_dir)
    value, dotted = brazilian_number(F.col("salário")), dotted_thousands_number(F.col("salário"))
    return raw.groupBy("file_kind").agg(
        F.count(value).alias("parsed"),
        F.sum(value.cast("decimal(18,2)")).alias("total"),
        F.sum(dotted.cast("decimal(18,2)")).alias("dotted_total"),
    )


@query(
    "code_normalizers",
    """WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) || CAST(o_custkey AS VARCHAR) AS d FROM orders),
    n AS (SELECT CASE length(d) WHEN 5 THEN '0' || d WHEN 6 THEN d END AS occupation, CASE WHEN length(d) IN (6, 7) THEN substr(d, 1, 6) END AS place FROM r)
    SELECT substr(occupation, 1, 4) AS family, substr(place, 1, 2) AS prefix, COUNT(*) AS rows, COUNT(occupation) AS occupations, COUNT(place) AS places FROM n GROUP BY ALL""",
)
def code_normalizers(spark, sf_dir):
    orders = binding.table(spark, sf_dir, "orders")
    raw = F.concat_ws("-", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    codes = orders.select(occupation_code(raw).alias("occupation"), municipality_code(raw).alias("place"))
    return codes.groupBy(
        F.substring("occupation", 1, 4).alias("family"), F.substring("place", 1, 2).alias("prefix")
    ).agg(F.count(F.lit(1)).alias("rows"), F.count("occupation").alias("occupations"), F.count("place").alias("places"))


@query(
    "row_predicates",
    f"""WITH {TEXT} SELECT COALESCE(uf IN ('RO','AC','AM','RR','PA','AP','TO','MA','PI','CE','RN','PB','PE','AL','SE','BA','MG','ES',
      'RJ','SP','PR','SC','RS','MS','MT','GO','DF'), false) AS valid_uf, length(cbo) >= 4 AS valid_cbo, COALESCE(salary >= 0, true) AS valid_salary,
      COUNT(*) AS rows FROM q GROUP BY ALL""",
)
def row_rules(spark, sf_dir):
    rules = row_predicates(F.col("uf"), F.col("cbo_codigo"), F.col("salario_mensal"))
    return silver(spark, sf_dir).groupBy(*[c.alias(n) for n, c in rules.items()]).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "month_functions",
    """SELECT strftime(o_orderdate, '%Y%m') AS competence, strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y%m') AS next_month,
      strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter,
      COUNT(*) AS orders FROM orders GROUP BY ALL""",
)
def month_functions(spark, sf_dir):
    month = F.col("competence")
    rows = binding.table(spark, sf_dir, "orders").groupBy(month_of(F.col("o_orderdate")).alias("competence"))
    counts = rows.agg(F.count(F.lit(1)).alias("orders"))
    return counts.withColumns(
        {"next_month": next_month(month), "first_day": month_start(month).cast("string"), "quarter": quarter_key(month)}
    )


@query(
    "reported_quality",
    f"""WITH {STOCK}, r AS (SELECT source_file, COUNT(*) AS rows_read, COUNT(*) FILTER (NOT bad) AS rows_valid,
      COUNT(*) FILTER (bad_active) + COUNT(*) FILTER (bad_ab) + COUNT(*) FILTER (bad_cbo) + COUNT(*) FILTER (bad_uf) AS rows_rejected FROM s GROUP BY source_file)
    SELECT *, round(rows_valid / rows_read, 6) AS valid_rate, rows_valid + rows_rejected <= rows_read AS consistent FROM r""",
)
def reported_quality(spark, sf_dir):
    """Reasons summed as if each row had one: rows with several reasons make the report inconsistent, and it says so."""
    counters = stock.stock_counters(stock.stock_silver(binding.stock_raw(spark, sf_dir)), ["source_file"])
    reasons = F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in stock.STOCK_REJECT_REASONS])
    long = counters.select("source_file", "rows_read", "rows_valid", F.inline(reasons))
    return quality.reported_quality(long, ["source_file"])


# ---------------------------------------------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------------------------------------------

_PROFILED = ["o_orderstatus", "o_orderpriority", "o_custkey"]
_COUNTS = """c AS (SELECT concept, value, COUNT(*) AS n FROM (
  SELECT 'o_orderstatus' AS concept, o_orderstatus AS value FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders) GROUP BY ALL)"""


def _profile(spark, sf_dir):
    return quality.value_counts(binding.table(spark, sf_dir, "orders"), _PROFILED)


@query(
    "value_profile",
    f"""WITH {_COUNTS} SELECT concept, CAST(SUM(n) AS BIGINT) AS non_blank, CAST(0 AS BIGINT) AS blank, COUNT(*) AS distinct_in_sample,
      CAST(COALESCE(SUM(n) FILTER (regexp_full_match(value, '[0-9]+')), 0) AS BIGINT) AS digits_only FROM c GROUP BY concept""",
)
def value_profile(spark, sf_dir):
    return quality.profile_summary(_profile(spark, sf_dir), ["concept"])


@query("value_profile_lengths", f"WITH {_COUNTS} SELECT concept, length(value) AS length, CAST(SUM(n) AS BIGINT) AS n FROM c GROUP BY ALL")
def value_profile_lengths(spark, sf_dir):
    return quality.profile_lengths(_profile(spark, sf_dir), ["concept"])


@query(
    "value_profile_top",
    f"""WITH {_COUNTS} SELECT concept, value, n, ROW_NUMBER() OVER (PARTITION BY concept ORDER BY n DESC, value) AS rank FROM c
      QUALIFY ROW_NUMBER() OVER (PARTITION BY concept ORDER BY n DESC, value) <= 25""",
)
def value_profile_top(spark, sf_dir):
    return quality.profile_top_values(_profile(spark, sf_dir), ["concept"])


@query(
    "value_profile_observed",
    f"""WITH {_COUNTS} SELECT concept, CASE WHEN COUNT(*) <= 50 THEN string_agg(value, ';' ORDER BY value) END AS observed_values
      FROM c GROUP BY concept""",
)
def value_profile_observed(spark, sf_dir):
    listed = quality.profile_observed_values(_profile(spark, sf_dir), ["concept"])
    return listed.withColumn("observed_values", F.array_join("observed_values", ";"))


_SAMPLE = """p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders),
    s AS (SELECT o_orderpriority AS file, concept, value FROM (SELECT o_orderpriority, 'o_orderstatus' AS concept, o_orderstatus AS value FROM p WHERE rn <= 1000
      UNION ALL SELECT o_orderpriority, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM p WHERE rn <= 1000))"""


@query(
    "profile_first_rows_per_file",
    f"""WITH {_SAMPLE} SELECT file, concept, COUNT(*) AS non_blank, CAST(0 AS BIGINT) AS blank, COUNT(DISTINCT value) AS distinct_in_sample,
      COUNT(*) FILTER (regexp_full_match(value, '[0-9]+')) AS digits_only FROM s GROUP BY GROUPING SETS ((file, concept), (concept))""",
)
def profile_first_rows_per_file(spark, sf_dir):
    """Controlled sample: the first 1000 rows of each part, profiled per part and over all parts."""
    orders = binding.table(spark, sf_dir, "orders").withColumn("file", F.col("o_orderpriority"))
    sample = quality.first_rows_per_file(orders, "file", ["o_orderkey"], 1000)
    return quality.profile_by_file_and_overall(sample, "file", ["o_orderstatus", "o_custkey"])


@query(
    "profile_whole_files",
    f"""WITH {_SAMPLE.replace(" WHERE rn <= 1000", "")} SELECT file, concept, COUNT(*) AS non_blank, CAST(0 AS BIGINT) AS blank, COUNT(DISTINCT value) AS distinct_in_sample,
      COUNT(*) FILTER (regexp_full_match(value, '[0-9]+')) AS digits_only FROM s GROUP BY GROUPING SETS ((file, concept), (concept))""",
)
def profile_whole_files(spark, sf_dir):
    """Every row of each part, profiled per part and over all parts."""
    orders = binding.table(spark, sf_dir, "orders").withColumn("file", F.col("o_orderpriority"))
    return quality.profile_by_file_and_overall(quality.first_rows_per_file(orders, "file", ["o_orderkey"]), "file", ["o_orderstatus", "o_custkey"])


@query("value_profile_counts", f"WITH {_COUNTS} SELECT concept, value, CAST(n AS BIGINT) AS n FROM c")
def value_profile_counts(spark, sf_dir):
    """Every value of every profiled column with its number, none cut off."""
    return _profile(spark, sf_dir)


@query(
    "derived_year_profile",
    """SELECT o_orderpriority AS file, COUNT(*) AS rows_profiled, COUNT(*) AS non_blank, CAST(0 AS BIGINT) AS blank,
      CAST(1 AS BIGINT) AS distinct_in_sample, COUNT(*) AS digits_only, '2025' AS observed_values FROM orders GROUP BY ALL""",
)
def derived_year_profile(spark, sf_dir):
    counted = binding.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("file")).agg(
        F.count(F.lit(1)).alias("rows_profiled")
    )
    profile = quality.derived_year_profile(counted, 2025, "rows_profiled")
    return profile.withColumn("observed_values", F.array_join("observed_values", ","))


# ---------------------------------------------------------------------------------------------------------------
# Layout
# ---------------------------------------------------------------------------------------------------------------

_ALIASES = {"english": ["en", "eng"], "german": ["de", "ger"], "romance": ["fr", "es", "it"], "nordic": ["sv", "da"]}
_MATCHES = """h AS (SELECT DISTINCT source AS file, lang AS col FROM documents),
    a AS (SELECT * FROM (VALUES ('english', ['en', 'eng']), ('german', ['de', 'ger']), ('romance', ['fr', 'es', 'it']), ('nordic', ['sv', 'da'])) t(concept, accepted)),
    m AS (SELECT file, concept, list_sort(list(col) FILTER (list_contains(accepted, col))) AS l FROM h, a GROUP BY file, concept),
    r AS (SELECT file, concept, COALESCE(array_to_string(l, ','), '') AS matches,
      CASE COALESCE(len(l), 0) WHEN 0 THEN 'missing' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS status FROM m)"""


def _alias_match(spark, sf_dir):
    documents = binding.table(spark, sf_dir, "documents")
    headers = documents.select(F.col("source").alias("file"), F.col("lang").alias("column")).distinct()
    return contracts.match_headers(headers, _ALIASES)


@query("alias_match", f"WITH {_MATCHES} SELECT * FROM r")
def alias_match(spark, sf_dir):
    return _alias_match(spark, sf_dir).withColumn("matches", F.array_join("matches", ","))


@query(
    "layout_readiness",
    f"""WITH {_MATCHES} SELECT file, COALESCE(string_agg(concept, ',' ORDER BY concept) FILTER (status = 'missing'), '') AS missing_required,
      COALESCE(string_agg(concept, ',' ORDER BY concept) FILTER (status = 'ambiguous'), '') AS ambiguous_required, bool_and(status = 'matched') AS valid
    FROM r GROUP BY file""",
)
def layout_readiness(spark, sf_dir):
    ready = contracts.layout_readiness(_alias_match(spark, sf_dir))
    return ready.withColumns({c: F.array_join(c, ",") for c in ("missing_required", "ambiguous_required")})


_OCCURRENCES = ", ".join(
    f"length(text) - length(replace(text, {mark}, '')) AS {name}"
    for name, mark in (("a", "';'"), ("b", "'|'"), ("c", "chr(9)"), ("d", "','"))
)


@query(
    "delimiter_detection",
    f"""WITH n AS (SELECT conv_id, turn, {_OCCURRENCES} FROM conversations)
    SELECT conv_id, turn, CASE WHEN greatest(a, b, c, d) = 0 THEN NULL WHEN a = greatest(a, b, c, d) THEN ';' WHEN b = greatest(a, b, c, d) THEN '|'
      WHEN c = greatest(a, b, c, d) THEN chr(9) ELSE ',' END AS delimiter FROM n""",
)
def delimiter_detection(spark, sf_dir):
    turns = binding.table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", layout.detect_delimiter(F.col("text")).alias("delimiter"))


@query(
    "header_layouts",
    """WITH h AS (SELECT p_partkey, ['código da peça', p_name, p_brand, 'Tipo - ' || p_type, '"Tamanho; ' || p_size || '"'] AS c FROM part),
    n AS (SELECT p_partkey, list_transform(c, lambda x: trim(regexp_replace(lower(strip_accents(x)), '[^a-z0-9]+', '_', 'g'), '_')) AS n FROM h)
    SELECT CAST(p_partkey AS VARCHAR) || '.csv' AS file, '.csv' AS suffix, ';' AS delimiter, array_to_string(n, ' ') AS normalized,
      CAST(5 AS BIGINT) AS column_count, sha256(array_to_string(n, chr(10))) AS header_signature_sha256, CAST(NULL AS VARCHAR) AS problem FROM n""",
)
def header_layouts(spark, sf_dir):
    """One header per part, with accents and a quoted field that holds the delimiter."""
    parts = binding.table(spark, sf_dir, "part")
    heads = parts.select(
        F.concat(F.lit("file:/parts/"), F.col("p_partkey").cast("string"), F.lit(".csv")).alias("path"),
        F.lit("utf-8").alias("encoding"),
        F.concat_ws(
            ";", F.lit("código da peça"), "p_name", "p_brand", F.concat(F.lit("Tipo - "), "p_type"),
            F.concat(F.lit('"Tamanho; '), F.col("p_size").cast("string"), F.lit('"')),
        ).alias("header_line"),
    )
    described = layout.describe_layouts(heads)
    return described.select(
        "file", "suffix", "delimiter", F.array_join("normalized_columns", " ").alias("normalized"), "column_count",
        "header_signature_sha256", "problem",
    )


@query(
    "snake_headers",
    """SELECT trim(regexp_replace(lower(strip_accents(p_name || ' (' || p_type || ') - Município ' || p_brand)), '[^a-z0-9]+', '_', 'g'), '_') AS header,
      COUNT(*) AS parts FROM part GROUP BY ALL""",
)
def snake_headers(spark, sf_dir):
    text = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") - Município "), "p_brand")
    headers = binding.table(spark, sf_dir, "part").groupBy(snake_header_column(text).alias("header"))
    return headers.agg(F.count(F.lit(1)).alias("parts"))


@query(
    "comparable_values",
    "SELECT doc_id, md5(trim(regexp_replace(replace(lower(strip_accents(text)), 'ß', 'ss'), '\\s+', ' ', 'g'))) AS folded FROM documents",
)
def comparable_values(spark, sf_dir):
    return binding.table(spark, sf_dir, "documents").select("doc_id", F.md5(comparable_value(F.col("text"))).alias("folded"))


@query(
    "population_snapshot_check",
    """WITH p AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS code, CAST(floor(c_acctbal) AS BIGINT) AS population FROM customer)
    SELECT COUNT(*) AS entries, CAST(0 AS BIGINT) AS bad_codes, COUNT(*) FILTER (NOT population > 0) AS bad_population,
      COUNT(DISTINCT substr(code, 1, 6)) AS prefixes, false AS valid FROM p""",
)
def population_snapshot_check(spark, sf_dir):
    people = binding.table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("code"), F.floor("c_acctbal").alias("population")
    )
    return contracts.population_snapshot_check(people)


_INDEX = "i AS (SELECT date_trunc('month', o_orderdate) AS m, COUNT(*) AS v FROM orders GROUP BY 1)"


@query(
    "monthly_index_rates",
    f"""WITH {_INDEX} SELECT strftime(i.m, '%Y%m') AS month, CAST(i.v AS DOUBLE) AS value, CAST(b.v AS DOUBLE) AS previous,
      round((i.v / b.v - 1) * 100, 2) AS monthly_rate FROM i LEFT JOIN i b ON b.m + INTERVAL 1 MONTH = i.m""",
)
def monthly_index_rates(spark, sf_dir):
    return contracts.monthly_index_rates(binding.price_index(spark, sf_dir))


@query(
    "index_snapshot_check",
    f"""WITH {_INDEX} SELECT COUNT(*) FILTER (m = DATE '1998-07-01') = 1 AS month_present, COUNT(*) FILTER (m = DATE '1998-06-01') = 1 AS base_present,
      round((MAX(v) FILTER (m = DATE '1998-07-01') / MAX(v) FILTER (m = DATE '1998-06-01') - 1) * 100, 2) AS rate,
      COUNT(*) FILTER (m = DATE '1998-07-01') = 1 AND COUNT(*) FILTER (m = DATE '1998-06-01') = 1 AS valid FROM i""",
)
def index_snapshot_check(spark, sf_dir):
    return contracts.index_snapshot_check(binding.price_index(spark, sf_dir), "199807", "199806")


# ---------------------------------------------------------------------------------------------------------------
# Cells and export
# ---------------------------------------------------------------------------------------------------------------


def _cells(spark, sf_dir):
    """Part attributes as spreadsheet cells; one sheet per brand."""
    parts = binding.table(spark, sf_dir, "part")
    code = F.col("p_partkey") + 300000
    values = F.array(
        F.struct(F.lit(1).alias("col"), F.lit("int").alias("kind"), code.cast("string").alias("value")),
        F.struct(F.lit(2).alias("col"), F.lit("text").alias("kind"), F.concat(F.lit("CBO "), code.cast("string"), F.lit("-x")).alias("value")),
        F.struct(F.lit(3).alias("col"), F.lit("float").alias("kind"), F.concat(F.col("p_size").cast("string"), F.lit(".5")).alias("value")),
        F.struct(F.lit(4).alias("col"), F.lit("float").alias("kind"), F.concat(code.cast("string"), F.lit(".0")).alias("value")),
        F.struct(F.lit(5).alias("col"), F.lit("bool").alias("kind"), code.cast("string").alias("value")),
    )
    return parts.select(F.col("p_brand").alias("sheet"), (F.col("p_partkey") + 2).alias("row"), F.inline(values))


def _expected_codes(spark, sf_dir):
    return binding.table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + 300500).cast("string").alias("code")).distinct()


_EXPECTED = "x AS (SELECT DISTINCT CAST(l_partkey + 300500 AS VARCHAR) AS code FROM lineitem)"


@query(
    "code_coverage",
    f"WITH {_EXPECTED} SELECT code, CAST(code AS BIGINT) - 300000 IN (SELECT p_partkey FROM part) AS matched FROM x",
)
def code_coverage(spark, sf_dir):
    return cells.code_coverage(_cells(spark, sf_dir), _expected_codes(spark, sf_dir))


@query("missing_codes", f"WITH {_EXPECTED} SELECT code FROM x WHERE CAST(code AS BIGINT) - 300000 NOT IN (SELECT p_partkey FROM part)")
def missing_codes(spark, sf_dir):
    return cells.missing_codes(_cells(spark, sf_dir), _expected_codes(spark, sf_dir))


@query(
    "join_columns",
    f"""WITH {_EXPECTED} SELECT p_brand AS sheet, col, COUNT(*) AS matched_count, CAST(NULL AS VARCHAR) AS header FROM x JOIN part ON CAST(code AS BIGINT) - 300000 = p_partkey
      CROSS JOIN (VALUES (CAST(1 AS BIGINT)), (2), (4)) c(col) GROUP BY p_brand, col""",
)
def join_columns(spark, sf_dir):
    return cells.join_columns(_cells(spark, sf_dir), _expected_codes(spark, sf_dir), list_codes=False)


@query(
    "csv_safe_cells",
    """SELECT conv_id, turn, CASE WHEN regexp_matches(text, '^\\s*[=+@-]') THEN '''' || text ELSE text END AS text,
      CASE WHEN regexp_matches(role, '^\\s*[=+@-]') THEN '''' || role ELSE role END AS role FROM conversations
    UNION ALL SELECT doc_id, n_chars, CASE WHEN regexp_matches(text, '^\\s*[=+@-]') THEN '''' || text ELSE text END, source FROM documents
    UNION ALL SELECT p_partkey, p_size, '''-' || p_name, '''  =' || p_brand FROM part""",
)
def csv_safe_cells(spark, sf_dir):
    """Text cells of three tables made safe for a spreadsheet; numbers stay as they are."""
    turns = binding.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", "role")
    documents = binding.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), "text", F.col("source").alias("role")
    )
    parts = binding.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("conv_id"), F.col("p_size").cast("bigint").alias("turn"),
        F.concat(F.lit("-"), "p_name").alias("text"), F.concat(F.lit("  ="), "p_brand").alias("role"),
    )
    return csv_export.safe_cells(csv_export.union_of_items([turns, documents, parts]))
