"""Queries over gates, approvals, decisions and guarded writes whose facts come from the tables on both sides."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError, NotApprovedError
from jobtide.functions.periods import month_of
from jobtide.functions.salary import ELIGIBLE, SalaryRule, with_salary_eligibility
from jobtide.operators import cells, contracts, flow_gold, gates, history, joins, official, stock
from jobtide.plans import binding
from jobtide.plans.oracle_sql import COUNTS, FLOW, PLACES, STOCK
from jobtide.plans.registry import query
from jobtide.sources import layout, tables

METRICS = ["admissions", "dismissals", "balance"]


def _counts(rows, *by):
    return rows.groupBy(*by).agg(*[F.sum(f"{c}_delta").cast("bigint").alias(c) for c in METRICS])


# ---------------------------------------------------------------------------------------------------------------
# Population and national checks of the monthly gate
# ---------------------------------------------------------------------------------------------------------------

#: Defects by the last two digits of the month; each breaks one condition of a check.
_DEFECTS = {"01": "date", "02": "url", "03": "published", "04": "hash", "05": "status", "06": "year", "07": "rate", "08": "uncovered", "09": "report", "10": "missing", "11": "reference", "12": ""}
_POPULATION_CHECKS = ["municipality_population_metadata", "municipality_population_coverage", "municipality_population_report", "official_reference_integrity", "national_reference_reconciliation", "non_identified_reconciliation"]


@query(
    "population_gate_checks",
    f"""WITH {FLOW}, m AS (SELECT competence, substr(competence, 5, 2) AS mm, COUNT(DISTINCT municipio_codigo_caged) AS places,
      COUNT(DISTINCT municipio_codigo_caged) FILTER (CAST(municipio_codigo_caged AS BIGINT) % 2 = 0) AS even_places,
      COUNT(DISTINCT municipio_codigo_caged) FILTER (CAST(municipio_codigo_caged AS BIGINT) % 2 = 0 AND adm <> 0) AS even_hiring,
      SUM(adm) AS a, SUM(dis) AS d, SUM(bal) AS b, SUM(CASE WHEN region = 'ASIA' THEN adm ELSE 0 END) AS na, COUNT(*) FILTER (region = 'EUROPE') AS europe
      FROM f WHERE kind = 'MOV' GROUP BY competence)
    SELECT competence, id, CASE id
      WHEN 'municipality_population_metadata' THEN mm NOT IN ('01', '02', '03', '04', '05')
      WHEN 'municipality_population_coverage' THEN NOT (mm = '06' AND even_places > 0) AND NOT (mm = '07' AND even_hiring > 0) AND NOT (mm = '08' AND even_places > 0)
      WHEN 'municipality_population_report' THEN mm <> '04' AND mm <> '09' AND NOT (mm = '08' AND even_places > 0)
      WHEN 'official_reference_integrity' THEN mm <> '11'
      WHEN 'national_reference_reconciliation' THEN mm <> '11' AND europe % 2 = 0
      WHEN 'non_identified_reconciliation' THEN na % 3 <> 0 END AS passed, true AS blocking
    FROM m CROSS JOIN (VALUES {", ".join(f"('{i}')" for i in _POPULATION_CHECKS)}) t(id) WHERE NOT (mm = '10' AND id LIKE 'municipality_population%')""",
)
def population_gate_checks(spark, sf_dir):
    """Checks on population metadata, coverage, recomputed rates and the enrichment report, and national and not-identified totals, of every month."""
    rows = binding.flow(spark, sf_dir, "competence", "region", "municipio_codigo_caged").where("adjustment_kind = 'MOV'")
    rows = joins.evaluate_once(rows, ["competence", "region", "municipio_codigo_caged", "admissions_delta", "dismissals_delta", "balance_delta"])
    defect = lambda name: F.substring("competence", 5, 2) == next(m for m, d in _DEFECTS.items() if d == name)
    even = F.col("municipio_codigo_caged").cast("bigint") % 2 == 0
    counts = _counts(rows, "competence", "municipio_codigo_caged")
    people = counts.select(F.col("municipio_codigo_caged").alias("municipio_codigo_ibge")).distinct().withColumn("population", F.lit(1000) + F.col("municipio_codigo_ibge").cast("bigint"))
    named = counts.withColumns({"municipio_codigo_ibge": F.col("municipio_codigo_caged"), "municipio_nome": F.lit("x"), "uf": F.lit("XX")})
    items = flow_gold.with_population_rates(named, people, 2001).withColumn("municipio_codigo_ibge", F.lpad("municipio_codigo_ibge", 7, "0"))
    gone = defect("uncovered") & even
    items = items.withColumns(
        {
            "population_reference_year": F.when(defect("year") & even, F.lit(2000)).otherwise(F.col("population_reference_year")),
            "admissions_per_100k": F.when(defect("rate") & even & (F.col("admissions") != 0), F.lit(-1.0)).otherwise(F.col("admissions_per_100k")),
            "population_estimate": F.when(~gone, F.col("population_estimate")),
        }
    )
    facts = gates.municipality_facts(items)
    months = facts.select("competence")
    sha = F.sha2("competence", 256)
    header = months.select(
        "competence", F.when(~defect("missing"), F.lit("census")).alias("source"), F.lit(2001).alias("reference_year"),
        F.when(defect("date"), F.lit("2001-01-01")).otherwise("2001-07-01").alias("reference_date"),
        F.when(defect("url"), F.lit("ftp://x")).otherwise("https://x").alias("source_url"),
        F.when(defect("published"), F.lit("soon")).otherwise("2001-08-30").alias("published_at"),
        F.when(defect("hash"), F.lit("short")).otherwise(sha).alias("cache_sha256"), sha.alias("artifact_sha256"),
        F.when(defect("status"), F.lit("partial")).otherwise("complete").alias("enrichment_status"),
    )
    report = items.groupBy("competence").agg(F.count("population_estimate").alias("matched_population"), F.count_if(F.col("population_estimate").isNull()).alias("missing_population"))
    report = report.select(
        "*", F.lit(True).alias("coverage_complete"), F.when(defect("report"), F.lit(1999)).otherwise(F.lit(2001)).alias("population_year"),
        sha.alias("population_cache_sha256"), sha.alias("municipality_artifact_sha256"),
    )
    audit = _counts(rows, "competence")
    asia = rows.groupBy("competence").agg(
        F.sum(F.when(F.col("region") == "ASIA", F.col("admissions_delta")).otherwise(0)).alias("n"), F.count_if(F.col("region") == "EUROPE").alias("europe")
    )
    both = audit.join(asia, "competence")
    audited = both.select("*", F.col("n").alias("non_identified_admissions"), F.lit(0).alias("non_identified_dismissals"), F.col("n").alias("non_identified_balance"))
    off = F.col("europe") % 2
    reference = both.select(
        "competence", (F.col("admissions") + off).alias("admissoes"), F.col("dismissals").alias("desligamentos"),
        (F.col("balance") + off + F.when(defect("reference"), 1).otherwise(0)).alias("saldo"),
        F.when(F.col("n") % 3 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("ni_admissoes"), F.lit(0).alias("ni_desligamentos"), F.col("n").alias("ni_saldo"), sha.alias("reference_sha256"),
    )
    quality_rows = audit.select("competence", F.lit(1).alias("rows_read"), F.lit(1).alias("rows_valid"), F.lit(0).alias("rows_rejected"), F.lit(1.0).alias("valid_rate"))
    approvals = months.select("competence", F.lit(True).alias("approved"), sha.alias("source_sha256"), sha.alias("reference_sha256"))
    judged = gates.monthly_gate(
        months, quality=quality_rows, overview=audit, market=audit, audit=audited, municipality=facts, manifests=months.select("competence", sha.alias("sha256")),
        official=reference, approvals=approvals, population_header=header, enrichment=report,
    )
    return judged.where(F.col("id").isin(_POPULATION_CHECKS)).drop("message")


# ---------------------------------------------------------------------------------------------------------------
# Approvals and decisions
# ---------------------------------------------------------------------------------------------------------------


@query(
    "approval_log",
    """WITH h AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN COUNT(*) FILTER (o_orderstatus = 'P') % 2 = 0 THEN sha256(CAST(COUNT(*) AS VARCHAR)) END AS sha
      FROM orders GROUP BY 1)
    SELECT year, sha AS release_sha256, true AS approved, CASE WHEN year >= '1999' THEN 'second' ELSE 'first' END AS reviewer, year AS notes FROM h WHERE sha IS NOT NULL""",
)
def approval_log(spark, sf_dir):
    """Approvals of every year are appended, those since 1999 twice; years without a hash cannot be approved, and the last entry of a year counts."""
    orders = binding.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("string").alias("year"))
    facts = orders.agg(F.count(F.lit(1)).cast("string").alias("n"), (F.count_if(F.col("o_orderstatus") == "P") % 2 == 0).alias("known"))
    hashes = tables.materialize(facts.select("year", F.when(F.col("known"), F.sha2("n", 256)).alias("release_sha256")), "release-hashes")
    years = sorted(r.year for r in hashes.select("year").collect())
    path = tables.scratch_path(spark, "approvals")
    for year in years:
        for reviewer, at in [("first", "2025-01-01"), *([("second", "2025-02-01")] if year >= "1999" else [])]:
            tables.write_table(gates.approval_record("year", year, reviewer, year, hashes, F.lit(at)), path, mode="append")
    return gates.current_approvals(tables.read_table(spark, path), "year").drop("approved_at_utc")


_SCENARIOS = ["first", "none", "locked_start", "next", "gap", "unregistered", "early", "locked", "revised"]


@query(
    "decision_outcomes",
    """WITH o AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS m FROM orders), b AS (SELECT MIN(m) AS first, MAX(m) AS last FROM o),
    s(scenario, ready, reason) AS (VALUES ('first', true, 'ready'), ('none', false, 'official_reference_not_registered'), ('locked_start', false, 'coverage_policy_locked'),
      ('next', true, 'ready'), ('gap', false, 'reference_gap'), ('unregistered', false, 'official_reference_not_registered'), ('early', false, 'reference_not_effective_yet'),
      ('locked', false, 'coverage_policy_locked'), ('revised', true, 'published_reference_revision')),
    n AS (SELECT (SELECT m FROM o ORDER BY m LIMIT 1 OFFSET 1) AS second, (SELECT m FROM o ORDER BY m LIMIT 1 OFFSET 2) AS third)
    SELECT scenario, ready, reason, CASE WHEN scenario IN ('first', 'none', 'locked_start') THEN NULL WHEN scenario = 'unregistered' THEN last ELSE first END AS latest_published,
      CASE WHEN ready THEN CASE scenario WHEN 'next' THEN second ELSE first END END AS candidate FROM s, b, n""",
)
def decision_outcomes(spark, sf_dir):
    """The seven reasons of the next-month decision, each from the months of the orders with one thing missing."""
    months = binding.table(spark, sf_dir, "orders").select(month_of(F.col("o_orderdate")).alias("competence")).distinct()
    bounds = months.agg(F.sort_array(F.collect_set("competence")).alias("m")).first().m  # the calendar months of the table
    first, second, last = bounds[0], bounds[1], bounds[-1]
    day = F.concat_ws("-", F.substring("competence", 1, 4), F.substring("competence", 5, 2), F.lit("28"))
    known = months.select("competence", day.alias("published_at"), F.sha2("competence", 256).alias("reference_sha256"))
    old, late, early = known.where(F.col("competence") == first).select("competence"), date(2010, 1, 1), date(int(second[:4]), int(second[4:]), 1)
    empty, stale = old.limit(0), known.select("competence", F.lit("stale").alias("reference_sha256")).where(F.col("competence") == first)
    cases = {
        "first": (empty, known, late, {}), "none": (empty, known.limit(0), late, {}), "locked_start": (empty, known, late, {"max_month": "190001"}),
        "next": (old, known, late, {}), "gap": (old, known.where(F.col("competence") != second), late, {}),
        "unregistered": (known.where(F.col("competence") == last).select("competence"), known, late, {}), "early": (old, known, early, {}),
        "locked": (old, known, late, {"max_month": first}), "revised": (old, known, late, {"approvals": stale}),
    }
    rows = [official.next_month_decision(p, o, today, **more).select(F.lit(name).alias("scenario"), "ready", "reason", "latest_published", "candidate") for name, (p, o, today, more) in cases.items()]
    return reduce(DataFrame.unionByName, rows)


@query(
    "reaudit_requests",
    """WITH o AS (SELECT strftime(o_orderdate, '%Y%m') AS m, COUNT(*) AS n FROM orders GROUP BY 1), b AS (SELECT *, m <= '199912' AS published, row_number() OVER (ORDER BY m) AS k FROM o),
    d AS (SELECT MIN(m) FILTER (NOT published) AS next FROM b)
    SELECT m AS requested, CASE WHEN m = next THEN 'ready' WHEN published AND n % 2 = 0 THEN 'published_reaudit' ELSE 'refused' END AS outcome FROM b, d WHERE k % 12 = 1""",
)
def reaudit_requests(spark, sf_dir):
    """Requests to audit the first month of every twelfth: the next month is ready, published ones may be audited again if their total is sound."""
    months = binding.table(spark, sf_dir, "orders").groupBy(month_of(F.col("o_orderdate")).alias("competence")).agg(F.count(F.lit(1)).alias("n"))
    day = F.concat_ws("-", F.substring("competence", 1, 4), F.substring("competence", 5, 2), F.lit("28"))
    reference = tables.materialize(
        months.select(
            "competence", F.lit("published_monthly_mov").alias("reference_kind"), F.lit("ministry").alias("source"), F.lit("https://x").alias("source_url"), day.alias("published_at"),
            (F.col("n") + 1).alias("admissoes"), F.lit(1).cast("bigint").alias("desligamentos"), (F.col("n") + F.col("n") % 2).alias("saldo"), F.sha2("competence", 256).alias("reference_sha256"),
        ), "references")
    published = reference.where("competence <= '199912'").select("competence")
    decision = tables.materialize(official.next_month_decision(published, reference, date(2010, 1, 1)), "decision")
    found = []
    for requested in sorted(r.competence for r in reference.select("competence").collect())[::12]:
        try:
            row = official.require_auditable(requested, decision, published, reference, date(2010, 1, 1), allow_published=True).first()
            found.append((requested, row.reason))
        except NotApprovedError:
            found.append((requested, "refused"))
    return spark.createDataFrame(found, "requested string, outcome string")


# ---------------------------------------------------------------------------------------------------------------
# Annual gate, parts, salary bounds
# ---------------------------------------------------------------------------------------------------------------


@query(
    "annual_gate_from_tables",
    f"""WITH {STOCK}, {PLACES}, t AS (SELECT s.*, dim_uf FROM s LEFT JOIN places USING (mun)),
    n AS (SELECT COUNT(*) FILTER (tech) AS tech, COUNT(*) FILTER (active) AS active, COUNT(*) FILTER (st = 'O' AND ab = '0') AS eligible, COUNT(*) FILTER (st = 'P') AS unknown,
      COUNT(*) FILTER (st = 'O' AND ab = '') AS unknown_ab, COUNT(DISTINCT source_file) AS parts, COUNT(*) FILTER (bad) AS rejected,
      COUNT(*) FILTER (tech AND mun <> '999999' AND dim_uf IS NULL) AS unmatched FROM t),
    v AS (SELECT *, unknown = 0 AND unknown_ab = 0 AND eligible > 0 AS reconciled, unknown = 0 AND unknown_ab = 0 AND rejected = 0 AS regional FROM n)
    SELECT CAST(2024 AS BIGINT) AS year, id, CASE id WHEN 'exact_national_reconciliation' THEN reconciled WHEN 'exact_regional_reconciliation' THEN regional
      WHEN 'municipality_dimension' THEN unmatched = 0 WHEN 'overview_stock_integrity' THEN active > 0 AND active = eligible AND tech <= active
      WHEN 'source_provenance' THEN parts > 0 WHEN 'manual_methodology_approval' THEN tech % 2 = 0 WHEN 'municipality_total' THEN true ELSE true END AS passed, true AS blocking
    FROM v, (VALUES ('source_provenance'), ('artifact_reconciliation'), ('artifact_regional_reconciliation'), ('artifact_municipality_validation'), ('artifact_overview'),
      ('artifact_by_uf'), ('artifact_by_cbo_family'), ('artifact_by_municipality'), ('artifact_market'), ('exact_national_reconciliation'),
      ('exact_regional_reconciliation'), ('municipality_dimension'), ('overview_year'), ('overview_stock_integrity'), ('pre_gate_publication_block'),
      ('uf_total'), ('cbo_family_total'), ('municipality_total'), ('market_total'), ('release_fingerprint'), ('manual_methodology_approval')) t(id)""",
)
def annual_gate_from_tables(spark, sf_dir):
    """The annual gate over what its tables say: reconciliations, the dimension check and every published total are computed, each from its own table."""
    silver = tables.materialize(stock.stock_silver(binding.stock_raw(spark, sf_dir)), "stock-rows")
    scope = tables.materialize(stock.route_stock(silver, 2024, stored=True).scope, "stock-scope")
    parts = tables.materialize(stock.with_stock_identities(stock.stock_counters(silver, ["source_file"])), "stock-parts")
    eligible = parts.agg(F.sum("rows_stock_eligible_source").alias("active_links")).withColumn("year", F.lit(2024))
    national = gates.annual_reconciliation(stock.merge_stock_counters(parts).withColumn("year", F.lit(2024)), eligible)
    expected = parts.select("source_file", F.col("rows_stock_eligible_source").alias("expected_stock"))
    regional = gates.regional_summary(gates.regional_reconciliation(parts, expected, "source_file"), eligible.select("active_links").scalar())
    dimension = binding.municipality_dimension(spark, sf_dir)
    checked = contracts.municipality_dimension_check(scope, dimension.select(F.col("municipio_codigo_ibge").alias("code7")))
    total = lambda table: table.agg(F.sum("active_stock")).scalar()
    hashes = parts.agg(F.transform(F.array_sort(F.collect_set("source_file")), lambda s: F.sha2(s, 256)).alias("h"))
    active = silver.agg(F.count_if(F.col("status").isin("scope", "out_of_scope"))).scalar()
    overview = stock.stock_overview(scope, active)
    release = F.sha2(F.array_join("source_hashes", ","), 256)
    facts = national.select(
        "year", "reconciled", "gold_ready", "difference", "expected_active", hashes.select("h").scalar().alias("source_hashes"),
        regional.select("regional_reconciled").scalar().alias("regional_reconciled"), regional.select("difference").scalar().alias("regional_difference"), regional.select("group_count").scalar().alias("regional_groups"),
        checked.select("municipality_ready").scalar().alias("municipality_ready"), checked.select("unmatched_codes").scalar().alias("unmatched_codes"), checked.select("uf_mismatch_rows").scalar().alias("uf_mismatch_rows"),
        overview.select("active_stock_tech").scalar().alias("active_stock_tech"), overview.select("active_stock_national_reference").scalar().alias("active_stock_national_reference"),
        F.lit(False).alias("publication_ready"), total(stock.stock_by(scope, ["uf"])).alias("uf_total"), total(stock.stock_by(scope, ["cbo_familia"])).alias("family_total"),
        total(stock.stock_by_municipality(scope, dimension)).alias("municipality_total"), total(stock.stock_market(scope)).alias("market_total"),
    )
    facts = facts.withColumn("release_sha256", release).withColumns({"approval_approved": F.lit(True), "approval_release_sha256": F.when(F.col("active_stock_tech") % 2 == 0, release).otherwise("old")})
    return gates.annual_gate(facts).drop("message")


@query("part_union", f"WITH {STOCK} SELECT source_file, COUNT(*) FILTER (tech) AS links, true AS refused FROM s GROUP BY source_file HAVING COUNT(*) FILTER (tech) > 0")
def part_union(spark, sf_dir):
    """Parts of one schema are put together; a part with another is refused."""
    scope = stock.route_stock(stock.stock_silver(binding.stock_raw(spark, sf_dir)), 2025).scope
    scope = tables.materialize(scope, "stock-scope")
    names = [r.source_file for r in scope.select("source_file").distinct().collect()]
    parts = [scope.where(F.col("source_file") == name) for name in sorted(names)]
    try:
        tables.union_parts([*parts, parts[0].withColumn("year", F.col("year").cast("int"))])
        refused = False
    except LayoutError:
        refused = True
    return tables.union_parts(parts).groupBy("source_file").agg(F.count(F.lit(1)).alias("links")).withColumn("refused", F.lit(refused))


_WAGES = {1992: 80.0, 1993: 85.5, 1994: 90.0, 1995: 95.3, 1996: 100.0, 1997: 112.33, 1998: 120.0, 1999: 130.4, 2000: 136.0, 2001: 151.0, 2002: 180.0, 2003: 200.0}


@query(
    "salary_rule_by_year",
    f"""WITH w(year, wage) AS (VALUES {", ".join(f"({y}, {w})" for y, w in _WAGES.items())}),
    b AS (SELECT year, round(wage * 40.3, 2) AS low, round(wage * 301.7, 2) AS high FROM w)
    SELECT CAST(b.year AS BIGINT) AS year, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, COUNT(*) FILTER (l_returnflag <> 'R' AND l_tax <> 0 AND l_extendedprice BETWEEN low AND high) AS eligible, COUNT(*) AS rows
    FROM lineitem JOIN b ON year(l_shipdate) = b.year GROUP BY ALL""",
)
def salary_rule_by_year(spark, sf_dir):
    """Salary bounds follow the minimum wage of each row's year."""
    rule = SalaryRule(_WAGES, 40.3, 301.7)
    rows = binding.table(spark, sf_dir, "lineitem").select(
        month_of(F.col("l_shipdate")).alias("competence"), F.when(F.col("l_returnflag") == "R", -1).otherwise(1).alias("saldo_movimentacao"),
        F.col("l_extendedprice").alias("salario_mensal"), F.when(F.col("l_tax") == 0, "sim").otherwise("0").alias("indicador_trabalho_intermitente"),
    )
    low, high = rule.bound_columns(F.col("competence"))
    judged = with_salary_eligibility(rows, rule, F.col("competence")).withColumns({"low": low, "high": high, "year": F.substring("competence", 1, 4).cast("bigint")})
    return judged.groupBy("year", "low", "high").agg(F.count_if(F.col(ELIGIBLE)).alias("eligible"), F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------------------------------------------
# Guarded revision
# ---------------------------------------------------------------------------------------------------------------


@query(
    "applied_revision",
    f"""WITH {FLOW} SELECT competence, uf, {COUNTS} FROM f WHERE kind = 'MOV' OR substr(competence, 5, 2) > '06' GROUP BY competence, uf""",
)
def applied_revision(spark, sf_dir):
    """Published base months are revised where late rows of a second half-year touch them; a second, stale application is refused."""
    rows = binding.flow(spark, sf_dir, "competence", "uf")
    path = tables.scratch_path(spark, "published")
    base = _counts(rows.where("adjustment_kind = 'MOV'"), "competence", "uf")
    tables.replace_partitions(base, path, ["competence"])
    shape = "uf string, admissions bigint, dismissals bigint, balance bigint, competence string"
    published = lambda: spark.read.schema(shape).parquet(path).select("competence", "uf", *METRICS)
    wanted = rows.where("adjustment_kind = 'MOV' OR substr(competence, 5, 2) > '06'")
    rebuilt = tables.materialize(_counts(wanted, "competence", "uf"), "rebuilt")
    before, after = (tables.materialize(history.table_snapshot(t, "by-uf"), "snapshot") for t in (published(), rebuilt))
    verdict = spark.createDataFrame([("209901", True, [])], "ingest_competence string, passed boolean, missing_rebuild_baselines array<string>")
    package = tables.materialize(history.revision_package(verdict, history.artifact_changes(before, after)), "package")
    history.apply_revision(verdict, package, {"by-uf": rebuilt}, {"by-uf": published()}, {"by-uf": path})
    if not package.isEmpty():
        try:
            history.apply_revision(verdict, package, {"by-uf": rebuilt}, {"by-uf": published()}, {"by-uf": path})
        except NotApprovedError:
            pass
        else:
            raise ConsistencyError("a package was applied twice")
    return published()


# ---------------------------------------------------------------------------------------------------------------
# Headers, cells, families
# ---------------------------------------------------------------------------------------------------------------


@query(
    "header_problems",
    """WITH h AS (SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN 'no delimiter' WHEN 2 THEN 'a;b;c' WHEN 3 THEN 'a;;c;d;' || p_name WHEN 4 THEN 'Ação;b;c;d;acao'
      ELSE 'a;b;c;d;' || p_name END AS line, p_size % 6 AS k FROM part)
    SELECT CASE k WHEN 0 THEN 'file is empty' WHEN 1 THEN 'no delimiter in header' WHEN 2 THEN 'too few columns' WHEN 3 THEN 'empty column name' WHEN 4 THEN 'duplicate column name' END AS problem,
      COUNT(*) AS files FROM h GROUP BY k""",
)
def header_problems(spark, sf_dir):
    """One header per part, five kinds of them broken."""
    kind = F.col("p_size") % 6
    line = F.when(kind == 1, "no delimiter").when(kind == 2, "a;b;c").when(kind == 3, F.concat(F.lit("a;;c;d;"), "p_name")).when(kind == 4, "Ação;b;c;d;acao").when(kind == 5, F.concat(F.lit("a;b;c;d;"), "p_name"))
    heads = binding.table(spark, sf_dir, "part").select(F.concat(F.lit("/x/"), F.col("p_partkey").cast("string"), F.lit(".csv")).alias("path"), F.lit("utf-8").alias("encoding"), line.alias("header_line"))
    return layout.describe_layouts(heads).groupBy("problem").agg(F.count(F.lit(1)).alias("files"))


@query(
    "matched_code_lists",
    """WITH c AS (SELECT DISTINCT p_brand AS sheet, 210000 + p_size AS code FROM part), e AS (SELECT DISTINCT 210000 + p_size AS code FROM part WHERE p_type <> 'PROMO' AND p_size % 3 > 0)
    SELECT sheet, CAST(2 AS BIGINT) AS col, COUNT(*) AS matched_count, string_agg(CAST(code AS VARCHAR), ' ' ORDER BY code) AS matched_codes, 'Código ' || sheet AS header
    FROM c JOIN e USING (code) GROUP BY sheet""",
)
def matched_code_lists(spark, sf_dir):
    """Sheets of parts by brand with a header row; the expected codes that each column holds, as a list."""
    parts = binding.table(spark, sf_dir, "part")
    body = parts.select(F.col("p_brand").alias("sheet"), (F.col("p_partkey") + 2).alias("row"), F.inline(F.array(
        F.struct(F.lit(1).cast("long").alias("col"), F.lit("text").alias("kind"), F.col("p_name").alias("value")),
        F.struct(F.lit(2).cast("long").alias("col"), F.lit("int").alias("kind"), (F.col("p_size") + 210000).cast("string").alias("value")),
    )))
    heads = parts.select("p_brand").distinct().select(F.col("p_brand").alias("sheet"), F.lit(1).cast("long").alias("row"), F.lit(2).cast("long").alias("col"), F.lit("text").alias("kind"), F.concat(F.lit(" Código "), "p_brand").alias("value"))
    expected = parts.where("p_type <> 'PROMO' AND p_size % 3 > 0").select((F.col("p_size") + 210000).cast("string").alias("code"))
    found = cells.join_columns(body.unionByName(heads), expected)
    return found.withColumn("matched_codes", F.array_join("matched_codes", " "))


@query(
    "one_sided_families",
    """WITH a AS (SELECT DISTINCT p_brand || '/' || p_type AS f FROM part WHERE p_size > 25), b AS (SELECT DISTINCT p_brand || '/' || p_type AS f FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_quantity > 45 AND p_size < 25)
    SELECT COALESCE(a.f, b.f) AS cbo_codigo, CASE WHEN b.f IS NULL THEN 'left' ELSE 'right' END AS side FROM a FULL JOIN b ON a.f = b.f WHERE a.f IS NULL OR b.f IS NULL""",
)
def one_sided_families(spark, sf_dir):
    """Codes that the stock lists and the flow does not, or the other way round."""
    parts = binding.table(spark, sf_dir, "part").withColumn("cbo_codigo", F.concat_ws("/", "p_brand", "p_type"))
    sold = parts.where("p_size < 25").join(binding.table(spark, sf_dir, "lineitem").where("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    return joins.one_sided_keys(parts.where("p_size > 25"), sold, "cbo_codigo")
