"""Queries over gates, official totals, revisions, serving tables, manifests and documents."""

from __future__ import annotations

import dataclasses
from datetime import date
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, NotApprovedError
from jobtide.functions.fingerprints import record_fingerprint, release_fingerprint, row_set_fingerprint
from jobtide.functions.periods import month_of
from jobtide.operators import analytics, checks, deployment, flow_gold, gates, history, official, quality, serving, stock
from jobtide.plans import binding
from jobtide.plans.oracle_sql import COUNTS, FLOW, STOCK, TEXT
from jobtide.plans.quality_queries import silver
from jobtide.operators.flow_silver import flow_silver
from jobtide.operators.joins import evaluate_once
from jobtide.plans.registry import query
from jobtide.sources import dimensions, documents, manifests, releases, tables
from jobtide.sources.files import first_lines, list_files
from jobtide.sources.flow_text import header_contract, read_flow_files, read_flow_rows

METRICS = ["admissions", "dismissals", "balance"]


def _counts(rows, *by):
    return rows.groupBy(*by).agg(*[F.sum(f"{c}_delta").cast("bigint").alias(c) for c in METRICS])


# ---------------------------------------------------------------------------------------------------------------
# Official totals
# ---------------------------------------------------------------------------------------------------------------


def _official_months(spark, sf_dir):
    """Official monthly totals, counted from the line items alone. Months after 2000 were published before the late
    rows of line 5 arrived, so they do not match what is measured."""
    late = (F.year("l_shipdate") > 2000) & (F.col("l_linenumber") == 5)
    rows = binding.table(spark, sf_dir, "lineitem").where((F.col("l_linenumber") != 7) & ~late)
    rows = rows.where(~((F.col("l_linenumber") == 6) & (F.col("l_quantity") < 5)))
    ended = F.col("l_returnflag") == "R"
    hired = (F.col("l_returnflag") == "N") | ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") != "O"))
    totals = rows.groupBy(month_of(F.col("l_shipdate")).alias("competence")).agg(
        F.count_if(hired).alias("admissions"), F.count_if(ended).alias("dismissals")
    )
    return totals.withColumn("balance", F.col("admissions") - F.col("dismissals"))


_OFFICIAL = """off AS (SELECT strftime(l_shipdate, '%Y%m') AS competence,
      COUNT(*) FILTER (l_returnflag = 'N' OR (l_returnflag = 'A' AND l_linestatus <> 'O')) AS oa, COUNT(*) FILTER (l_returnflag = 'R') AS od
    FROM lineitem WHERE l_linenumber <> 7 AND NOT (l_linenumber = 6 AND l_quantity < 5) AND NOT (year(l_shipdate) > 2000 AND l_linenumber = 5) GROUP BY ALL),
    aud AS (SELECT competence, COUNT(*) FILTER (sgn = 1) AS admissions, COUNT(*) FILTER (sgn = -1) AS dismissals,
      CAST(COALESCE(SUM(sgn), 0) AS BIGINT) AS balance FROM q WHERE kind = 'MOV' GROUP BY competence)"""


def _measured_months(spark, sf_dir):
    rows = silver(spark, sf_dir).where("file_kind = 'MOV'")
    return quality.national_audit(rows, ["ingest_competence"]).withColumnRenamed("ingest_competence", "competence")


@query(
    "national_reconciliation",
    f"""WITH {TEXT}, {_OFFICIAL} SELECT competence, admissions, dismissals, balance, oa AS official_admissions, od AS official_dismissals,
      oa - od AS official_balance, oa IS NOT NULL AS reference_available, oa IS NOT NULL AS reference_consistent,
      COALESCE(admissions = oa AND dismissals = od AND balance = oa - od, false) AS matches FROM aud LEFT JOIN off USING (competence)""",
)
def national_reconciliation(spark, sf_dir):
    return official.reconcile_months(_measured_months(spark, sf_dir), _official_months(spark, sf_dir))


def _level_totals(spark, sf_dir, keys=()):
    """Published totals at every level, by the year of the month if it is a key, from one pass (grouping sets). The regional rows leave out one brand, so
    some regions do not close."""
    rows = binding.flow(spark, sf_dir, "competence", "uf", "region", "cbo_familia").withColumn("competence", F.substring("competence", 1, 4))
    kept = ~((F.col("cbo_familia") == "Brand#1") & F.col("region").isin("ASIA", "EUROPE"))
    sums = [F.sum(f"{c}_delta").cast("bigint").alias(c) for c in METRICS] + [F.sum(F.when(kept, F.col(f"{c}_delta"))).cast("bigint").alias(f"kept_{c}") for c in METRICS]
    keys, grouping = list(keys), lambda c: F.grouping(c) == 0
    levels = rows.groupingSets([[*keys], [*keys, "uf"], [*keys, "region"]], *keys, "uf", "region").agg(*sums, grouping("uf").alias("is_state"), grouping("region").alias("is_region"))

    def line(level, name, values):
        return F.struct(F.lit(level).alias("level"), name.alias("name"), *[v.alias(c) for c, v in zip(METRICS, values, strict=True)])

    whole, part = [F.col(c) for c in METRICS], [F.col(f"kept_{c}") for c in METRICS]
    lines = (
        F.when(F.col("is_state"), F.array(line("state", F.col("uf"), whole)))
        .when(F.col("is_region"), F.array(line("region", F.col("region"), part)))
        .otherwise(F.array(line("national", F.lit("BR"), whole), line("non_identified", F.lit("NI"), [F.lit(0).cast("bigint")] * 3)))
    )
    return levels.select(*keys, F.inline(lines))


_REGIONS = {
    name: [f"NATION_{i}" for i in range(start, 25, 5)]
    for start, name in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])
}
_CLOSURE = """a AS (SELECT region, CAST(SUM(adm) AS BIGINT) AS s1, CAST(SUM(dis) AS BIGINT) AS s2, CAST(SUM(bal) AS BIGINT) AS s3,
      CAST(SUM(adm) FILTER (keep) AS BIGINT) AS r1, CAST(SUM(dis) FILTER (keep) AS BIGINT) AS r2, CAST(SUM(bal) FILTER (keep) AS BIGINT) AS r3
    FROM (SELECT *, NOT (cbo_familia = 'Brand#1' AND region IN ('ASIA', 'EUROPE')) AS keep FROM f) GROUP BY region)"""


@query(
    "region_closure",
    f"""WITH {FLOW}, {_CLOSURE} SELECT region, s1 AS admissions_states, s2 AS dismissals_states, s3 AS balance_states,
      r1 AS admissions_region, r2 AS dismissals_region, r3 AS balance_region, s1 = r1 AND s2 = r2 AND s3 = r3 AS matches FROM a""",
)
def region_closure(spark, sf_dir):
    return official.region_closure(_level_totals(spark, sf_dir), _REGIONS)


@query(
    "official_reference_checks",
    f"""WITH {FLOW}, y AS (SELECT substr(competence, 1, 4) AS year, region, SUM(adm) AS s1, SUM(dis) AS s2, SUM(bal) AS s3, SUM(adm) FILTER (keep) AS r1, SUM(dis) FILTER (keep) AS r2,
      SUM(bal) FILTER (keep) AS r3 FROM (SELECT *, NOT (cbo_familia = 'Brand#1' AND region IN ('ASIA', 'EUROPE')) AS keep FROM f) GROUP BY ALL),
    u AS (SELECT substr(competence, 1, 4) AS year, uf, SUM(adm) AS a, SUM(dis) AS d, SUM(bal) AS b FROM f GROUP BY ALL),
    n AS (SELECT year, SUM(a) AS a, SUM(d) AS d, SUM(b) AS b, bool_and(a - d = b) AS states FROM u GROUP BY year),
    c AS (SELECT year, bool_and(r1 - r2 = r3) AS regions, bool_and(s1 = r1 AND s2 = r2 AND s3 = r3) AND COUNT(*) = 5 AS closed, SUM(s1) AS a, SUM(s2) AS d, SUM(s3) AS b FROM y GROUP BY year)
    SELECT year AS competence, id, CASE id WHEN 'national_arithmetic' THEN n.a - n.d = n.b WHEN 'uf_arithmetic' THEN states WHEN 'region_arithmetic' THEN regions
      WHEN 'regions_equal_sum_of_ufs' THEN closed WHEN 'national_equals_ufs_plus_unidentified' THEN (n.a, n.d, n.b) = (c.a, c.d, c.b)
      ELSE round(30000.0 * 0.3, 2) = 9000.0 AND round(30000.0 * 3.3, 2) = CASE WHEN year = '1999' THEN 98000.0 ELSE 99000.0 END END AS passed, true AS blocking
    FROM n JOIN c USING (year), (VALUES ('national_arithmetic'), ('uf_arithmetic'), ('region_arithmetic'),
      ('regions_equal_sum_of_ufs'), ('national_equals_ufs_plus_unidentified'), ('salary_methodology')) t(id)""",
)
def official_reference_checks(spark, sf_dir):
    """The checks of every year; the salary rule that is published for 1999 does not follow from the minimum wage."""
    totals = evaluate_once(_level_totals(spark, sf_dir, ["competence"]))
    low, high = binding.SALARY_BOUNDS
    salary = totals.where("level = 'national'").select(
        "competence", F.lit(30000.0).alias("minimum_wage_brl"), F.lit(0.3).alias("minimum_multiple"), F.lit(3.3).alias("maximum_multiple"), F.lit(low).alias("minimum_salary_brl"),
        F.when(F.col("competence") == "1999", high - 1000).otherwise(high).alias("maximum_salary_brl"), F.lit(True).alias("exclude_intermittent"),
    )
    return official.official_reference_checks(totals, salary, ["competence"], _REGIONS).drop("message")


def _references(spark, sf_dir):
    """Registered official months with some broken ones: no source, no total, bad date."""
    totals = _official_months(spark, sf_dir)
    month = F.col("competence")
    return totals.select(
        "competence",
        F.when(F.substring(month, 5, 2) == "01", F.lit("annual")).otherwise(F.lit("published_monthly_mov")).alias("reference_kind"),
        F.when(F.substring(month, 5, 2) == "02", F.lit(" ")).otherwise(F.lit("ministry")).alias("source"),
        F.lit("https://example.org").alias("source_url"),
        F.when(F.substring(month, 5, 2) == "03", F.lit("soon"))
        .otherwise(F.concat_ws("-", F.substring(month, 1, 4), F.substring(month, 5, 2), F.lit("28")))
        .alias("published_at"),
        F.when(F.substring(month, 5, 2) == "04", F.lit(0)).otherwise(F.col("admissions")).alias("admissoes"),
        F.col("dismissals").alias("desligamentos"),
        F.when(F.substring(month, 5, 2) == "05", F.col("balance") + 1).otherwise(F.col("balance")).alias("saldo"),
    )


@query(
    "reference_problems",
    f"""WITH {TEXT}, {_OFFICIAL} SELECT competence, CASE substr(competence, 5, 2) WHEN '01' THEN 'not a monthly publication' WHEN '02' THEN 'no source'
      WHEN '03' THEN 'invalid published_at' WHEN '04' THEN 'invalid totals' WHEN '05' THEN 'inconsistent balance' END AS problem FROM off""",
)
def reference_problems(spark, sf_dir):
    return official.reference_problems(_references(spark, sf_dir)).select("competence", "problem")


@query(
    "month_gaps",
    """WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders WHERE month(o_orderdate) <> 7)
    SELECT strftime(m, '%Y%m') AS competence, strftime(m + INTERVAL 1 MONTH, '%Y%m') AS next_expected FROM m
    WHERE m + INTERVAL 1 MONTH NOT IN (SELECT m FROM m) AND m < (SELECT MAX(m) FROM m)""",
)
def month_gaps(spark, sf_dir):
    """Months of orders when one calendar month is never published."""
    orders = binding.table(spark, sf_dir, "orders").where(F.month("o_orderdate") != 7)
    return official.month_gaps(orders.select(month_of(F.col("o_orderdate")).alias("competence")))


_PUBLISHED = "p AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS competence FROM orders WHERE o_orderdate < DATE '2000-12-01')"


def _published(spark, sf_dir):
    orders = binding.table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(date(2000, 12, 1)))
    return orders.select(month_of(F.col("o_orderdate")).alias("competence")).distinct()


@query(
    "next_month_decision",
    f"""WITH {_PUBLISHED}, o AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS competence FROM lineitem)
    SELECT true AS ready, 'ready' AS reason, (SELECT MAX(competence) FROM p) AS latest_published, MIN(competence) AS next_expected,
      MIN(competence) AS candidate, substr(MIN(competence), 1, 4) || '-' || substr(MIN(competence), 5, 2) || '-28' AS reference_published_at
    FROM o WHERE competence > (SELECT MAX(competence) FROM p)""",
)
def next_month_decision(spark, sf_dir):
    references = _references(spark, sf_dir)
    sound = references.withColumn("published_at", F.concat_ws("-", F.substring("competence", 1, 4), F.substring("competence", 5, 2), F.lit("28")))
    sound = sound.withColumn("reference_sha256", F.sha2(F.concat_ws("|", "competence", "admissoes", "saldo"), 256))
    return official.next_month_decision(_published(spark, sf_dir), sound, date(2002, 1, 1))


@query(
    "next_month_revision",
    f"""WITH {_PUBLISHED}, o AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS competence FROM lineitem)
    SELECT true AS ready, 'published_reference_revision' AS reason, (SELECT MAX(competence) FROM p) AS latest_published,
      (SELECT MIN(competence) FROM o WHERE competence > (SELECT MAX(competence) FROM p)) AS next_expected,
      MIN(competence) AS candidate, substr(MIN(competence), 1, 4) || '-' || substr(MIN(competence), 5, 2) || '-28' AS reference_published_at
    FROM p SEMI JOIN o USING (competence) WHERE competence >= '1998'""",
)
def next_month_revision(spark, sf_dir):
    """Totals of 1998 and later changed after their approval: the earliest of them comes first."""
    references = _references(spark, sf_dir)
    sound = references.withColumn("published_at", F.concat_ws("-", F.substring("competence", 1, 4), F.substring("competence", 5, 2), F.lit("28")))
    sound = sound.withColumn("reference_sha256", F.sha2(F.concat_ws("|", "competence", "admissoes", "saldo"), 256))
    stale = F.when(F.col("competence") >= "1998", F.lit("stale")).otherwise(F.col("reference_sha256"))
    approvals = sound.select("competence", stale.alias("reference_sha256"))
    return official.next_month_decision(_published(spark, sf_dir), sound, date(2002, 1, 1), approvals)


# ---------------------------------------------------------------------------------------------------------------
# Gates
# ---------------------------------------------------------------------------------------------------------------


def _monthly_checks(spark, sf_dir):
    """Three passes over the movements: the parsed rows, the published places with the months they add up to, and the official totals."""
    rows = silver(spark, sf_dir).where("file_kind = 'MOV'")
    facts = quality.quality_and_audit(rows, ["2122", "2123", "2124", "3171", "3172"], ["ingest_competence"])
    facts = evaluate_once(facts.withColumnRenamed("ingest_competence", "competence"))
    places = evaluate_once(_counts(binding.flow(spark, sf_dir, "competence", "municipio_codigo_caged"), "competence", "municipio_codigo_caged"))
    gold = evaluate_once(places.groupBy("competence").agg(*[F.sum(c).alias(c) for c in METRICS]))
    totals = _official_months(spark, sf_dir)
    reference = evaluate_once(totals.select(
        "competence", F.col("admissions").alias("admissoes"), F.col("dismissals").alias("desligamentos"),
        F.col("balance").alias("saldo"),
        F.sha2(F.concat_ws("|", "competence", "admissions", "dismissals"), 256).alias("reference_sha256"),
    ))
    suppliers = binding.table(spark, sf_dir, "supplier")
    dimension = suppliers.select(
        F.col("s_suppkey").cast("string").alias("prefix"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("municipio_codigo_ibge"),
        F.col("s_name").alias("municipio_nome"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("uf"),
    )
    items = gates.municipality_facts(flow_gold.with_municipality(places, dimension))
    files = gold.select("competence", F.sha2("competence", 256).alias("sha256"))
    approvals = reference.select(
        "competence", F.lit(True).alias("approved"), F.sha2("competence", 256).alias("source_sha256"),
        F.when(F.col("competence") < "1999", F.col("reference_sha256")).otherwise(F.lit("old")).alias("reference_sha256"),
    )
    return gates.monthly_gate(
        gold.select("competence"), quality=facts, overview=gold, market=gold, audit=facts, municipality=items,
        manifests=files, official=reference, approvals=approvals, minimum_valid_rate=0.4,
    )


_CHECK_RESULTS = f"""{TEXT}, {_OFFICIAL}, months AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS competence FROM lineitem),
    ql AS (SELECT competence, COUNT(*) FILTER (NOT bad) / COUNT(*) AS rate FROM q WHERE kind = 'MOV' GROUP BY competence),
    facts AS (SELECT m.competence, rate, aud.competence IS NOT NULL AS has_audit, off.competence IS NOT NULL AS has_off,
      admissions = oa AND dismissals = od AND balance = oa - od AS equal FROM months m LEFT JOIN ql USING (competence) LEFT JOIN aud USING (competence)
      LEFT JOIN off USING (competence)),
    ids AS (SELECT * FROM (VALUES ('quality_report'), ('overview'), ('gold_market'), ('national_mov_audit'), ('municipality_gold'), ('mov_provenance'),
      ('quality_competence'), ('quality_counts'), ('valid_rate'), ('overview_competence'), ('overview_arithmetic'), ('municipality_dimension_quality'),
      ('official_reference_available'), ('official_reference_integrity'), ('national_reference_reconciliation'), ('manual_methodology_approval')) t(id)),
    res AS (SELECT competence, id, CASE WHEN id IN ('quality_report', 'national_mov_audit') THEN has_audit
        WHEN id IN ('quality_competence', 'quality_counts') THEN true WHEN id = 'valid_rate' THEN rate >= 0.4
        WHEN id = 'official_reference_available' THEN false WHEN id = 'national_reference_reconciliation' THEN equal
        WHEN id = 'manual_methodology_approval' THEN has_off AND competence < '1999' ELSE true END AS passed
      FROM facts, ids WHERE NOT (id IN ('quality_competence', 'quality_counts', 'valid_rate') AND NOT has_audit)
        AND NOT (id = 'official_reference_available' AND has_off) AND NOT (id IN ('official_reference_integrity') AND NOT has_off)
        AND NOT (id = 'national_reference_reconciliation' AND NOT (has_off AND has_audit)))"""


@query("monthly_gate_checks", f"WITH {_CHECK_RESULTS} SELECT competence, id, passed, true AS blocking FROM res")
def monthly_gate_checks(spark, sf_dir):
    return _monthly_checks(spark, sf_dir).drop("message")


@query(
    "gate_summary",
    f"""WITH {_CHECK_RESULTS} SELECT competence, bool_and(passed OR id = 'manual_methodology_approval') AS automatic_checks_passed,
      bool_or(passed AND id = 'manual_methodology_approval') AS manual_approval_valid, COUNT(*) AS checks_total,
      COUNT(*) FILTER (NOT passed) AS checks_failed, bool_and(passed) AS publishable FROM res GROUP BY competence""",
)
def gate_summary(spark, sf_dir):
    return checks.gate_summary(_monthly_checks(spark, sf_dir), ["competence"])


def _stored_gates(spark, sf_dir):
    """Gates as stored documents, one per order month, with typical defects in their checks."""
    orders = binding.table(spark, sf_dir, "orders")
    month = month_of(F.col("o_orderdate"))
    facts = orders.groupBy(month.alias("competence")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        F.max("o_totalprice").alias("top"),
    )
    one = lambda name, passed, blocking: F.struct(
        name.alias("id"), passed.alias("passed"), blocking.alias("blocking")
    )
    number = F.substring("competence", 5, 2)
    return facts.select(
        "competence",
        (F.col("open") * 3 > F.col("n")).alias("publishable"),
        F.lit(True).alias("automatic_checks_passed"),
        (number != "12").alias("manual_approval_valid"),
        F.sha2("competence", 256).alias("source_sha256"),
        F.array(
            one(F.lit("rows"), F.lit(True), F.lit(True)),
            one(F.when(number == "02", F.lit("rows")).otherwise(F.lit("totals")), number != "03", number != "04"),
            one(F.when(number == "05", F.lit(" ")).otherwise(F.lit("note")), number == "06", F.lit(False)),
            one(F.lit("typed"), F.when(number != "07", F.lit(True)), F.lit(True)),
        ).alias("checks"),
    )


_GATES = """g AS (SELECT strftime(o_orderdate, '%Y%m') AS competence, COUNT(*) FILTER (o_orderstatus = 'O') * 3 > COUNT(*) AS publishable,
      substr(strftime(o_orderdate, '%Y%m'), 5, 2) AS mm FROM orders GROUP BY strftime(o_orderdate, '%Y%m')),
    cl AS (SELECT *, publishable AND mm NOT IN ('12', '02', '03', '05', '07') AS clean FROM g)"""


@query("gate_is_clean", f"WITH {_GATES} SELECT competence, clean FROM cl")
def gate_is_clean(spark, sf_dir):
    return checks.gate_is_clean(_stored_gates(spark, sf_dir), ["competence"])


def _deployment(spark, sf_dir):
    stored = _stored_gates(spark, sf_dir)
    states = F.when(F.substring("competence", 5, 2) == "08", F.lit("209912")).otherwise(F.col("competence"))
    rows = stored.select(
        F.lit("monthly").alias("kind"), F.col("competence").alias("file_key"), states.alias("key"),
        "publishable", "automatic_checks_passed", "manual_approval_valid", "checks",
    )
    ship = month_of(F.col("l_shipdate"))
    folder = F.when(F.col("l_linestatus") == "O", F.lit("data/gold/by-uf-")).otherwise(F.lit("docs/by-uf-"))
    changed = binding.table(spark, sf_dir, "lineitem").select(F.concat(folder, ship, F.lit(".json")).alias("path"))
    return deployment.deployment_reasons(changed, rows)


_REASONS = f"""{_GATES}, t AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS key FROM lineitem WHERE l_linestatus = 'O' AND year(l_shipdate) >= 2000),
    r AS (SELECT 'monthly' AS kind, key, CASE WHEN clean IS NULL THEN 'gate is missing' WHEN mm = '08' THEN 'gate is for another release'
      WHEN NOT clean THEN 'release is not publishable yet' END AS reason FROM t LEFT JOIN cl ON key = competence)"""


@query("deployment_reasons", f"WITH {_REASONS} SELECT * FROM r")
def deployment_reasons(spark, sf_dir):
    return _deployment(spark, sf_dir)


@query(
    "deployment_decision",
    f"""WITH {_REASONS} SELECT COUNT(reason) = 0 AS eligible, string_agg(key, ',' ORDER BY key) AS monthly, '' AS annual,
      COALESCE(string_agg(key || ': ' || reason, ',' ORDER BY key) FILTER (reason IS NOT NULL), '') AS reasons FROM r""",
)
def deployment_decision(spark, sf_dir):
    decision = deployment.deployment_decision(_deployment(spark, sf_dir))
    return decision.withColumns({c: F.array_join(c, ",") for c in ("monthly", "annual", "reasons")})


@query("release_registry", f"WITH {_GATES} SELECT competence, true AS automatic_checks_passed, mm <> '12' AS manual_approval_valid, publishable, sha256(competence) AS source_sha256 FROM g")
def release_registry(spark, sf_dir):
    return analytics.release_registry(_stored_gates(spark, sf_dir))


@query("registry_summary", f"WITH {_GATES} SELECT COUNT(*) AS releases, COUNT(*) FILTER (publishable) AS published, MAX(competence) FILTER (publishable) AS latest FROM g")
def registry_summary(spark, sf_dir):
    return analytics.registry_summary(analytics.release_registry(_stored_gates(spark, sf_dir)))


@query("published_months", f"WITH {_GATES} SELECT competence FROM g WHERE publishable")
def published_months(spark, sf_dir):
    return analytics.published_months(_stored_gates(spark, sf_dir))


@query("published_years", "SELECT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def published_years(spark, sf_dir):
    orders = binding.table(spark, sf_dir, "orders")
    gates_of_years = orders.select(F.year("o_orderdate").alias("year"), (F.col("o_orderstatus") == "O").alias("publishable"))
    return analytics.published_years(gates_of_years)


@query("trend_published", f"WITH {FLOW}, {_GATES} SELECT competence, {COUNTS} FROM f WHERE competence IN (SELECT competence FROM g WHERE publishable) GROUP BY competence")
def trend_published(spark, sf_dir):
    months = analytics.published_months(_stored_gates(spark, sf_dir))
    return analytics.published_only(_counts(binding.flow(spark, sf_dir, "competence"), "competence"), months)


@query("months_after_stock_year", f"WITH {FLOW} SELECT competence, {COUNTS} FROM f WHERE substr(competence, 1, 4) = '1998' GROUP BY competence")
def months_after_stock_year(spark, sf_dir):
    return analytics.months_after_stock_year(_counts(binding.flow(spark, sf_dir, "competence"), "competence"), 1997)


@query(
    "published_codes",
    f"""WITH {_GATES} SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code FROM lineitem
      WHERE strftime(l_shipdate, '%Y%m') IN (SELECT competence FROM g WHERE publishable)""",
)
def published_codes(spark, sf_dir):
    codes = F.lpad(F.col("l_partkey").cast("string"), 6, "0").alias("cbo_codigo")
    rows = binding.table(spark, sf_dir, "lineitem").select(codes, month_of(F.col("l_shipdate")).alias("competence"))
    return analytics.published_codes(rows, analytics.published_months(_stored_gates(spark, sf_dir)))


def _annual_facts(spark, sf_dir):
    """Facts of one annual release, each from its own aggregate over the stock."""
    rows = stock.stock_silver(binding.stock_raw(spark, sf_dir))
    scope = F.col("status") == "scope"
    total = F.count_if(scope)
    facts = rows.agg(
        F.transform(F.array_sort(F.collect_set("source_file")), lambda s: F.sha2(s, 256)).alias("source_hashes"),
        total.alias("active_stock_tech"), total.alias("uf_total"), total.alias("family_total"),
        F.count_if(scope & (F.col("municipio_codigo") != "999999")).alias("municipality_total"), total.alias("market_total"),
        F.count_if(F.col("source_status") == "eligible").alias("expected_active"),
    )
    return facts.select(
        "*", F.lit(2020).alias("year"), F.lit(True).alias("reconciled"), F.lit(True).alias("gold_ready"), F.lit(0).alias("difference"),
        F.lit(True).alias("regional_reconciled"), F.lit(0).alias("regional_difference"), F.size("source_hashes").alias("regional_groups"),
        F.lit(True).alias("municipality_ready"), F.lit(0).alias("unmatched_codes"), F.lit(0).alias("uf_mismatch_rows"),
        F.col("expected_active").alias("active_stock_national_reference"), F.lit(False).alias("publication_ready"),
        F.sha2(F.array_join("source_hashes", ","), 256).alias("release_sha256"), F.lit(True).alias("approval_approved"),
        F.sha2(F.array_join("source_hashes", ","), 256).alias("approval_release_sha256"),
    )


@query(
    "annual_gate_checks",
    f"""WITH {STOCK}, n AS (SELECT COUNT(*) FILTER (tech) = COUNT(*) FILTER (tech AND mun <> '999999') AS all_placed FROM s)
    SELECT CAST(2020 AS BIGINT) AS year, id, CASE WHEN id = 'municipality_total' THEN all_placed ELSE true END AS passed, true AS blocking FROM n, (VALUES
      ('source_provenance'), ('artifact_reconciliation'), ('artifact_regional_reconciliation'), ('artifact_municipality_validation'), ('artifact_overview'),
      ('artifact_by_uf'), ('artifact_by_cbo_family'), ('artifact_by_municipality'), ('artifact_market'), ('exact_national_reconciliation'),
      ('exact_regional_reconciliation'), ('municipality_dimension'), ('overview_year'), ('overview_stock_integrity'), ('pre_gate_publication_block'),
      ('uf_total'), ('cbo_family_total'), ('municipality_total'), ('market_total'), ('release_fingerprint'), ('manual_methodology_approval')) t(id)""",
)
def annual_gate_checks(spark, sf_dir):
    return gates.annual_gate(_annual_facts(spark, sf_dir)).drop("message")


# ---------------------------------------------------------------------------------------------------------------
# Revisions
# ---------------------------------------------------------------------------------------------------------------


def _state_months(spark, sf_dir, only_base=False):
    rows = binding.flow(spark, sf_dir, "competence", "uf")
    return _counts(rows.where("adjustment_kind = 'MOV'") if only_base else rows, "competence", "uf")


_ROW = """sha256('{{"admissions":' || admissions || ',"balance":' || balance || ',"competence":"' || competence || '","dismissals":' || dismissals
      || ',"uf":"' || uf || '"}}')"""
_SLICES = ", ".join(f"CAST(SUM(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))


def _snapshot_sql(name: str, where: str) -> str:
    return f"""{name} AS (SELECT competence, sha256(concat_ws('|', CAST(COUNT(*) AS VARCHAR), {_SLICES})) AS sha FROM (
      SELECT competence, {_ROW.replace('{{', '{').replace('}}', '}')} AS h FROM (SELECT competence, uf, {COUNTS} FROM f WHERE {where} GROUP BY competence, uf)) GROUP BY competence)"""


@query("history_snapshot", f"WITH {FLOW}, {_snapshot_sql('b', 'true')} SELECT competence, 'by-uf' AS file, sha AS sha256 FROM b")
def history_snapshot(spark, sf_dir):
    return history.table_snapshot(_state_months(spark, sf_dir), "by-uf")


_CHANGES = f"{FLOW}, {_snapshot_sql('b', "kind = 'MOV'")}, {_snapshot_sql('a', "competence < '200111'")}"


def _revision(spark, sf_dir):
    """Baseline: base rows only. Current: with adjustments, and without the last month, which went missing."""
    baseline = history.table_snapshot(_state_months(spark, sf_dir, only_base=True), "by-uf")
    current = history.table_snapshot(_state_months(spark, sf_dir).where("competence < '200111'"), "by-uf")
    return baseline, current


@query(
    "history_diff",
    f"""WITH {_CHANGES} SELECT b.competence, 'by-uf' AS file, b.sha AS before_sha256, a.sha AS after_sha256 FROM b LEFT JOIN a USING (competence)
      WHERE a.sha IS DISTINCT FROM b.sha""",
)
def history_diff(spark, sf_dir):
    return history.artifact_changes(*_revision(spark, sf_dir))


def _adjustments(spark, sf_dir):
    """Small late rows of the second half of each year, and retractions."""
    rows = binding.flow(spark, sf_dir, "competence", "quantity").where("adjustment_kind <> 'MOV' and quantity < 25")
    return rows.where(F.substring("competence", 5, 2) > "06").withColumn("effective_competence", F.col("competence"))


_TOUCHED = "tm AS (SELECT DISTINCT competence FROM f WHERE kind <> 'MOV' AND l_quantity < 25 AND substr(competence, 5, 2) > '06')"


@query(
    "history_evaluation",
    f"""WITH {_CHANGES}, {_TOUCHED}, ch AS (SELECT b.competence, a.sha AS after FROM b LEFT JOIN a USING (competence) WHERE a.sha IS DISTINCT FROM b.sha),
    base AS (SELECT DISTINCT competence FROM f WHERE kind = 'MOV' AND competence < '2001')
    SELECT '200012' AS ingest_competence, CAST(2 AS BIGINT) AS version, false AS passed,
      (SELECT string_agg(competence, ',' ORDER BY competence) FROM tm) AS adjustment_effective_competencies,
      (SELECT string_agg(competence, ',' ORDER BY competence) FROM ch) AS changed_published_competencies,
      (SELECT COALESCE(string_agg(competence, ',' ORDER BY competence), '') FROM ch WHERE competence <> '200012' AND competence NOT IN (SELECT competence FROM tm)) AS unexpected_changed_competencies,
      (SELECT COALESCE(string_agg(competence, ',' ORDER BY competence), '') FROM tm WHERE competence > '200012') AS future_adjustment_competencies,
      (SELECT COALESCE(string_agg(competence, ',' ORDER BY competence), '') FROM tm WHERE competence <> '200012' AND competence IN (SELECT competence FROM b)
         AND competence NOT IN (SELECT competence FROM base)) AS missing_rebuild_baselines,
      (SELECT CASE WHEN COUNT(*) > 0 THEN 'by-uf' ELSE '' END FROM ch WHERE after IS NULL) AS missing_after""",
)
def history_evaluation(spark, sf_dir):
    """One pass: counts of each month and state with and without late rows, and which months have base and late rows, as columns of one small table."""
    rows = binding.flow(spark, sf_dir, "competence", "uf", "quantity")
    base = F.col("adjustment_kind") == "MOV"
    late = ~base & (F.col("quantity") < 25) & (F.substring("competence", 5, 2) > "06")
    facts = rows.groupBy("competence", "uf").agg(
        *[F.sum(f"{c}_delta").cast("bigint").alias(c) for c in METRICS], *[F.sum(F.when(base, F.col(f"{c}_delta"))).cast("bigint").alias(f"base_{c}") for c in METRICS],
        F.bool_or(base).alias("has_base"), F.bool_or(late).alias("has_late"),
    )
    facts = tables.materialize(facts, "history-facts")
    before = facts.where("has_base").select("competence", "uf", *[F.col(f"base_{c}").alias(c) for c in METRICS])
    baseline = history.table_snapshot(before, "by-uf")
    current = history.table_snapshot(facts.where("competence < '200111'").select("competence", "uf", *METRICS), "by-uf")
    adjustments = facts.where("has_late").select(F.col("competence").alias("effective_competence"))
    row = history.evaluate_revisions("200012", baseline, current, adjustments, facts.where("has_base AND competence < '2001'").select("competence").distinct())
    lists = [f.name for f in row.schema.fields if f.dataType.typeName() == "array"]
    return row.withColumns({c: F.array_join(c, ",") for c in lists})


@query(
    "metric_changes",
    f"""WITH {_CHANGES}, ch AS (SELECT b.competence FROM b LEFT JOIN a USING (competence) WHERE a.sha IS DISTINCT FROM b.sha),
    x AS (SELECT competence, {COUNTS} FROM f WHERE kind = 'MOV' GROUP BY competence), y AS (SELECT competence, {COUNTS} FROM f GROUP BY competence)
    SELECT competence, x.admissions AS admissions_before, x.dismissals AS dismissals_before, x.balance AS balance_before, y.admissions AS admissions_after,
      y.dismissals AS dismissals_after, y.balance AS balance_after FROM ch LEFT JOIN x USING (competence) LEFT JOIN y USING (competence)""",
)
def metric_changes(spark, sf_dir):
    changes = history.artifact_changes(*_revision(spark, sf_dir))
    rows = binding.flow(spark, sf_dir, "competence")
    before = _counts(rows.where("adjustment_kind = 'MOV'"), "competence")
    return history.metric_changes(changes, history.snapshot_metrics(before), history.snapshot_metrics(_counts(rows, "competence")))


@query(
    "months_to_rebuild",
    f"WITH {FLOW}, {_TOUCHED} SELECT competence, competence IN (SELECT competence FROM f WHERE kind = 'MOV' AND competence < '2001') AS has_base FROM tm",
)
def months_to_rebuild(spark, sf_dir):
    base = binding.flow(spark, sf_dir, "competence").where("adjustment_kind = 'MOV' and competence < '2001'")
    return history.months_to_rebuild(_adjustments(spark, sf_dir), base)


@query(
    "rebuilt_months",
    f"""WITH {FLOW}, {_TOUCHED} SELECT competence, uf, {COUNTS} FROM f WHERE competence IN (SELECT competence FROM tm)
      AND competence IN (SELECT competence FROM f WHERE kind = 'MOV') GROUP BY competence, uf""",
)
def rebuilt_months(spark, sf_dir):
    """Only the months the adjustments touch are recomputed."""
    rows = binding.flow(spark, sf_dir, "competence", "uf").withColumn("effective_competence", F.col("competence"))
    months = history.months_to_rebuild(_adjustments(spark, sf_dir), rows.where("adjustment_kind = 'MOV'"))
    build = lambda part: _counts(part, "effective_competence", "uf").withColumnRenamed("effective_competence", "competence")
    return history.rebuild_months(rows, months, build)


# ---------------------------------------------------------------------------------------------------------------
# Serving and enrichment
# ---------------------------------------------------------------------------------------------------------------


@query(
    "serving_release",
    f"""WITH {FLOW}, {_GATES} SELECT competence || '01' AS competence, {COUNTS}, COUNT(*) AS records_tech, sha256(competence) AS source_sha256,
      true AS publishable, CAST(0.995 AS DOUBLE) AS valid_rate FROM f WHERE competence IN (SELECT competence FROM g WHERE publishable) GROUP BY f.competence""",
)
def serving_release(spark, sf_dir):
    overview = flow_gold.overview(binding.flow(spark, sf_dir, "competence"), ["competence"])
    published = analytics.published_months(_stored_gates(spark, sf_dir))
    shown = analytics.published_only(overview, published)
    quality_rows = shown.select("competence", F.lit(0.995).alias("valid_rate"))
    hashes = shown.select("competence", F.sha2("competence", 256).alias("sha256"))
    release = serving.serving_release(shown, quality_rows, hashes)
    wanted = ["source_sha256", "publishable", "records_tech", "valid_rate", *METRICS]
    return release.select(F.date_format("competence", "yyyyMMdd").alias("competence"), *wanted)


@query(
    "serving_latest_states",
    f"""WITH {FLOW}, {_GATES} SELECT competence || '01' AS competence, upper(substr(region, 1, 2)) AS uf, {COUNTS} FROM f
      WHERE competence = (SELECT MAX(competence) FROM g WHERE publishable) GROUP BY f.competence, f.region ORDER BY admissions DESC, uf LIMIT 10""",
)
def serving_latest_states(spark, sf_dir):
    """State rows of the newest publishable release, best ten, with late rows and retractions. Regions stand for states: in smaller places a month
    may have more retractions than terminations, which serving refuses."""
    rows = binding.flow(spark, sf_dir, "competence", "region").withColumn("uf", F.substring("region", 1, 2))
    served = serving.serving_states(flow_gold.group_table(rows, ["competence", "uf"]))
    release = _stored_gates(spark, sf_dir).select(F.to_date("competence", "yyyyMM").alias("competence"), "publishable")
    rows = analytics.top(serving.rows_of_latest(served, release), "admissions", "uf", 10)
    return rows.select(F.date_format("competence", "yyyyMMdd").alias("competence"), "uf", *METRICS)


_SERVED = {
    "dataset_release": "'-'", "market_uf": "upper(substr(region, 1, 2))",
    "market_occupation": "'000' || CAST(CAST(regexp_extract(cbo_familia, '[0-9]+') AS INTEGER) % 5 AS VARCHAR)",
    "market_municipality": "CAST(CAST(municipio_codigo_caged AS BIGINT) % 5 AS VARCHAR)",
}


@query(
    "guarded_release_load",
    f"WITH {FLOW}, {_GATES}, p AS (SELECT f.* FROM f JOIN g ON f.competence = g.competence AND g.publishable) "
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, competence || '01' AS competence, {key} AS key, {COUNTS} FROM p GROUP BY ALL" for t, key in _SERVED.items()),
)
def guarded_release_load(spark, sf_dir):
    """Base rows are published, then the months with their late rows and retractions; a load that fails in its last table and one with a month that is not
    approved change nothing."""
    root = tables.scratch_path(spark, "release")
    rows = binding.flow(spark, sf_dir, "competence", "region", "cbo_familia", "municipio_codigo_caged")
    named = rows.select(
        "competence", "adjustment_kind", "admissions_delta", "dismissals_delta", "balance_delta", F.substring("region", 1, 2).alias("uf"),
        F.concat(F.lit("000"), (F.regexp_extract("cbo_familia", "[0-9]+", 0).cast("int") % 5).cast("string")).alias("cbo_familia"),
        (F.col("municipio_codigo_caged").cast("bigint") % 5).cast("string").alias("municipio_codigo_caged"),
    )
    # Every load and its checks go back to the movements: they are counted once, at the finest grain that the tables need.
    named = tables.materialize(_counts(named, "competence", "adjustment_kind", "uf", "cbo_familia", "municipio_codigo_caged"), "release-counts")
    named = named.withColumnsRenamed({c: f"{c}_delta" for c in METRICS})
    gates = tables.materialize(_stored_gates(spark, sf_dir).select("competence", "publishable"), "release-gates")

    def served(part, allowed):
        shown = analytics.published_only(part, analytics.published_months(allowed))
        overview = _counts(shown, "competence").withColumn("records_tech", F.col("admissions") + F.col("dismissals"))
        occupations = _counts(shown, "competence", "cbo_familia").withColumn("cbo_codigo", F.concat("cbo_familia", F.lit("05")))
        return serving.ServingTables(
            serving.serving_release(overview, overview.select("competence", F.lit(1.0).alias("valid_rate")), overview.select("competence", F.sha2("competence", 256).alias("sha256"))),
            serving.serving_states(_counts(shown, "competence", "uf")), serving.serving_occupations(occupations),
            serving.serving_municipalities(_counts(shown, "competence", "municipio_codigo_caged")),
        )

    whole = served(named, gates)
    serving.load_release(spark, served(named.where("adjustment_kind = 'MOV'"), gates), root, gates)
    number = serving.load_release(spark, whole, root, gates)
    broken = serving.serving_municipalities(_counts(named, "competence", "municipio_codigo_caged").withColumn("admissions", F.lit(-1)))
    refused = [(dataclasses.replace(whole, municipality=broken), gates), (served(named, gates.withColumn("publishable", F.lit(True))), gates)]
    for load, allowed in refused:
        try:
            serving.load_release(spark, load, root, allowed)
        except (NotApprovedError, PySparkException):
            continue
        raise ConsistencyError("a load that must fail was published")
    keys = {"dataset_release": F.lit("-"), "market_uf": F.col("uf"), "market_occupation": F.col("cbo_family"), "market_municipality": F.col("municipality_code")}
    parts = [
        releases.read_release(spark, root, name, number=number).select(F.lit(name).alias("table_name"), F.date_format("competence", "yyyyMMdd").alias("competence"), key.alias("key"), *METRICS)
        for name, key in keys.items()
    ]
    if len(releases.current_parts(spark, root)) != len(releases.current_parts(spark, root, number)):
        raise ConsistencyError("a refused load changed the release")
    return reduce(DataFrame.unionByName, parts)


_PROBLEM_KEYS = {
    "market_uf": ("uf", "length(uf) <> 2", "invalid state"),
    "market_occupation": ("cbo_familia, cbo_codigo", "length(cbo_familia) <> 8", "invalid occupation code"),
    "market_municipality": ("municipio_codigo_caged", "CAST(municipio_codigo_caged AS BIGINT) % 7 = 0", "invalid municipality code"),
    "dataset_release": ("1", "substr(competence, 6, 1) = '5'", "invalid source hash"),
}


@query(
    "serving_problems",
    f"WITH {FLOW}, "
    + ", ".join(f"{t} AS (SELECT competence, {key}, {COUNTS} FROM f GROUP BY ALL)" for t, (key, _, _) in _PROBLEM_KEYS.items())
    + " SELECT table_name, problem, COUNT(*) AS rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CASE WHEN admissions < 0 OR dismissals < 0 THEN 'negative count' WHEN {bad} THEN '{name}' END AS problem FROM {t}"
        for t, (_, bad, name) in _PROBLEM_KEYS.items()
    )
    + ") GROUP BY ALL",
)
def serving_problems(spark, sf_dir):
    """What keeps rows of the four serving tables from being served, over all rows."""
    rows = binding.flow(spark, sf_dir, "competence", "uf", "cbo_familia", "cbo_codigo", "municipio_codigo_caged")
    places = _counts(rows, "competence", "municipio_codigo_caged")
    marked = F.when(F.col("municipio_codigo_caged").cast("bigint") % 7 == 0, F.concat("municipio_codigo_caged", F.lit("x"))).otherwise(F.col("municipio_codigo_caged"))
    codes = _counts(rows, "competence", "cbo_familia", "cbo_codigo")
    digits = F.regexp_replace("cbo_familia", r"\D", "")
    families = F.when(F.length("cbo_familia") == 8, F.lpad(digits, 4, "0")).otherwise(digits)
    hashes = F.when(F.substring("competence", 6, 1) == "5", F.lit("none")).otherwise(F.sha2("competence", 256))
    tables_of = {
        "market_uf": (_counts(rows, "competence", "uf"), serving.state_problem()),
        "market_occupation": (codes.withColumns({"cbo_familia": families, "cbo_codigo": F.lit("212405")}), serving.occupation_problem()),
        "market_municipality": (places.withColumn("municipio_codigo_caged", marked), serving.municipality_problem()),
        "dataset_release": (_counts(rows, "competence").withColumn("source_sha256", hashes), serving.release_problem()),
    }
    found = [t.groupBy(problem.alias("problem")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "problem", "rows") for name, (t, problem) in tables_of.items()]
    return reduce(DataFrame.unionByName, found)


def _places(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "competence", "municipio_codigo_caged")
    counts = _counts(rows, "competence", "municipio_codigo_caged")
    return counts.withColumn("municipio_codigo_ibge", F.lpad("municipio_codigo_caged", 7, "0"))


def _people(spark, sf_dir):
    suppliers = binding.table(spark, sf_dir, "supplier")
    return suppliers.select(
        F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("municipio_codigo_ibge"), F.floor("s_acctbal").alias("population")
    )


@query(
    "enrichment_report",
    f"""WITH {FLOW}, c AS (SELECT competence, municipio_codigo_caged, {COUNTS} FROM f GROUP BY ALL),
    j AS (SELECT c.*, floor(s_acctbal) > 0 AS has FROM c LEFT JOIN supplier ON municipio_codigo_caged = CAST(s_suppkey AS VARCHAR))
    SELECT competence, COUNT(*) AS identified_municipalities, CAST(0 AS BIGINT) AS residual_municipalities, COUNT(*) FILTER (has) AS matched_population,
      CAST(SUM(admissions) AS BIGINT) AS admissions_after, CAST(SUM(dismissals) AS BIGINT) AS dismissals_after, CAST(SUM(balance) AS BIGINT) AS balance_after,
      CAST(SUM(admissions) AS BIGINT) AS admissions_before, CAST(SUM(dismissals) AS BIGINT) AS dismissals_before, CAST(SUM(balance) AS BIGINT) AS balance_before,
      COUNT(*) FILTER (NOT has) AS missing_population, COUNT(*) FILTER (NOT has) = 0 AS coverage_complete, CAST(2001 AS BIGINT) AS population_year,
      'abc' AS population_cache_sha256 FROM j GROUP BY competence""",
)
def enrichment_report(spark, sf_dir):
    before = _places(spark, sf_dir)
    return serving.enrichment_report(before, serving.enrich_population(before, _people(spark, sf_dir), 2001), 2001, "abc")


@query(
    "places_without_population",
    f"""WITH {FLOW} SELECT DISTINCT municipio_codigo_caged FROM f JOIN supplier ON municipio_codigo_caged = CAST(s_suppkey AS VARCHAR) WHERE NOT floor(s_acctbal) > 0""",
)
def places_without_population(spark, sf_dir):
    enriched = serving.enrich_population(_places(spark, sf_dir), _people(spark, sf_dir), 2001)
    return serving.places_without_population(enriched).select("municipio_codigo_caged").distinct()


@query("totals_changed", f"""WITH {FLOW}, x AS (SELECT competence, {COUNTS} FROM f GROUP BY competence),
    y AS (SELECT competence, {COUNTS} FROM f WHERE kind <> 'EXC' GROUP BY competence)
    SELECT competence, x.admissions, x.dismissals, x.balance, y.admissions AS admissions_after, y.dismissals AS dismissals_after, y.balance AS balance_after
    FROM x FULL JOIN y USING (competence) WHERE (x.admissions, x.dismissals, x.balance) IS DISTINCT FROM (y.admissions, y.dismissals, y.balance)""")
def totals_changed(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "competence", "uf")
    return serving.totals_changed(_counts(rows, "competence", "uf"), _counts(rows.where("adjustment_kind <> 'EXC'"), "competence", "uf"))


@query(
    "enrichment_blockers",
    f"""WITH {_CHECK_RESULTS}, s AS (SELECT competence, bool_and(passed) AS pub, string_agg(id, ', ' ORDER BY id) FILTER (NOT passed AND id <> 'manual_methodology_approval') AS bad FROM res GROUP BY competence)
    SELECT competence, CASE WHEN pub THEN NULL WHEN bad IS NOT NULL THEN 'failed checks: ' || bad END AS reason FROM s""",
)
def enrichment_blockers(spark, sf_dir):
    rows = _monthly_checks(spark, sf_dir)
    return serving.enrichment_blockers(checks.gate_summary(rows, ["competence"]), rows, allow_candidate=True)


# ---------------------------------------------------------------------------------------------------------------
# Manifests and documents
# ---------------------------------------------------------------------------------------------------------------


def _document_files(spark, sf_dir):
    rows = binding.table(spark, sf_dir, "documents")
    return rows.select(
        F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("original_name"),
        F.octet_length("text").cast("bigint").alias("size_bytes"), F.sha2("text", 256).alias("sha256"), "source",
    )


@query(
    "file_manifests",
    "SELECT source, lang_id AS original_name, size_bytes, sha256, '202401' AS competence, '2024-01-01T00:00:00' AS ingested_at_utc FROM (SELECT source,"
    " lang || '/' || doc_id AS lang_id, octet_length(encode(text)) AS size_bytes, sha256(text) AS sha256 FROM documents)",
)
def file_manifests(spark, sf_dir):
    """Name, size and hash of every whole text."""
    files = _document_files(spark, sf_dir)
    return manifests.build_manifests(files, F.col("source"), F.lit("202401"), F.lit("2024-01-01T00:00:00"))


@query(
    "file_digests",
    """SELECT CAST(c_nationkey AS VARCHAR) AS nation, CAST(SUM(octet_length(encode(c_name)) + 1) AS BIGINT) AS size_bytes,
      sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY c_nationkey""",
)
def file_digests(spark, sf_dir):
    """The names of each nation's customers as a file, hashed line by line."""
    path = tables.scratch_path(spark, "name-files")
    rows = binding.table(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_custkey").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    rows.select("c_name", "c_nationkey").write.partitionBy("c_nationkey").text(path)
    return manifests.file_digests(spark, path).select(F.regexp_extract("path", "c_nationkey=([^/]*)/", 1).alias("nation"), "size_bytes", "sha256")


_PAGES = "pg AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS name, sha256(html) AS sha FROM pages)"


@query(
    "ingest_decisions",
    f"""WITH {_PAGES}, st AS (SELECT name, MIN(sha) AS lo, MAX(sha) AS hi FROM pg WHERE url LIKE 'https%' GROUP BY name)
    SELECT page_id, name AS original_name, sha AS sha256, CASE WHEN lo IS NULL THEN 'ingest' WHEN lo = sha AND hi = sha THEN 'skip' ELSE 'conflict' END AS action
    FROM pg LEFT JOIN st USING (name)""",
)
def ingest_decisions(spark, sf_dir):
    """Pages to ingest against those already stored over the secure scheme, by address without scheme and query."""
    pages = binding.table(spark, sf_dir, "pages")
    name = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")
    new = pages.select("page_id", name.alias("original_name"), F.sha2("html", 256).alias("sha256"), "url")
    stored = new.where(F.col("url").startswith("https"))
    return manifests.ingest_decisions(new.drop("url"), stored)


def _event_manifests(spark, sf_dir):
    events = binding.table(spark, sf_dir, "events")
    return events.select(
        F.when(F.col("event_type") == "view", F.lit("novo_mov_local")).otherwise(F.lit("other")).alias("source"),
        F.date_format("ts", "yyyyMMdd").alias("competence"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("CagedMov"), F.col("event_id").cast("string"))).otherwise(F.col("event_type")).alias("original_name"),
        F.sha2("props", 256).alias("sha256"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at_utc"),
    )


@query(
    "latest_mov_manifests",
    """SELECT strftime(ts, '%Y%m%d') AS competence, CASE event_type WHEN 'view' THEN 'novo_mov_local' ELSE 'other' END AS source,
      CASE event_type WHEN 'click' THEN 'CagedMov' || event_id ELSE event_type END AS original_name, sha256(props) AS sha256,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at_utc FROM events WHERE event_type IN ('view', 'click')
    QUALIFY ROW_NUMBER() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY ts DESC) = 1""",
)
def latest_mov_manifests(spark, sf_dir):
    return manifests.latest_mov_manifests(_event_manifests(spark, sf_dir))


@query(
    "manifest_coverage",
    "SELECT COUNT(*) AS manifests, string_agg(DISTINCT strftime(ts, '%Y%m%d'), ',' ORDER BY strftime(ts, '%Y%m%d')) AS competencies FROM events",
)
def manifest_coverage(spark, sf_dir):
    coverage = manifests.manifest_coverage(_event_manifests(spark, sf_dir))
    return coverage.withColumn("competencies", F.array_join("competencies", ","))


def _part_manifests(spark, sf_dir):
    """One regional manifest per supplier; some carry the old key, some name the same file."""
    rows = binding.table(spark, sf_dir, "supplier")
    old = F.col("s_acctbal") > 5000
    entry = F.struct(
        F.when(~old, F.when(F.col("s_acctbal") < 0, F.lit("2024")).otherwise(F.lit("2025"))).alias("competence"),
        F.when(old, F.lit("2025")).alias("comptence"),
        F.concat(F.lit("part/"), F.floor(F.col("s_acctbal") / 100).cast("string")).alias("path"),
        F.sha2("s_name", 256).alias("sha256"),
        F.when(F.col("s_nationkey") < 20, F.lit("ftp")).alias("transport"),
    )
    return rows.select(F.lit(2025).alias("year"), F.array(entry).alias("files"))


_PARTS = """e AS (SELECT 'part/' || CAST(CAST(floor(s_acctbal / 100) AS BIGINT) AS VARCHAR) AS path, sha256(s_name) AS sha256,
      CASE WHEN s_acctbal < 0 THEN '2024' ELSE '2025' END AS competence, CASE WHEN s_nationkey < 20 THEN 'ftp' ELSE 'unknown' END AS transport FROM supplier)"""


@query(
    "merged_part_manifests",
    f"""WITH {_PARTS} SELECT CAST(2025 AS BIGINT) AS year, competence, path, sha256, transport, CASE WHEN competence <> '2025' THEN 'other month'
      WHEN COUNT(*) OVER (PARTITION BY path) > 1 THEN 'repeated file' END AS problem FROM e""",
)
def merged_part_manifests(spark, sf_dir):
    return manifests.merge_part_manifests(_part_manifests(spark, sf_dir), 2025)


@query(
    "merged_transport",
    f"""WITH {_PARTS} SELECT CASE WHEN COUNT(DISTINCT transport) = 1 THEN MIN(transport) ELSE 'mixed' END AS transport,
      string_agg(DISTINCT transport, ',' ORDER BY transport) AS transports FROM e""",
)
def merged_transport(spark, sf_dir):
    merged = manifests.merged_transport(manifests.merge_part_manifests(_part_manifests(spark, sf_dir), 2025))
    return merged.withColumn("transports", F.array_join("transports", ","))


@query(
    "part_set_problems",
    f"""WITH {STOCK} SELECT (SELECT COUNT(DISTINCT source_file) FROM s) AS quality, (SELECT COUNT(DISTINCT source_file) FROM s WHERE tech) AS silver,
      (SELECT COUNT(DISTINCT source_file) FROM s WHERE bad) AS reject, (SELECT COUNT(DISTINCT source_file) FROM s) AS manifest, CAST(0 AS BIGINT) AS other_year,
      (SELECT COUNT(DISTINCT source_file) = 7 FROM s) AS complete""",
)
def part_set_problems(spark, sf_dir):
    """Pieces found per region: report, stock, rejects, manifest."""
    rows = stock.stock_silver(binding.stock_raw(spark, sf_dir))
    per_part = rows.groupBy("source_file").agg(
        F.bool_or(F.col("status") == "scope").alias("s"), F.bool_or(F.col("status") == "rejected").alias("r")
    )
    kinds = F.array_compact(
        F.array(F.lit("quality"), F.lit("manifest"), F.when(F.col("s"), F.lit("silver")), F.when(F.col("r"), F.lit("reject")))
    )
    pieces = per_part.select(F.explode(kinds).alias("kind"), F.lit(2025).alias("year"))
    return manifests.part_set_problems(pieces, 2025)


@query(
    "record_fingerprints",
    """SELECT c_custkey, sha256('{"c_acctbal":' || c_acctbal || ',"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey
      || ',"huge":' || c_acctbal * 1e13 || ',"large":' || c_acctbal * 1e5 || ',"note":null,"small":' || c_acctbal / 1e9 || '}') AS sha256 FROM customer""",
)
def record_fingerprints(spark, sf_dir):
    """All columns of a customer, with balances that other writers put in plain digits or with another exponent."""
    scaled = {"large": F.col("c_acctbal") * 1e5, "huge": F.col("c_acctbal") * 1e13, "small": F.col("c_acctbal") / 1e9}
    rows = binding.table(spark, sf_dir, "customer").withColumn("note", F.lit(None).cast("string")).withColumns(scaled)
    return rows.select("c_custkey", record_fingerprint(rows).alias("sha256"))


_SETS = ", ".join(f"CAST(SUM(CAST('0x' || substr(sha256(t), {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))


@query(
    "release_fingerprint",
    f"""WITH c AS (SELECT c_nationkey AS k, sha256(concat_ws('|', CAST(COUNT(*) AS VARCHAR), {_SETS})) AS h FROM (SELECT c_nationkey, c_name AS t FROM customer) GROUP BY c_nationkey),
    o AS (SELECT k, sha256(concat_ws('|', CAST(COUNT(*) AS VARCHAR), {_SETS})) AS h FROM (SELECT c_nationkey AS k, CAST(o_orderkey AS VARCHAR) AS t FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY k)
    SELECT r_name AS region, sha256('rais-release:2025' || chr(10) || string_agg('source:' || c.h || chr(10), '' ORDER BY c.h)
      || string_agg('artifact:' || n_name || ':' || o.h || chr(10), '' ORDER BY n_nationkey)) AS release_sha256
    FROM nation JOIN region ON n_regionkey = r_regionkey JOIN c ON c.k = n_nationkey JOIN o ON o.k = n_nationkey GROUP BY r_name""",
)
def release_fingerprints(spark, sf_dir):
    """Per region: its nations' customer sets are the sources, their order sets the artifacts."""
    customers = binding.table(spark, sf_dir, "customer")
    sources = customers.groupBy("c_nationkey").agg(row_set_fingerprint(F.col("c_name")).alias("source"))
    orders = binding.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    owned = orders.join(customers.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    artifacts = owned.groupBy("c_nationkey").agg(row_set_fingerprint(F.col("o_orderkey").cast("string")).alias("artifact"))
    nations = binding.table(spark, sf_dir, "nation").join(
        binding.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    both = nations.join(sources, F.col("n_nationkey") == sources["c_nationkey"]).drop("c_nationkey")
    both = both.join(artifacts, F.col("n_nationkey") == artifacts["c_nationkey"])
    entry = F.struct(F.col("n_nationkey").alias("position"), F.col("n_name").alias("name"), F.col("artifact").alias("sha256"))
    lists = both.groupBy(F.col("r_name").alias("region")).agg(F.collect_list("source").alias("s"), F.collect_list(entry).alias("a"))
    return lists.select("region", release_fingerprint(F.lit(2025), F.col("s"), F.col("a")).alias("release_sha256"))


@query(
    "artifact_provenance",
    f"""WITH {_GATES} SELECT original_name, sha256, competence FROM (SELECT 'by-uf-' || strftime(ts, '%Y%m') || '.json' AS original_name, sha256(props) AS sha256,
      strftime(ts, '%Y%m') AS competence FROM events UNION ALL SELECT 'overview-' || strftime(o_orderdate, '%Y%m') || '.json', sha256(CAST(o_orderkey AS VARCHAR)),
      strftime(o_orderdate, '%Y%m') FROM orders) WHERE competence IN (SELECT competence FROM g WHERE publishable)""",
)
def artifact_provenance(spark, sf_dir):
    events, orders = binding.table(spark, sf_dir, "events"), binding.table(spark, sf_dir, "orders")
    name = lambda prefix, at: F.concat(F.lit(prefix), month_of(F.col(at)), F.lit(".json")).alias("original_name")
    files = events.select(name("by-uf-", "ts"), F.sha2("props", 256).alias("sha256")).unionByName(
        orders.select(name("overview-", "o_orderdate"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"))
    )
    return manifests.artifact_provenance(files, analytics.published_months(_stored_gates(spark, sf_dir)))


@query(
    "latest_document",
    f"""WITH {TEXT} SELECT 'MOV' AS kind, competence, COUNT(*) AS rows FROM q WHERE kind = 'MOV' AND competence = (SELECT MAX(competence) FROM q WHERE kind = 'MOV') GROUP BY competence""",
)
def latest_document(spark, sf_dir):
    """Newest base report; adjustment reports of a later month do not compete with it."""
    reports = binding.flow(spark, sf_dir, "competence").groupBy(F.col("adjustment_kind").alias("kind"), "competence").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return documents.latest_document(reports, "competence", kind="kind")


@query(
    "document_roundtrip",
    f"WITH {FLOW} SELECT competence, uf, {COUNTS} FROM f GROUP BY competence, uf",
)
def document_roundtrip(spark, sf_dir):
    """State tables written as one JSON document per month and read back item by item."""
    items = _state_months(spark, sf_dir)
    texts = documents.to_documents(items, ["competence"], ["uf"])
    schema = "competence string, items array<struct<uf:string, admissions:bigint, dismissals:bigint, balance:bigint>>"
    parsed = texts.select(F.from_json("value", schema).alias("d")).select("d.*")
    return documents.document_items(parsed)


@query("key_value_maps", "SELECT 'k' AS key, COUNT(*) AS rows, CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events")
def key_value_maps(spark, sf_dir):
    texts = binding.table(spark, sf_dir, "events").select(F.concat(F.lit('{"values":'), "props", F.lit("}")).alias("value"))
    pairs = documents.key_values(texts, "values", "bigint")
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total"))


@query(
    "parse_population",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS municipio_codigo_ibge, CAST(floor(c_acctbal) AS BIGINT) AS population FROM customer WHERE floor(c_acctbal) > 0""",
)
def parse_population(spark, sf_dir):
    """Nested population answers, one per customer, with thousands dots and null marks."""
    people = F.floor("c_acctbal")
    text = F.when(people < -500, F.lit("...")).otherwise(F.replace(F.format_number(people, 0), F.lit(","), F.lit(".")))
    series = F.struct(
        F.struct(F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("id")).alias("localidade"),
        F.create_map(F.lit("2001"), text).alias("serie"),
    )
    document = F.array(F.struct(F.array(F.struct(F.array(series).alias("series"))).alias("resultados")))
    texts = binding.table(spark, sf_dir, "customer").select(F.to_json(document).alias("value"))
    return dimensions.parse_population(texts, 2001)


@query(
    "parse_municipalities",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS prefix, lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '5' AS municipio_codigo_ibge, c_name AS municipio_nome,
      'S' || c_nationkey AS uf FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
)
def parse_municipalities(spark, sf_dir):
    """Nested municipality answers: the state sits under one of two paths, or under none."""
    state = F.struct(F.struct(F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("sigla")).alias("UF"))
    first = F.when(F.col("c_mktsegment") == "BUILDING", F.struct(state.alias("mesorregiao")))
    second = F.when(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.struct(state.alias("regiao-intermediaria")))
    item = F.struct(
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit("5")).alias("id"),
        F.concat(F.lit(" "), "c_name").alias("nome"), first.alias("microrregiao"), second.alias("regiao-imediata"),
    )
    texts = binding.table(spark, sf_dir, "customer").select(F.to_json(F.array(item)).alias("value"))
    return dimensions.parse_municipalities(texts)


@query(
    "ambiguous_prefixes",
    "SELECT lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS prefix, COUNT(DISTINCT c_name) AS entries FROM customer GROUP BY 1 HAVING COUNT(DISTINCT c_name) > 1",
)
def ambiguous_prefixes(spark, sf_dir):
    customers = binding.table(spark, sf_dir, "customer")
    prefix = F.lpad(F.col("c_nationkey").cast("string"), 6, "0")
    rows = customers.select(
        prefix.alias("prefix"), F.concat(prefix, F.lit("0")).alias("municipio_codigo_ibge"), F.col("c_name").alias("municipio_nome"), F.lit("XX").alias("uf")
    )
    return dimensions.ambiguous_prefixes(rows)


@query(
    "price_index_upsert",
    """WITH o AS (SELECT strftime(o_orderdate, '%Y%m') AS month, COUNT(*) AS v FROM orders GROUP BY 1),
    l AS (SELECT strftime(l_shipdate, '%Y%m') AS month, COUNT(*) AS v FROM lineitem GROUP BY 1)
    SELECT month, CAST(COALESCE(l.v, o.v) AS DOUBLE) AS value FROM o FULL JOIN l USING (month)""",
)
def price_index_upsert(spark, sf_dir):
    """New months over existing ones, the new ones parsed from an API answer with decimal commas."""
    monthly = binding.table(spark, sf_dir, "lineitem").groupBy(month_of(F.col("l_shipdate")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    answer = F.create_map(
        F.lit("D1C"), F.lit("1"), F.lit("D3C"), F.col("m"), F.lit("V"), F.concat(F.col("n").cast("string"), F.lit(",00"))
    )
    new = dimensions.parse_price_index(monthly.select(F.to_json(F.array(answer)).alias("value")))
    return dimensions.upsert_price_index(binding.price_index(spark, sf_dir), new)


# ---------------------------------------------------------------------------------------------------------------
# Through files
# ---------------------------------------------------------------------------------------------------------------


@query(
    "silver_table_roundtrip",
    f"""WITH {TEXT} SELECT kind AS adjustment_kind, bad AS registro_invalido, COUNT(*) AS rows, COUNT(DISTINCT competence) AS months FROM q GROUP BY kind, bad""",
)
def silver_table_roundtrip(spark, sf_dir):
    """Movements written to shared storage as text, scanned back, typed, and stored as a partitioned table."""
    path = tables.scratch_path(spark, "flow-text")
    raw = binding.flow_text_rows(spark, sf_dir)
    raw.write.csv(path, sep=";", header=True, emptyValue="", encoding="UTF-8", escape='"')
    rows = read_flow_rows(spark, path).withColumnsRenamed({"filekind": "file_kind", "ingestcompetence": "ingest_competence"})
    stored = tables.materialize(flow_silver(rows), "flow-silver", ["adjustment_kind"])
    return stored.groupBy("adjustment_kind", "registro_invalido").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("effective_competence").alias("months")
    )


#: Columns of the written movement files under the names that each kind of file gives them: another order, other spellings, more columns.
_SPELLINGS = {
    "MOV": {"competênciamov": "competênciamov", "uf": "uf", "município": "município", "saldomovimentação": "saldomovimentação", "cbo2002ocupação": "cbo2002ocupação",
            "tipomovimentação": "tipomovimentação", "salário": "salário", "indtrabintermitente": "indtrabintermitente"},
    "FOR": {"competênciadec": "Competência Dec", "salário": "Salário", "uf": " UF ", "competênciamov": "Competência Mov", "saldomovimentação": "Saldo Movimentação",
            "cbo2002ocupação": "CBO 2002 Ocupação", "tipomovimentação": "Tipo Movimentação", "município": "Município", "indtrabintermitente": "IndTrabIntermitente"},
    "EXC": {"uf": "UF", "competênciamov": "COMPETENCIAMOV", "saldomovimentação": "SALDOMOVIMENTACAO", "município": "MUNICIPIO", "salário": "SALARIO", "competênciadec": "COMPETENCIADEC",
            "tipomovimentação": "TIPOMOVIMENTACAO", "cbo2002ocupação": "CBO2002OCUPACAO", "indtrabintermitente": "INDTRABINTERMITENTE", "ingest_competence": "Nova Coluna"},
}
#: The same with broken headers: late files without the occupation, retractions with two columns for the state.
_BROKEN = {**_SPELLINGS, "FOR": {k: v for k, v in _SPELLINGS["FOR"].items() if k != "cbo2002ocupação"}, "EXC": {**_SPELLINGS["EXC"], "ingest_competence": "U.F."}}


def _write_flow_files(spark, sf_dir, spellings) -> str:
    """All movements as text files, in a folder per kind and month; every file has the header of its kind."""
    path = tables.scratch_path(spark, "flow-files")
    raw = binding.flow_text_rows(spark, sf_dir)
    for kind, names in spellings.items():
        rows = raw.where(F.col("file_kind") == kind).select(*[F.col(c).alias(name) for c, name in names.items()], F.col("ingest_competence").alias("month"))
        out = rows.hint("rebalance", "month").write.partitionBy("month").options(sep=";", header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        out.csv(f"{path}/{kind}")
    return path


_SPELLED = ", ".join(f"('{kind}', {i}, '{name}')" for kind, names in _BROKEN.items() for i, name in enumerate(names.values()))


@query(
    "flow_header_contract",
    f"""WITH spelled(kind, place, name) AS (VALUES {_SPELLED}),
    required(name) AS (VALUES ('competenciamov'), ('uf'), ('municipio'), ('saldomovimentacao'), ('cbo2002ocupacao'), ('tipomovimentacao'), ('salario')),
    h AS (SELECT kind, place, regexp_replace(lower(strip_accents(name)), '[^a-z0-9]', '', 'g') AS name FROM spelled),
    kinds AS (SELECT DISTINCT CASE WHEN l_linenumber = 7 THEN 'FOR' WHEN l_linenumber = 6 AND l_quantity < 5 THEN 'EXC' ELSE 'MOV' END AS kind FROM lineitem),
    listed AS (SELECT kind, string_agg(name, ' ' ORDER BY place) AS headers FROM h GROUP BY kind),
    gone AS (SELECT kind, string_agg(name, ' ' ORDER BY name) AS missing FROM kinds CROSS JOIN required WHERE (kind, name) NOT IN (SELECT (kind, name) FROM h) GROUP BY kind),
    twice AS (SELECT kind, string_agg(name, ' ' ORDER BY name) AS doubled FROM (SELECT kind, name FROM h GROUP BY kind, name HAVING COUNT(*) > 1) GROUP BY kind)
    SELECT kind, headers, COALESCE(missing, '') AS missing, COALESCE(doubled, '') AS doubled, missing IS NULL AND doubled IS NULL AS valid
    FROM kinds JOIN listed USING (kind) LEFT JOIN gone USING (kind) LEFT JOIN twice USING (kind)""",
)
def flow_header_contract(spark, sf_dir):
    """The headers of written files, some of them broken, file by file; files of a kind agree."""
    path = _write_flow_files(spark, sf_dir, _BROKEN)
    found = header_contract(first_lines(spark, list_files(spark, path)))
    return found.select(
        F.element_at(F.split("path", "/"), -3).alias("kind"), F.array_join("headers", " ").alias("headers"),
        F.array_join("missing", " ").alias("missing"), F.array_join("doubled", " ").alias("doubled"), "valid",
    ).distinct()


@query(
    "mixed_header_scan",
    f"""WITH {TEXT} SELECT kind AS adjustment_kind, competence AS ingest_competence, bad AS registro_invalido, COUNT(*) AS rows,
      COUNT(CASE WHEN kind <> 'MOV' THEN declared END) AS declared, CAST(SUM(sgn) AS BIGINT) AS balance, COUNT(DISTINCT cbo) AS codes,
      COUNT(CASE WHEN kind = 'EXC' THEN 1 END) AS extra_column FROM q GROUP BY kind, competence, bad""",
)
def mixed_header_scan(spark, sf_dir):
    """Files of all months and kinds, read with one scan per layout; month and kind come from the file of each row."""
    path = _write_flow_files(spark, sf_dir, _SPELLINGS)
    folders = sorted({file.rsplit("/", 1)[0] for file in list_files(spark, path)})
    loads = [(folder, folder.rsplit("=", 1)[1], folder.split("/")[-2]) for folder in folders]
    rows = flow_silver(read_flow_files(spark, loads))
    return rows.groupBy("adjustment_kind", "ingest_competence", "registro_invalido").agg(
        F.count(F.lit(1)).alias("rows"), F.count("competencia_declarada").alias("declared"), F.sum(F.col("saldo_movimentacao").cast("bigint")).alias("balance"),
        F.count_distinct("cbo_codigo").alias("codes"), F.count("novacoluna").alias("extra_column"),
    )


@query(
    "idempotent_month_load",
    f"""WITH {FLOW} SELECT competence, uf, {COUNTS} FROM f GROUP BY competence, uf""",
)
def idempotent_month_load(spark, sf_dir):
    """Base rows are loaded first; each month is then replaced by its rows with adjustments, and row counts checked."""
    path = tables.scratch_path(spark, "serving")
    final = _state_months(spark, sf_dir)
    for load in (_state_months(spark, sf_dir, only_base=True), final):
        tables.replace_partitions(load, path, ["competence"])
    tables.require_row_counts(spark, path, final, "competence")
    return spark.read.schema("uf string, admissions bigint, dismissals bigint, balance bigint, competence string").parquet(path)
