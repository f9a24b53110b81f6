"""Queries over the annual stock, and stock against flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.fixed_values import OCCUPATION_FAMILIES
from jobtide.functions.numbers import dotted_thousands_number
from jobtide.operators import analytics, contracts, gates, quality, stock
from jobtide.operators.joins import evaluate_once
from jobtide.plans import binding
from jobtide.plans.oracle_sql import COUNTERS, COUNTS, FLOW, PLACES, STOCK
from jobtide.plans.registry import query
from jobtide.sources.layout import inspect_layouts
from jobtide.sources.stock_text import read_stock_text
from jobtide.sources.tables import scratch_path

YEAR = 2025


def _raw(spark, sf_dir):
    """The columns that rows are routed by, built once."""
    return evaluate_once(binding.stock_raw(spark, sf_dir), [*stock.RAW, "source_file"])


def _silver(spark, sf_dir):
    return stock.stock_silver(binding.stock_raw(spark, sf_dir))


def _routed(spark, sf_dir):
    """Text columns built once per row, as a file scan would give them, then routed."""
    return stock.route_stock(stock.stock_silver(_raw(spark, sf_dir)), YEAR)


def _scope(spark, sf_dir):
    return _routed(spark, sf_dir).scope


@query(
    "stock_cube",
    f"""WITH {STOCK} SELECT CAST(2025 AS BIGINT) AS year, uf, fam AS cbo_familia, cbo AS cbo_codigo, COUNT(*) AS active_stock
      FROM s WHERE tech GROUP BY ALL""",
)
def stock_cube(spark, sf_dir):
    return stock.stock_market(_scope(spark, sf_dir))


@query(
    "stock_by_state_share",
    f"""WITH {STOCK} SELECT uf, COUNT(*) AS active_stock,
      round(COUNT(*) / (SELECT COUNT(*) FROM s WHERE tech), 6) AS share_of_tech_stock FROM s WHERE tech GROUP BY uf""",
)
def stock_by_state_share(spark, sf_dir):
    return stock.stock_by(_scope(spark, sf_dir), ["uf"])


@query(
    "stock_by_family_share",
    f"""WITH {STOCK} SELECT fam AS cbo_familia, COUNT(*) AS active_stock,
      round(COUNT(*) / (SELECT COUNT(*) FROM s WHERE tech), 6) AS share_of_tech_stock,
      CASE fam WHEN '2122' THEN 'Engenheiros em computação' WHEN '2123' THEN 'Administradores de tecnologia da informação'
        WHEN '2124' THEN 'Analistas de tecnologia da informação' END AS cbo_familia_nome
      FROM s WHERE tech GROUP BY fam""",
)
def stock_by_family_share(spark, sf_dir):
    return stock.with_family_name(stock.stock_by(_scope(spark, sf_dir), ["cbo_familia"]))


@query(
    "stock_by_municipality",
    f"""WITH {STOCK}, {PLACES}, c AS (SELECT mun, uf, COUNT(*) AS n FROM s WHERE tech GROUP BY mun, uf)
    SELECT c.mun AS municipio_codigo_rais, CASE WHEN c.mun <> '999999' AND nome IS NOT NULL THEN c.mun || '7' END AS municipio_codigo_ibge,
      CASE WHEN c.mun = '999999' THEN 'Não identificado' ELSE nome END AS municipio_nome, c.uf, n AS active_stock,
      round(n / (SELECT SUM(n) FROM c), 6) AS share_of_tech_stock,
      CASE WHEN c.mun = '999999' THEN NULL WHEN nome IS NULL THEN 'unknown municipality' END AS problem
    FROM c LEFT JOIN places USING (mun)""",
)
def stock_by_municipality(spark, sf_dir):
    return stock.stock_by_municipality(_scope(spark, sf_dir), binding.municipality_dimension(spark, sf_dir))


@query(
    "stock_municipality_topk",
    f"""WITH {STOCK} SELECT mun AS municipio_codigo, COUNT(*) AS active_stock FROM s WHERE tech GROUP BY mun
      ORDER BY active_stock DESC, municipio_codigo LIMIT 15""",
)
def stock_municipality_topk(spark, sf_dir):
    counts = _scope(spark, sf_dir).groupBy("municipio_codigo").agg(F.count(F.lit(1)).alias("active_stock"))
    return analytics.top(counts, "active_stock", "municipio_codigo", 15)


@query(
    "stock_overview",
    f"""WITH {STOCK} SELECT COUNT(*) FILTER (tech) AS active_stock_tech, COUNT(DISTINCT uf) FILTER (tech) AS uf_count,
      (SELECT COUNT(*) FROM (SELECT DISTINCT uf, fam, cbo FROM s WHERE tech)) AS market_rows,
      COUNT(*) FILTER (active) AS active_stock_national_reference,
      round(COUNT(*) FILTER (tech) / COUNT(*) FILTER (active), 6) AS share_tech_of_national_active FROM s""",
)
def stock_overview(spark, sf_dir):
    national = _silver(spark, sf_dir).agg(F.count_if(F.col("status").isin("scope", "out_of_scope"))).scalar()
    return stock.stock_overview(_scope(spark, sf_dir), national)


@query(
    "stock_guard",
    f"""WITH {STOCK} SELECT COUNT(*) AS stock, CAST(0 AS BIGINT) AS other_year, CAST(0 AS BIGINT) AS not_active,
      COUNT(*) FILTER (fam = '2124') AS outside_scope, false AS ok FROM s WHERE tech""",
)
def stock_guard(spark, sf_dir):
    """The guard with one family taken out of the scope, so it has something to find."""
    return stock.stock_guard(_scope(spark, sf_dir), YEAR, ["2122", "2123", "3171", "3172"], 10**15)


@query("unknown_families", f"WITH {STOCK} SELECT DISTINCT fam AS cbo_familia FROM s WHERE active AND fam NOT IN ('2122','2123','2124')")
def unknown_families(spark, sf_dir):
    rows = evaluate_once(stock.stock_silver(_raw(spark, sf_dir)), ["cbo_familia", "status"])
    active = rows.where(F.col("status").isin("scope", "out_of_scope"))
    known = spark.createDataFrame([(code,) for code in OCCUPATION_FAMILIES], "cbo_familia string")
    return stock.unknown_families(active, known)


@query(
    "reject_routing",
    f"""WITH {STOCK} SELECT source_file, concat_ws(',', CASE WHEN bad_active THEN 'invalid_active_status' END,
        CASE WHEN bad_ab THEN 'invalid_abandoned_status' END, CASE WHEN bad_cbo THEN 'invalid_cbo' END,
        CASE WHEN bad_uf THEN 'invalid_uf' END) AS reason, COALESCE(uf, '') AS uf_derived, COUNT(*) AS rows
      FROM s WHERE bad GROUP BY ALL""",
)
def reject_routing(spark, sf_dir):
    rejected = _routed(spark, sf_dir).rejected
    return rejected.groupBy("source_file", "reason", "uf_derived").agg(F.count(F.lit(1)).alias("rows"))


_IDENTITIES = """true AS source_partition_complete, true AS stock_partition_complete,
  round(COUNT(*) FILTER (NOT bad) / COUNT(*), 6) AS valid_rate"""


@query("stock_partition_counts", f"WITH {STOCK} SELECT source_file, {COUNTERS}, {_IDENTITIES} FROM s GROUP BY source_file")
def stock_partition_counts(spark, sf_dir):
    return stock.with_stock_identities(stock.stock_counters(_silver(spark, sf_dir), ["source_file"]))


@query("annual_text_scan", f"WITH {STOCK} SELECT {COUNTERS} FROM s")
def annual_text_scan(spark, sf_dir):
    """Links written as annual text in two layouts, with a remark that holds line breaks, quotes and delimiters in quotes; laid out,
    matched and read back."""
    path = scratch_path(spark, "annual-text")
    remark = F.concat(F.lit('primeira linha\n"'), "rem_mean_raw", F.lit('"; x,\n\n'), F.repeat(F.lit("|\n"), F.length("rem_dec_raw")), F.lit(';"'))
    raw = binding.stock_raw(spark, sf_dir)
    named = raw.select(
        "source_file", F.col("cbo_raw").alias("CBO 2002 Ocupação - Código"), F.col("municipio_raw").alias("Município - Código"),
        F.when(F.col("abandoned_raw") != "1", remark).otherwise("sem").alias("Observação"),
        F.col("active_raw").alias("Ind Vínculo Ativo 31/12 - Código"), F.col("abandoned_raw").alias("Ind Vínculo Abandonado - Código"),
    )
    out = {"header": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for delimiter, regions in ((";", ["AFRICA", "AMERICA", "NI"]), (",", ["ASIA", "EUROPE", "MIDDLE EAST"])):
        named.where(F.col("source_file").isin(regions)).drop("source_file").write.options(sep=delimiter, **out).csv(f"{path}/{ord(delimiter)}")
    rows = read_stock_text(spark, inspect_layouts(spark, path))
    return stock.stock_counters(stock.stock_silver(rows), [])


@query(
    "stock_quality_merged",
    f"WITH {STOCK} SELECT {COUNTERS}, {_IDENTITIES}, COUNT(DISTINCT source_file) AS parts_merged FROM s",
)
def stock_quality_merged(spark, sf_dir):
    return stock.merge_stock_counters(stock_partition_counts(spark, sf_dir))


@query(
    "merged_reason_maps",
    f"""WITH {STOCK} SELECT reason, CAST(n AS BIGINT) AS rows FROM (SELECT COUNT(*) FILTER (bad_active) AS invalid_active_status,
      COUNT(*) FILTER (bad_ab) AS invalid_abandoned_status, COUNT(*) FILTER (bad_cbo) AS invalid_cbo,
      CAST(0 AS BIGINT) AS invalid_municipality, COUNT(*) FILTER (bad_uf) AS invalid_uf FROM s)
      UNPIVOT (n FOR reason IN (invalid_active_status, invalid_abandoned_status, invalid_cbo, invalid_municipality, invalid_uf))""",
)
def merged_reason_maps(spark, sf_dir):
    parts = stock_partition_counts(spark, sf_dir)
    pairs = [p for name in stock.STOCK_REJECT_REASONS for p in (F.lit(name), F.col(name))]
    return stock.merge_reason_maps(parts.select(F.create_map(*pairs).alias("rejection_counts")))


@query(
    "stock_rule_candidates",
    f"""WITH {STOCK}, a AS (SELECT source_file, COUNT(*) FILTER (st = 'O') AS active_total,
        COUNT(*) FILTER (st = 'O' AND ab = '0') AS active_abandoned_zero, COUNT(*) FILTER (st = 'O' AND ab <> '1') AS active_abandoned_not_one,
        COUNT(*) FILTER (st = 'O' AND o_totalprice > 0) AS active_rem_mean_positive,
        COUNT(*) FILTER (st = 'O' AND o_orderpriority <> '1-URGENT' AND o_totalprice > 0) AS active_rem_dec_positive,
        COUNT(*) FILTER (st = 'O' AND ab = '0' AND o_totalprice > 0) AS active_abandoned_zero_rem_mean_positive,
        COUNT(*) FILTER (st = 'O' AND ab = '0' AND o_orderpriority <> '1-URGENT' AND o_totalprice > 0) AS active_abandoned_zero_rem_dec_positive,
      FROM s GROUP BY source_file)
    SELECT source_file, CAST(official AS BIGINT) AS official, candidate, CAST(stock AS BIGINT) AS stock, stock = official AS exact_match
    FROM (SELECT *, active_abandoned_zero AS official FROM a) UNPIVOT (stock FOR candidate IN (active_total, active_abandoned_zero,
      active_abandoned_not_one, active_rem_mean_positive, active_rem_dec_positive, active_abandoned_zero_rem_mean_positive,
      active_abandoned_zero_rem_dec_positive))""",
)
def stock_rule_candidates(spark, sf_dir):
    raw = binding.stock_raw(spark, sf_dir).withColumns(
        {
            "rem_mean": dotted_thousands_number(F.col("rem_mean_raw")),
            "rem_dec": dotted_thousands_number(F.col("rem_dec_raw")),
        }
    )
    return quality.stock_rule_candidates(raw, F.col("active_abandoned_zero"), ["source_file"])


@query(
    "abandoned_values_of_active",
    f"WITH {STOCK} SELECT ab AS abandoned, COUNT(*) AS rows FROM s WHERE st = 'O' GROUP BY ab",
)
def abandoned_values_of_active(spark, sf_dir):
    return quality.abandoned_values_of_active(binding.stock_raw(spark, sf_dir))


@query(
    "dimension_check",
    f"""WITH {STOCK}, {PLACES}, p AS (SELECT mun, uf, COUNT(*) AS n FROM s WHERE tech GROUP BY mun, uf),
    j AS (SELECT p.*, nome IS NOT NULL AS hit FROM p LEFT JOIN places USING (mun))
    SELECT CAST(SUM(n) AS BIGINT) AS silver_rows, COUNT(DISTINCT mun) AS unique_codes,
      CAST(COALESCE(SUM(n) FILTER (mun = '999999'), 0) AS BIGINT) AS residual_rows,
      COUNT(DISTINCT mun) FILTER (mun <> '999999' AND hit) AS matched_codes,
      COUNT(DISTINCT mun) FILTER (mun <> '999999' AND NOT hit) AS unmatched_codes, CAST(0 AS BIGINT) AS invalid_length_codes,
      CAST(0 AS BIGINT) AS invalid_numeric_codes, CAST(0 AS BIGINT) AS uf_mismatch_rows, CAST(0 AS BIGINT) AS ambiguous_prefixes,
      COUNT(DISTINCT mun) FILTER (mun <> '999999' AND NOT hit) = 0 AS municipality_ready FROM j""",
)
def dimension_check(spark, sf_dir):
    dimension = binding.municipality_dimension(spark, sf_dir).select(F.col("municipio_codigo_ibge").alias("code7"))
    return contracts.municipality_dimension_check(_scope(spark, sf_dir), dimension)


@query(
    "value_contract",
    f"""WITH {STOCK} SELECT '1' AS positive_observed, '0' AS negative_observed, string_agg(DISTINCT lower(st), ',') FILTER (st = 'P') AS unknown_values,
      COUNT(DISTINCT st) FILTER (st = 'P') AS unknown_count, CAST(0 AS BIGINT) AS blank_values, COUNT(*) FILTER (st = 'P') = 0 AS valid FROM s""",
)
def value_contract(spark, sf_dir):
    counts = quality.value_counts(binding.stock_raw(spark, sf_dir), ["active_raw"])
    result = contracts.binary_value_contract(counts, ["1"], ["0"])
    return result.withColumns(
        {c: F.array_join(c, ",") for c in ("positive_observed", "negative_observed", "unknown_values")}
    )


@query(
    "contract_values",
    """SELECT CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS value, CASE WHEN c_acctbal < 0 THEN 'blank' WHEN c_custkey IN (1, 2, 3) THEN 'positive'
      WHEN c_custkey IN (4, 5, 6) THEN 'negative' ELSE 'unknown' END AS class, COUNT(*) AS n FROM customer GROUP BY ALL""",
)
def contract_values(spark, sf_dir):
    """Every value of a column that a two-valued contract does not fit: nearly all are unknown, and all are listed."""
    text = F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("c_custkey").cast("string")))
    counts = quality.value_counts(binding.table(spark, sf_dir, "customer").select(text.alias("code")), ["code"])
    return contracts.classified_values(counts, ["1", "2", "3"], ["4", "5", "6"])


@query("observed_years", "SELECT CAST(year(o_orderdate) AS VARCHAR) AS value, COUNT(*) AS n FROM orders GROUP BY 1")
def observed_years(spark, sf_dir):
    years = binding.table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("string").alias("year"))
    return contracts.observed_values(quality.value_counts(years, ["year"]))


@query(
    "year_contract",
    "SELECT string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS observed,"
    " COUNT(DISTINCT year(o_orderdate)) = 1 AND MAX(year(o_orderdate)) = 1998 AS valid FROM orders",
)
def year_contract(spark, sf_dir):
    years = binding.table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("string").alias("value"))
    checked = contracts.year_contract(years, 1998)
    return checked.withColumn("observed", F.array_join("observed", ","))


@query(
    "national_stock_reconciliation",
    f"""WITH {STOCK} SELECT CAST(2025 AS BIGINT) AS year, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'O') AS expected_active,
      COUNT(*) FILTER (st = 'O' AND ab = '0') AS observed_active, COUNT(*) FILTER (st = 'O') AS raw_active_source,
      COUNT(*) FILTER (st = 'O' AND ab = '1') AS abandoned_active_source,
      COUNT(*) FILTER (st = 'O' AND ab = '0') - COUNT(*) FILTER (st = 'O') AS difference, true AS source_partition_complete,
      true AS stock_partition_complete, COUNT(*) FILTER (st = 'P') AS unknown_status_rows,
      COUNT(*) FILTER (st = 'O' AND ab = '') AS unknown_abandoned_rows, CAST(0 AS BIGINT) AS year_mismatch_rows,
      COUNT(*) FILTER (tech) AS tech_rows, false AS reconciled, false AS gold_ready FROM s""",
)
def national_stock_reconciliation(spark, sf_dir):
    counters = stock.with_stock_identities(stock.stock_counters(_silver(spark, sf_dir))).withColumn("year", F.lit(YEAR))
    orders = binding.table(spark, sf_dir, "orders")
    official = orders.agg(F.count_if(F.col("o_orderstatus") == "O").alias("active_links")).withColumn("year", F.lit(YEAR))
    return gates.annual_reconciliation(counters, official)


_EXPECTED = """e AS (SELECT r_name AS archive, COUNT(*) AS expected FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'O'
  AND o_orderpriority <> '5-LOW' AND NOT (o_orderpriority = '3-MEDIUM' AND c_acctbal < 0) GROUP BY r_name)"""


def _regional(spark, sf_dir):
    """Official totals by region come from the keys alone; the observed ones from the routed text rows."""
    rows = stock.stock_counters(_silver(spark, sf_dir), ["source_file"]).withColumnRenamed("source_file", "archive")
    eligible = binding.table(spark, sf_dir, "orders").where("o_orderstatus = 'O' and o_orderpriority <> '5-LOW'")
    for name, left, right, keep in [
        ("customer", "o_custkey", "c_custkey", ["c_nationkey", "c_acctbal"]),
        ("nation", "c_nationkey", "n_nationkey", ["n_regionkey"]),
        ("region", "n_regionkey", "r_regionkey", ["r_name"]),
    ]:
        side = binding.table(spark, sf_dir, name).select(right, *keep)
        eligible = eligible.join(side, F.col(left) == F.col(right))
    eligible = eligible.where("not (o_orderpriority = '3-MEDIUM' and c_acctbal < 0)")
    expected = eligible.groupBy(F.col("r_name").alias("archive")).agg(F.count(F.lit(1)).alias("expected_stock"))
    return gates.regional_reconciliation(rows, expected)


@query(
    "regional_reconciliation",
    f"""WITH {STOCK}, {_EXPECTED}, o AS (SELECT source_file AS archive, COUNT(*) FILTER (st = 'O' AND ab = '0') AS obs,
      COUNT(*) FILTER (st = 'O') AS raw, COUNT(*) FILTER (st = 'O' AND ab = '1') AS abd, COUNT(*) FILTER (bad) AS rej,
      COUNT(*) FILTER (st = 'O' AND ab = '') AS unk FROM s GROUP BY ALL)
    SELECT archive, expected AS expected_stock, obs AS observed_stock, raw AS raw_active, abd AS abandoned_active,
      obs - expected AS difference, COALESCE(obs = expected AND rej = 0 AND unk = 0, false) AS matched
    FROM e FULL JOIN o USING (archive)""",
)
def regional_reconciliation(spark, sf_dir):
    return _regional(spark, sf_dir)


@query(
    "regional_summary",
    f"""WITH {STOCK}, {_EXPECTED} SELECT COUNT(*) FILTER (st = 'O' AND ab = '0') AS observed_national_stock,
      COUNT(DISTINCT source_file) AS group_count, (SELECT CAST(SUM(expected) AS BIGINT) FROM e) AS expected_national_stock,
      COUNT(*) FILTER (st = 'O' AND ab = '0') - (SELECT CAST(SUM(expected) AS BIGINT) FROM e) AS difference,
      false AS regional_reconciled FROM s""",
)
def regional_summary(spark, sf_dir):
    checks = _regional(spark, sf_dir)
    return gates.regional_summary(checks, checks.agg(F.sum("expected_stock")).scalar())


# ---------------------------------------------------------------------------------------------------------------
# Stock and flow
# ---------------------------------------------------------------------------------------------------------------

_BRAND_STOCK = """bs AS (SELECT p_brand AS cbo_familia, COUNT(*) AS active_stock FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'O' GROUP BY p_brand),
  bf AS (SELECT cbo_familia, """ + COUNTS + """ FROM f GROUP BY cbo_familia)"""


def _family_stock(spark, sf_dir):
    """Links of open orders per occupation: the stock side keyed like the flow."""
    orders = binding.table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    parts = binding.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    rows = binding.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.withColumns({"cbo_familia": F.col("p_brand"), "cbo_codigo": F.concat("p_brand", F.lit("/"), "p_type")})


def _context(spark, sf_dir):
    links = _family_stock(spark, sf_dir).groupBy("cbo_familia").agg(F.count(F.lit(1)).alias("active_stock"))
    flow = binding.flow(spark, sf_dir, "cbo_familia").groupBy("cbo_familia").agg(
        *[F.sum(f"{c}_delta").cast("bigint").alias(c) for c in analytics.COUNTS]
    )
    return analytics.stock_flow_context(links, flow)


@query(
    "stock_flow_context",
    f"""WITH {FLOW}, {_BRAND_STOCK}, x AS (SELECT *, active_stock / SUM(active_stock) OVER () AS ss, admissions / SUM(admissions) OVER () AS fs
      FROM bs JOIN bf USING (cbo_familia))
    SELECT cbo_familia, active_stock, admissions, dismissals, balance, round(ss, 6) AS share_of_tech_stock,
      round(fs, 6) AS share_of_tech_admissions, round(admissions / active_stock * 100, 6) AS admissions_per_100_prior_stock,
      round(dismissals / active_stock * 100, 6) AS dismissals_per_100_prior_stock,
      round(balance / active_stock * 100, 6) AS balance_per_100_prior_stock, round((fs - ss) * 100, 6) AS composition_gap_pp FROM x""",
)
def stock_flow_context(spark, sf_dir):
    return _context(spark, sf_dir)


@query(
    "stock_flow_totals",
    f"""WITH {FLOW}, {_BRAND_STOCK}, t AS (SELECT CAST(SUM(active_stock) AS BIGINT) AS active_stock, CAST(SUM(admissions) AS BIGINT) AS admissions,
      CAST(SUM(dismissals) AS BIGINT) AS dismissals, CAST(SUM(balance) AS BIGINT) AS balance FROM bs JOIN bf USING (cbo_familia))
    SELECT *, round(admissions / active_stock * 100, 6) AS admissions_per_100_prior_stock,
      round(dismissals / active_stock * 100, 6) AS dismissals_per_100_prior_stock,
      round(balance / active_stock * 100, 6) AS balance_per_100_prior_stock FROM t""",
)
def stock_flow_totals(spark, sf_dir):
    return analytics.stock_flow_totals(_context(spark, sf_dir))


@query(
    "stock_flow_by_code",
    f"""WITH {FLOW}, a AS (SELECT uf, cbo_codigo, CAST(SUM(bal) AS BIGINT) AS saldo FROM f GROUP BY uf, cbo_codigo),
    b AS (SELECT n_name AS uf, p_brand || '/' || p_type AS cbo_codigo, COUNT(*) AS active_stock FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON s_nationkey = n_nationkey WHERE o_orderstatus = 'O' GROUP BY ALL)
    SELECT uf, cbo_codigo, saldo, active_stock FROM a JOIN b USING (uf, cbo_codigo)""",
)
def stock_flow_by_code(spark, sf_dir):
    flow = binding.flow(spark, sf_dir, "uf", "cbo_codigo").withColumn("saldo", F.col("balance_delta").cast("bigint"))
    suppliers = binding.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = binding.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("uf"))
    links = _family_stock(spark, sf_dir).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    links = links.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("active_stock", F.lit(1).cast("bigint"))
    return analytics.stock_flow_by_code(flow, links)
