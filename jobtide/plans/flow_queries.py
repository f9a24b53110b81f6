"""Queries over the monthly movements."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions.movement import effective_month
from jobtide.functions.rates import deflate, price_ratio
from jobtide.functions.salary import ELIGIBLE
from jobtide.operators import analytics, flow_gold
from jobtide.plans import binding
from jobtide.plans.oracle_sql import COUNTS, FLOW, group_ctes
from jobtide.plans.registry import query

_GROUP_COLUMNS = (
    "admissions, dismissals, balance, records, salary_mean_admissions, salary_median_admissions, "
    "salary_eligible_admissions"
)


@query("flow_by_state", group_ctes("uf") + f"SELECT uf, {_GROUP_COLUMNS} FROM g")
def flow_by_state(spark, sf_dir):
    return flow_gold.group_table(binding.flow(spark, sf_dir, "uf"), ["uf"])


@query(
    "flow_by_family_code",
    group_ctes("cbo_familia, cbo_codigo") + f"SELECT cbo_familia, cbo_codigo, {_GROUP_COLUMNS} FROM g",
)
def flow_by_family_code(spark, sf_dir):
    return flow_gold.group_table(binding.flow(spark, sf_dir, "cbo_familia", "cbo_codigo"), ["cbo_familia", "cbo_codigo"])


@query(
    "flow_by_municipality",
    group_ctes("municipio_codigo_caged") + f"""SELECT municipio_codigo_caged, {_GROUP_COLUMNS},
      lpad(municipio_codigo_caged, 7, '0') AS municipio_codigo_ibge, s_name AS municipio_nome, n_name AS uf
    FROM g LEFT JOIN supplier ON municipio_codigo_caged = CAST(s_suppkey AS VARCHAR)
    LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def flow_by_municipality(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "municipio_codigo_caged")
    suppliers = binding.table(spark, sf_dir, "supplier")
    nations = binding.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dimension = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").cast("string").alias("prefix"),
        F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("municipio_codigo_ibge"),
        F.col("s_name").alias("municipio_nome"),
        F.col("n_name").alias("uf"),
    )
    return flow_gold.with_municipality(flow_gold.group_table(rows, ["municipio_codigo_caged"]), dimension)


@query(
    "flow_overview",
    group_ctes("one").replace("SELECT strftime(l_shipdate, '%Y%m') AS competence,", "SELECT 1 AS one, strftime(l_shipdate, '%Y%m') AS competence,", 1)
    + """SELECT admissions, dismissals, balance, records AS records_tech, salary_mean_admissions,
      salary_median_admissions, salary_eligible_admissions,
      admissions - salary_eligible_admissions AS salary_excluded_admissions FROM g""",
)
def flow_overview(spark, sf_dir):
    return flow_gold.overview(binding.flow(spark, sf_dir), [])


_ALL_GRAINS = {"uf": "by_uf", "cbo_familia, cbo_codigo": "by_occupation", "municipio_codigo_caged": "by_municipality"}


def _one_grain(keys: str, grain: str) -> str:
    shown = [k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}" for k in ("uf", "cbo_familia", "cbo_codigo", "municipio_codigo_caged")]
    return f"SELECT '{grain}' AS grain, {', '.join(shown)}, {_GROUP_COLUMNS} FROM ({group_ctes(keys)} SELECT * FROM g)"


@query("flow_all_grains", " UNION ALL ".join(_one_grain(k, g) for k, g in _ALL_GRAINS.items()))
def flow_all_grains(spark, sf_dir):
    """Three published groupings from one scan."""
    rows = binding.flow(spark, sf_dir, "uf", "cbo_familia", "cbo_codigo", "municipio_codigo_caged")
    grains = {name: cols for name, cols in flow_gold.GRAINS.items() if cols}
    return flow_gold.group_tables(rows, grains)


@query(
    "market_cube",
    f"""WITH {FLOW} SELECT uf, cbo_familia, cbo_codigo, competence AS competencia, CAST(SUM(adm) AS BIGINT) AS admissoes,
      CAST(SUM(dis) AS BIGINT) AS desligamentos, CAST(SUM(bal) AS BIGINT) AS saldo FROM f GROUP BY ALL""",
)
def market_cube(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "uf", "cbo_familia", "cbo_codigo", "competence")
    return flow_gold.market_cube(rows, "competence")


@query(
    "market_by_state",
    f"""WITH {FLOW} SELECT uf, CAST(SUM(adm) AS BIGINT) AS admissoes, CAST(SUM(dis) AS BIGINT) AS desligamentos,
      CAST(SUM(bal) AS BIGINT) AS saldo FROM f GROUP BY uf""",
)
def market_by_state(spark, sf_dir):
    return flow_gold.cube_by(market_cube(spark, sf_dir), ["uf"])


@query(
    "adjustment_breakdown",
    f"""WITH {FLOW} SELECT competence, kind AS adjustment_kind, COUNT(*) AS rows,
      CAST(SUM(adm) AS BIGINT) AS admissions_delta, CAST(SUM(dis) AS BIGINT) AS dismissals_delta,
      CAST(SUM(bal) AS BIGINT) AS balance_delta FROM f GROUP BY competence, kind""",
)
def adjustment_breakdown(spark, sf_dir):
    return flow_gold.adjustment_breakdown(binding.flow(spark, sf_dir, "competence"), ["competence"])


def _cent_median(keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    shown, grouped = (f"{keys},", f"GROUP BY {keys}") if keys else ("", "")
    return f"""(WITH v AS (SELECT {shown} l_extendedprice AS pay, SUM(CAST(l_quantity AS BIGINT)) AS w FROM lineitem GROUP BY {shown} pay),
    p AS (SELECT *, SUM(w) OVER ({part} ORDER BY pay) AS cum, SUM(w) OVER ({part}) AS tot FROM v)
    SELECT {shown} CAST(MAX(tot) AS BIGINT) AS total_weight,
      (MIN(CASE WHEN 2 * cum >= tot THEN pay END) + MIN(CASE WHEN 2 * cum > tot THEN pay END)) / 2 AS weighted_median
    FROM p {grouped})"""


@query(
    "cent_value_medians",
    f"""SELECT 'all' AS level, CAST(NULL AS VARCHAR) AS flag, total_weight, weighted_median FROM {_cent_median("")}
    UNION ALL SELECT 'flag', l_returnflag, total_weight, weighted_median FROM {_cent_median("l_returnflag")}""",
)
def cent_value_medians(spark, sf_dir):
    """Medians of uncapped values to the cent, over everything and by flag: groups with nearly as many values as rows."""
    rows = binding.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", F.col("l_quantity").cast("bigint").alias("quantity"))
    whole = flow_gold.weighted_median(rows, [], "l_extendedprice", "quantity").select(F.lit("all").alias("level"), F.lit(None).cast("string").alias("flag"), "total_weight", "weighted_median")
    by_flag = flow_gold.weighted_median(rows, ["l_returnflag"], "l_extendedprice", "quantity")
    return whole.unionByName(by_flag.select(F.lit("flag").alias("level"), F.col("l_returnflag").alias("flag"), "total_weight", "weighted_median"))


@query(
    "weighted_median",
    f"""WITH {FLOW}, v AS (SELECT cbo_familia, pay, SUM(CAST(l_quantity AS BIGINT)) AS w FROM f GROUP BY cbo_familia, pay),
    p AS (SELECT *, SUM(w) OVER (PARTITION BY cbo_familia ORDER BY pay) AS cum, SUM(w) OVER (PARTITION BY cbo_familia) AS tot FROM v)
    SELECT cbo_familia, CAST(MAX(tot) AS BIGINT) AS total_weight,
      (MIN(CASE WHEN 2 * cum >= tot THEN pay END) + MIN(CASE WHEN 2 * cum > tot THEN pay END)) / 2 AS weighted_median
    FROM p GROUP BY cbo_familia""",
)
def weighted_median(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "cbo_familia", "quantity")
    return flow_gold.weighted_median(rows, ["cbo_familia"], "salario_mensal", "quantity")


@query(
    "salary_eligibility",
    f"""WITH {FLOW} SELECT uf, kind AS adjustment_kind, COUNT(*) AS rows, COUNT(*) FILTER (elig) AS eligible,
      COUNT(*) FILTER (sgn = 1 AND NOT elig) AS excluded_hires FROM f GROUP BY uf, kind""",
)
def salary_eligibility(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "uf")
    return rows.groupBy("uf", "adjustment_kind").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ELIGIBLE).alias("eligible"),
        F.count_if((F.col("saldo_movimentacao") == 1) & ~F.col(ELIGIBLE)).alias("excluded_hires"),
    )


_INDEX = """idx AS (SELECT strftime(o_orderdate, '%Y%m') AS competence, CAST(COUNT(*) AS DOUBLE) AS v FROM orders GROUP BY ALL),
base AS (SELECT v AS b FROM idx WHERE competence = '199806')"""


def _trend(spark, sf_dir):
    months = flow_gold.overview(binding.flow(spark, sf_dir, "competence"), ["competence"])
    index = binding.price_index(spark, sf_dir)
    return flow_gold.with_real_salary(months, index, binding.BASE_MONTH, "competence")


@query(
    "trend",
    group_ctes("competence") + f""", {_INDEX}
    SELECT competence, admissions, dismissals, balance, salary_mean_admissions, salary_median_admissions,
      round(mean * ((SELECT b FROM base) / v), 6) AS salary_mean_admissions_real,
      round(median * ((SELECT b FROM base) / v), 6) AS salary_median_admissions_real,
      CASE WHEN v IS NOT NULL THEN '199806' END AS salary_real_base_competence
    FROM g LEFT JOIN (SELECT competence, mean, median FROM st) USING (competence) LEFT JOIN idx USING (competence)""",
)
def trend(spark, sf_dir):
    return flow_gold.trend(_trend(spark, sf_dir))


@query(
    "deflated_salary",
    f"""WITH {FLOW}, {_INDEX} SELECT competence, uf, COUNT(*) AS hires, round(SUM(pay * ((SELECT b FROM base) / v)), 4) AS real_pay,
      COUNT(v) AS with_index FROM f LEFT JOIN idx USING (competence) WHERE elig GROUP BY competence, uf""",
)
def deflated_salary(spark, sf_dir):
    """Row-level deflation: pay is summed per month first, so the ratio meets one row per month and state."""
    index = binding.price_index(spark, sf_dir)
    rows = binding.flow(spark, sf_dir, "competence", "uf").where(ELIGIBLE)
    sums = rows.groupBy("competence", "uf").agg(
        F.count(F.lit(1)).alias("hires"), F.sum(F.col("salario_mensal").cast("decimal(18,2)")).alias("pay")
    )
    base = index.where(F.col("month") == binding.BASE_MONTH).select("value").scalar()
    joined = sums.join(index.withColumnRenamed("month", "competence"), "competence", "left")
    real = F.round(deflate(F.col("pay").cast("double"), price_ratio(base, F.col("value"))), 4)
    with_index = F.when(F.col("value").isNotNull(), F.col("hires")).otherwise(F.lit(0))
    return joined.select("competence", "uf", "hires", real.alias("real_pay"), with_index.alias("with_index"))


_POPULATION = """pop AS (SELECT n_name AS uf, COUNT(*) AS p FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
c AS (SELECT uf, """ + COUNTS + """ FROM f GROUP BY uf)"""


def _counts(rows, *by):
    return rows.groupBy(*by).agg(
        F.sum("admissions_delta").cast("bigint").alias("admissions"),
        F.sum("dismissals_delta").cast("bigint").alias("dismissals"),
        F.sum("balance_delta").cast("bigint").alias("balance"),
    )


def _rates(spark, sf_dir):
    by_state = _counts(binding.flow(spark, sf_dir, "uf"), "uf")
    return flow_gold.with_population_rates(by_state, binding.population(spark, sf_dir), 2001, key="uf")


_RATE_COLUMNS = """uf, admissions, dismissals, balance, p AS population_estimate, CAST(2001 AS BIGINT) AS population_reference_year,
      round(admissions * 100000 / p, 4) AS admissions_per_100k, round(dismissals * 100000 / p, 4) AS dismissals_per_100k,
      round(balance * 100000 / p, 4) AS balance_per_100k"""


@query("rates_per_100k", f"WITH {FLOW}, {_POPULATION} SELECT {_RATE_COLUMNS} FROM c LEFT JOIN pop USING (uf)")
def rates_per_100k(spark, sf_dir):
    return _rates(spark, sf_dir)


@query(
    "ranked_rate_topk",
    f"""WITH {FLOW}, {_POPULATION} SELECT * FROM (SELECT {_RATE_COLUMNS} FROM c LEFT JOIN pop USING (uf))
      WHERE admissions_per_100k IS NOT NULL ORDER BY admissions_per_100k DESC, uf LIMIT 10""",
)
def ranked_rate_topk(spark, sf_dir):
    return analytics.rank_municipalities(_rates(spark, sf_dir), "admissions_per_100k", 10, code="uf")


@query(
    "rates_available",
    f"WITH {FLOW}, {_POPULATION} SELECT COUNT(p) > 0 AS normalization_available FROM c LEFT JOIN pop USING (uf)",
)
def rates_available(spark, sf_dir):
    return analytics.rates_available(_rates(spark, sf_dir))


@query(
    "top_states",
    f"WITH {FLOW} SELECT uf, {COUNTS} FROM f GROUP BY uf ORDER BY admissions DESC, uf LIMIT 27",
)
def top_states(spark, sf_dir):
    return analytics.top(_counts(binding.flow(spark, sf_dir, "uf"), "uf"), "admissions", "uf", 27)


@query(
    "top_occupations",
    f"""WITH {FLOW} SELECT cbo_familia, cbo_codigo, {COUNTS} FROM f GROUP BY cbo_familia, cbo_codigo
      ORDER BY admissions DESC, cbo_codigo LIMIT 10""",
)
def top_occupations(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "cbo_familia", "cbo_codigo")
    return analytics.top(_counts(rows, "cbo_familia", "cbo_codigo"), "admissions", "cbo_codigo", 10)


@query(
    "ranked_municipalities_topk",
    f"""WITH {FLOW} SELECT municipio_codigo_caged, {COUNTS} FROM f GROUP BY municipio_codigo_caged
      ORDER BY admissions DESC, municipio_codigo_caged LIMIT 20""",
)
def ranked_municipalities_topk(spark, sf_dir):
    counts = _counts(binding.flow(spark, sf_dir, "municipio_codigo_caged"), "municipio_codigo_caged")
    return analytics.rank_municipalities(counts, "admissions", 20)


@query(
    "rank_within_state",
    f"""WITH {FLOW}, c AS (SELECT uf, cbo_familia, CAST(SUM(bal) AS BIGINT) AS saldo FROM f GROUP BY uf, cbo_familia)
    SELECT uf, cbo_familia, saldo, ROW_NUMBER() OVER (PARTITION BY uf ORDER BY saldo DESC, cbo_familia) AS rank FROM c""",
)
def rank_within_state(spark, sf_dir):
    sums = binding.flow(spark, sf_dir, "uf", "cbo_familia").groupBy("uf", "cbo_familia").agg(
        F.sum("balance_delta").cast("bigint").alias("saldo")
    )
    return analytics.rank_within(sums, "uf", "saldo", "cbo_familia")


# A territory without movements has zero totals, as the sum over an empty list has.
_TERRITORY = ", ".join(
    f"CAST(COALESCE(SUM({short}), 0) AS BIGINT) AS {name}"
    for short, name in (("adm", "admissions"), ("dis", "dismissals"), ("bal", "balance"))
)


@query(
    "territory_comparison",
    f"""WITH {FLOW}, x AS (
      SELECT 'BR' AS key, 'Country' AS label, {_TERRITORY} FROM f
      UNION ALL SELECT 'RG', 'Asia', {_TERRITORY} FROM f WHERE region = 'ASIA'
      UNION ALL SELECT 'ST', 'Nation 2', {_TERRITORY} FROM f WHERE uf = 'NATION_2'),
    m AS (SELECT MAX(admissions) FILTER (key = 'BR') AS br, MAX(admissions) FILTER (key = 'RG') AS rg,
                 MAX(admissions) FILTER (key = 'ST') AS st FROM x)
    SELECT key, label, admissions, dismissals, balance, round(admissions / br, 6) AS share_national_admissions,
      round(st / rg, 6) AS state_share_of_region FROM x, m""",
)
def territory_comparison(spark, sf_dir):
    by_state = _counts(binding.flow(spark, sf_dir, "uf"), "uf")
    asia = [f"NATION_{i}" for i in range(2, 25, 5)]
    labels = {"BR": "Country", "RG": "Asia", "ST": "Nation 2"}
    return analytics.territorial_comparison(by_state, asia, "NATION_2", labels)


@query(
    "quarter_summary",
    f"""WITH {FLOW}, c AS (SELECT competence, {COUNTS} FROM f GROUP BY competence)
    SELECT substr(competence, 1, 4) || 'Q' || CAST(ceil(CAST(substr(competence, 5, 2) AS INT) / 3) AS INT) AS key,
      CAST(ceil(CAST(substr(competence, 5, 2) AS INT) / 3) AS INT) || 'º trimestre de ' || substr(competence, 1, 4) AS label,
      CAST(substr(competence, 1, 4) AS BIGINT) AS year, CAST(ceil(CAST(substr(competence, 5, 2) AS INT) / 3) AS BIGINT) AS quarter,
      CAST(SUM(admissions) AS BIGINT) AS admissions, CAST(SUM(dismissals) AS BIGINT) AS dismissals, CAST(SUM(balance) AS BIGINT) AS balance,
      string_agg(competence, ',' ORDER BY competence) AS competencies, MIN(competence) AS start_competence,
      MAX(competence) AS end_competence, COUNT(*) AS published_months, COUNT(*) = 3 AS complete,
      round(SUM(balance) / COUNT(*), 2) AS average_monthly_balance FROM c GROUP BY ALL""",
)
def quarter_summary(spark, sf_dir):
    months = _counts(binding.flow(spark, sf_dir, "competence"), "competence")
    return analytics.temporal_summary(months).withColumn("competencies", F.array_join("competencies", ","))


@query(
    "cumulative_totals",
    f"""WITH {FLOW} SELECT MIN(competence) AS published_from, MAX(competence) AS published_to,
      COUNT(DISTINCT competence) AS published_months, {COUNTS} FROM f""",
)
def cumulative_totals(spark, sf_dir):
    return analytics.cumulative_totals(_counts(binding.flow(spark, sf_dir, "competence"), "competence"))


_GRID = f"""WITH {FLOW}, fam AS (SELECT 'Brand#' || i AS cbo_familia FROM range(1, 26) t(i)),
    months AS (SELECT DISTINCT competence FROM f), c AS (SELECT competence, cbo_familia, {COUNTS} FROM f GROUP BY ALL),
    grid AS (SELECT competence, cbo_familia, COALESCE(admissions, 0) AS admissions, COALESCE(dismissals, 0) AS dismissals,
      COALESCE(balance, 0) AS balance FROM months CROSS JOIN fam LEFT JOIN c USING (competence, cbo_familia))"""


def _family_months(spark, sf_dir):
    sums = _counts(binding.flow(spark, sf_dir, "competence", "cbo_familia"), "competence", "cbo_familia")
    return analytics.family_months(sums, binding.FAMILIES)


@query("family_trend_zero_filled", f"{_GRID} SELECT * FROM grid")
def family_trend_zero_filled(spark, sf_dir):
    return _family_months(spark, sf_dir)


@query(
    "family_trend",
    f"""{_GRID} SELECT cbo_familia, CAST(SUM(admissions) AS BIGINT) AS admissions, CAST(SUM(dismissals) AS BIGINT) AS dismissals,
      CAST(SUM(balance) AS BIGINT) AS balance, round(SUM(admissions) / (SELECT SUM(admissions) FROM grid), 6) AS share_of_tech_admissions,
      string_agg(competence || ':' || admissions || '/' || dismissals || '/' || balance, ' ' ORDER BY competence) AS monthly
    FROM grid GROUP BY cbo_familia""",
)
def family_trend(spark, sf_dir):
    table = analytics.family_trend(_family_months(spark, sf_dir))
    text = F.transform(
        "monthly",
        lambda m: F.concat(m["competence"], F.lit(":"), m["admissions"], F.lit("/"), m["dismissals"], F.lit("/"), m["balance"]),
    )
    return table.withColumn("monthly", F.array_join(text, " "))


@query(
    "net_negative_guard",
    f"""WITH {FLOW} SELECT cbo_familia, cbo_codigo, competence, {COUNTS} FROM f GROUP BY cbo_familia, cbo_codigo, competence
      HAVING SUM(adm) < 0 OR SUM(dis) < 0""",
)
def net_negative_guard(spark, sf_dir):
    keys = ["cbo_familia", "cbo_codigo", "competence"]
    return flow_gold.negative_groups(_counts(binding.flow(spark, sf_dir, *keys), *keys))


@query(
    "effective_month",
    f"""WITH {FLOW} SELECT kind AS adjustment_kind, CASE WHEN kind = 'FOR' THEN declared WHEN l_quantity < 3 THEN declared
      ELSE competence END AS effective_competence, COUNT(*) AS rows FROM f WHERE kind <> 'MOV' GROUP BY ALL""",
)
def effective_month_counts(spark, sf_dir):
    """Late rows carry only the declared month; small retractions likewise, the others carry the movement month."""
    rows = binding.flow(spark, sf_dir, "competence", "competencia_declarada", "quantity").where("adjustment_kind <> 'MOV'")
    late = (F.col("adjustment_kind") == "FOR") | (F.col("quantity") < 3)
    moved = F.when(~late, F.concat_ws("-", F.substring("competence", 1, 4), F.substring("competence", 5, 2)))
    rows = rows.withColumn("competencia_mov", F.coalesce(moved, F.lit("")))
    month = F.when(
        F.col("adjustment_kind") == "FOR", effective_month(rows.columns, "FOR", "000000")
    ).otherwise(effective_month(rows.columns, "EXC", "000000"))
    return rows.groupBy("adjustment_kind", month.alias("effective_competence")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "rows_with_base",
    f"""WITH {FLOW}, e AS (SELECT CASE WHEN kind = 'MOV' THEN competence ELSE declared END AS effective_competence, * FROM f),
    b AS (SELECT DISTINCT effective_competence FROM e WHERE kind = 'MOV')
    SELECT effective_competence, {COUNTS} FROM e SEMI JOIN b USING (effective_competence) GROUP BY effective_competence""",
)
def rows_with_base(spark, sf_dir):
    rows = binding.flow(spark, sf_dir, "competence", "competencia_declarada")
    base = F.col("adjustment_kind") == "MOV"
    month = F.when(base, F.col("competence")).otherwise(F.col("competencia_declarada"))
    return _counts(flow_gold.rows_with_base(rows.withColumn("effective_competence", month)), "effective_competence")


@query(
    "contributing_month",
    f"""WITH {FLOW} SELECT uf, {COUNTS} FROM f WHERE (kind = 'MOV' AND competence = '199806')
      OR (kind <> 'MOV' AND declared = '199806') GROUP BY uf""",
)
def contributing_month(spark, sf_dir):
    """Gold of one month: its base rows and the adjustments due to it from every file."""
    rows = binding.flow(spark, sf_dir, "competence", "competencia_declarada", "uf")
    base = rows.where((F.col("adjustment_kind") == "MOV") & (F.col("competence") == binding.BASE_MONTH))
    adjustments = [
        rows.where(F.col("adjustment_kind") == kind).withColumn("effective_competence", F.col("competencia_declarada"))
        for kind in ("FOR", "EXC")
    ]
    return _counts(flow_gold.contributing_rows(base, adjustments, binding.BASE_MONTH), "uf")
