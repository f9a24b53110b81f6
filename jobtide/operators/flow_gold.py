"""Published monthly tables: counts with adjustments, net-weighted salary statistics, price-adjusted pay, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError
from jobtide.fixed_values import RESIDUAL_MUNICIPALITY, RESIDUAL_MUNICIPALITY_NAME, UNIDENTIFIED_STATE
from jobtide.functions.movement import with_base_deltas
from jobtide.functions.rates import deflate, per_100k, price_ratio
from jobtide.functions.salary import ELIGIBLE
from jobtide.operators.joins import evaluate_once
from jobtide.operators.selection import weighted_medians

COUNTS = ["admissions", "dismissals", "balance"]
SALARY = ["salary_mean_admissions", "salary_median_admissions", "salary_eligible_admissions"]
GRAINS = {
    "overview": [],
    "by_uf": ["uf"],
    "by_occupation": ["cbo_familia", "cbo_codigo"],
    "by_municipality": ["municipio_codigo_caged"],
}
_PAY = "__pay"


# ---------------------------------------------------------------------------------------------------------------
# Rows that contribute to a month
# ---------------------------------------------------------------------------------------------------------------


def contributing_rows(base: DataFrame, adjustments: list[DataFrame], month: str) -> DataFrame:
    """Base rows of a month plus every adjustment whose effective month it is, whatever month brought it.

    Frames without an effective month are left out. Missing columns are null; types widen to the base's.
    """
    out = with_base_deltas(base, month)
    for frame in adjustments:
        if "effective_competence" in frame.columns:
            due = frame.where(F.col("effective_competence").cast("string") == month)
            out = out.unionByName(due, allowMissingColumns=True)
    return out


def rows_with_base(silver: DataFrame, base_months: DataFrame | None = None) -> DataFrame:
    """All months at once: adjustments count only for months whose base (MOV) file is present.

    ``base_months`` lists those months as ``effective_competence``; without it they are the months of the base rows.
    """
    if base_months is None:
        base_months = silver.where("adjustment_kind = 'MOV'").select("effective_competence")
    return silver.join(base_months.select("effective_competence").distinct(), "effective_competence", "left_semi")


# ---------------------------------------------------------------------------------------------------------------
# Counts and net-weighted salary statistics
# ---------------------------------------------------------------------------------------------------------------


def _delta_sums() -> list[Column]:
    return [
        F.sum("admissions_delta").cast("bigint").alias("admissions"),
        F.sum("dismissals_delta").cast("bigint").alias("dismissals"),
        F.sum("balance_delta").cast("bigint").alias("balance"),
        F.count(F.lit(1)).alias("records"),
    ]


def _with_pay(flow: DataFrame) -> DataFrame:
    counted = F.col(ELIGIBLE) & (F.col("admissions_delta") != 0)
    return flow.withColumn(_PAY, F.when(counted, F.col("salario_mensal")))


def _statistics(per_salary: DataFrame, by: list[str]) -> DataFrame:
    """Counts and salary statistics from rows already summed per group and exact salary.

    The hire deltas of one exact salary are netted before weights that are not positive are dropped. The median is selected by
    buckets (``weighted_medians``); counts and means are plain sums. Mean sums are decimal, hence equal on every run.
    """
    weight = F.when(F.col(_PAY).isNotNull() & (F.col("admissions") > 0), F.col("admissions"))
    # The boundary keeps the rows one shuffle that counts, histogram and open buckets all read.
    rows = evaluate_once(per_salary.withColumn("__w", weight))
    medians = weighted_medians(rows, by, _PAY, "__w").select(*by, F.col("median").alias("__median"))
    return rows.unionByName(medians, allowMissingColumns=True).groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in [*COUNTS, "records"]],
        _mean(F.col(_PAY), F.col("__w")).alias("salary_mean_admissions"),
        F.max("__median").alias("salary_median_admissions"),
        F.coalesce(F.sum("__w"), F.lit(0)).alias("salary_eligible_admissions"),
    )


def _mean(value: Column, weight: Column) -> Column:
    product = value.cast("decimal(20,6)") * weight.cast("decimal(14,0)")
    return F.sum(product).cast("double") / F.sum(weight)


def group_table(flow: DataFrame, by: list[str]) -> DataFrame:
    """Hires, terminations, balance and salary statistics per group.

    Rows are first summed per group and exact salary with map-side partial sums, so a group that holds a third of
    all rows reaches the second step as one row per distinct salary.
    """
    return _statistics(_with_pay(flow).groupBy(*by, _PAY).agg(*_delta_sums()), by)


def group_tables(flow: DataFrame, grains: dict[str, list[str]] = GRAINS, common: list[str] | None = None) -> DataFrame:
    """Several groupings in one scan (grouping sets). ``grain`` names the grouping; keys outside it are null.

    ``common`` keys, for example the month, belong to every grouping.
    """
    common = common or []
    keys = [*common, *dict.fromkeys(k for cols in grains.values() for k in cols)]
    sets = {name: [*common, *cols] for name, cols in grains.items()}
    ids = {sum(1 << (len(keys) - i) for i, k in enumerate(keys) if k not in cols): name for name, cols in sets.items()}
    per_salary = _with_pay(flow).groupingSets([[*cols, _PAY] for cols in sets.values()], *keys, _PAY).agg(
        F.grouping_id().alias("__gid"), *_delta_sums()
    )
    grain = F.lit(None).cast("string")
    for gid, name in ids.items():
        grain = F.when(F.col("__gid") == gid, F.lit(name)).otherwise(grain)
    return _statistics(per_salary.withColumn("grain", grain), ["grain", *keys])


def grain_of(tables: DataFrame, name: str, common: list[str] | None = None, grains=GRAINS) -> DataFrame:
    """One grouping out of :func:`group_tables`."""
    used = [*(common or []), *grains[name]]
    unused = {k for cols in grains.values() for k in cols} - set(used)
    return tables.where(F.col("grain") == name).drop("grain", *unused)


def overview(flow: DataFrame, by: list[str]) -> DataFrame:
    """Totals per month (or for everything, with ``by=[]``) with the number of hires outside the salary rule."""
    table = group_table(flow, by)
    return table.withColumn(
        "salary_excluded_admissions", F.col("admissions") - F.col("salary_eligible_admissions")
    ).withColumnRenamed("records", "records_tech")


def weighted_median(df: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """Weighted median per group of whole-number weights. Weights are netted per value; only positive ones count."""
    netted = evaluate_once(df.groupBy(*by, F.col(value).cast("double").alias("__value")).agg(F.sum(weight).alias("__weight")))
    return weighted_medians(netted, by, "__value", "__weight").withColumnRenamed("median", "weighted_median")


# ---------------------------------------------------------------------------------------------------------------
# Other cubes
# ---------------------------------------------------------------------------------------------------------------


def market_cube(flow: DataFrame, month: str = "effective_competence") -> DataFrame:
    return flow.groupBy("uf", "cbo_familia", "cbo_codigo", F.col(month).alias("competencia")).agg(
        F.sum("admissions_delta").cast("bigint").alias("admissoes"),
        F.sum("dismissals_delta").cast("bigint").alias("desligamentos"),
        F.sum("balance_delta").cast("bigint").alias("saldo"),
    )


def adjustment_breakdown(flow: DataFrame, by: list[str] | None = None) -> DataFrame:
    return flow.groupBy(*(by or []), "adjustment_kind").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("admissions_delta", "dismissals_delta", "balance_delta")],
    )


def cube_by(cube: DataFrame, by: list[str]) -> DataFrame:
    return cube.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("admissoes", "desligamentos", "saldo")])


# ---------------------------------------------------------------------------------------------------------------
# Guards
# ---------------------------------------------------------------------------------------------------------------


def negative_groups(table: DataFrame) -> DataFrame:
    return table.where("admissions < 0 or dismissals < 0")


def require_no_negative_groups(table: DataFrame, label: str = "gold") -> None:
    if not negative_groups(table).isEmpty():
        raise ConsistencyError(f"{label}: adjustments made a count negative; a base month may be missing")


def require_balanced(table: DataFrame, label: str = "gold") -> None:
    if not table.where("admissions - dismissals <> balance").isEmpty():
        raise ConsistencyError(f"{label}: hires minus terminations is not the balance")


# ---------------------------------------------------------------------------------------------------------------
# Price adjustment, municipality names, population rates
# ---------------------------------------------------------------------------------------------------------------


def with_real_salary(table: DataFrame, index: DataFrame, base_month: str, month: str) -> DataFrame:
    """Mean and median pay in prices of the base month; null where the month or the base is not in the index."""
    base = index.where(F.col("month") == base_month).select("value").scalar()
    ratios = index.select(F.col("month").alias(month), price_ratio(base, F.col("value")).alias("__ratio"))
    joined = table.join(ratios, month, "left")
    ratio = F.col("__ratio")
    return joined.withColumns(
        {
            "salary_mean_admissions_real": deflate(F.col("salary_mean_admissions"), ratio),
            "salary_median_admissions_real": deflate(F.col("salary_median_admissions"), ratio),
            "salary_real_base_competence": F.when(ratio.isNotNull(), F.lit(base_month)),
        }
    ).drop("__ratio")


def with_municipality(table: DataFrame, dimension: DataFrame, code: str = "municipio_codigo_caged") -> DataFrame:
    """Seven-digit code, name and state of each municipality. The residual is labelled; unknown codes stay null."""
    joined = table.join(dimension.withColumnRenamed("prefix", code), code, "left")
    residual = F.col(code) == RESIDUAL_MUNICIPALITY
    return joined.withColumns(
        {
            "municipio_codigo_ibge": F.when(~residual, F.col("municipio_codigo_ibge")),
            "municipio_nome": F.when(residual, F.lit(RESIDUAL_MUNICIPALITY_NAME)).otherwise(F.col("municipio_nome")),
            "uf": F.when(residual, F.lit(UNIDENTIFIED_STATE)).otherwise(F.col("uf")),
        }
    )


def with_population_rates(
    table: DataFrame, population: DataFrame, reference_year: int | None = None, key: str = "municipio_codigo_ibge"
) -> DataFrame:
    """Population and rates per 100 000. Rows without a positive population keep null rates.

    ``table`` is already aggregated to one row per place, so the look-up never meets a hot key.
    """
    people = population.select(key, F.when(F.col("population") > 0, F.col("population")).alias("population_estimate"))
    joined = table.join(people, key, "left").withColumn("population_reference_year", F.lit(reference_year).cast("int"))
    rates = {f"{name}_per_100k": per_100k(F.col(name), F.col("population_estimate")) for name in COUNTS}
    return joined.withColumns(rates)


def trend(overviews: DataFrame, month: str = "competence") -> DataFrame:
    """One row per month with the headline columns that are present, in month order."""
    wanted = [
        month, *COUNTS, "salary_mean_admissions", "salary_median_admissions", "salary_mean_admissions_real",
        "salary_median_admissions_real", "salary_real_base_competence",
    ]
    rows = overviews.where(F.length(month) == 6)
    return rows.select(*[c for c in wanted if c in rows.columns]).orderBy(month)
