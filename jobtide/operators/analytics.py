"""Read-side tables: rankings, comparisons, summaries and the stock-flow context."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError
from jobtide.fixed_values import PUBLISHED_YEAR_RANGE, STATES_OF_REGION
from jobtide.functions.periods import quarter_key, quarter_label, quarter_number
from jobtide.functions.rates import per_100, plain_share
from jobtide.operators.joins import one_sided_keys

COUNTS = ["admissions", "dismissals", "balance"]


def _sums(columns: Iterable[str] = COUNTS) -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns]


# ---------------------------------------------------------------------------------------------------------------
# Rankings. A limit is the feature here; ties are always broken by code.
# ---------------------------------------------------------------------------------------------------------------


def top(table: DataFrame, metric: str, code: str, limit: int) -> DataFrame:
    """First rows by metric. Spark keeps ``limit`` rows per task and merges them; nothing is sorted as a whole."""
    return table.orderBy(F.desc(metric), code).limit(limit)


def rank_municipalities(table: DataFrame, metric: str, limit: int, code: str = "municipio_codigo_caged") -> DataFrame:
    """Ranking by count or by rate. A rate ranking leaves out rows without a rate."""
    if metric not in ("admissions", "admissions_per_100k"):
        raise ValueError(f"unknown ranking metric {metric!r}")
    rows = table.where(F.col(metric).isNotNull()) if metric == "admissions_per_100k" else table
    return top(rows, metric, code, limit)


def rates_available(table: DataFrame) -> DataFrame:
    """Whether any row has a rate."""
    return table.agg(
        F.coalesce(F.bool_or(F.col("admissions_per_100k").isNotNull()), F.lit(False)).alias("normalization_available")
    )


def rank_within(table: DataFrame, group: str, metric: str, code: str) -> DataFrame:
    order = W.partitionBy(group).orderBy(F.desc(metric), code)
    return table.withColumn("rank", F.row_number().over(order))


# ---------------------------------------------------------------------------------------------------------------
# Comparisons and summaries
# ---------------------------------------------------------------------------------------------------------------


def territorial_comparison(
    by_state: DataFrame,
    region_states: Iterable[str] = tuple(STATES_OF_REGION["Nordeste"]),
    state: str = "CE",
    labels: Mapping[str, str] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Country, one region and one state side by side, one row each, with shares of national and regional hires."""
    labels = labels or {"BR": "Brasil", "NE": "Nordeste", "CE": "Ceará"}
    by = by or []
    scopes = [F.lit(True), F.col("uf").isin(list(region_states)), F.col("uf") == state]
    wide = by_state.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(scope, F.col(c))), F.lit(0)).alias(f"{key}_{c}")
            for key, scope in zip(labels, scopes, strict=True)
            for c in COUNTS
        ]
    )
    national, region, single = [F.col(f"{key}_admissions") for key in labels]
    rows = F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.lit(label).alias("label"), *[F.col(f"{key}_{c}").alias(c) for c in COUNTS])
            for key, label in labels.items()
        ]
    )
    long = wide.select(
        *by, national.alias("__national"), plain_share(single, region).alias("state_share_of_region"), F.inline(rows)
    )
    return long.withColumn("share_national_admissions", plain_share(F.col("admissions"), F.col("__national"))).drop(
        "__national"
    )


def temporal_summary(trend: DataFrame, month: str = "competence") -> DataFrame:
    """One row per quarter: sums, first and last month, number of months, completeness, average monthly balance."""
    m = F.col(month)
    quarters = trend.where(F.length(m) == 6).groupBy(
        quarter_key(m).alias("key"),
        quarter_label(m).alias("label"),
        m.substr(1, 4).cast("int").alias("year"),
        quarter_number(m).alias("quarter"),
    ).agg(
        *_sums(),
        F.sort_array(F.collect_list(m)).alias("competencies"),
        F.min(m).alias("start_competence"),
        F.max(m).alias("end_competence"),
        F.count(F.lit(1)).alias("published_months"),
    )
    return quarters.withColumns(
        {
            "complete": F.col("published_months") == 3,
            "average_monthly_balance": F.round(F.col("balance") / F.col("published_months"), 2),
        }
    )


def cumulative_totals(trend: DataFrame, month: str = "competence") -> DataFrame:
    return trend.agg(
        F.min(month).alias("published_from"),
        F.max(month).alias("published_to"),
        F.count(F.lit(1)).alias("published_months"),
        *_sums(),
    )


def family_months(by_occupation: DataFrame, families: Iterable[str], month: str = "competence") -> DataFrame:
    """Month x family table with zeros for families without movement in a month.

    The families are configuration, so the grid is each month exploded by a literal list.
    """
    sums = by_occupation.groupBy(month, "cbo_familia").agg(*_sums())
    months = by_occupation.select(month).distinct()
    grid = months.select(month, F.explode(F.array(*map(F.lit, families))).alias("cbo_familia"))
    joined = grid.join(sums, [month, "cbo_familia"], "left")
    return joined.select(month, "cbo_familia", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])


def family_trend(months: DataFrame, month: str = "competence") -> DataFrame:
    """One row per family: totals, share of all hires and the monthly values as an array in month order.

    ``months`` comes from :func:`family_months`. The array has one entry per published month.
    """
    totals = months.groupBy("cbo_familia").agg(
        *_sums(), F.sort_array(F.collect_list(F.struct(month, *COUNTS))).alias("monthly")
    )
    # One row per configured family: the configuration bounds this window.
    everything = F.sum("admissions").over(W.partitionBy())
    return totals.withColumn("share_of_tech_admissions", plain_share(F.col("admissions"), everything))


def occupation_violations(by_occupation: DataFrame, families: Iterable[str]) -> DataFrame:
    """Rows a family trend must not be built from, with the reason."""
    reason = (
        F.when(~F.coalesce(F.col("cbo_familia").isin(list(families)), F.lit(False)), F.lit("family outside scope"))
        .when((F.col("admissions") < 0) | (F.col("dismissals") < 0), F.lit("negative count"))
        .when(F.col("admissions") - F.col("dismissals") != F.col("balance"), F.lit("inconsistent balance"))
    )
    return by_occupation.withColumn("reason", reason).where("reason is not null")


def require_clean_occupations(by_occupation: DataFrame, families: Iterable[str]) -> None:
    bad = occupation_violations(by_occupation, families).select("reason").limit(1).collect()
    if bad:
        raise ConsistencyError(f"occupation table: {bad[0].reason}")


# ---------------------------------------------------------------------------------------------------------------
# Stock and flow
# ---------------------------------------------------------------------------------------------------------------


def months_after_stock_year(months: DataFrame, stock_year: int, month: str = "competence") -> DataFrame:
    return months.where(F.substring(month, 1, 4) == str(stock_year + 1))


def stock_flow_context(stock: DataFrame, flow: DataFrame, key: str = "cbo_familia") -> DataFrame:
    """Flow per 100 links of the prior stock and the gap between flow and stock composition.

    Both sides have one row per family and list the same families (:func:`require_comparable`), so the totals are
    window sums over the configured families.
    """
    everything = W.partitionBy()
    stock_total, flow_total = F.sum("active_stock").over(everything), F.sum("admissions").over(everything)
    joined = stock.select(key, "active_stock").join(flow.select(key, *COUNTS), key)
    links = F.col("active_stock")
    shares = joined.withColumns(
        {
            "share_of_tech_stock": plain_share(links, stock_total),
            "share_of_tech_admissions": plain_share(F.col("admissions"), flow_total),
        }
    )
    gap = (F.col("share_of_tech_admissions") - F.col("share_of_tech_stock")) * 100
    return shares.withColumns(
        {**{f"{c}_per_100_prior_stock": per_100(F.col(c), links) for c in COUNTS}, "composition_gap_pp": gap}
    )


def stock_flow_totals(context: DataFrame) -> DataFrame:
    totals = context.agg(F.sum("active_stock").alias("active_stock"), *_sums())
    return totals.withColumns({f"{c}_per_100_prior_stock": per_100(F.col(c), F.col("active_stock")) for c in COUNTS})


def require_comparable(stock: DataFrame, flow: DataFrame, key: str = "cbo_familia") -> None:
    """Both sides must list the same families, with positive stock and a consistent accumulated balance."""
    if not one_sided_keys(stock, flow, key).isEmpty():
        raise ConsistencyError("stock and flow do not list the same families")
    if not stock.where("active_stock is null or active_stock <= 0").isEmpty():
        raise ConsistencyError("a family has no stock")
    if not flow.agg(*_sums()).where("admissions - dismissals <> balance").isEmpty():
        raise ConsistencyError("accumulated flow has an inconsistent balance")


def stock_flow_by_code(flow_cube: DataFrame, stock_cube: DataFrame) -> DataFrame:
    """Balance and stock per state and occupation, both summed before they meet."""
    flow = flow_cube.groupBy("uf", "cbo_codigo").agg(F.sum("saldo").alias("saldo"))
    stock = stock_cube.groupBy("uf", "cbo_codigo").agg(F.sum("active_stock").alias("active_stock"))
    return flow.join(stock, ["uf", "cbo_codigo"])


# ---------------------------------------------------------------------------------------------------------------
# What is published
# ---------------------------------------------------------------------------------------------------------------


def published_months(gates: DataFrame) -> DataFrame:
    """Sorted distinct six-digit months whose gate says publishable."""
    rows = gates.where(F.col("publishable") & F.col("competence").rlike(r"^\d{6}$"))
    return rows.select("competence").distinct().orderBy("competence")


def published_years(gates: DataFrame) -> DataFrame:
    first, last = PUBLISHED_YEAR_RANGE
    rows = gates.where(F.col("publishable") & F.col("year").between(first, last))
    return rows.select(F.col("year").cast("int").alias("year")).distinct().orderBy("year")


def published_only(table: DataFrame, published: DataFrame, month: str = "competence") -> DataFrame:
    return table.join(published.select(F.col("competence").alias(month)).distinct(), month, "left_semi")


def release_registry(gates: DataFrame, key: str = "competence", fingerprint: str = "source_sha256") -> DataFrame:
    """One row per gate with a well-formed month or year; missing flags read as false."""
    first, last = PUBLISHED_YEAR_RANGE
    well_formed = F.col(key).rlike(r"^\d{6}$") if key == "competence" else F.col(key).between(first, last)
    flags = [
        F.coalesce(c, F.lit(False)).alias(c)
        for c in ("automatic_checks_passed", "manual_approval_valid", "publishable")
    ]
    return gates.where(well_formed).select(key, *flags, fingerprint).orderBy(key)


def registry_summary(registry: DataFrame, key: str = "competence") -> DataFrame:
    published = F.when(F.col("publishable"), F.col(key))
    return registry.agg(
        F.count(F.lit(1)).alias("releases"), F.count(published).alias("published"), F.max(published).alias("latest")
    )


def published_codes(by_occupation: DataFrame, published: DataFrame, month: str = "competence") -> DataFrame:
    """Distinct six-digit occupation codes of all published months; another code fails the job."""
    digits = F.regexp_replace("cbo_codigo", r"\D", "")
    error = F.raise_error(F.concat(F.lit("invalid published code: "), F.coalesce("cbo_codigo", F.lit("null"))))
    code = F.when(F.length(digits) == 6, digits).otherwise(error.cast("string"))
    return published_only(by_occupation, published, month).select(code.alias("code")).distinct()
