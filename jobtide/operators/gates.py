"""Publication gates. All months, or years, are judged in one plan: inputs are small published tables keyed by month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import (
    EXPECTED_PARTS_BY_YEAR,
    MINIMUM_VALID_RATE,
    RESIDUAL_MUNICIPALITY,
    RESIDUAL_MUNICIPALITY_NAME,
    UNIDENTIFIED_STATE,
)
from jobtide.functions.rates import per_100k
from jobtide.operators.checks import check, check_rows

_RATES = ["admissions", "dismissals", "balance"]
_MONTHLY_ARTIFACTS = {
    "quality_report": "quality", "overview": "overview", "gold_market": "market",
    "national_mov_audit": "audit", "municipality_gold": "municipality",
}


def municipality_facts(items: DataFrame, month: str = "competence") -> DataFrame:
    """Per month: is every item identified, and do population and rates hold when recomputed?"""
    residual = F.col("municipio_codigo_caged") == RESIDUAL_MUNICIPALITY
    labelled = (F.col("municipio_nome") == RESIDUAL_MUNICIPALITY_NAME) & (F.col("uf") == UNIDENTIFIED_STATE)
    identified = (
        (F.col("municipio_codigo_caged") != "")
        & (F.col("municipio_nome") != "")
        & (F.length("uf") == 2)
        & (F.length("municipio_codigo_ibge") == 7)
    )
    facts = [
        F.bool_and(F.coalesce(F.when(residual, labelled).otherwise(identified), F.lit(False))).alias("dimension_ok"),
        F.count(F.lit(1)).alias("items"),
        F.count_if(residual).alias("residual_items"),
    ]
    if "population_estimate" in items.columns:
        people = F.col("population_estimate")
        rates_hold = reduce(
            lambda a, b: a & b,
            [F.col(f"{c}_per_100k").eqNullSafe(per_100k(F.col(c), people)) for c in _RATES],
        )
        no_rates = people.isNull() & reduce(lambda a, b: a & b, [F.col(f"{c}_per_100k").isNull() for c in _RATES])
        covered = F.when(residual, no_rates).otherwise((people > 0) & rates_hold)
        facts += [
            F.bool_and(F.coalesce(covered, F.lit(False))).alias("coverage_ok"),
            F.min(F.when(~residual, F.col("population_reference_year"))).alias("item_year_min"),
            F.max(F.when(~residual, F.col("population_reference_year"))).alias("item_year_max"),
        ]
    return items.groupBy(month).agg(*facts)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Columns under ``prefix_`` plus a presence mark, to left join on the month."""
    renamed = df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c != "competence"})
    return renamed.withColumn(f"has_{prefix}", F.lit(True))


def monthly_gate(
    months: DataFrame,
    *,
    quality: DataFrame,
    overview: DataFrame,
    market: DataFrame,
    audit: DataFrame,
    municipality: DataFrame,
    manifests: DataFrame,
    official: DataFrame,
    approvals: DataFrame,
    population_header: DataFrame | None = None,
    enrichment: DataFrame | None = None,
    minimum_valid_rate: float = MINIMUM_VALID_RATE,
) -> DataFrame:
    """Checks of every month in ``months``.

    All inputs are keyed by ``competence``; a missing row means the artifact is missing. ``municipality`` comes from
    :func:`municipality_facts`. ``official`` has admissoes, desligamentos, saldo, optional ni_admissoes,
    ni_desligamentos, ni_saldo, and reference_sha256. ``approvals`` has approved, source_sha256, reference_sha256.
    """
    inputs = {
        "quality": quality, "overview": overview, "market": market.select("competence").distinct(), "audit": audit,
        "municipality": municipality, "manifest": manifests, "official": official, "approval": approvals,
    }
    if population_header is not None:
        inputs["population"] = population_header
        empty = "competence string, coverage_complete boolean, population_year int, population_cache_sha256 string, "
        empty += "municipality_artifact_sha256 string, matched_population bigint, missing_population bigint"
        inputs["enrichment"] = (
            enrichment if enrichment is not None else months.sparkSession.createDataFrame([], empty)
        )
    facts = months
    for prefix, df in inputs.items():
        facts = facts.join(_prefixed(df, prefix), "competence", "left")

    has = lambda name: F.coalesce(F.col(f"has_{name}"), F.lit(False))
    c = F.col
    checks = [check(name, has(table), f"artifact {table}") for name, table in _MONTHLY_ARTIFACTS.items()]
    checks.append(check("mov_provenance", F.coalesce(c("manifest_sha256"), F.lit("")) != "", "base file has a SHA-256"))

    counts_ok = (
        (c("quality_rows_read") > 0)
        & c("quality_rows_valid").between(F.lit(0), c("quality_rows_read"))
        & c("quality_rows_rejected").between(F.lit(0), c("quality_rows_read"))
    )
    rate_ok = F.coalesce(c("quality_valid_rate"), F.lit(0.0)) >= minimum_valid_rate
    balanced = c("overview_admissions") - c("overview_dismissals") == c("overview_balance")
    checks += [
        check("quality_competence", has("quality"), "quality report is for this month", has("quality")),
        check("quality_counts", counts_ok, "row counts are coherent", has("quality")),
        check("valid_rate", rate_ok, f"valid rate is at least {minimum_valid_rate:.2%}", has("quality")),
        check("overview_competence", has("overview"), "overview is for this month", has("overview")),
        check("overview_arithmetic", balanced, "hires minus terminations is the balance", has("overview")),
        check(
            "municipality_dimension_quality", c("municipality_dimension_ok"), "municipalities are identified",
            has("municipality"),
        ),
    ]
    if population_header is not None:
        checks += _population_checks(has)

    ref = has("official")
    reference_ok = c("official_admissoes") - c("official_desligamentos") == c("official_saldo")
    national = (
        (c("audit_admissions") == c("official_admissoes"))
        & (c("audit_dismissals") == c("official_desligamentos"))
        & (c("audit_balance") == c("official_saldo"))
    )
    checks += [
        check("official_reference_available", F.lit(False), "no official total for the month", ~ref),
        check("official_reference_integrity", reference_ok, "official total is consistent", ref),
        check("national_reference_reconciliation", national, "national totals equal the official ones", ref & has("audit")),
    ]
    if "ni_admissoes" in official.columns:
        unidentified = (
            (c("audit_non_identified_admissions") == F.coalesce(c("official_ni_admissoes"), F.lit(0)))
            & (c("audit_non_identified_dismissals") == F.coalesce(c("official_ni_desligamentos"), F.lit(0)))
            & (c("audit_non_identified_balance") == F.coalesce(c("official_ni_saldo"), F.lit(0)))
        )
        applies = ref & has("audit") & c("official_ni_admissoes").isNotNull()
        checks.append(
            check("non_identified_reconciliation", unidentified, "not-identified totals equal the official ones", applies)
        )
    approved = (
        c("approval_approved")
        & (c("approval_source_sha256") == c("manifest_sha256"))
        & (c("approval_reference_sha256") == c("official_reference_sha256"))
    )
    checks.append(check("manual_methodology_approval", approved, "review is bound to the current source and total"))
    return check_rows(facts, ["competence"], checks)


def _population_checks(has) -> list[Column]:
    c = F.col
    year = c("population_reference_year")
    metadata = (
        (year >= 2000)
        & (c("population_reference_date") == F.concat(year.cast("string"), F.lit("-07-01")))
        & c("population_source_url").startswith("https://")
        & (F.length("population_published_at") == 10)
        & (F.length("population_cache_sha256") == 64)
        & (c("population_enrichment_status") == "complete")
    )
    identified = c("municipality_items") - c("municipality_residual_items")
    coverage = (
        c("municipality_dimension_ok")
        & c("municipality_coverage_ok")
        & c("municipality_item_year_min").eqNullSafe(year)
        & c("municipality_item_year_max").eqNullSafe(year)
    )
    report = (
        c("enrichment_coverage_complete")
        & (c("enrichment_population_year") == year)
        & (c("enrichment_population_cache_sha256") == c("population_cache_sha256"))
        & (c("enrichment_municipality_artifact_sha256") == c("population_artifact_sha256"))
        & (c("enrichment_matched_population") == identified)
        & (c("enrichment_missing_population") == 0)
    )
    applies = has("municipality") & (F.coalesce(c("population_source"), F.lit("")) != "")
    return [
        check("municipality_population_metadata", metadata, "population reference is documented", applies),
        check("municipality_population_coverage", coverage, "population and rates hold for every municipality", applies),
        check("municipality_population_report", report, "enrichment report agrees with the table", applies),
    ]


def approval_record(
    key: str, value: str, reviewer: str, notes: str, hashes: DataFrame, at: Column | None = None
) -> DataFrame:
    """Approval row bound to the hashes in force now; empty when they are not known, so nothing can be approved blind."""
    known = hashes.where(F.col(key) == value)
    for name in [c for c in hashes.columns if c != key]:
        known = known.where(F.coalesce(F.col(name), F.lit("")) != "")
    return known.select(
        "*",
        F.lit(True).alias("approved"),
        F.lit(reviewer).alias("reviewer"),
        F.lit(notes).alias("notes"),
        (at if at is not None else F.current_timestamp()).alias("approved_at_utc"),
    )


def current_approvals(approvals: DataFrame, key: str) -> DataFrame:
    """Latest approval per key of an append-only approvals table."""
    fields = [c for c in approvals.columns if c != key]
    newest = F.max_by(F.struct(*fields), "approved_at_utc").alias("a")
    return approvals.groupBy(key).agg(newest).select(key, "a.*")


# ---------------------------------------------------------------------------------------------------------------
# Annual
# ---------------------------------------------------------------------------------------------------------------


def annual_reconciliation(counters: DataFrame, official: DataFrame) -> DataFrame:
    """Observed stock of each year against its official total. ``counters`` is the national report with ``year``."""
    joined = counters.join(official.select("year", F.col("active_links").alias("expected_active")), "year", "left")
    observed = F.col("rows_stock_eligible_source")
    reconciled = (
        F.col("source_partition_complete")
        & F.col("stock_partition_complete")
        & (F.col("rows_unknown_status_source") == 0)
        & (F.col("rows_unknown_abandoned_source") == 0)
        & (F.col("rows_year_mismatch_source") == 0)
        & (F.col("expected_active") > 0)
        & (observed == F.col("expected_active"))
        & F.col("rows_tech").between(F.lit(0), observed)
    )
    return joined.select(
        "year",
        "expected_active",
        observed.alias("observed_active"),
        F.col("rows_active_source").alias("raw_active_source"),
        F.col("rows_abandoned_source").alias("abandoned_active_source"),
        (observed - F.col("expected_active")).alias("difference"),
        "source_partition_complete",
        "stock_partition_complete",
        F.col("rows_unknown_status_source").alias("unknown_status_rows"),
        F.col("rows_unknown_abandoned_source").alias("unknown_abandoned_rows"),
        F.col("rows_year_mismatch_source").alias("year_mismatch_rows"),
        F.col("rows_tech").alias("tech_rows"),
        F.coalesce(reconciled, F.lit(False)).alias("reconciled"),
    ).withColumn("gold_ready", F.col("reconciled"))


def regional_reconciliation(parts: DataFrame, expected: DataFrame, key: str = "archive") -> DataFrame:
    """Each regional part against its official stock; a part on one side only is kept and does not match."""
    joined = expected.select(key, "expected_stock").join(parts, key, "full_outer")
    observed = F.col("rows_stock_eligible_source")
    whole = (
        (
            F.col("rows_active_source")
            == observed + F.col("rows_abandoned_source") + F.col("rows_unknown_abandoned_source")
        )
        & (F.col("rows_unknown_abandoned_source") == 0)
        & (F.col("rows_unknown_status_source") == 0)
        & (F.col("rows_rejected") == 0)
    )
    difference = observed - F.col("expected_stock")
    return joined.select(
        key,
        "expected_stock",
        observed.alias("observed_stock"),
        F.col("rows_active_source").alias("raw_active"),
        F.col("rows_abandoned_source").alias("abandoned_active"),
        difference.alias("difference"),
        F.coalesce(whole & (difference == 0), F.lit(False)).alias("matched"),
    )


def regional_summary(checks: DataFrame, national_active: int | Column) -> DataFrame:
    national = national_active if isinstance(national_active, Column) else F.lit(national_active)
    summary = checks.agg(
        F.coalesce(F.sum("observed_stock"), F.lit(0)).alias("observed_national_stock"),
        F.count(F.lit(1)).alias("group_count"),
        F.coalesce(F.bool_and("matched"), F.lit(False)).alias("__all"),
    ).withColumn("expected_national_stock", national)
    difference = F.col("observed_national_stock") - F.col("expected_national_stock")
    return summary.withColumn("difference", difference).withColumn(
        "regional_reconciled", F.col("__all") & (F.col("difference") == 0)
    ).drop("__all")


def annual_gate(facts: DataFrame) -> DataFrame:
    """Checks per year from one row of facts per year (a null column means the artifact is missing).

    Facts: source_hashes (array), the reconciliation fields reconciled, gold_ready, difference, expected_active; the
    regional fields regional_reconciled, regional_difference, regional_groups; municipality_ready, unmatched_codes,
    uf_mismatch_rows; the overview fields active_stock_tech, active_stock_national_reference, publication_ready; the
    totals uf_total, family_total, municipality_total, market_total; release_sha256; approval_approved,
    approval_release_sha256.
    """
    c = F.col
    sources = F.size(F.filter("source_hashes", lambda h: h.rlike("^[0-9a-fA-F]{64}$")))
    parts = reduce(
        lambda col, item: F.when(c("year") == item[0], sources == item[1]).otherwise(col),
        EXPECTED_PARTS_BY_YEAR.items(),
        sources > 0,
    )
    groups = reduce(
        lambda col, item: F.when(c("year") == item[0], c("regional_groups") == item[1]).otherwise(col),
        EXPECTED_PARTS_BY_YEAR.items(),
        F.lit(True),
    )
    present = {
        "reconciliation": c("reconciled"), "regional_reconciliation": c("regional_reconciled"),
        "municipality_validation": c("municipality_ready"), "overview": c("active_stock_tech"), "by_uf": c("uf_total"),
        "by_cbo_family": c("family_total"), "by_municipality": c("municipality_total"), "market": c("market_total"),
    }
    stock = c("active_stock_tech")
    stock_ok = (
        (stock >= 0)
        & (c("active_stock_national_reference") > 0)
        & (c("active_stock_national_reference") == c("expected_active"))
        & (stock <= c("active_stock_national_reference"))
    )
    totals = {
        "uf_total": c("uf_total"), "cbo_family_total": c("family_total"),
        "municipality_total": c("municipality_total"), "market_total": c("market_total"),
    }
    fingerprint = F.coalesce(c("release_sha256"), F.lit(""))
    checks = [
        check("source_provenance", parts, "all source files have a SHA-256"),
        *[check(f"artifact_{name}", col.isNotNull(), f"artifact {name}") for name, col in present.items()],
        check(
            "exact_national_reconciliation", c("reconciled") & c("gold_ready") & (c("difference") == 0),
            "national stock equals the official total", c("reconciled").isNotNull(),
        ),
        check(
            "exact_regional_reconciliation", c("regional_reconciled") & (c("regional_difference") == 0) & groups,
            "regional stocks equal the official totals", c("regional_reconciled").isNotNull(),
        ),
        check(
            "municipality_dimension",
            c("municipality_ready") & (c("unmatched_codes") == 0) & (c("uf_mismatch_rows") == 0),
            "municipality codes are official", c("municipality_ready").isNotNull(),
        ),
        check("overview_year", stock.isNotNull(), "overview is for this year", stock.isNotNull()),
        check("overview_stock_integrity", stock_ok, "overview agrees with the reconciliation", stock.isNotNull()),
        check(
            "pre_gate_publication_block", ~c("publication_ready"), "tables are blocked before the gate", stock.isNotNull()
        ),
        *[
            check(name, col == stock, f"{name} equals the stock", col.isNotNull() & stock.isNotNull())
            for name, col in totals.items()
        ],
        check("release_fingerprint", fingerprint != "", "release has a fingerprint"),
        check(
            "manual_methodology_approval",
            c("approval_approved") & (fingerprint != "") & (c("approval_release_sha256") == fingerprint),
            "review is bound to the current fingerprint",
        ),
    ]
    return check_rows(facts, ["year"], checks)
