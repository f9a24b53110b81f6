"""Serving tables and population enrichment of published months."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, NotApprovedError
from jobtide.fixed_values import POPULATION_MINIMUM_ENTRIES, RESIDUAL_MUNICIPALITY, TOLERATED_BEFORE_ENRICHMENT
from jobtide.functions.periods import month_start
from jobtide.operators.flow_gold import with_population_rates
from jobtide.sources.releases import publish
from jobtide.sources.tables import replace_partitions, require_row_counts

COUNTS = ["admissions", "dismissals", "balance"]
# Column types of the serving tables.
SERVING_TYPES = {
    **{c: "bigint" for c in [*COUNTS, "records_tech", "population_estimate"]},
    "population_reference_year": "int",
    "salary_mean_admissions": "decimal(14,2)",
    "salary_median_admissions": "decimal(14,2)",
    "salary_mean_admissions_real": "decimal(14,2)",
    "salary_median_admissions_real": "decimal(14,2)",
    "admissions_per_100k": "decimal(14,4)",
    "dismissals_per_100k": "decimal(14,4)",
    "balance_per_100k": "decimal(14,4)",
    "valid_rate": "decimal(8,6)",
}
SERVING_TABLES = ["dataset_release", "market_uf", "market_occupation", "market_municipality"]


@dataclass(frozen=True)
class ServingTables:
    release: DataFrame
    uf: DataFrame
    occupation: DataFrame
    municipality: DataFrame


def metric_problem(extra: Column | None = None) -> Column:
    """Reason a metric row is not servable, or null."""
    negative = (F.col("admissions") < 0) | (F.col("dismissals") < 0)
    missing = F.col("admissions").isNull() | F.col("dismissals").isNull() | F.col("balance").isNull()
    base = (
        F.when(month_start(F.col("competence")).isNull(), F.lit("invalid month"))
        .when(missing, F.lit("missing count"))
        .when(negative, F.lit("negative count"))
        .when(F.col("admissions") - F.col("dismissals") != F.col("balance"), F.lit("inconsistent balance"))
    )
    return F.coalesce(base, extra) if extra is not None else base


def state_problem() -> Column:
    return metric_problem(F.when(~F.coalesce(F.length("uf") == 2, F.lit(False)), F.lit("invalid state")))


def occupation_problem() -> Column:
    ok = F.col("cbo_familia").rlike(r"^\d{4}$") & F.col("cbo_codigo").rlike(r"^\d+$")
    return metric_problem(F.when(~F.coalesce(ok, F.lit(False)), F.lit("invalid occupation code")))


def municipality_problem() -> Column:
    ok = F.col("municipio_codigo_caged").rlike(r"^\d+$")
    return metric_problem(F.when(~F.coalesce(ok, F.lit(False)), F.lit("invalid municipality code")))


def release_problem() -> Column:
    ok = F.coalesce(F.col("source_sha256").rlike("^[0-9a-fA-F]{64}$"), F.lit(False))
    return metric_problem(F.when(~ok, F.lit("invalid source hash")))


def _serve(table: DataFrame, problem: Column, columns: dict[str, str]) -> DataFrame:
    """Cast and rename to the serving layout; an invalid row fails the job that reads it."""
    stop = F.raise_error(F.concat(F.col("__problem"), F.lit(" in "), F.col("competence"))).cast("date")
    date = F.when(F.col("__problem").isNull(), month_start(F.col("competence"))).otherwise(stop)
    picked = [
        (F.col(old).try_cast(SERVING_TYPES[old]) if old in SERVING_TYPES else F.col(old)).alias(new)
        for old, new in columns.items()
        if old in table.columns
    ]
    return table.withColumn("__problem", problem).select(date.alias("competence"), *picked)


_METRICS = {
    c: c
    for c in [
        *COUNTS, "salary_mean_admissions", "salary_median_admissions", "salary_mean_admissions_real",
        "salary_median_admissions_real",
    ]
}


def serving_release(overview: DataFrame, quality: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row per month. ``quality`` gives (competence, valid_rate), ``manifests`` (competence, sha256)."""
    release = overview.join(quality.select("competence", "valid_rate"), "competence", "left").join(
        manifests.select("competence", F.col("sha256").alias("source_sha256")), "competence", "left"
    )
    release = release.withColumns({"publishable": F.lit(True), "valid_rate": F.coalesce("valid_rate", F.lit(0.0))})
    others = ["source_sha256", "publishable", "records_tech", "salary_real_base_competence", "valid_rate"]
    return _serve(release, release_problem(), {**{c: c for c in others}, **_METRICS})


def serving_states(by_uf: DataFrame) -> DataFrame:
    return _serve(by_uf.withColumn("uf", F.upper("uf")), state_problem(), {"uf": "uf", **_METRICS})


def serving_occupations(by_occupation: DataFrame) -> DataFrame:
    names = {"cbo_familia": "cbo_family", "cbo_codigo": "cbo_code"}
    return _serve(by_occupation, occupation_problem(), {**names, **_METRICS})


def serving_municipalities(by_municipality: DataFrame) -> DataFrame:
    names = {
        "municipio_codigo_caged": "municipality_code", "municipio_codigo_ibge": "municipality_ibge_code",
        "municipio_nome": "municipality_name", "uf": "uf",
    }
    places = ["population_estimate", "population_reference_year", *[f"{c}_per_100k" for c in COUNTS]]
    return _serve(by_municipality, municipality_problem(), {**names, **_METRICS, **{c: c for c in places}})


def require_approved(release: DataFrame, gates: DataFrame) -> None:
    """Every month of a release needs a publishable gate."""
    allowed = gates.where("publishable").select(month_start(F.col("competence")).alias("competence")).distinct()
    blocked = release.select("competence").join(allowed, "competence", "left_anti").limit(1).collect()
    if blocked:
        raise NotApprovedError(f"{blocked[0].competence:%Y%m} is not approved for serving")


def load_serving(spark: SparkSession, tables: ServingTables, root: str, gates: DataFrame) -> None:
    """Load the months whose gate is publishable, replacing them table by table, and compare the stored row counts.

    A month in the tables without a publishable gate is an error, before anything is written. Readers that must never see months of two
    loads use :func:`load_release`.
    """
    require_approved(tables.release, gates)
    frames = [tables.release, tables.uf, tables.occupation, tables.municipality]
    for name, frame in zip(SERVING_TABLES, frames, strict=True):
        months = tables.release.select("competence").distinct()
        replace_partitions(frame, f"{root}/{name}", ["competence"], months)
        require_row_counts(spark, f"{root}/{name}", frame, "competence", months)


def load_release(spark: SparkSession, tables: ServingTables, root: str, gates: DataFrame) -> int:
    """Load the months of ``tables.release`` into all four tables at once: readers see the old release until the new one is complete, and keep it if
    the load fails. Months without a publishable gate, and invalid rows, stop the load. Returns the number of the release."""
    require_approved(tables.release, gates)
    frames = [tables.release, tables.uf, tables.occupation, tables.municipality]
    # One row per month; a month twice would be two releases of one month.
    months = [str(r.competence) for r in tables.release.select("competence").collect()]
    if len(set(months)) != len(months):
        raise ConsistencyError("a month has two release rows")
    return publish(spark, root, dict(zip(SERVING_TABLES, frames, strict=True)), months)


def latest_release(release: DataFrame) -> DataFrame:
    """The newest publishable release, as one row."""
    rows = release.where("publishable")
    fields = [c for c in rows.columns if c != "competence"]
    newest = rows.agg(F.max_by(F.struct("competence", *fields), "competence").alias("r"))
    return newest.where("r is not null").select("r.*")


def rows_of_latest(facts: DataFrame, release: DataFrame) -> DataFrame:
    """Fact rows of the newest publishable month. The month is a scalar subquery, so it prunes partitions."""
    month = release.where("publishable").agg(F.max("competence")).scalar()
    return facts.where(F.col("competence") == month)


# ---------------------------------------------------------------------------------------------------------------
# Population enrichment of a published table
# ---------------------------------------------------------------------------------------------------------------


def enrichment_blockers(gates: DataFrame, checks: DataFrame, allow_candidate: bool = False) -> DataFrame:
    """Per gate, the reason population may not be added, null if it may.

    A published month may always be enriched. A candidate may when its only blocking failures are the three that
    enrichment itself, or the later approval, resolves.
    """
    unexpected = checks.where(
        F.coalesce("blocking", F.lit(True))
        & ~F.coalesce("passed", F.lit(False))
        & ~F.coalesce("id", F.lit("")).isin(TOLERATED_BEFORE_ENRICHMENT)
    )
    failures = unexpected.groupBy("competence").agg(F.sort_array(F.collect_set("id")).alias("unexpected"))
    joined = gates.select("competence", "publishable").join(failures, "competence", "left")
    reason = F.when(F.col("publishable"), F.lit(None).cast("string"))
    if allow_candidate:
        reason = reason.when(
            F.col("unexpected").isNotNull(), F.concat(F.lit("failed checks: "), F.array_join("unexpected", ", "))
        )
    else:
        reason = reason.otherwise(F.lit("not published"))
    return joined.select("competence", reason.alias("reason"))


def totals(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    return table.groupBy(*(by or [])).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])


def totals_changed(before: DataFrame, after: DataFrame, by: str = "competence") -> DataFrame:
    """Groups whose totals differ between two versions of a table, or that exist in one only."""
    renamed = totals(after, [by]).withColumnsRenamed({c: f"{c}_after" for c in COUNTS})
    joined = totals(before, [by]).join(renamed, by, "full_outer")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_after")) for c in COUNTS]
    return joined.where(~(same[0] & same[1] & same[2]))


def enrich_population(items: DataFrame, population: DataFrame, population_year: int) -> DataFrame:
    stale = [
        c
        for c in ["population_estimate", "population_reference_year", *[f"{m}_per_100k" for m in COUNTS]]
        if c in items.columns
    ]
    return with_population_rates(items.drop(*stale), population, population_year)


def places_without_population(enriched: DataFrame) -> DataFrame:
    """Identified places that got no population: the coverage must be empty of these."""
    identified = F.col("municipio_codigo_caged") != RESIDUAL_MUNICIPALITY
    covered = F.coalesce(
        F.col("municipio_codigo_ibge").rlike(r"^\d{7}$") & (F.col("population_estimate") > 0), F.lit(False)
    )
    return enriched.where(identified & ~covered)


def enrichment_report(before: DataFrame, enriched: DataFrame, population_year: int, cache_sha256: str) -> DataFrame:
    """Per month: identified, residual, matched and missing places, totals before and after, coverage flag."""
    residual = F.col("municipio_codigo_caged") == RESIDUAL_MUNICIPALITY
    covered = ~residual & (F.col("population_estimate") > 0)
    counts = enriched.groupBy("competence").agg(
        F.count_if(~residual).alias("identified_municipalities"),
        F.count_if(residual).alias("residual_municipalities"),
        F.count_if(covered).alias("matched_population"),
        *[F.sum(c).alias(f"{c}_after") for c in COUNTS],
    )
    old = totals(before, ["competence"]).withColumnsRenamed({c: f"{c}_before" for c in COUNTS})
    joined = counts.join(old, "competence", "left")
    missing = F.col("identified_municipalities") - F.col("matched_population")
    return joined.withColumns(
        {
            "missing_population": missing,
            "coverage_complete": missing == 0,
            "population_year": F.lit(population_year),
            "population_cache_sha256": F.lit(cache_sha256),
        }
    )


def require_enriched(
    before: DataFrame, enriched: DataFrame, population: DataFrame, minimum_entries: int = POPULATION_MINIMUM_ENTRIES
) -> None:
    entries = population.count()
    if entries < minimum_entries:
        raise ConsistencyError(f"population list has only {entries} entries")
    if not places_without_population(enriched).isEmpty():
        raise ConsistencyError("an identified municipality has no population")
    if not totals_changed(before, enriched).isEmpty():
        raise ConsistencyError("enrichment changed the movement totals")
