"""Official totals: internal closure, reconciliation with measured totals, and which month may come next."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import NotApprovedError
from jobtide.fixed_values import STATES_OF_REGION
from jobtide.functions.codes import literal_map
from jobtide.functions.periods import is_month, next_month
from jobtide.operators.checks import check, check_rows

METRICS = ["admissions", "dismissals", "balance"]


def _balanced() -> Column:
    return F.coalesce(F.col("admissions") - F.col("dismissals") == F.col("balance"), F.lit(False))


def region_closure(
    totals: DataFrame, states_of_region: Mapping[str, list[str]] = STATES_OF_REGION, keys: list[str] | None = None
) -> DataFrame:
    """Published total of each region next to the sum of its states.

    ``totals`` has (keys..., level, name, admissions, dismissals, balance) with level national, region, state or
    non_identified.
    """
    keys = keys or []
    region_of = {state: region for region, states in states_of_region.items() for state in states}
    region = F.when(F.col("level") == "state", F.try_element_at(literal_map(region_of), F.col("name"))).when(
        F.col("level") == "region", F.col("name")
    )
    summed = totals.withColumn("region", region).where("region is not null").groupBy(*keys, "region").agg(
        *[F.sum(F.when(F.col("level") == "state", F.col(m))).alias(f"{m}_states") for m in METRICS],
        *[F.sum(F.when(F.col("level") == "region", F.col(m))).alias(f"{m}_region") for m in METRICS],
    )
    equal = [F.col(f"{m}_states").eqNullSafe(F.col(f"{m}_region")) for m in METRICS]
    return summed.withColumn("matches", equal[0] & equal[1] & equal[2])


def official_reference_checks(
    totals: DataFrame,
    salary: DataFrame,
    keys: list[str],
    states_of_region: Mapping[str, list[str]] = STATES_OF_REGION,
) -> DataFrame:
    """The six named checks of a detailed official month.

    ``salary`` has the keys and minimum_wage_brl, minimum_multiple, maximum_multiple, minimum_salary_brl,
    maximum_salary_brl, exclude_intermittent.
    """
    level = F.col("level")
    facts = totals.groupBy(*keys).agg(
        F.bool_and(F.when(level == "national", _balanced())).alias("national_ok"),
        F.bool_and(F.when(level == "state", _balanced())).alias("states_ok"),
        F.bool_and(F.when(level == "region", _balanced())).alias("regions_ok"),
        *[F.sum(F.when(level == "national", F.col(m))).alias(f"{m}_national") for m in METRICS],
        *[F.sum(F.when(level.isin("state", "non_identified"), F.col(m))).alias(f"{m}_parts") for m in METRICS],
    )
    closure = region_closure(totals, states_of_region, keys).groupBy(*keys).agg(
        (F.bool_and("matches") & (F.count(F.lit(1)) == len(states_of_region))).alias("closure_ok")
    )
    joined = facts.join(closure, keys, "left").join(salary, keys, "left")
    closed = [F.col(f"{m}_national") == F.col(f"{m}_parts") for m in METRICS]
    bounds = (
        (F.round(F.col("minimum_wage_brl") * F.col("minimum_multiple"), 2) == F.col("minimum_salary_brl"))
        & (F.round(F.col("minimum_wage_brl") * F.col("maximum_multiple"), 2) == F.col("maximum_salary_brl"))
        & F.col("exclude_intermittent")
    )
    return check_rows(
        joined,
        keys,
        [
            check("national_arithmetic", F.col("national_ok"), "national hires minus terminations is the balance"),
            check("uf_arithmetic", F.col("states_ok"), "the same in every state"),
            check("region_arithmetic", F.col("regions_ok"), "the same in every region"),
            check("regions_equal_sum_of_ufs", F.col("closure_ok"), "regions are the sum of their states"),
            check(
                "national_equals_ufs_plus_unidentified", closed[0] & closed[1] & closed[2],
                "national total is states plus not identified",
            ),
            check("salary_methodology", bounds, "salary bounds follow from the minimum wage"),
        ],
    )


def reconcile_months(measured: DataFrame, official: DataFrame, key: str = "competence") -> DataFrame:
    """Measured totals next to the official ones; months without an official total stay and do not match."""
    reference = official.select(key, *[F.col(m).alias(f"official_{m}") for m in METRICS])
    joined = measured.select(key, *METRICS).join(reference, key, "left")
    equal = [F.coalesce(F.col(m) == F.col(f"official_{m}"), F.lit(False)) for m in METRICS]
    return joined.withColumns(
        {
            "reference_available": F.col("official_admissions").isNotNull(),
            "reference_consistent": F.coalesce(
                F.col("official_admissions") - F.col("official_dismissals") == F.col("official_balance"), F.lit(False)
            ),
            "matches": equal[0] & equal[1] & equal[2],
        }
    )


def reference_problems(official: DataFrame) -> DataFrame:
    """First broken rule of each registered official month, null when it is sound."""
    filled = lambda name: F.trim(F.coalesce(F.col(name), F.lit(""))) != ""
    hires, ends = F.coalesce("admissoes", F.lit(0)), F.coalesce("desligamentos", F.lit(0))
    problem = (
        F.when(~F.coalesce(F.col("competence").rlike(r"^\d{6}$"), F.lit(False)), F.lit("invalid month"))
        .when(~(F.col("reference_kind").eqNullSafe(F.lit("published_monthly_mov"))), F.lit("not a monthly publication"))
        .when(~filled("source"), F.lit("no source"))
        .when(~filled("source_url"), F.lit("no source_url"))
        .when(~filled("published_at"), F.lit("no published_at"))
        .when((hires <= 0) | (ends <= 0), F.lit("invalid totals"))
        .when(hires - ends != F.coalesce("saldo", F.lit(0)), F.lit("inconsistent balance"))
        .when(F.col("published_at").try_cast("date").isNull(), F.lit("invalid published_at"))
    )
    return official.withColumn("problem", problem)


# ---------------------------------------------------------------------------------------------------------------
# Month sequence
# ---------------------------------------------------------------------------------------------------------------


def month_gaps(months: DataFrame, month: str = "competence") -> DataFrame:
    """Months whose successor is absent although later months exist, with the expected successor.

    An anti-join on the successor: no ordering of the whole table.
    """
    present = months.where(is_month(F.col(month))).select(month).distinct()
    successor = present.withColumn("next_expected", next_month(F.col(month)))
    last = present.agg(F.max(month)).scalar()
    gaps = successor.join(present.select(F.col(month).alias("next_expected")), "next_expected", "left_anti")
    return gaps.where(F.col(month) < last).select(month, "next_expected")


def next_month_decision(
    published: DataFrame,
    official: DataFrame,
    today: date | Column,
    approvals: DataFrame | None = None,
    max_month: str | None = None,
) -> DataFrame:
    """Which month may be audited next: one row (ready, reason, latest_published, next_expected, candidate, published_at).

    A published month whose official total changed after its approval comes first; then the month after the latest
    published one, unless coverage is locked, its total is missing (a gap when a later one exists) or not yet in force.
    ``official`` has (competence, published_at, reference_sha256) of sound months, ``approvals`` (competence,
    reference_sha256).
    """
    day = today if isinstance(today, Column) else F.lit(today)
    facts = official.select(
        "competence", F.col("published_at").cast("string").alias("published_at"), F.col("reference_sha256").alias("sha")
    ).withColumn("effective", F.col("published_at").cast("date") <= day)
    facts = facts.join(
        published.select("competence", F.lit(True).alias("is_published")).distinct(), "competence", "full_outer"
    )
    if approvals is not None:
        approved = approvals.groupBy("competence").agg(F.max("reference_sha256").alias("approved_sha"))
        facts = facts.join(approved.withColumn("has_approval", F.lit(True)), "competence", "left")
        revised = (
            F.col("is_published")
            & F.col("sha").isNotNull()
            & F.col("has_approval")
            & (F.coalesce("approved_sha", F.lit("")) != F.col("sha"))
        )
    else:
        revised = F.lit(False)
    latest = published.agg(F.max("competence")).scalar()
    expected = next_month(F.col("latest"))
    registered = F.col("published_at").isNotNull()
    month = F.col("competence")

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.struct(month.alias("m"), F.col("published_at").alias("p"))))

    one = (
        facts.withColumn("latest", latest)
        .withColumn("expected", expected)
        .agg(
            F.max("latest").alias("latest"),
            first(revised).alias("revised"),
            first(registered & F.col("effective")).alias("eligible"),
            first(registered & (month == F.col("expected"))).alias("next"),
            F.coalesce(F.bool_or(registered & (month == F.col("expected")) & F.col("effective")), F.lit(False)).alias(
                "next_effective"
            ),
            F.coalesce(F.bool_or(registered & (month > F.col("expected"))), F.lit(False)).alias("later"),
        )
        .withColumn("expected", expected)
    )
    locked = lambda m: (m > max_month) if max_month else F.lit(False)
    started = F.col("latest").isNotNull()
    reason = (
        F.when(F.col("revised").isNotNull(), F.lit("published_reference_revision"))
        .when(~started & F.col("eligible").isNull(), F.lit("official_reference_not_registered"))
        .when(~started & locked(F.col("eligible.m")), F.lit("coverage_policy_locked"))
        .when(~started, F.lit("ready"))
        .when(locked(F.col("expected")), F.lit("coverage_policy_locked"))
        .when(F.col("next").isNull() & F.col("later"), F.lit("reference_gap"))
        .when(F.col("next").isNull(), F.lit("official_reference_not_registered"))
        .when(~F.col("next_effective"), F.lit("reference_not_effective_yet"))
        .otherwise(F.lit("ready"))
    )
    chosen = (
        F.when(F.col("reason") == "published_reference_revision", F.col("revised"))
        .when((F.col("reason") == "ready") & ~started, F.col("eligible"))
        .when(F.col("reason") == "ready", F.col("next"))
    )
    return (
        one.withColumn("reason", reason)
        .withColumn("chosen", chosen)
        .select(
            F.col("chosen").isNotNull().alias("ready"),
            "reason",
            F.col("latest").alias("latest_published"),
            F.when(started, F.col("expected")).otherwise(F.col("eligible.m")).alias("next_expected"),
            F.col("chosen.m").alias("candidate"),
            F.when(F.col("reason") == "reference_not_effective_yet", F.col("next.p"))
            .otherwise(F.col("chosen.p"))
            .alias("reference_published_at"),
        )
    )


def require_auditable(
    requested: str, decision: DataFrame, published: DataFrame, official: DataFrame, today: date, allow_published: bool = False
) -> DataFrame:
    """The decision for a requested month, or an error. A published month may be audited again only on request."""
    is_published = not published.where(F.col("competence") == requested).isEmpty()
    row = decision.collect()[0]
    if row.ready and row.candidate == requested and (not is_published or allow_published):
        return decision
    if allow_published and is_published:
        reference = reference_problems(official.where(F.col("competence") == requested))
        found = reference.where("problem is null").where(F.col("published_at").cast("date") <= F.lit(today))
        if found.isEmpty():
            raise NotApprovedError(f"official total of {requested} is missing, unsound or not yet in force")
        return found.select(
            F.lit(True).alias("ready"),
            F.lit("published_reaudit").alias("reason"),
            F.lit(requested).alias("latest_published"),
            F.lit(row.next_expected).alias("next_expected"),
            F.lit(requested).alias("candidate"),
            F.col("published_at").cast("string").alias("reference_published_at"),
        )
    raise NotApprovedError(f"{requested} may not be audited: {row.reason}; next expected is {row.next_expected}")
