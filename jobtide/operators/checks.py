"""The one contract all gates share: a frame of (keys..., id, passed, message, blocking) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError


def check(
    name: str, passed: Column, message: str | Column, applies: Column | None = None, blocking: bool = True
) -> Column:
    """A check result. A condition that cannot be evaluated fails; a check that does not apply is null."""
    text = F.lit(message) if isinstance(message, str) else message
    result = F.struct(
        F.lit(name).alias("id"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        text.alias("message"),
        F.lit(blocking).alias("blocking"),
    )
    return result if applies is None else F.when(applies, result)


def check_rows(facts: DataFrame, keys: list[str], checks: list[Column]) -> DataFrame:
    """Check rows from one wide row of facts per key."""
    return facts.select(*keys, F.inline(F.array_compact(F.array(*checks))))


def all_blocking_passed() -> Column:
    return F.bool_and(F.col("passed") | ~F.col("blocking"))


def gate_summary(checks: DataFrame, keys: list[str], approval: str = "manual_methodology_approval") -> DataFrame:
    """Automatic result, approval and ``publishable`` per key."""
    automatic = F.bool_and(F.col("passed") | ~F.col("blocking") | (F.col("id") == approval))
    approved = F.coalesce(F.bool_or((F.col("id") == approval) & F.col("passed")), F.lit(False))
    summary = checks.groupBy(*keys).agg(
        automatic.alias("automatic_checks_passed"),
        approved.alias("manual_approval_valid"),
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
    )
    return summary.withColumn("publishable", F.col("automatic_checks_passed") & F.col("manual_approval_valid"))


def gate_documents(checks: DataFrame, keys: list[str]) -> DataFrame:
    """Summary flags plus the checks as an array: the stored form of a gate. A gate has a fixed, small set of checks."""
    listed = F.sort_array(F.collect_list(F.struct("id", "passed", "message", "blocking")))
    return gate_summary(checks, keys).join(checks.groupBy(*keys).agg(listed.alias("checks")), keys)


def gate_is_clean(gates: DataFrame, keys: list[str]) -> DataFrame:
    """Per stored gate: all three flags true, at least one check, well-typed checks, unique ids, blocking ones passed.

    ``checks`` is an array of (id, passed, blocking, ...). A null in a check means it was not a proper boolean or text.
    """
    one = F.col("c")
    typed = (F.trim(one["id"]) != "") & one["passed"].isNotNull() & one["blocking"].isNotNull()
    exploded = gates.select(
        *keys,
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("publishable", "automatic_checks_passed", "manual_approval_valid")],
        F.explode_outer("checks").alias("c"),
    )
    return exploded.groupBy(*keys).agg(
        (
            F.bool_and(F.col("publishable") & F.col("automatic_checks_passed") & F.col("manual_approval_valid"))
            & F.bool_and(F.coalesce(typed, F.lit(False)))
            & (F.count_distinct(one["id"]) == F.count(F.lit(1)))
            & F.bool_and(F.coalesce(~one["blocking"] | one["passed"], F.lit(False)))
        ).alias("clean")
    )


def require_passed(checks: DataFrame) -> None:
    bad = checks.where("blocking and not passed").select("id", "message").limit(3).collect()
    if bad:
        raise ConsistencyError("; ".join(f"{row.id}: {row.message}" for row in bad))
