"""Revisions of published months: snapshots, differences, allowed changes and partition-wise rebuilds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, NotApprovedError
from jobtide.functions.fingerprints import canonical_json, row_set_fingerprint
from jobtide.operators.joins import missing_keys
from jobtide.sources.tables import replace_partitions



def table_snapshot(table: DataFrame, name: str, month: str = "competence") -> DataFrame:
    """(competence, file, sha256): an order-free fingerprint of each month's rows, summed on the map side."""
    text = canonical_json(table)
    rows = table.select(F.col(month).alias("competence"), text.alias("__row"))
    hashes = rows.groupBy("competence").agg(row_set_fingerprint(F.col("__row")).alias("sha256"))
    return hashes.select("competence", F.lit(name).alias("file"), "sha256")


def history_snapshot(tables: Mapping[str, DataFrame], published: DataFrame, month: str = "competence") -> DataFrame:
    """Snapshot of several published tables, restricted to published months."""
    parts = [table_snapshot(df, name, month) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).join(published.select("competence").distinct(), "competence", "left_semi")


def require_complete_snapshot(snapshot: DataFrame, published: DataFrame, tables: int) -> None:
    """Every published month must have every table, else there is no baseline to compare with."""
    counts = snapshot.groupBy("competence").agg(F.count(F.lit(1)).alias("n"))
    short = published.select("competence").distinct().join(counts, "competence", "left")
    bad = short.where(F.coalesce("n", F.lit(0)) < tables).select("competence").limit(1).collect()
    if bad:
        raise ConsistencyError(f"published month {bad[0].competence} lacks a table in the baseline")


def snapshot_metrics(overviews: DataFrame) -> DataFrame:
    wanted = ["competence", "admissions", "dismissals", "balance", "salary_median_admissions_real"]
    return overviews.select(*[c for c in wanted if c in overviews.columns])


def artifact_changes(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Baseline artifacts whose hash differs now or that are gone (``after_sha256`` null)."""
    after = current.select("competence", "file", F.col("sha256").alias("after_sha256"))
    joined = baseline.withColumnRenamed("sha256", "before_sha256").join(after, ["competence", "file"], "left")
    return joined.where(~F.col("after_sha256").eqNullSafe(F.col("before_sha256")))


def effective_months(adjustments: DataFrame) -> DataFrame:
    """Distinct six-digit months that a set of adjustment rows touches."""
    month = F.col("effective_competence").cast("string").alias("competence")
    return adjustments.select(month).where(F.col("competence").rlike(r"^\d{6}$")).distinct()


def future_adjustments(touched: DataFrame, ingest_month: str) -> DataFrame:
    return touched.where(F.col("competence") > ingest_month)


def months_without_base(touched: DataFrame, baseline: DataFrame, base: DataFrame, ingest_month: str) -> DataFrame:
    """Published months that must be rebuilt but whose base rows are absent: missing data, not "no change"."""
    needed = touched.select("competence").intersect(baseline.select("competence"))
    return missing_keys(needed.where(F.col("competence") != ingest_month), base, "competence")


def unexpected_changes(changes: DataFrame, touched: DataFrame, baseline: DataFrame, ingest_month: str) -> DataFrame:
    """Changed months that no adjustment explains. The ingested month itself may change if it was published."""
    own = baseline.where(F.col("competence") == ingest_month).select("competence").distinct()
    return missing_keys(changes, touched.select("competence").union(own), "competence")


def evaluate_revisions(
    ingest_month: str, baseline: DataFrame, current: DataFrame, adjustments: DataFrame, base_months: DataFrame
) -> DataFrame:
    """One row: changed, unexpected, future and base-less months as sorted arrays, missing artifacts, and ``passed``."""
    touched = effective_months(adjustments)
    changes = artifact_changes(baseline, current)
    kinds = {
        "adjustment_effective_competencies": touched,
        "changed_published_competencies": changes.select("competence"),
        "unexpected_changed_competencies": unexpected_changes(changes, touched, baseline, ingest_month),
        "future_adjustment_competencies": future_adjustments(touched, ingest_month),
        "missing_rebuild_baselines": months_without_base(touched, baseline, base_months, ingest_month),
        "missing_after": changes.where("after_sha256 is null").select(F.col("file").alias("competence")),
    }
    # Lists hold months or artifact names, which the published history bounds.
    rows = reduce(
        DataFrame.unionByName, [df.select(F.lit(name).alias("kind"), "competence") for name, df in kinds.items()]
    )
    lists = rows.agg(
        *[F.sort_array(F.collect_set(F.when(F.col("kind") == name, F.col("competence")))).alias(name) for name in kinds]
    )
    blockers = [
        "unexpected_changed_competencies", "future_adjustment_competencies", "missing_rebuild_baselines", "missing_after",
    ]
    passed = reduce(lambda a, b: a & b, [F.size(name) == 0 for name in blockers])
    return lists.select(
        F.lit(ingest_month).alias("ingest_competence"), F.lit(2).alias("version"), passed.alias("passed"), "*"
    )


def metric_changes(changes: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Headline metrics of the changed months before and after."""
    names = [c for c in before.columns if c != "competence"]
    changed = changes.select("competence").distinct()
    b = before.withColumnsRenamed({c: f"{c}_before" for c in names})
    a = after.select("competence", *names).withColumnsRenamed({c: f"{c}_after" for c in names})
    return changed.join(b, "competence", "left").join(a, "competence", "left")


def revision_package(evaluation: DataFrame, changes: DataFrame) -> DataFrame:
    """Artifacts to replace, with both hashes: all changed ones except the ingested month's, none unless passed."""
    verdict = evaluation.select("ingest_competence", "passed").where("passed")
    ingest = verdict.agg(F.max("ingest_competence")).scalar()
    return changes.where(ingest.isNotNull() & (F.col("competence") != ingest))


def require_passed_revision(evaluation: DataFrame) -> None:
    row = evaluation.collect()[0]
    if not row.passed:
        raise NotApprovedError("history revision did not pass its audit")
    if row.missing_rebuild_baselines:
        raise NotApprovedError("months lack base rows: " + ", ".join(row.missing_rebuild_baselines))


def package_conflicts(package: DataFrame, packaged: DataFrame, published: DataFrame) -> DataFrame:
    """Package entries that may not be applied, with the reason. Inputs are (competence, file, sha256) snapshots."""
    key = ["competence", "file"]
    facts = (
        package.join(packaged.select(*key, F.col("sha256").alias("source_sha")), key, "left")
        .join(published.select(*key, F.col("sha256").alias("target_sha")), key, "left")
    )
    reason = (
        F.when(F.col("source_sha").isNull(), F.lit("missing in package"))
        .when(F.col("target_sha").isNull(), F.lit("not published before"))
        .when(F.col("source_sha") != F.col("after_sha256"), F.lit("package changed since the audit"))
        .when(F.col("target_sha") != F.col("before_sha256"), F.lit("published data changed since the audit"))
    )
    return facts.withColumn("reason", reason).where("reason is not null")


def apply_revision(evaluation: DataFrame, package: DataFrame, rebuilt: Mapping[str, DataFrame],
                   published: Mapping[str, DataFrame], paths: Mapping[str, str]) -> None:
    """Replace the packaged months, table by table, only if every hash on both sides is the audited one.

    All conditions are checked before the first write; each write replaces whole month partitions.
    """
    require_passed_revision(evaluation)
    side = lambda tables: reduce(DataFrame.unionByName, [table_snapshot(df, n) for n, df in tables.items()])
    conflict = package_conflicts(package, side(rebuilt), side(published)).select("file", "reason").limit(1).collect()
    if conflict:
        raise NotApprovedError(f"{conflict[0].file}: {conflict[0].reason}")
    for name, table in rebuilt.items():
        months = package.where(F.col("file") == name).select("competence").distinct()
        replace_partitions(table.join(months, "competence", "left_semi"), paths[name], ["competence"], months)


# ---------------------------------------------------------------------------------------------------------------
# Rebuild
# ---------------------------------------------------------------------------------------------------------------


def months_to_rebuild(adjustments: DataFrame, base_months: DataFrame) -> DataFrame:
    """Touched months with a ``has_base`` mark; months without base rows keep their adjustments for later."""
    base = base_months.select("competence").distinct().withColumn("has_base", F.lit(True))
    return effective_months(adjustments).join(base, "competence", "left").withColumn(
        "has_base", F.coalesce("has_base", F.lit(False))
    )


def rebuild_months(
    silver: DataFrame, months: DataFrame, build: Callable[[DataFrame], DataFrame], path: str | None = None
) -> DataFrame:
    """Recompute ``build`` for the touched months only; with ``path``, replace those months' partitions there.

    Late rows are stored under the month they came with, so all of ``silver`` that may hold them has to be scanned.
    """
    wanted = months.where("has_base").select(F.col("competence").alias("effective_competence"))
    rebuilt = build(silver.join(wanted, "effective_competence", "left_semi"))
    if path:
        replace_partitions(rebuilt, path, ["competence"], months.where("has_base").select("competence"))
    return rebuilt
