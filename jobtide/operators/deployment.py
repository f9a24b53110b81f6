"""May a set of changed files be deployed? Every month and year it touches needs a clean gate of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators.checks import gate_is_clean

# How a published file names its month or year.
GOLD_PREFIX = "data/gold/"
MONTH_PATTERN = r"(20\d{4})\.[^.]+$"
YEAR_PATTERN = r"rais-[^/]*-(20\d{2})\.[^.]+$"


def touched_releases(paths: DataFrame) -> DataFrame:
    """Distinct (kind, key) of the changed paths: kind is ``monthly`` or ``annual``."""
    path = F.col("path")
    annual = F.regexp_extract(path, YEAR_PATTERN, 1)
    monthly = F.when(~F.contains(path, F.lit("/rais-")), F.regexp_extract(path, MONTH_PATTERN, 1)).otherwise(F.lit(""))
    found = paths.where(path.startswith(GOLD_PREFIX)).select(
        F.inline(
            F.array(
                F.struct(F.lit("monthly").alias("kind"), monthly.alias("key")),
                F.struct(F.lit("annual").alias("kind"), annual.alias("key")),
            )
        )
    )
    return found.where("key <> ''").distinct()


def deployment_reasons(paths: DataFrame, gates: DataFrame) -> DataFrame:
    """One row per touched release with the reason it blocks, null when it does not.

    ``gates`` has (kind, file_key, key, flags..., checks): ``file_key`` is the key the gate is stored under, ``key``
    the one it states.
    """
    clean = gate_is_clean(gates, ["kind", "file_key"]).join(
        gates.select("kind", "file_key", F.col("key").alias("stated")), ["kind", "file_key"]
    )
    joined = touched_releases(paths).join(clean.withColumnRenamed("file_key", "key"), ["kind", "key"], "left")
    reason = (
        F.when(F.col("clean").isNull(), F.lit("gate is missing"))
        .when(~F.col("stated").eqNullSafe(F.col("key")), F.lit("gate is for another release"))
        .when(~F.col("clean"), F.lit("release is not publishable yet"))
    )
    return joined.select("kind", "key", reason.alias("reason"))


def deployment_decision(reasons: DataFrame) -> DataFrame:
    """``eligible`` and the sorted touched keys and reasons. Nothing touched is eligible."""
    keys = lambda kind: F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("key"))))
    text = F.concat(F.col("key"), F.lit(": "), F.col("reason"))
    return reasons.agg(
        (F.count("reason") == 0).alias("eligible"),
        keys("monthly").alias("monthly"),
        keys("annual").alias("annual"),
        F.sort_array(F.collect_set(text)).alias("reasons"),
    )
