"""Plan helpers. No join here is forced to broadcast: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, splitting skewed partitions (AQE)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which two null keys match; keys are taken from the left side."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def missing_keys(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``expected`` that ``found`` lacks."""
    return expected.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def one_sided_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with ``side`` = ``left`` or ``right``."""
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, key, "full_outer").where("in_left is null or in_right is null")
    return both.select(key, F.when(F.col("in_left"), F.lit("left")).otherwise(F.lit("right")).alias("side"))


def evaluate_once(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The same rows, with a boundary that filters above do not cross.

    Spark moves a filter on derived columns below the projection that derives them, and then evaluates each parsing
    expression again wherever the filter mentions it. A one-element ``inline`` stops that: all columns are computed
    once per row, still inside generated code, and the filter reads the results. ``keep`` limits the columns.
    """
    return df.select(F.inline(F.array(F.struct(*(keep or df.columns)))))
