"""Weighted medians of groups of any size: a histogram finds the bucket of the middle positions, only that bucket is put in order.

Buckets follow the logarithm of a value, so their number is bounded whatever the values are (``STEPS`` an octave), and a bucket spans a
thousandth of an octave. A group's histogram is summed by tasks and then ranked as one row a bucket; the values of its open
bucket, or two where the middle lies between buckets, are ranked on their own. No task sees all values of a group.
"""

from __future__ import annotations

from functools import reduce
from math import log
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets between a value and its double.
STEPS = 1024


def value_bucket(value: Column, steps: int = STEPS) -> Column:
    """A number that never falls as the value grows; a double, so that infinity and NaN have buckets too."""
    return F.signum(value) * F.rint(F.log1p(F.abs(value)) * F.lit(steps / log(2)))


def weighted_medians(rows: DataFrame, by: list[str], value: str, weight: str, steps: int = STEPS) -> DataFrame:
    """(*by, total_weight, median) of rows with one row per group and value. Null keys are a group.

    ``weight`` is a whole number; rows whose weight is null or not positive, or whose value is null, do not count, and a group without
    others has no row. The median is the mean of the values at positions ceil(n/2) and floor(n/2)+1.
    """
    counted = rows.where((F.col(weight) > 0) & F.col(value).isNotNull()).select(
        *by, F.col(value).cast("double").alias("__v"), F.col(weight).cast("bigint").alias("__w"), value_bucket(F.col(value).cast("double"), steps).alias("__bucket")
    )
    lower, upper = F.floor((F.col("__total") + 1) / 2), F.floor(F.col("__total") / 2) + 1
    group = W.partitionBy(*by)
    histogram = counted.groupBy(*by, "__bucket").agg(F.sum("__w").alias("__mass"))
    placed = histogram.withColumns(
        {"__upto": F.sum("__mass").over(group.orderBy("__bucket").rowsBetween(W.unboundedPreceding, W.currentRow)), "__total": F.sum("__mass").over(group)}
    )
    middle = placed.where((F.col("__upto") >= lower) & (F.col("__upto") - F.col("__mass") < upper))
    middle = middle.select(*[F.col(c).alias(f"__open_{c}") for c in by], F.col("__bucket").alias("__open"), (F.col("__upto") - F.col("__mass")).alias("__before"), "__total")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__open_{c}")) for c in by], F.col("__bucket") == F.col("__open"))
    inside = W.partitionBy(*by, "__bucket").orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counted.join(middle, same).withColumn("__upto", F.col("__before") + F.sum("__w").over(inside))

    def value_at(position: Column) -> Column:
        return F.min(F.when(F.col("__upto") >= position, F.col("__v")))

    return ranked.groupBy(*by).agg(F.max("__total").alias("total_weight"), ((value_at(lower) + value_at(upper)) / 2).alias("median"))
