"""Weighted medians by buckets against sorted values: skewed, tied, negative, huge and odd values, null keys."""

import math
import random

import pytest

from jobtide.operators.selection import value_bucket, weighted_medians


def plain(rows):
    groups = {}
    for key, value, weight in rows:
        if value is not None and weight is not None and weight > 0:
            groups.setdefault(key, []).append((value, weight))
    out = {}
    for key, pairs in groups.items():
        pairs.sort(key=lambda p: (math.isnan(p[0]), p[0]))
        total = sum(w for _, w in pairs)

        def at(position, pairs=pairs):
            upto = 0
            for value, weight in pairs:
                upto += weight
                if upto >= position:
                    return value

        out[key] = (total, (at((total + 1) // 2) + at(total // 2 + 1)) / 2)
    return out


@pytest.mark.parametrize("steps", [1, 16, 1024])
def test_medians_equal_sorted_values(spark, steps):
    dice = random.Random(steps)
    rows = [("hot", round(dice.lognormvariate(8, 1), 2), dice.randint(1, 9)) for _ in range(3000)]
    rows += [("close", 5000 + i / 100, 1) for i in range(500)] + [("spread", dice.choice([-1, 1]) * 10 ** dice.uniform(-9, 12), dice.randint(-2, 5)) for _ in range(400)]
    rows += [(None, 1.0, 2), (None, 2.0, 2), ("one", 7.5, 1), ("even", 1e-300, 1), ("even", 3.0, 1), ("zero", 0.0, 3), ("zero", -0.5, 3), ("none", 1.0, 0), ("none", None, 5), ("none", 2.0, None), ("inf", math.inf, 3), ("inf", 1.0, 2)]
    rows = list({(k, v): (k, v, w) for k, v, w in rows}.values())
    found = weighted_medians(spark.createDataFrame(rows, "k string, v double, w long").repartition(3), ["k"], "v", "w", steps)
    assert {r.k: (r.total_weight, r.median) for r in found.collect()} == plain(rows)
    whole = weighted_medians(spark.createDataFrame([(v, w) for _, v, w in rows], "v double, w long"), [], "v", "w", steps).first()
    assert (whole.total_weight, whole.median) == plain([(0, v, w) for _, v, w in rows])[0]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "k string, v double, w long")
    assert weighted_medians(empty, ["k"], "v", "w").count() == 0
    nan = spark.createDataFrame([("a", math.nan, 1), ("a", 1.0, 3)], empty.schema)
    assert weighted_medians(nan, ["k"], "v", "w").first().median == 1.0


def test_no_task_ranks_all_values(spark):
    """The only window over values runs within a bucket; the one over a group runs on its histogram."""
    rows = spark.range(0, 200_000).selectExpr("CAST(100 + id / 100 AS double) AS v", "1L AS w")
    buckets = rows.select(value_bucket(rows.v).alias("b")).groupBy("b").count()
    assert buckets.count() < 6000 and buckets.agg({"count": "max"}).first()[0] < 300
    found = weighted_medians(rows, [], "v", "w")
    assert (found.first().total_weight, found.first().median) == (200_000, (1099.99 + 1100.0) / 2)
