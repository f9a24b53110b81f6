"""Rates, shares and deflation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def per_100k(count: Column, population: Column) -> Column:
    """Rate per 100 000 to 4 places; null without a positive population."""
    return F.when(population > 0, F.round(F.coalesce(count, F.lit(0)) * 100000 / population, 4))


def share(part: Column, total: Column, places: int = 8) -> Column:
    """Share to ``places`` decimals, 0.0 on an empty total."""
    # The total is named once, so a scalar subquery given as total runs once.
    return F.coalesce(F.round(part / F.nullif(total, F.lit(0)), places), F.lit(0.0))


def plain_share(part: Column, total: Column) -> Column:
    """Unrounded share, 0.0 on an empty total."""
    return F.coalesce(part / F.nullif(total, F.lit(0)), F.lit(0.0))


def per_100(count: Column, stock: Column) -> Column:
    return count / stock * 100


def price_ratio(base_index: Column, month_index: Column) -> Column:
    """Base over month as a decimal ratio; null unless both are positive."""
    base, month = base_index.cast("decimal(18,6)"), month_index.cast("decimal(18,6)")
    return F.when((base > 0) & (month > 0), base / month)


def deflate(nominal: Column, ratio: Column) -> Column:
    return nominal * ratio.cast("double")
