"""Months as YYYYMM text: text order is time order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_month(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^\d{4}(0[1-9]|1[0-2])$"), F.lit(False))


def month_of(date_or_time: Column) -> Column:
    return (F.year(date_or_time) * 100 + F.month(date_or_time)).cast("string")


def month_start(month: Column) -> Column:
    """First day of the month; null for text that is not a month."""
    return F.when(is_month(month), F.make_date(month.substr(1, 4).cast("int"), month.substr(5, 2).cast("int"), F.lit(1)))


def next_month(month: Column) -> Column:
    """Following month; null for text that is not a month."""
    return month_of(F.add_months(month_start(month), 1))


def next_month_text(month: str) -> str:
    """:func:`next_month` for a driver-side value."""
    if len(month) != 6 or not month.isdigit() or not 1 <= int(month[4:]) <= 12:
        raise ValueError(f"month must be YYYYMM, got {month!r}")
    year, number = divmod(int(month[:4]) * 12 + int(month[4:]), 12)
    return f"{year:04d}{number + 1:02d}"


def quarter_number(month: Column) -> Column:
    return F.ceil(month.substr(5, 2).cast("int") / 3).cast("int")


def quarter_key(month: Column) -> Column:
    return F.concat(month.substr(1, 4), F.lit("Q"), quarter_number(month).cast("string"))


def quarter_label(month: Column) -> Column:
    return F.concat(quarter_number(month).cast("string"), F.lit("º trimestre de "), month.substr(1, 4))
