"""Lenient number parsing: what does not parse becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?\d+$"
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lenient_smallint(col: Column) -> Column:
    """Whole number of at most 16 bits. ``1,0``, ``1.0`` and blanks are null; they are not whole-number text."""
    return F.when(col.rlike(_INTEGER), col.try_cast("smallint"))


def _to_double(col: Column) -> Column:
    return F.when(col.rlike(_DECIMAL), col.try_cast("double"))


def brazilian_number(col: Column) -> Column:
    """``1.234,56`` and ``1234.56`` are both 1234.56: dots are thousands marks only when there is a comma.

    A text with two commas is not a number.
    """
    with_comma = F.translate(col, ",.", ".")
    return _to_double(F.when(F.contains(col, F.lit(",")), with_comma).otherwise(col))


def dotted_thousands_number(col: Column) -> Column:
    """Variant of the stock diagnosis: a dot is always a thousands mark. Surrounding blanks are dropped."""
    return _to_double(F.trim(F.translate(col, ",.", ".")))
