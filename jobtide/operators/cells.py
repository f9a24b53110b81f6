"""Occupation codes in spreadsheet cells given as a table (sheet, row, col, kind, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError
from jobtide.functions.codes import occupation_code_from_cell
from jobtide.operators.joins import missing_keys


def cell_codes(cells: DataFrame) -> DataFrame:
    """Cells that hold a six-digit code, as (sheet, col, code)."""
    code = occupation_code_from_cell(F.col("kind"), F.col("value"))
    return cells.select("sheet", "col", code.alias("code")).where("code is not null")


def join_columns(cells: DataFrame, expected: DataFrame, list_codes: bool = True) -> DataFrame:
    """Columns that hold expected codes: per sheet and column the number of distinct codes, the header and, with
    ``list_codes``, the sorted codes themselves.

    Codes are made distinct per column first. Each list is at most as long as ``expected``; ask for it only when that
    is a code table, not data.
    """
    found = cell_codes(cells).distinct().join(expected.select("code").distinct(), "code", "left_semi")
    listed = [F.sort_array(F.collect_list("code")).alias("matched_codes")] if list_codes else []
    columns = found.groupBy("sheet", "col").agg(F.count(F.lit(1)).alias("matched_count"), *listed)
    headers = cells.where("row = 1").groupBy("sheet", "col").agg(F.max(F.trim("value")).alias("header"))
    return columns.join(headers, ["sheet", "col"], "left")


def code_coverage(cells: DataFrame, expected: DataFrame) -> DataFrame:
    """Each expected code with a ``matched`` mark."""
    found = cell_codes(cells).select("code").distinct().withColumn("matched", F.lit(True))
    wanted = expected.select("code").distinct()
    return wanted.join(found, "code", "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def missing_codes(cells: DataFrame, expected: DataFrame) -> DataFrame:
    return missing_keys(expected, cell_codes(cells), "code")


def require_join_column(columns: DataFrame) -> None:
    if columns.isEmpty():
        raise ConsistencyError("no column of the sheets holds a published occupation code")
