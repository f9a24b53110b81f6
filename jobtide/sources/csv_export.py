"""CSV export of published tables, safe to open in a spreadsheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from jobtide.fixed_values import UTF8_BOM
from jobtide.functions.text import spreadsheet_safe


def safe_cells(df: DataFrame) -> DataFrame:
    """Text columns protected against formulas, numbers untouched."""
    cells = [
        spreadsheet_safe(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cells)


def union_of_items(tables: list[DataFrame]) -> DataFrame:
    """Items of several documents under the union of their keys, in first-seen order."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header. Each file's header starts with a UTF-8 byte order mark, so spreadsheets read accents right."""
    safe = safe_cells(df)
    marked = safe.withColumnRenamed(safe.columns[0], UTF8_BOM + safe.columns[0])
    marked.write.mode("overwrite").csv(path, header=True, escape='"', lineSep="\n", emptyValue="")
