"""Annual stock files: one text file per region, delimiter, encoding and header names vary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import STOCK_REQUIRED_ALIASES
from jobtide.operators.contracts import concept_columns, match_aliases
from jobtide.sources.layout import require_valid_layouts
from jobtide.sources.quoted import broken_parts, part_states, read_records, text_lines
from jobtide.sources.tables import materialize

RAW_COLUMNS = {
    "cbo_occupation": "cbo_raw",
    "municipality": "municipio_raw",
    "active_3112": "active_raw",
    "abandoned_link": "abandoned_raw",
}
_SPARK_ENCODING = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "latin-1": "ISO-8859-1"}


def _strictly_decoded(col: Column) -> Column:
    """Spark's reader replaces bytes it cannot decode; here such a byte is an error."""
    error = F.raise_error(F.lit("undecodable bytes in an annual file")).cast("string")
    return F.when(F.contains(col, F.lit("�")), error).otherwise(col)


def _broken_records(spark: SparkSession, files: list[str], encoding: str, delimiter: str, columns: tuple[str, ...]) -> DataFrame | None:
    """(file, fields) of files with quoted line breaks, None where no line leaves a quoted field open: a plain scan reads those."""
    lines = text_lines(spark, files)
    states = materialize(part_states(lines, delimiter), "part-states")
    if broken_parts(states).isEmpty():
        return None
    records = read_records(lines, states, delimiter)
    if encoding == "latin-1":
        text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    else:
        text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.raise_error(F.lit("undecodable bytes in an annual file")))
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    fields = F.from_csv(text, schema, {"sep": delimiter, "escape": '"', "multiLine": "true"})
    return records.select("file", F.inline(F.array(fields)))


def read_stock_text(spark: SparkSession, layouts: DataFrame, aliases=None) -> DataFrame:
    """Raw text of the four required concepts plus ``source_file``.

    Files that share delimiter, encoding and header are one scan, so the number of scans follows the number of
    distinct layouts, not the number of files. Quoted fields may hold line breaks, in files of any size: large files are still read in parts
    (``quoted``), after one scan that looks for lines with an open quote. ``layouts`` comes from ``inspect_layouts``; it has one small row per
    file and is read on the driver to plan the scans.
    """
    layouts = materialize(layouts, "layouts")  # every line of every file was read for them
    require_valid_layouts(layouts)
    columns_of = concept_columns(match_aliases(layouts, aliases or STOCK_REQUIRED_ALIASES))
    groups: dict[tuple, list[tuple[str, str]]] = {}
    for row in layouts.select("path", "file", "encoding", "delimiter", "columns", "normalized_columns").collect():
        key = (row.encoding, row.delimiter, tuple(row.columns), tuple(row.normalized_columns))
        groups.setdefault(key, []).append((row.path, row.file))

    scans = []
    for (encoding, delimiter, columns, normalized), files in sorted(groups.items()):
        place = {name: i for i, name in enumerate(normalized)}
        resolved = columns_of[files[0][1]]
        paths = [path for path, _ in files]
        records = _broken_records(spark, paths, encoding, delimiter, columns)
        if records is not None:
            taken = [F.col(f"c{place[resolved[concept]]}").alias(raw) for concept, raw in RAW_COLUMNS.items()]
            name = F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B")))
        else:
            records = spark.read.csv(paths, sep=delimiter, header=True, inferSchema=False, escape='"', encoding=_SPARK_ENCODING[encoding], mode="PERMISSIVE")
            taken = [_strictly_decoded(F.col(f"`{columns[place[resolved[concept]]]}`")).alias(raw) for concept, raw in RAW_COLUMNS.items()]
            name = F.col("_metadata.file_name")
        scans.append(records.select(*taken, name.alias("source_file")))
    return reduce(DataFrame.unionByName, scans)
