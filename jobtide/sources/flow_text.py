"""Monthly movement files: ``;`` separated text, every column read as text.

Headers are held against the contract file by file, before any row is read. Files whose headers have the same contract names in the
same order are one scan, however they spell them, so the number of scans follows the number of layouts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from jobtide.errors import LayoutError
from jobtide.fixed_values import FLOW_COLUMN_NAMES, FLOW_REQUIRED_HEADERS
from jobtide.functions.movement import checked_kind
from jobtide.functions.text import compact_header, compact_header_column, null_tokens_to_null
from jobtide.sources.files import exact_path, first_lines, list_files, spelled_in_rows
from jobtide.sources.layout import split_header

DELIMITER = ";"
#: Holds the file of a row from the scan until the rows meet their month and kind.
_FILE = "__file"


def header_contract(heads: DataFrame, required: set[str] = FLOW_REQUIRED_HEADERS) -> DataFrame:
    """One row per file from (path, header_line): its normalised ``headers`` in order, the required ones that are ``missing``, those that
    several columns share (``doubled``), both sorted, and ``valid``. A file without a byte has no headers and lacks them all.
    """
    headers = F.transform(split_header(F.col("header_line"), F.lit(DELIMITER)), compact_header_column)
    read = heads.select("*", F.coalesce(headers, F.array().cast("array<string>")).alias("headers"))
    wanted = F.array(*map(F.lit, sorted(required)))
    doubled = F.filter("headers", lambda h: F.size(F.filter("headers", lambda other: other == h)) > 1)
    checked = read.withColumns({"missing": F.array_except(wanted, "headers"), "doubled": F.array_sort(F.array_distinct(doubled))})
    return checked.withColumn("valid", (F.size("missing") == 0) & (F.size("doubled") == 0))


def _scan(spark: SparkSession, files: list[str], names: list[str]) -> DataFrame:
    """Rows of files whose columns are these, in this order, and the file of each.

    A line with too few or too many fields fails the job. Column pruning is off because a pruned parse does not
    look at the fields it skips and would let such a line through.
    """
    schema = StructType([StructField(name, StringType()) for name in names])
    reader = spark.read.options(sep=DELIMITER, header=True, mode="FAILFAST", escape='"', encoding="UTF-8", columnPruning=False)
    return reader.schema(schema).csv([exact_path(f) for f in files]).select("*", F.col("_metadata.file_path").alias(_FILE))


def _read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """All rows of files that all keep the contract, matched by name; optional columns that a file lacks are null."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    broken = []
    for row in header_contract(first_lines(spark, files)).orderBy("path").collect():
        if row.valid:
            layouts.setdefault(tuple(row.headers), []).append(row.path)
        elif row.missing:
            broken.append(f"{row.path} lacks required columns: {', '.join(row.missing)}")
        else:
            broken.append(f"{row.path} has headers that normalise to the same name: {', '.join(row.doubled)}")
    if broken:
        raise LayoutError(f"{len(broken)} of {len(files)} flow files break the header contract: " + "; ".join(broken[:5]))
    scans = []
    for headers, paths in layouts.items():
        names = [FLOW_COLUMN_NAMES.get(h, h) for h in headers]
        scans.append(_scan(spark, paths, names).select(*[null_tokens_to_null(F.col(f"`{n}`")).alias(n) for n in names], _FILE))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_flow_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw rows under the files' own header names, whatever the contract asks; files with their columns in another order are matched by
    name, a column that a file lacks is null."""
    heads = first_lines(spark, list_files(spark, paths)).select("path", split_header(F.col("header_line"), F.lit(DELIMITER)).alias("names"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in heads.orderBy("path").collect():
        layouts.setdefault(tuple(row.names or ()), []).append(row.path)
    scans = [_scan(spark, files, list(names)).drop(_FILE) for names, files in layouts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_flow_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of files, folders or globs under contract names, null words turned into nulls. Every file must keep the contract."""
    return _read_files(spark, list_files(spark, paths)).drop(_FILE)


def missing_headers(columns: list[str], required: set[str] = FLOW_REQUIRED_HEADERS) -> list[str]:
    return sorted(required - {compact_header(name) for name in columns})


def flow_names(columns: list[str]) -> dict[str, str]:
    """Contract name of each column of a table; unknown columns keep their normalised name."""
    missing = missing_headers(columns)
    if missing:
        raise LayoutError("flow file lacks required columns: " + ", ".join(missing))
    compact = {name: compact_header(name) for name in columns}
    if len(set(compact.values())) != len(columns):
        raise LayoutError("flow file has headers that normalise to the same name")
    return {name: FLOW_COLUMN_NAMES.get(short, short) for name, short in compact.items()}


def named_columns(names: dict[str, str]) -> list[Column]:
    """Columns under their contract name, null words turned into nulls."""
    return [null_tokens_to_null(F.col(f"`{old}`")).alias(new) for old, new in names.items()]


def with_flow_names(raw: DataFrame) -> DataFrame:
    """A table of raw text rows under contract names."""
    return raw.select(*named_columns(flow_names(raw.columns)))


def read_flow(spark: SparkSession, paths: str | list[str], month: str, kind: str = "MOV") -> DataFrame:
    """Named text rows of one file group with its ``kind`` and the month it was published for."""
    if kind != "MOV":
        kind = checked_kind(kind)
    return read_flow_rows(spark, paths).withColumns({"file_kind": F.lit(kind), "ingest_competence": F.lit(month)})


def read_flow_files(spark: SparkSession, loads: list[tuple[str, str, str]]) -> DataFrame:
    """Rows of (path, month, kind) loads of any number of months: one scan per layout; each row learns month and kind from its file."""
    of_file: dict[str, tuple[str, str]] = {}
    for path, month, kind in loads:
        own = (month, kind if kind == "MOV" else checked_kind(kind))
        for file in list_files(spark, path):
            if of_file.setdefault(file, own) != own:
                raise LayoutError(f"{file} is given for two months or kinds")
    spelled = [(name, k, m) for f, (m, k) in of_file.items() for name in spelled_in_rows(spark, f)]
    # A small row per file, listed on the driver: sent to every task, so that the rows themselves are not dealt out by file.
    known = F.broadcast(spark.createDataFrame(spelled, f"{_FILE} string, file_kind string, ingest_competence string"))
    rows = _read_files(spark, sorted(of_file)).join(known, _FILE, "left")
    unknown = F.raise_error(F.concat(F.lit("a row of a file that was not given: "), F.col(_FILE))).cast("string")
    return rows.withColumn("file_kind", F.coalesce("file_kind", unknown)).drop(_FILE)
