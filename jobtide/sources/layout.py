"""Layout inspection of annual files: encoding, delimiter, header and header signature.

The encoding is decided on all lines of a file. Files are scanned as text by Spark's reader, large ones in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.errors import LayoutError
from jobtide.fixed_values import (
    HEADER_DELIMITERS,
    HEADER_ENCODINGS,
    HEADER_MINIMUM_COLUMNS,
    STOCK_SUFFIXES,
)
from jobtide.functions.text import snake_header_column
from jobtide.sources.tables import materialize


def read_file_heads(spark: SparkSession, directory: str) -> DataFrame:
    """One row per supported file below ``directory``: path, encoding, first non-blank line (null for a file without one).
    Spark lists no files of zero bytes.

    The reader keeps the bytes of each line. UTF-8 never uses a line break inside a character, so a file decodes if all its
    lines do; otherwise the last known encoding, which decodes any bytes, is taken. A byte order mark is not part of the line.
    """
    utf8, *_, any_bytes = HEADER_ENCODINGS
    supported = F.lower("file").rlike("(" + "|".join(s.replace(".", r"\.") for s in STOCK_SUFFIXES) + ")$")
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    lines = spark.read.option("recursiveFileLookup", True).text(directory)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    marked = placed.select("file", "block", "place", F.is_valid_utf8("value").alias("valid"), F.col("value").rlike(r"(?U)\S").alias("filled"))
    # Numbers only, over all lines: they are summed up in place. The first line itself is fetched by its place, which every scan gives alike.
    blocks = marked.groupBy("file", "block").agg(F.bool_and("valid").alias("valid"), F.min(F.when(F.col("filled"), F.col("place"))).alias("place")).where(supported)
    first = F.min(F.when(F.col("place").isNotNull(), F.struct("block", "place"))).getField("place")
    heads = materialize(blocks.groupBy("file").agg(F.bool_and("valid").alias("valid"), first.alias("place")), "file-heads")
    wanted = F.broadcast(heads.where("place IS NOT NULL").select("file", "place"))  # one row per file
    raw = placed.join(wanted, ["file", "place"]).select("file", F.col("value").cast("binary").alias("raw"))
    files = names.select("path", F.col("_metadata.file_path").alias("file")).where(supported).join(heads.join(raw, "file", "left"), "file", "left")
    valid = F.coalesce("valid", F.lit(True))
    header = F.when(valid, F.decode("raw", "UTF-8")).otherwise(F.decode("raw", "ISO-8859-1"))
    return files.select("path", F.when(valid, utf8).otherwise(any_bytes).alias("encoding"), header.alias("header_line"))


def detect_delimiter(header: Column) -> Column:
    """Candidate that occurs most often, the earlier candidate on ties, null when none occurs."""
    counts = [F.length(header) - F.length(F.replace(header, F.lit(d), F.lit(""))) for d in HEADER_DELIMITERS]
    best = F.greatest(*counts)
    choice = F.lit(None).cast("string")
    for delimiter, count in reversed(list(zip(HEADER_DELIMITERS, counts, strict=True))):
        choice = F.when(count == best, F.lit(delimiter)).otherwise(choice)
    return F.when(best > 0, choice)


def split_header(header: Column, delimiter: Column) -> Column:
    """Header fields, quotes removed, blanks trimmed. A delimiter inside quotes does not split."""
    fields = F.lit(None).cast("array<string>")
    for d in HEADER_DELIMITERS:
        mark = "\\" + d if d != "\t" else r"\t"
        # A field starts at the line start or after a delimiter; the look-behind keeps empty fields.
        pattern = rf'(?:^|(?<={mark}))("(?:[^"]|"")*"|[^{mark}"]*)(?={mark}|$)'
        fields = F.when(delimiter == d, F.regexp_extract_all(header, F.lit(pattern), 1)).otherwise(fields)
    return F.transform(fields, lambda c: F.trim(F.trim(F.trim(c), F.lit('"'))))


def describe_layouts(heads: DataFrame) -> DataFrame:
    """Layout rows from (path, encoding, header_line), with the header rules as a ``problem`` text or null."""
    described = (
        heads.withColumn("file", F.element_at(F.split("path", "/"), -1))
        .withColumn("suffix", F.lower(F.regexp_extract("file", r"(\.[^.]*)$", 1)))
        .withColumn("delimiter", detect_delimiter(F.col("header_line")))
        .withColumn("columns", split_header(F.col("header_line"), F.col("delimiter")))
        .withColumn("normalized_columns", F.transform("columns", snake_header_column))
        .withColumn("column_count", F.size("normalized_columns"))
        .withColumn("header_signature_sha256", F.sha2(F.array_join("normalized_columns", "\n"), 256))
    )
    names = F.col("normalized_columns")
    problem = (
        F.when(F.col("header_line").isNull(), F.lit("file is empty"))
        .when(F.col("delimiter").isNull(), F.lit("no delimiter in header"))
        .when(F.col("column_count") < HEADER_MINIMUM_COLUMNS, F.lit("too few columns"))
        .when(F.array_contains(names, ""), F.lit("empty column name"))
        .when(F.size(F.array_distinct(names)) != F.size(names), F.lit("duplicate column name"))
    )
    return described.withColumn("problem", problem)


def inspect_layouts(spark: SparkSession, directory: str) -> DataFrame:
    return describe_layouts(read_file_heads(spark, directory))


def layout_summary(layouts: DataFrame) -> DataFrame:
    """Number of files, number of distinct layouts and the sorted signatures."""
    return layouts.agg(
        F.count(F.lit(1)).alias("files_inspected"),
        F.count_distinct("header_signature_sha256").alias("unique_layouts"),
        F.sort_array(F.collect_set("header_signature_sha256")).alias("layout_signatures"),
        F.count_if(F.col("problem").isNotNull()).alias("files_with_problem"),
    )


def require_valid_layouts(layouts: DataFrame) -> None:
    """Raise on the first files that break a header rule, or when there is no file at all."""
    broken = layouts.where(F.col("problem").isNotNull()).select("file", "problem").limit(5).collect()
    if broken:
        raise LayoutError("; ".join(f"{row.file}: {row.problem}" for row in broken))
    if layouts.isEmpty():
        raise LayoutError("no supported annual file was found")
