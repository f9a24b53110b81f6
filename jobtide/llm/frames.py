"""Column and frame helpers shared by the operators."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import jobtide
from jobtide.sources.tables import scratch_path

#: A word: a longest run of characters other than space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def text_of(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps read it column by column, survive lost executors and never repeat the work above it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def strings(column: pa.Array) -> list[str]:
    """Arrow strings as Python text; null counts as empty."""
    return ["" if value is None else value for value in column.to_pylist()]


def _ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_jobtide_shipped", False):
        return
    packed, root = io.BytesIO(), Path(jobtide.__file__).parent
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    path = f"{scratch_path(spark, 'package')}/jobtide.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path)
    context._jobtide_shipped = True


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    _ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
