"""Files of a load as Hadoop's file systems list them, and their first lines, read without the rest of the file."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.errors import LayoutError

#: A first line longer than this is no header.
HEADER_BYTES = 1 << 20


def list_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Data files at paths, folders (with their folders) or globs, in order of their path; names that start with . or _ are left out."""
    out: set[str] = set()
    for path in [paths] if isinstance(paths, str) else paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        waiting = list(system.globStatus(place) or [])
        if not waiting:
            raise LayoutError(f"no file at {path}")
        while waiting:
            status = waiting.pop()
            if status.isDirectory():
                waiting += [s for s in system.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
            else:
                out.add(status.getPath().toString())
    return sorted(out)


def exact_path(path: str) -> str:
    """A path for Spark's readers, which take it for a glob otherwise."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _first_line(spark: SparkSession, path: str) -> str | None:
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        line = hadoop.io.Text()
        read = hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream).readLine(line, HEADER_BYTES, HEADER_BYTES)
        if line.getLength() >= HEADER_BYTES:
            raise LayoutError(f"{path}: the first line is longer than {HEADER_BYTES} bytes")
        return line.toString().removeprefix("﻿") if read else None
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, header_line) of each file; null for a file without a byte. The driver reads the first block of each file, no more."""
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    return spark.createDataFrame(list(zip(files, lines, strict=True)), "path string, header_line string")


def file_of_row() -> Column:
    """The file that a row was read from, spelled as :func:`list_files` does."""
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def spelled_in_rows(spark: SparkSession, file: str) -> set[str]:
    """How rows may name a file that :func:`list_files` found: the other way round from :func:`file_of_row`, done once per file."""
    name = spark._jvm.org.apache.hadoop.fs.Path(file).toUri().toString()
    return {name, re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", r"\1:///", name)}
