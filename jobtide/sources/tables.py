"""Table sinks and scans. Published tables are partitioned by month (and kind), so a month is read or replaced alone."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """zstd Parquet. Rows are clustered by the partition columns first, so each partition has few files, but a hot
    partition still splits: the number of tasks follows its size (AQE rebalance)."""
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *partition_by)
    out = writer.write.mode(mode).option("compression", "zstd")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def _stored_parts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame | None:
    """``folder`` and partition values, as text, of the table's partitions; None where there is no table yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    file = F.col("_metadata.file_path")
    value = lambda c: F.regexp_extract(file, f"/{c}=([^/]*)/", 1)
    text = lambda c: F.when(value(c) != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(value(c), F.lit("+"), F.lit("%2B"))))
    return spark.read.parquet(path).select(F.regexp_replace(file, "/[^/]*$", "").alias("folder"), *[text(c).alias(c) for c in columns]).distinct()


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], keys: DataFrame | None = None) -> None:
    """Idempotent load: the partitions present in ``df`` are replaced, all others stay.

    With ``keys`` (the values of the first partition column that this load covers), partitions of those keys that ``df``
    does not fill are removed too, so nothing of an earlier load of them is left.
    """
    spark, stale = df.sparkSession, []
    stored = _stored_parts(spark, path, partition_by) if keys is not None else None
    if stored is not None:
        first = partition_by[0]
        covered = keys.select(F.col(first).cast("string").alias("key")).distinct()
        filled = df.select(*[F.col(c).cast("string").alias(f"new_{c}") for c in partition_by]).distinct()
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in partition_by])
        old = stored.join(covered, F.col(first).eqNullSafe(F.col("key")), "left_semi").join(filled, same, "left_anti")
        stale = [row.folder for row in old.select("folder").collect()]
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    for folder in stale:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(folder))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def require_row_counts(spark: SparkSession, path: str, expected: DataFrame, key: str, keys: DataFrame | None = None) -> None:
    """Compare the stored row count of each loaded key with the rows that were to be written; ``keys`` names loaded keys
    that may have no rows."""
    wanted = expected.groupBy(key).agg(F.count(F.lit(1)).alias("wanted"))
    stored = spark.read.parquet(path).groupBy(key).agg(F.count(F.lit(1)).alias("stored"))
    every = wanted.select(key).union(keys.select(key)).distinct() if keys is not None else wanted.select(key)
    counts = every.join(wanted, key, "left").join(stored, key, "left").na.fill(0, ["wanted", "stored"])
    wrong = counts.where("stored <> wanted").limit(1).collect()
    if wrong:
        raise ConsistencyError(f"{path}: {key}={wrong[0][key]} holds {wrong[0].stored} rows, not {wrong[0].wanted}")


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Concatenate parts whose schemas (names, order and types) are equal."""
    shape = [(f.name, f.dataType) for f in parts[0].schema.fields]
    for part in parts[1:]:
        if [(f.name, f.dataType) for f in part.schema.fields] != shape:
            raise LayoutError("parts do not share one schema")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path in a folder that driver and executors share; it is removed when the driver ends.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, else the warehouse, which is shared too. A
    machine-local temporary folder is never used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/jobtide-{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame that several results need to shared storage and read it back.

    Cuts the lineage and survives the loss of any executor; the next reader prunes columns and partitions.
    """
    path = scratch_path(df.sparkSession, label)
    write_table(df, path, partition_by)
    return df.sparkSession.read.parquet(path)
