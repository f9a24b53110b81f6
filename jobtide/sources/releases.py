"""Several tables published as one: a load is seen whole or not at all.

Below a root, ``versions/<id>/<table>/month=<m>/`` holds the rows of one load and ``manifests/<number>.json`` names, for every table and month, the
folder that is valid now and its number of rows. A load writes its folders, checks them, and then puts the next manifest in place by a rename, which
either happens or does not. Readers take the newest manifest and read the folders it names. A load that fails leaves the release as it
was, and of two loads at the same time one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobtide.errors import ConsistencyError, LayoutError

_MONTH = "__month"


@dataclass(frozen=True)
class Part:
    """One month of a table: the folder of its rows (None for a month without rows), their number and their schema."""

    table: str
    month: str
    folder: str | None
    rows: int
    schema: str


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _newest(spark: SparkSession, root: str) -> int:
    """Number of the newest manifest, 0 where there is none."""
    place, system = _files(spark, f"{root}/manifests")
    if not system.exists(place):
        return 0
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()), default=0)


def current_parts(spark: SparkSession, root: str, number: int | None = None) -> list[Part]:
    """What is published: a small entry per table and month, from one file that never changes."""
    number = _newest(spark, root) if number is None else number
    if not number:
        return []
    lines = spark.read.text(f"{root}/manifests/{number:08d}.json").collect()
    return [Part(**json.loads(r.value)) for r in lines]


def _commit(spark: SparkSession, root: str, number: int, parts: list[Part]) -> None:
    """The manifest appears whole under its number; a number that is taken is an error."""
    jvm = spark._jvm
    target, system = _files(spark, f"{root}/manifests/{number:08d}.json")
    draft, _ = _files(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    system.mkdirs(target.getParent())
    out = system.create(draft)
    out.write(bytearray("".join(json.dumps(asdict(p), sort_keys=True) + "\n" for p in sorted(parts, key=lambda p: (p.table, p.month))).encode()))
    out.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    qualified = [system.makeQualified(p) for p in (draft, target)]
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified[1].toUri(), spark._jsc.hadoopConfiguration()).rename(*qualified, rename)
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise ConsistencyError(f"{root}: another load was published meanwhile") from error
        raise


def _observed(seen: Observation) -> int:
    """Rows that went through a write; none where Spark knew the frame to be empty and left the observer out."""
    try:
        return seen.get["n"]
    except (Py4JError, KeyError):
        return 0


def _write_part(df: DataFrame, path: str, table: str, month: str, months: list[str]) -> list[Part]:
    """Store a table's rows by month and compare the stored numbers with those that went into the write."""
    seen = Observation(f"load-{uuid.uuid4().hex}")
    rows = df.withColumn(_MONTH, F.col(month).cast("string")).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.hint("rebalance", _MONTH).write.option("compression", "zstd").partitionBy(_MONTH).parquet(path)
    wanted = _observed(seen)
    stored = df.sparkSession.read.schema(f"{_MONTH} string").parquet(path)
    counts = {r[_MONTH]: r.n for r in stored.groupBy(_MONTH).agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(counts.values()) != wanted:
        raise ConsistencyError(f"{table}: {sum(counts.values())} rows are stored, not {wanted}")
    if other := set(counts) - set(months):
        raise ConsistencyError(f"{table} has rows of months that this load does not cover: {sorted(other)[:5]}")
    schema = json.dumps(df.schema.jsonValue())
    return [Part(table, m, f"{path}/{_MONTH}={m}" if m in counts else None, counts.get(m, 0), schema) for m in months]


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], months: list[str], month: str = "competence") -> int:
    """Replace these months in all the tables at once; other months and tables stay. Returns the number of the release.

    A month for which a table has no rows is empty afterwards. Loading the same rows again gives the same tables.
    """
    number = _newest(spark, root)
    old, version = current_parts(spark, root, number), f"{root}/versions/{uuid.uuid4().hex}"
    try:
        new = [p for name, df in tables.items() for p in _write_part(df, f"{version}/{name}", name, month, sorted(months))]
        replaced = {(p.table, p.month) for p in new}
        _commit(spark, root, number + 1, [p for p in old if (p.table, p.month) not in replaced] + new)
    except BaseException:
        place, system = _files(spark, version)
        system.delete(place, True)
        raise
    return number + 1


def read_release(spark: SparkSession, root: str, table: str, months: list[str] | None = None, number: int | None = None) -> DataFrame:
    """Rows of a published table, all or some months, in one scan of the valid folders. With ``number``, as that release had them, while
    its folders exist."""
    parts = [p for p in current_parts(spark, root, number) if p.table == table]
    if not parts:
        raise LayoutError(f"{root}: no table {table} is published")
    schemas = {p.schema for p in parts if p.folder} or {parts[0].schema}
    if len(schemas) > 1:
        raise LayoutError(f"{table}: months were published with different columns")
    schema = StructType.fromJson(json.loads(schemas.pop()))
    folders = [p.folder for p in parts if p.folder and (months is None or p.month in months)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)


def remove_unused(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete folders that none of the last releases names, and older manifests. Not while a load is running."""
    newest = _newest(spark, root)
    kept = range(max(1, newest - keep + 1), newest + 1)
    used = {p.folder.split("/versions/")[1].split("/")[0] for n in kept for p in current_parts(spark, root, n) if p.folder}
    versions, system = _files(spark, f"{root}/versions")
    for status in system.listStatus(versions) if system.exists(versions) else []:
        if status.getPath().getName() not in used:
            system.delete(status.getPath(), True)
    manifests, _ = _files(spark, f"{root}/manifests")
    for status in system.listStatus(manifests) if system.exists(manifests) else []:
        name = status.getPath().getName()
        if name.endswith(".json") and int(name.removesuffix(".json")) not in kept:
            system.delete(status.getPath(), False)
