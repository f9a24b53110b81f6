"""File manifests: what was ingested, when, and the hash that identifies its bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError
from jobtide.fixed_values import EXPECTED_PARTS_BY_YEAR
from jobtide.sources.files import exact_path, file_of_row, list_files
from jobtide.sources.tables import scratch_path

MANIFEST_SCHEMA = (
    "source string, competence string, original_name string, size_bytes bigint, sha256 string, "
    "ingested_at_utc string, transport string, source_url string"
)


def file_facts(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """Path, name, size and SHA-256 of files. For artifacts: a file is one value and must stay below 2 GiB (``file_digests`` takes any size)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return files.load(paths).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("original_name"),
        F.col("length").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def _line_hasher():
    """The function that runs in tasks. It is made here so that it travels whole."""

    def hashed(batches):
        import hashlib

        import pyarrow as pa

        def ended(file, size, last, length, digests):
            """The reader leaves out a byte order mark at the start; whether it did, and whether the last line is ended, the sizes tell."""
            closed, missing = (b"\n", size - length - 1) if size - length in (1, 4) else (b"", size - length)
            digest = digests[1 if missing == 3 else 0]
            digest.update(last + closed)
            known = missing in (0, 3)
            return file, size, digest.hexdigest() if known else None

        now = last = size = None
        length, digests = 0, ()
        for batch in batches:
            done = []
            for file, whole, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != now:
                    if now is not None:
                        done.append(ended(now, size, last, length, digests))
                    now, size, last, length, digests = file, whole, line, len(line), (hashlib.sha256(), hashlib.sha256(b"\xef\xbb\xbf"))
                    continue
                for d in digests:
                    d.update(last + b"\n")
                last, length = line, length + 1 + len(line)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(("file", "size", "sha256"), r, strict=True)) for r in done])
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "size", "sha256"), ended(now, size, last, length, digests), strict=True))])

    return hashed


#: Larger than any file, so that a file is one split and several files never share one.
_WHOLE_FILE = str(1 << 50)


def file_digests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Path, name, size and SHA-256 of files of any size, below folders and globs too.

    A digest needs a file's bytes in order, so each file is one task, which takes them as lines, some thousand at a time; no file is held as
    a whole. Files that Hadoop would unpack while reading lines are taken as one value (below 2 GiB). The result is stored, as it is a row a
    file and hashing reads every byte.
    """
    files = list_files(spark, paths)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    packed = [f for f in files if codecs.getCodec(spark._jvm.org.apache.hadoop.fs.Path(f)) is not None]
    plain = sorted(set(files) - set(packed))
    found = []
    if plain:
        session = spark.newSession()
        for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            session.conf.set(name, _WHOLE_FILE)
        lines = session.read.option("lineSep", "\n").text([exact_path(f) for f in plain])
        rows = lines.select(file_of_row().alias("file"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"))
        path = scratch_path(spark, "digests")
        rows.mapInArrow(_line_hasher(), "file string, size long, sha256 string").write.parquet(path)
        hashes = spark.read.schema("file string, size long, sha256 string").parquet(path)
        # A file without a byte, which Spark does not list, or with nothing but a byte order mark has no line.
        lengths = spark.read.format("binaryFile").load([exact_path(f) for f in plain]).select(file_of_row().alias("file"), "length")
        none = F.sha2(F.when(F.col("length") > 0, F.unhex(F.lit("EFBBBF"))).otherwise(F.unhex(F.lit(""))), 256)
        every = spark.createDataFrame([(f,) for f in plain], "file string").join(lengths, "file", "left").join(hashes, "file", "left")
        found.append(every.select("file", F.coalesce("length", F.lit(0).cast("long")).alias("size_bytes"), F.when(F.col("size").isNull(), none).otherwise(F.col("sha256")).alias("sha256")))
    if packed:
        whole = spark.read.format("binaryFile").load([exact_path(f) for f in packed])
        found.append(whole.select(file_of_row().alias("file"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")))
    if not found:
        return spark.createDataFrame([], "path string, original_name string, size_bytes long, sha256 string")
    facts = reduce(DataFrame.unionByName, found)
    return facts.select(F.col("file").alias("path"), F.element_at(F.split("file", "/"), -1).alias("original_name"), "size_bytes", "sha256")


def build_manifests(files: DataFrame, source: Column, competence: Column, ingested_at: Column) -> DataFrame:
    return files.select(
        source.alias("source"),
        competence.alias("competence"),
        "original_name",
        "size_bytes",
        "sha256",
        ingested_at.alias("ingested_at_utc"),
    )


def read_manifests(spark: SparkSession, directory: str) -> DataFrame:
    reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True)
    return reader.json(directory, multiLine=True, pathGlobFilter="*.manifest.json")


def ingest_decisions(new: DataFrame, stored: DataFrame, name: str = "original_name") -> DataFrame:
    """``action`` per new file: ``ingest`` (name unknown), ``skip`` (same bytes), ``conflict`` (other bytes)."""
    known = stored.select(F.col(name), F.col("sha256").alias("stored_sha256")).distinct()
    # A name can be stored once only; should history hold several hashes, any difference is a conflict.
    known = known.groupBy(name).agg(F.min("stored_sha256").alias("first"), F.max("stored_sha256").alias("last"))
    same = (F.col("first") == F.col("sha256")) & (F.col("last") == F.col("sha256"))
    action = F.when(F.col("first").isNull(), F.lit("ingest")).when(same, F.lit("skip")).otherwise(F.lit("conflict"))
    return new.join(known, name, "left").withColumn("action", action).drop("first", "last")


def require_no_conflict(decisions: DataFrame, name: str = "original_name") -> None:
    bad = decisions.where("action = 'conflict'").select(name).limit(1).collect()
    if bad:
        raise ConsistencyError(f"another file named {bad[0][0]} is already stored")


def manifest_coverage(manifests: DataFrame) -> DataFrame:
    """Number of manifests and the sorted distinct months they cover."""
    return manifests.agg(
        F.count(F.lit(1)).alias("manifests"),
        F.sort_array(F.collect_set("competence")).alias("competencies"),
    )


def latest_mov_manifests(manifests: DataFrame) -> DataFrame:
    """Newest MOV manifest of every month, recognised by file name or source."""
    is_mov = F.contains(F.upper("original_name"), F.lit("CAGEDMOV")) | F.contains(F.lower("source"), F.lit("_mov"))
    newest = F.max_by(
        F.struct(*[c for c in manifests.columns if c != "competence"]), F.coalesce("ingested_at_utc", F.lit(""))
    )
    return manifests.where(is_mov).groupBy("competence").agg(newest.alias("m")).select("competence", "m.*")


def merge_part_manifests(parts: DataFrame, year: int) -> DataFrame:
    """One row per source file of the regional manifests, repaired, with a ``problem`` text or null.

    ``parts`` has one row per regional manifest: ``year`` and ``files`` (array of structs). An old spelling of the
    month key is accepted. Problems: other year, not exactly one file, other month, incomplete or repeated entry.
    """
    fields = parts.schema["files"].dataType.elementType.fieldNames()
    keys = [F.col(f"f.{name}") for name in ("competence", "comptence") if name in fields]
    text = lambda name: F.coalesce(F.col(f"f.{name}"), F.lit("")) if name in fields else F.lit("")
    entries = parts.select(
        "year",
        F.size("files").alias("file_count"),
        F.explode_outer("files").alias("f"),
    ).select(
        "year",
        "file_count",
        F.coalesce(*[F.nullif(k.cast("string"), F.lit("")) for k in keys], F.lit(str(year))).alias("competence"),
        text("path").alias("path"),
        text("sha256").alias("sha256"),
        F.coalesce(F.nullif(text("transport"), F.lit("")), F.lit("unknown")).alias("transport"),
    )
    repeated = entries.groupBy("path").agg(F.count(F.lit(1)).alias("copies"))
    problem = (
        F.when(F.coalesce(F.col("year"), F.lit(0)) != year, F.lit("other year"))
        .when(F.col("file_count") != 1, F.lit("not exactly one file"))
        .when(F.col("competence") != str(year), F.lit("other month"))
        .when((F.col("path") == "") | (F.length("sha256") != 64), F.lit("incomplete provenance"))
        .when(F.col("copies") > 1, F.lit("repeated file"))
    )
    return entries.join(repeated, "path").withColumn("problem", problem).drop("file_count", "copies")


def merged_transport(entries: DataFrame) -> DataFrame:
    """The transport all files share, or ``mixed``, and the sorted list."""
    transports = F.sort_array(F.collect_set("transport"))
    return entries.agg(transports.alias("transports")).select(
        F.when(F.size("transports") == 1, F.get("transports", 0)).otherwise(F.lit("mixed")).alias("transport"),
        "transports",
    )


def require_clean_entries(entries: DataFrame) -> None:
    bad = entries.where("problem is not null").select("path", "problem").limit(1).collect()
    if bad:
        raise ConsistencyError(f"{bad[0].path or 'part manifest'}: {bad[0].problem}")


def part_set_problems(parts: DataFrame, year: int) -> DataFrame:
    """Completeness of a part set as one row of counts and a ``complete`` flag.

    ``parts`` lists the pieces found as (kind, year) with kind in quality, silver, reject, manifest.
    """
    kinds = ["quality", "silver", "reject", "manifest"]
    counts = parts.agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in kinds],
        F.count_if(~F.col("year").eqNullSafe(F.lit(year))).alias("other_year"),
    )
    expected = EXPECTED_PARTS_BY_YEAR.get(year)
    size_ok = F.col("quality") == expected if expected else F.col("quality") > 0
    equal = (F.col("silver") == F.col("quality")) & (F.col("reject") == F.col("quality"))
    return counts.withColumn(
        "complete", size_ok & equal & (F.col("manifest") == F.col("quality")) & (F.col("other_year") == 0)
    )


def artifact_provenance(files: DataFrame, published: DataFrame) -> DataFrame:
    """Files that belong to a published month or year: the key is the trailing number of the file name."""
    key = F.regexp_extract("original_name", r"(\d{4}(?:\d{2})?)\.[^.]+$", 1)
    keyed = files.withColumn("competence", key)
    return keyed.join(published.select("competence").distinct(), "competence", "left_semi")
