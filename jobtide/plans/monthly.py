"""Monthly pipeline: files of any number of months and kinds to published tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import OCCUPATION_FAMILIES, STATE_BY_CODE
from jobtide.functions.salary import SalaryRule, with_salary_eligibility
from jobtide.operators import flow_gold, quality, serving
from jobtide.operators.flow_silver import flow_silver, route_flow
from jobtide.sources.flow_text import read_flow_files
from jobtide.sources.tables import read_table, replace_partitions, write_table


@dataclass(frozen=True)
class MonthlySettings:
    families: Mapping[str, str] = field(default_factory=lambda: dict(OCCUPATION_FAMILIES))
    labels: Mapping[str, str] = field(default_factory=lambda: dict(STATE_BY_CODE))
    salary: SalaryRule = field(default_factory=SalaryRule)
    null_flags: str = "reject"


@dataclass(frozen=True)
class MonthlyFile:
    path: str
    month: str
    kind: str = "MOV"


def build_silver(spark: SparkSession, files: list[MonthlyFile], root: str, settings: MonthlySettings) -> list[str]:
    """Hold every header against the contract, parse all files once and store every flagged row, partitioned by ingest month, kind and validity.

    Scope, rejects and reports are later reads of that table: each prunes to its partitions and columns. Returns the months whose
    published tables this load may change: those that its rows take effect in, and those of the rows that it replaces.
    """
    rows = read_flow_files(spark, [(f.path, f.month, f.kind) for f in files])
    silver = flow_silver(rows, settings.labels, settings.null_flags)
    # A row whose validity is unknown (null_flags="reference") belongs to neither table and gets its own partition.
    status = F.when(F.col("registro_invalido"), F.lit("rejected")).when(~F.col("registro_invalido"), F.lit("valid"))
    stored = silver.withColumn("row_status", F.coalesce(status, F.lit("unknown")))
    loaded = sorted({f.month for f in files})
    months = spark.createDataFrame([(m,) for m in loaded], "ingest_competence string")
    before = _touched(spark, root, loaded)
    replace_partitions(stored, f"{root}/silver", ["ingest_competence", "file_kind", "row_status"], months)
    own = read_silver(spark, root).where(F.col("ingest_competence").isin(loaded))
    index = own.select(F.col("effective_competence").cast("string").alias("effective_competence"), "file_kind", "ingest_competence").distinct()
    replace_partitions(index, f"{root}/months", ["ingest_competence"], months)
    return sorted({*loaded, *before, *_touched(spark, root, loaded)})


def read_months(spark: SparkSession, root: str) -> DataFrame:
    """The index of silver: which months the rows of each ingest month and kind take effect in. One row per combination, kept by each load."""
    rows = spark.read.schema("effective_competence string, file_kind string, ingest_competence string").parquet(f"{root}/months")
    return rows.where("effective_competence IS NOT NULL")


def _touched(spark: SparkSession, root: str, loaded: list[str]) -> list[str]:
    """Months that the stored rows of these ingest months take effect in; a few hundred texts at most."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/months")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return []
    found = read_months(spark, root).where(F.col("ingest_competence").isin(loaded)).select("effective_competence").distinct().collect()
    return [r.effective_competence for r in found]


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """Stored rows; partition columns that look like numbers are read back as the text they are."""
    rows = read_table(spark, f"{root}/silver")
    return rows.withColumn("ingest_competence", F.col("ingest_competence").cast("string"))


def build_reports(spark: SparkSession, root: str, settings: MonthlySettings) -> None:
    rows = read_silver(spark, root)
    families = sorted(settings.families)
    write_table(quality.flow_quality(rows, families, quality.FILE_KEYS), f"{root}/quality")
    write_table(quality.national_audit(rows, quality.FILE_KEYS), f"{root}/audit")
    write_table(quality.adjustment_quality(rows, families), f"{root}/adjustment_quality")


def gold_of(silver: DataFrame, settings: MonthlySettings, months: list[str] | None = None) -> DataFrame:
    """All published groupings of all months (or of these) with a base file, in one scan of the scope rows."""
    valid = silver.where("row_status = 'valid'")
    scope = route_flow(valid, settings.families, stored=True).scope
    # A base file without scope rows still makes its month a base month; this reads partition names only.
    base = silver.where("file_kind = 'MOV'").select(F.col("ingest_competence").alias("effective_competence"))
    rows = flow_gold.rows_with_base(scope, base)
    if months is not None:
        rows = rows.where(F.col("effective_competence").isin(months))
    eligible = with_salary_eligibility(rows, settings.salary, F.col("effective_competence"))
    tables = flow_gold.group_tables(eligible, common=["effective_competence"])
    return tables.withColumnRenamed("effective_competence", "competence")


def silver_of_months(spark: SparkSession, root: str, months: list[str]) -> DataFrame:
    """The partitions of silver that may hold rows of these months, by the index; the scan lists no others."""
    parts = read_months(spark, root).where(F.col("effective_competence").isin(months)).select("ingest_competence", "file_kind").distinct().collect()
    if not parts:
        return read_silver(spark, root).where("false")
    wanted = reduce(Column.__or__, [(F.col("ingest_competence") == p.ingest_competence) & (F.col("file_kind") == p.file_kind) for p in parts])
    return read_silver(spark, root).where(wanted)


def build_gold(
    spark: SparkSession, root: str, settings: MonthlySettings, index: DataFrame | None = None, base_month: str | None = None
) -> DataFrame:
    """Store the groupings by month and grain, then check them."""
    tables = gold_of(read_silver(spark, root), settings)
    if index is not None and base_month:
        tables = flow_gold.with_real_salary(tables, index, base_month, "competence")
    # Every month is computed anew, so the whole table is replaced and no group of an earlier run is left.
    write_table(tables, f"{root}/gold", ["competence", "grain"])
    stored = read_gold(spark, root)
    flow_gold.require_no_negative_groups(stored)
    flow_gold.require_balanced(stored)
    return stored


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/gold").withColumn("competence", F.col("competence").cast("string"))


def update_gold(
    spark: SparkSession, root: str, settings: MonthlySettings, months: list[str], index: DataFrame | None = None, base_month: str | None = None
) -> DataFrame:
    """Recompute these months only, from the partitions of silver that may hold their rows, replace them and check them.

    ``months`` are those that :func:`build_silver` returns. A month without a base file leaves the table, its late rows wait.
    """
    tables = gold_of(silver_of_months(spark, root, months), settings, months)
    if index is not None and base_month:
        tables = flow_gold.with_real_salary(tables, index, base_month, "competence")
    replace_partitions(tables, f"{root}/gold", ["competence", "grain"], spark.createDataFrame([(m,) for m in months], "competence string"))
    stored = read_gold(spark, root).where(F.col("competence").isin(months))
    flow_gold.require_no_negative_groups(stored)
    flow_gold.require_balanced(stored)
    return stored


def publish_months(spark: SparkSession, root: str, release_root: str, gates: DataFrame, manifests: DataFrame, months: list[str]) -> int:
    """Stored months to the four serving tables, in one step (``load_release``): all of them or none. A month that is not in gold is not loaded.

    ``gates`` has (competence, publishable), ``manifests`` (competence, sha256) of the base files. Returns the number of the release.
    """
    gold = read_gold(spark, root).where(F.col("competence").isin(months))
    grain = lambda name: flow_gold.grain_of(gold, name, ["competence"])
    quality = read_table(spark, f"{root}/quality").where("file_kind = 'MOV'")
    rates = quality.select(F.col("ingest_competence").cast("string").alias("competence"), "valid_rate")
    overview = grain("overview").withColumnRenamed("records", "records_tech")
    tables = serving.ServingTables(
        serving.serving_release(overview, rates, manifests), serving.serving_states(grain("by_uf")),
        serving.serving_occupations(grain("by_occupation")), serving.serving_municipalities(grain("by_municipality")),
    )
    return serving.load_release(spark, tables, release_root, gates)
