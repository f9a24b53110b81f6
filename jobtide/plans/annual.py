"""Annual pipeline: regional text files to published stock tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.errors import LayoutError
from jobtide.fixed_values import OCCUPATION_FAMILIES
from jobtide.operators import contracts, gates, quality, stock
from jobtide.operators.stock import ValueContract
from jobtide.sources.layout import inspect_layouts
from jobtide.sources.stock_text import read_stock_text
from jobtide.sources.tables import read_table, write_table


STATUS_COLUMNS = ["active_raw", "abandoned_raw"]


def build_value_checks(spark: SparkSession, raw: DataFrame, root: str, contract: ValueContract) -> DataFrame:
    """Store what the files hold before any row is routed: every value of the status columns by file (``value_counts``), a profile of the four columns by
    file and over all files (``profile``), and the contract of each status column (``value_contract``), which is returned. All rows count, no sample."""
    counts = quality.value_counts(raw, STATUS_COLUMNS, ["source_file"])
    write_table(counts, f"{root}/value_counts")
    write_table(quality.profile_by_file_and_overall(raw, "source_file", stock.RAW), f"{root}/profile")
    accepted = {"active_raw": (contract.active, contract.inactive), "abandoned_raw": (contract.eligible, contract.excluded)}
    stored = read_table(spark, f"{root}/value_counts")
    checks = [
        contracts.binary_value_contract(stored.where(F.col("concept") == name).select("value", "n"), *values).withColumn("concept", F.lit(name))
        for name, values in accepted.items()
    ]
    write_table(reduce(DataFrame.unionByName, checks), f"{root}/value_contract")
    return read_table(spark, f"{root}/value_contract")


def require_values(checks: DataFrame) -> None:
    """Stop on a status column with an unknown or blank value, or without one of its two classes."""
    bad = checks.where(~F.col("valid")).select("concept", "unknown_values", "unknown_count", "blank_values").collect()
    if bad:
        raise LayoutError("; ".join(f"{r.concept}: {r.unknown_count} unknown values ({', '.join(r.unknown_values[:5])}), {r.blank_values} blanks" for r in bad))


def build_stock_silver(
    spark: SparkSession,
    directory: str,
    root: str,
    year: int,
    contract: ValueContract = ValueContract(),
    families: Iterable[str] = tuple(OCCUPATION_FAMILIES),
) -> None:
    """One scan per distinct file layout; values are held against their contract, then all rows stored with their status; scope and rejects read it
    back pruned."""
    write_table(read_stock_text(spark, inspect_layouts(spark, directory)), f"{root}/raw")
    raw = read_table(spark, f"{root}/raw")
    require_values(build_value_checks(spark, raw, root, contract))
    write_table(stock.stock_silver(raw, contract, families), f"{root}/rows", ["status"])
    rows = read_table(spark, f"{root}/rows")
    routed = stock.route_stock(rows, year, stored=True)
    write_table(routed.scope, f"{root}/scope")
    write_table(routed.rejected, f"{root}/rejects")
    write_table(stock.with_stock_identities(stock.stock_counters(rows, ["source_file"])), f"{root}/parts")


def reconcile(spark: SparkSession, root: str, year: int, official: DataFrame) -> DataFrame:
    national = stock.merge_stock_counters(read_table(spark, f"{root}/parts")).withColumn("year", F.lit(year))
    result = gates.annual_reconciliation(national, official)
    write_table(result, f"{root}/reconciliation")
    return read_table(spark, f"{root}/reconciliation")


def build_stock_gold(spark: SparkSession, root: str, year: int, dimension: DataFrame | None = None) -> None:
    """Published tables, only for a reconciled year."""
    scope = read_table(spark, f"{root}/scope")
    expected = stock.require_publishable_stock(scope, read_table(spark, f"{root}/reconciliation"), year)
    write_table(stock.stock_market(scope), f"{root}/market")
    write_table(stock.stock_by(scope, ["uf"]), f"{root}/by_uf")
    write_table(stock.with_family_name(stock.stock_by(scope, ["cbo_familia"])), f"{root}/by_family")
    write_table(stock.stock_overview(scope, F.lit(expected)), f"{root}/overview")
    if dimension is not None:
        places = stock.stock_by_municipality(scope, dimension)
        stock.require_clean_municipalities(places, scope.count())
        write_table(places.drop("problem"), f"{root}/by_municipality")
