"""Annual stock: row routing, counters and published tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError
from jobtide.fixed_values import (
    ABANDONED_ELIGIBLE_VALUES,
    ABANDONED_EXCLUDED_VALUES,
    ACTIVE_VALUES,
    INACTIVE_VALUES,
    OCCUPATION_FAMILIES,
    RESIDUAL_MUNICIPALITY,
    RESIDUAL_MUNICIPALITY_NAME,
    STOCK_COUNTERS,
    STOCK_REJECT_REASONS,
    UNIDENTIFIED_STATE,
)
from jobtide.functions.codes import literal_map, municipality_code, occupation_code, occupation_family, state_of_municipality
from jobtide.functions.rates import share
from jobtide.functions.text import comparable_value
from jobtide.operators.joins import evaluate_once


@dataclass(frozen=True)
class ValueContract:
    """Accepted values of the two status columns, already in comparable form."""

    active: tuple[str, ...] = tuple(ACTIVE_VALUES)
    inactive: tuple[str, ...] = tuple(INACTIVE_VALUES)
    eligible: tuple[str, ...] = tuple(ABANDONED_ELIGIBLE_VALUES)
    excluded: tuple[str, ...] = tuple(ABANDONED_EXCLUDED_VALUES)


@dataclass(frozen=True)
class RoutedStock:
    """``scope`` and ``rejected`` carry the fixed output columns; both are filters over one routed frame."""

    scope: DataFrame
    rejected: DataFrame


def stock_silver(
    raw: DataFrame, contract: ValueContract = ValueContract(), families: Iterable[str] = tuple(OCCUPATION_FAMILIES)
) -> DataFrame:
    """Every raw row with codes, status, reject reasons and its ``status``.

    ``raw`` has cbo_raw, municipio_raw, active_raw, abandoned_raw and source_file. ``status`` is one of rejected,
    inactive, abandoned, out_of_scope, scope: each row has exactly one.
    """
    trimmed = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in RAW}
    coded = raw.withColumns(trimmed).withColumns(
        {
            "active": comparable_value(F.col("active_raw")),
            "abandoned": comparable_value(F.col("abandoned_raw")),
            "cbo_codigo": occupation_code(F.col("cbo_raw")),
            "municipio_codigo": municipality_code(F.col("municipio_raw")),
        }
    )
    coded = coded.withColumns(
        {"uf": state_of_municipality(F.col("municipio_codigo")), "cbo_familia": occupation_family(F.col("cbo_codigo"))}
    )
    active, abandoned = F.col("active"), F.col("abandoned")
    failed = [
        ~active.isin(*contract.active, *contract.inactive),
        ~abandoned.isin(*contract.eligible, *contract.excluded),
        F.col("cbo_codigo").isNull(),
        F.col("municipio_codigo").isNull(),
        F.col("municipio_codigo").isNotNull() & F.col("uf").isNull(),
    ]
    reasons = F.array_compact(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in zip(STOCK_REJECT_REASONS, failed, strict=True)])
    )
    status = (
        F.when(F.size("reasons") > 0, F.lit("rejected"))
        .when(active.isin(*contract.inactive), F.lit("inactive"))
        .when(abandoned.isin(*contract.excluded), F.lit("abandoned"))
        .when(~F.col("cbo_familia").isin(sorted(families)), F.lit("out_of_scope"))
        .otherwise(F.lit("scope"))
    )
    source_status = (
        F.when(active.isin(*contract.active) & abandoned.isin(*contract.eligible), F.lit("eligible"))
        .when(active.isin(*contract.active) & abandoned.isin(*contract.excluded), F.lit("abandoned"))
        .when(active.isin(*contract.active), F.lit("unknown_abandoned"))
        .when(active.isin(*contract.inactive), F.lit("inactive"))
        .otherwise(F.lit("unknown"))
    )
    return coded.withColumn("reasons", reasons).withColumns({"status": status, "source_status": source_status})


RAW = ["cbo_raw", "municipio_raw", "active_raw", "abandoned_raw"]


def route_stock(silver: DataFrame, year: int, stored: bool = False) -> RoutedStock:
    """Scope and rejects. ``stored`` says that ``silver`` was read back from a table, so its filters go to the scan."""
    rows = silver if stored else evaluate_once(silver, [*RAW, "source_file", "cbo_codigo", "cbo_familia", "municipio_codigo", "uf", "reasons", "status"])
    scope = rows.where("status = 'scope'").select(
        F.lit(year).cast("smallint").alias("year"),
        "cbo_codigo", "cbo_familia", "municipio_codigo", "uf", F.lit(True).alias("active_3112"), "source_file",
    )
    rejected = rows.where("status = 'rejected'").select(
        "source_file",
        F.lit(str(year)).alias("year_context"),
        "cbo_raw",
        "municipio_raw",
        F.coalesce("uf", F.lit("")).alias("uf_derived"),
        "active_raw",
        "abandoned_raw",
        F.array_join("reasons", ",").alias("reason"),
    )
    return RoutedStock(scope, rejected)


# ---------------------------------------------------------------------------------------------------------------
# Counters
# ---------------------------------------------------------------------------------------------------------------


def stock_counters(silver: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The 14 row counters and the reject count of each reason, in one pass, for all rows or per ``by`` group."""
    status, source = F.col("status"), F.col("source_status")
    counters = {
        "rows_read": F.lit(True),
        "rows_valid": status != "rejected",
        "rows_rejected": status == "rejected",
        "rows_active": status.isin("scope", "out_of_scope"),
        "rows_inactive": status == "inactive",
        "rows_active_source": source.isin("eligible", "abandoned", "unknown_abandoned"),
        "rows_abandoned_source": source == "abandoned",
        "rows_stock_eligible_source": source == "eligible",
        "rows_unknown_abandoned_source": source == "unknown_abandoned",
        "rows_inactive_source": source == "inactive",
        "rows_unknown_status_source": source == "unknown",
        # The year comes from the yearly context, so no row can disagree with it.
        "rows_year_mismatch_source": F.lit(False),
        "rows_residual_municipality": F.col("municipio_codigo") == RESIDUAL_MUNICIPALITY,
        "rows_tech": status == "scope",
    }
    reasons = {name: F.array_contains("reasons", name) for name in STOCK_REJECT_REASONS}
    return silver.groupBy(*(by or [])).agg(
        *[F.count_if(condition).alias(name) for name, condition in {**counters, **reasons}.items()]
    )


def with_stock_identities(counters: DataFrame) -> DataFrame:
    """Valid rate and the two identities a complete partition must satisfy."""
    source = sum((F.col(c) for c in _SOURCE[1:]), F.col(_SOURCE[0]))
    active = (
        F.col("rows_stock_eligible_source") + F.col("rows_abandoned_source") + F.col("rows_unknown_abandoned_source")
    )
    return counters.withColumns(
        {
            "source_partition_complete": F.col("rows_read") == source,
            "stock_partition_complete": F.col("rows_active_source") == active,
            "valid_rate": share(F.col("rows_valid"), F.col("rows_read")),
        }
    )


_SOURCE = [
    "rows_active_source", "rows_inactive_source", "rows_unknown_status_source", "rows_year_mismatch_source",
]


def merge_stock_counters(parts: DataFrame) -> DataFrame:
    """National report from part reports: counters are summed, identities must hold in every part and in the sum."""
    summed = parts.agg(
        *[F.sum(c).alias(c) for c in [*STOCK_COUNTERS, *STOCK_REJECT_REASONS]],
        F.bool_and("source_partition_complete").alias("__source"),
        F.bool_and("stock_partition_complete").alias("__stock"),
        F.count(F.lit(1)).alias("parts_merged"),
    )
    merged = with_stock_identities(summed)
    return merged.withColumns(
        {
            "source_partition_complete": F.col("__source") & F.col("source_partition_complete"),
            "stock_partition_complete": F.col("__stock") & F.col("stock_partition_complete"),
        }
    ).drop("__source", "__stock")


def merge_reason_maps(parts: DataFrame, column: str = "rejection_counts") -> DataFrame:
    """Sum of reject counts given as maps, one row per reason."""
    return parts.select(F.explode(column).alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("rows"))


# ---------------------------------------------------------------------------------------------------------------
# Guards before publication
# ---------------------------------------------------------------------------------------------------------------


def stock_guard(scope: DataFrame, year: int, families: Iterable[str], expected_active: int) -> DataFrame:
    """One row with the violations that forbid publication and an ``ok`` flag."""
    counts = scope.agg(
        F.count(F.lit(1)).alias("stock"),
        F.count_if(~F.col("year").eqNullSafe(F.lit(year))).alias("other_year"),
        F.count_if(~F.coalesce("active_3112", F.lit(False))).alias("not_active"),
        F.count_if(~F.coalesce(F.col("cbo_familia").isin(sorted(families)), F.lit(False))).alias("outside_scope"),
    )
    ok = (F.col("other_year") + F.col("not_active") + F.col("outside_scope") == 0) & (
        F.col("stock") <= F.lit(expected_active)
    )
    return counts.withColumn("ok", ok)


def unknown_families(scope: DataFrame, families: DataFrame) -> DataFrame:
    """Distinct families of the rows that the scope table does not list."""
    return scope.select("cbo_familia").distinct().join(families, "cbo_familia", "left_anti")


def require_stock_columns(df: DataFrame) -> None:
    missing = {"year", "cbo_codigo", "cbo_familia", "uf", "active_3112"} - set(df.columns)
    if missing:
        raise LayoutError("stock table lacks columns: " + ", ".join(sorted(missing)))


def require_publishable_stock(
    scope: DataFrame, reconciliation: DataFrame, year: int, families: Iterable[str] = tuple(OCCUPATION_FAMILIES)
) -> int:
    """National total to relate the stock to, or an error when reconciliation or rows forbid publication."""
    require_stock_columns(scope)
    row = reconciliation.where(F.col("year") == year).limit(1).collect()
    if not row or not (row[0].reconciled and row[0].gold_ready):
        raise ConsistencyError(f"annual stock {year} is not reconciled with its official total")
    expected = row[0].expected_active
    if not expected or expected <= 0:
        raise ConsistencyError("reconciliation has no valid official total")
    guard = stock_guard(scope, year, families, expected).collect()[0]
    if not guard.ok:
        raise ConsistencyError(f"stock rows break a publication rule: {guard.asDict()}")
    return expected


# ---------------------------------------------------------------------------------------------------------------
# Published tables
# ---------------------------------------------------------------------------------------------------------------


def stock_market(scope: DataFrame) -> DataFrame:
    return scope.groupBy("year", "uf", "cbo_familia", "cbo_codigo").agg(F.count(F.lit(1)).alias("active_stock"))


def with_stock_share(counts: DataFrame) -> DataFrame:
    """Share of each group in the whole. The total is a scalar subquery over the same aggregate, whose shuffle is
    reused: no second scan, no single-task window."""
    total = counts.agg(F.sum("active_stock")).scalar()
    return counts.withColumn("share_of_tech_stock", share(F.col("active_stock"), total))


def stock_by(scope: DataFrame, by: list[str]) -> DataFrame:
    return with_stock_share(scope.groupBy(*by).agg(F.count(F.lit(1)).alias("active_stock")))


def with_family_name(table: DataFrame, families: Mapping[str, str] = OCCUPATION_FAMILIES) -> DataFrame:
    """Name of each family from the configured scope; a family without a name fails the job."""
    error = F.raise_error(F.concat(F.lit("family without a name: "), F.col("cbo_familia"))).cast("string")
    name = F.coalesce(F.try_element_at(literal_map(families), F.col("cbo_familia")), error)
    return table.withColumn("cbo_familia_nome", name)


def stock_overview(scope: DataFrame, expected_active: Column) -> DataFrame:
    """Scope stock, its share of the national stock, states and cube rows, all from the small cube."""
    cube = scope.groupBy("uf", "cbo_familia", "cbo_codigo").agg(F.count(F.lit(1)).alias("n"))
    counts = cube.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("active_stock_tech"),
        F.count_distinct("uf").alias("uf_count"),
        F.count(F.lit(1)).alias("market_rows"),
    )
    total = counts.withColumn("active_stock_national_reference", expected_active)
    return total.withColumn(
        "share_tech_of_national_active", share(F.col("active_stock_tech"), F.col("active_stock_national_reference"))
    )


def stock_by_municipality(scope: DataFrame, dimension: DataFrame) -> DataFrame:
    """Stock per municipality with its name and share. ``problem`` is set where code or state do not match."""
    counts = scope.groupBy("municipio_codigo", "uf").agg(F.count(F.lit(1)).alias("active_stock"))
    shares = with_stock_share(counts)
    names = dimension.select(
        F.col("prefix").alias("municipio_codigo"), "municipio_codigo_ibge", "municipio_nome", F.col("uf").alias("__uf")
    )
    residual = F.col("municipio_codigo") == RESIDUAL_MUNICIPALITY
    problem = (
        F.when(residual, F.lit(None).cast("string"))
        .when(F.col("municipio_codigo_ibge").isNull(), F.lit("unknown municipality"))
        .when(~F.col("__uf").eqNullSafe(F.col("uf")), F.lit("state differs"))
    )
    joined = shares.join(names, "municipio_codigo", "left").withColumn("problem", problem)
    return joined.select(
        F.col("municipio_codigo").alias("municipio_codigo_rais"),
        F.when(~residual, F.col("municipio_codigo_ibge")).alias("municipio_codigo_ibge"),
        F.when(residual, F.lit(RESIDUAL_MUNICIPALITY_NAME)).otherwise(F.col("municipio_nome")).alias("municipio_nome"),
        F.when(residual, F.lit(UNIDENTIFIED_STATE)).otherwise(F.col("uf")).alias("uf"),
        "active_stock",
        "share_of_tech_stock",
        "problem",
    )


def require_clean_municipalities(table: DataFrame, stock: int) -> None:
    row = table.agg(
        F.coalesce(F.sum("active_stock"), F.lit(0)).alias("total"), F.max("problem").alias("problem")
    ).collect()[0]
    if row.problem:
        raise ConsistencyError(f"municipality table: {row.problem}")
    if row.total != stock:
        raise ConsistencyError(f"municipality table holds {row.total} links, the stock {stock}")
