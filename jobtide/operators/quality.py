"""Quality reports and value profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError
from jobtide.fixed_values import UNIDENTIFIED_STATE
from jobtide.functions.rates import share

FILE_KEYS = ["file_kind", "ingest_competence"]


def _signed_counts(prefix: str, scope: Column) -> list[Column]:
    sign = F.col("saldo_movimentacao")
    return [
        F.count_if(scope & (sign == 1)).alias(f"{prefix}admissions"),
        F.count_if(scope & (sign == -1)).alias(f"{prefix}dismissals"),
        F.coalesce(F.sum(F.when(scope, sign)), F.lit(0)).cast("bigint").alias(f"{prefix}balance"),
    ]


def _audit_columns() -> list[Column]:
    everywhere, unidentified = F.lit(True), F.col("uf") == UNIDENTIFIED_STATE
    return [F.count(F.lit(1)).alias("rows"), *_signed_counts("", everywhere), *_signed_counts("non_identified_", unidentified)]


def national_audit(silver: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals over all rows, valid or not, and the same for the not-identified state. One pass."""
    return silver.groupBy(*(by or [])).agg(*_audit_columns())


def _quality_columns(families: list[str]) -> list[Column]:
    invalid = F.col("registro_invalido")
    counters = {
        "rows_valid": ~invalid,
        "rows_rejected": invalid,
        "rows_tech": ~invalid & F.col("cbo_familia").isin(families),
        "invalid_uf": invalid & F.col("erro_uf"),
        "invalid_cbo": invalid & F.col("erro_cbo"),
        "invalid_saldo": invalid & F.col("erro_saldo"),
        "invalid_salary": invalid & F.col("erro_salario"),
        "non_identified_uf_rows": F.col("uf") == UNIDENTIFIED_STATE,
    }
    return [F.count(F.lit(1)).alias("rows_read"), *[F.count_if(c).alias(n) for n, c in counters.items()]]


def flow_quality(silver: DataFrame, families: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows read, valid, rejected and in scope, rejects per rule, valid rate. One pass over the flagged rows."""
    report = silver.groupBy(*(by or [])).agg(*_quality_columns(families))
    return report.withColumn("valid_rate", share(F.col("rows_valid"), F.col("rows_read")))


def quality_and_audit(silver: DataFrame, families: list[str], by: list[str]) -> DataFrame:
    """The columns of :func:`flow_quality` and :func:`national_audit` from one aggregate; a gate reads both."""
    report = silver.groupBy(*by).agg(*_quality_columns(families), *_audit_columns())
    return report.withColumn("valid_rate", share(F.col("rows_valid"), F.col("rows_read")))


def adjustment_quality(silver: DataFrame, families: list[str]) -> DataFrame:
    """Report per adjustment file with the sorted distinct months its scope rows change."""
    invalid = F.col("registro_invalido")
    tech = ~invalid & F.col("cbo_familia").isin(families)
    report = silver.where("file_kind <> 'MOV'").groupBy(*FILE_KEYS).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~invalid).alias("rows_valid"),
        F.count_if(invalid).alias("rows_rejected"),
        F.count_if(tech).alias("rows_tech"),
        F.sort_array(F.collect_set(F.when(tech, F.col("effective_competence")))).alias("effective_competencies"),
    )
    return report.withColumn("valid_rate", share(F.col("rows_valid"), F.col("rows_read")))


def reported_quality(reasons: DataFrame, by: list[str]) -> DataFrame:
    """Report from counts alone: (rows_read, rows_valid, reason, n) rows per ``by`` group.

    Rejected rows are the sum over reasons; ``consistent`` is false when valid and rejected exceed what was read.
    """
    report = reasons.groupBy(*by).agg(
        F.max("rows_read").alias("rows_read"),
        F.max("rows_valid").alias("rows_valid"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_rejected"),
    )
    return report.withColumns(
        {
            "valid_rate": share(F.col("rows_valid"), F.col("rows_read"), 6),
            "consistent": F.col("rows_valid") + F.col("rows_rejected") <= F.col("rows_read"),
        }
    )


def require_consistent_report(report: DataFrame) -> None:
    if not report.where(~F.col("consistent")).isEmpty():
        raise ConsistencyError("quality report: valid plus rejected exceed the rows read")


# ---------------------------------------------------------------------------------------------------------------
# Value profiles
# ---------------------------------------------------------------------------------------------------------------


def value_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., concept, value, n) for several text columns in one scan; blanks count under the value ``""``.

    The unpivot multiplies rows only inside the task: partial sums run before the shuffle.
    """
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("concept"), F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias("value"))
            for c in columns
        ]
    )
    by = by or []
    return df.select(*by, F.inline(cells)).groupBy(*by, "concept", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_summary(counts: DataFrame, by: list[str]) -> DataFrame:
    """Non-blank, blank, distinct and digits-only counts per ``by`` group of :func:`value_counts` rows."""
    filled = F.col("value") != ""
    return counts.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("non_blank"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("blank"),
        F.count_if(filled).alias("distinct_in_sample"),
        F.coalesce(F.sum(F.when(F.col("value").rlike(r"^\d+$"), F.col("n"))), F.lit(0)).alias("digits_only"),
    )


def profile_lengths(counts: DataFrame, by: list[str]) -> DataFrame:
    rows = counts.where("value <> ''")
    return rows.groupBy(*by, F.length("value").alias("length")).agg(F.sum("n").alias("n"))


def profile_top_values(counts: DataFrame, by: list[str], limit: int = 25) -> DataFrame:
    """Most frequent values with their rank. Spark keeps ``limit`` rows per group in each task before it shuffles."""
    order = W.partitionBy(*by).orderBy(F.desc("n"), "value")
    ranked = counts.where("value <> ''").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= limit)


def profile_observed_values(counts: DataFrame, by: list[str], limit: int = 50) -> DataFrame:
    """Sorted values of each group with at most ``limit`` distinct values; null for a group with more."""
    order = W.partitionBy(*by).orderBy("value")
    first = counts.where("value <> ''").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit + 1)
    listed = first.groupBy(*by).agg(F.sort_array(F.collect_list("value")).alias("v"))
    return listed.select(*by, F.when(F.size("v") <= limit, F.col("v")).alias("observed_values"))


def first_rows_per_file(df: DataFrame, file: str, order: list[str], limit: int | None = None) -> DataFrame:
    """The first ``limit`` rows of each file, kept per task before the shuffle; without a limit every row, and nothing is shuffled."""
    if limit is None:
        return df
    position = F.row_number().over(W.partitionBy(file).orderBy(*order))
    return df.withColumn("__position", position).where(F.col("__position") <= limit).drop("__position")


def with_file_position(df: DataFrame) -> DataFrame:
    """Columns that give the reading order of text rows: file, start of the split, running id inside it."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def profile_by_file_and_overall(sample: DataFrame, file: str, columns: list[str]) -> DataFrame:
    """Summary per (file, concept) and per concept over all files, from one set of per-file value counts."""
    counts = value_counts(sample, columns, [file])
    per_file = profile_summary(counts, [file, "concept"])
    merged = counts.groupBy("concept", "value").agg(F.sum("n").alias("n"))
    overall = profile_summary(merged, ["concept"]).withColumn(file, F.lit(None).cast("string"))
    return per_file.unionByName(overall)


def derived_year_profile(counted: DataFrame, year: int, rows: str) -> DataFrame:
    """Profile of the year column, which is constant by context, from the number of rows read."""
    n = F.col(rows)
    text = F.lit(str(year))
    return counted.withColumns(
        {
            "non_blank": n,
            "blank": F.lit(0).cast("bigint"),
            "distinct_in_sample": (n > 0).cast("bigint"),
            "digits_only": n,
            "observed_values": F.when(n > 0, F.array(text)).otherwise(F.array().cast("array<string>")),
        }
    )


# ---------------------------------------------------------------------------------------------------------------
# Which rule reproduces the official stock
# ---------------------------------------------------------------------------------------------------------------


def stock_rule_candidates(rows: DataFrame, official: Column | int, by: list[str] | None = None) -> DataFrame:
    """Seven candidate stock definitions, their counts, and whether each equals the official total.

    ``rows`` has active_raw, abandoned_raw and the two numbers rem_mean and rem_dec (null if unparsable). ``official``
    is a value, or an expression over the ``by`` columns and the aggregates.
    """
    active, abandoned = F.trim("active_raw") == "1", F.trim("abandoned_raw")
    mean_paid, dec_paid = F.col("rem_mean") > 0, F.col("rem_dec") > 0
    rules: Mapping[str, Column] = {
        "active_total": active,
        "active_abandoned_zero": active & (abandoned == "0"),
        "active_abandoned_not_one": active & (F.coalesce(abandoned, F.lit("")) != "1"),
        "active_rem_mean_positive": active & mean_paid,
        "active_rem_dec_positive": active & dec_paid,
        "active_abandoned_zero_rem_mean_positive": active & (abandoned == "0") & mean_paid,
        "active_abandoned_zero_rem_dec_positive": active & (abandoned == "0") & dec_paid,
    }
    by = by or []
    wide = rows.groupBy(*by).agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    long = wide.select(
        *by,
        (official if isinstance(official, Column) else F.lit(official)).cast("bigint").alias("official"),
        F.inline(
            F.array(*[F.struct(F.lit(name).alias("candidate"), F.col(name).alias("stock")) for name in rules])
        ),
    )
    return long.withColumn("exact_match", F.col("stock") == F.col("official"))


def abandoned_values_of_active(rows: DataFrame) -> DataFrame:
    """Histogram of the abandoned code among active rows."""
    value = F.trim(F.coalesce("abandoned_raw", F.lit("")))
    return rows.where(F.trim("active_raw") == "1").groupBy(value.alias("abandoned")).agg(F.count(F.lit(1)).alias("rows"))
