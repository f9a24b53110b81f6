"""Layout and value contracts of annual files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import LayoutError
from jobtide.fixed_values import POPULATION_EXPECTED_ENTRIES, RESIDUAL_MUNICIPALITY
from jobtide.functions.codes import state_of_municipality
from jobtide.functions.periods import next_month
from jobtide.functions.text import comparable_value


def match_headers(headers: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """Status of each concept in each file: ``matched``, ``missing`` or ``ambiguous``, with the headers that matched.

    ``headers`` has (file, column), one row per header. The contract is configuration, so it becomes an exploded
    literal: one aggregation, no join.
    """
    concepts = F.array(
        *[
            F.struct(F.lit(name).alias("concept"), F.array(*map(F.lit, words)).alias("accepted"))
            for name, words in aliases.items()
        ]
    )
    pairs = headers.select("file", "column", F.inline(concepts))
    hit = F.array_contains(F.col("accepted"), F.col("column"))
    matches = pairs.groupBy("file", "concept").agg(
        F.sort_array(F.collect_list(F.when(hit, F.col("column")))).alias("matches")
    )
    size = F.size("matches")
    status = F.when(size == 0, F.lit("missing")).when(size == 1, F.lit("matched")).otherwise(F.lit("ambiguous"))
    return matches.withColumn("status", status)


def match_aliases(layouts: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """:func:`match_headers` for rows of ``describe_layouts``."""
    return match_headers(layouts.select("file", F.explode("normalized_columns").alias("column")), aliases)


def layout_readiness(matches: DataFrame) -> DataFrame:
    """Per file: missing and ambiguous concepts and whether all match exactly once."""
    names = lambda status: F.sort_array(F.collect_set(F.when(F.col("status") == status, F.col("concept"))))
    return matches.groupBy("file").agg(
        names("missing").alias("missing_required"),
        names("ambiguous").alias("ambiguous_required"),
        F.bool_and(F.col("status") == "matched").alias("valid"),
    )


def concept_columns(matches: DataFrame) -> dict[str, dict[str, str]]:
    """``{file: {concept: normalised header}}`` for the reader. One small row per file and concept."""
    out: dict[str, dict[str, str]] = {}
    for row in matches.select("file", "concept", "status", "matches").collect():
        if row.status != "matched":
            raise LayoutError(f"{row.file}: concept {row.concept} is {row.status}")
        out.setdefault(row.file, {})[row.concept] = row.matches[0]
    return out


#: Values that a summary row shows if the caller names no other number; the functions below give all of them as rows.
LISTED_VALUES = 50


def _listed(values: DataFrame, most: int) -> Column:
    """The first values in order, as a sorted array. Every task keeps ``most`` of them, so a column full of
    distinct values is never gathered."""
    first = values.distinct().orderBy(values.columns[0]).limit(most)
    return first.agg(F.sort_array(F.collect_list(values.columns[0]))).scalar()


def classified_values(counts: DataFrame, positive: Iterable[str], negative: Iterable[str]) -> DataFrame:
    """Every observed value of a two-valued column as a row: (value, class, n), class being positive, negative, blank or unknown.

    ``counts`` has (value, n); spellings that compare equal are one value.
    """
    value = F.col("value")
    kind = F.when(value == "", "blank").when(value.isin(list(positive)), "positive").when(value.isin(list(negative)), "negative").otherwise("unknown")
    seen = counts.select(comparable_value(F.col("value")).alias("value"), "n").groupBy("value").agg(F.sum("n").alias("n"))
    return seen.select("value", kind.alias("class"), "n")


def observed_values(counts: DataFrame) -> DataFrame:
    """Every observed value, compared as contracts do, with its number: (value, n) rows, none left out."""
    return counts.select(comparable_value(F.col("value")).alias("value"), "n").groupBy("value").agg(F.sum("n").alias("n"))


def binary_value_contract(
    counts: DataFrame,
    positive: Iterable[str],
    negative: Iterable[str],
    reject_unknown: bool = True,
    reject_blank: bool = True,
    listed: int = LISTED_VALUES,
) -> DataFrame:
    """Check the observed values of a two-valued column.

    ``counts`` has (value, n), one row per distinct raw value. The result is one row: the sorted values seen in each
    class, the first ``listed`` unknown values and how many there are (``classified_values`` gives them all), the number of blanks, and ``valid``, which
    asks for both classes, no unknown value and no blank.
    """
    positive, negative = list(positive), list(negative)
    seen = counts.select(comparable_value(F.col("value")).alias("v"), "n")
    blank = F.col("v") == ""
    unknown = ~blank & ~F.col("v").isin(positive + negative)

    def seen_of(accepted: list[str]) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("v").isin(accepted), F.col("v"))))

    result = seen.agg(
        seen_of(positive).alias("positive_observed"),
        seen_of(negative).alias("negative_observed"),
        F.count_distinct(F.when(unknown, F.col("v"))).alias("unknown_count"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blank_values"),
    ).withColumn("unknown_values", _listed(seen.where(unknown).select("v"), listed))
    valid = (F.size("positive_observed") > 0) & (F.size("negative_observed") > 0)
    if reject_unknown:
        valid &= F.col("unknown_count") == 0
    if reject_blank:
        valid &= F.col("blank_values") == 0
    return result.withColumn("valid", valid)


def year_contract(values: DataFrame, year: int, listed: int = LISTED_VALUES) -> DataFrame:
    """The observed years are exactly the requested one; the first ``listed`` are shown (``observed_values`` gives them all)."""
    seen = values.select(comparable_value(F.col("value")).alias("v"))
    same = F.coalesce(F.bool_and(F.col("v") == str(year)), F.lit(False))
    return seen.agg(same.alias("valid")).withColumn("observed", _listed(seen, listed))


def municipality_dimension_check(codes: DataFrame, dimension: DataFrame) -> DataFrame:
    """Check municipality codes and states of the stock against the official list; one summary row.

    ``codes`` has (municipio_codigo, uf) row per link; it is reduced to distinct pairs with a row count before it
    meets the dimension, which has (code7) per official municipality.
    """
    pairs = codes.groupBy(
        F.coalesce("municipio_codigo", F.lit("")).alias("code"), F.coalesce("uf", F.lit("")).alias("uf")
    ).agg(F.count(F.lit(1)).alias("rows"))
    official = dimension.where(F.col("code7").rlike(r"^\d{7}$")).select("code7").distinct()
    prefixes = official.groupBy(F.substring("code7", 1, 6).alias("code")).agg(F.count(F.lit(1)).alias("full_codes"))

    residual = F.col("code") == RESIDUAL_MUNICIPALITY
    matched = F.col("full_codes").isNotNull()
    mismatch = F.when(residual, F.col("uf") != "NI").when(
        matched, ~F.col("uf").eqNullSafe(state_of_municipality(F.col("code")))
    )
    facts = pairs.join(prefixes, "code", "left")
    per_code = facts.groupBy("code").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(mismatch, F.col("rows"))), F.lit(0)).alias("mismatch_rows"),
        F.max(F.col("full_codes")).alias("full_codes"),
    )
    identified = F.col("code") != RESIDUAL_MUNICIPALITY
    summary = per_code.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("silver_rows"),
        F.count(F.lit(1)).alias("unique_codes"),
        F.coalesce(F.sum(F.when(~identified, F.col("rows"))), F.lit(0)).alias("residual_rows"),
        F.count_if(identified & F.col("full_codes").isNotNull()).alias("matched_codes"),
        F.count_if(identified & F.col("full_codes").isNull()).alias("unmatched_codes"),
        F.count_if(identified & (F.length("code") != 6)).alias("invalid_length_codes"),
        F.count_if(identified & ~F.col("code").rlike(r"^\d+$")).alias("invalid_numeric_codes"),
        F.coalesce(F.sum("mismatch_rows"), F.lit(0)).alias("uf_mismatch_rows"),
    )
    ambiguous = prefixes.agg(F.count_if(F.col("full_codes") > 1)).scalar()
    ready = (
        F.col("ambiguous_prefixes")
        + F.col("unmatched_codes")
        + F.col("invalid_length_codes")
        + F.col("invalid_numeric_codes")
        + F.col("uf_mismatch_rows")
        == 0
    )
    return summary.withColumn("ambiguous_prefixes", ambiguous).withColumn("municipality_ready", ready)


def population_snapshot_check(population: DataFrame, expected_entries: int = POPULATION_EXPECTED_ENTRIES) -> DataFrame:
    """Entries (code, population): expected number, seven digits, positive, six-digit prefixes unique."""
    codes = population.groupBy(F.substring("code", 1, 6).alias("prefix")).agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(~F.coalesce(F.col("code").rlike(r"^\d{7}$"), F.lit(False))).alias("bad_codes"),
        F.count_if(~F.coalesce(F.col("population") > 0, F.lit(False))).alias("bad_population"),
    )
    summary = codes.agg(
        F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"),
        F.coalesce(F.sum("bad_codes"), F.lit(0)).alias("bad_codes"),
        F.coalesce(F.sum("bad_population"), F.lit(0)).alias("bad_population"),
        F.count(F.lit(1)).alias("prefixes"),
    )
    ok = (
        (F.col("entries") == expected_entries)
        & (F.col("bad_codes") + F.col("bad_population") == 0)
        & (F.col("prefixes") == F.col("entries"))
    )
    return summary.withColumn("valid", ok)


def monthly_index_rates(index: DataFrame) -> DataFrame:
    """Month-over-month change in percent to 2 places. The previous value is found by an equi-join on the next month,
    so a gap gives null instead of a change over several months."""
    previous = index.select(next_month(F.col("month")).alias("month"), F.col("value").alias("previous"))
    rate = F.when(F.col("previous") > 0, F.round((F.col("value") / F.col("previous") - 1) * 100, 2))
    return index.join(previous, "month", "left").withColumn("monthly_rate", rate.cast("double"))


def index_snapshot_check(index: DataFrame, month: str, base_month: str, expected_rate: float | None = None) -> DataFrame:
    """Both months present with positive values; the month's rate, if one is expected, matches to 2 places."""
    rates = monthly_index_rates(index)
    usable = lambda m: F.count_if((F.col("month") == m) & (F.col("value") > 0)) == 1
    rate = F.max(F.when(F.col("month") == month, F.col("monthly_rate")))
    summary = rates.agg(usable(month).alias("month_present"), usable(base_month).alias("base_present"), rate.alias("rate"))
    rate_ok = F.lit(True) if expected_rate is None else F.coalesce(F.col("rate") == expected_rate, F.lit(False))
    return summary.withColumn("valid", F.col("month_present") & F.col("base_present") & rate_ok)
