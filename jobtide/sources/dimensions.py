"""Reference dimensions from nested API answers: municipalities, population, price index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError
from jobtide.fixed_values import MUNICIPALITY_MINIMUM_ENTRIES, POPULATION_NULL_MARKS

_STATE = "struct<sigla:string>"
_MUNICIPALITY = (
    "array<struct<id:string, nome:string, "
    f"microrregiao:struct<mesorregiao:struct<UF:{_STATE}>>, "
    f"`regiao-imediata`:struct<`regiao-intermediaria`:struct<UF:{_STATE}>>>>"
)
_POPULATION = (
    "array<struct<resultados:array<struct<series:array<struct<"
    "localidade:struct<id:string>, serie:map<string,string>>>>>>>"
)


def parse_municipalities(texts: DataFrame) -> DataFrame:
    """(prefix, municipio_codigo_ibge, municipio_nome, uf) from the JSON list in ``value``; unusable entries skipped."""
    item = texts.select(F.explode(F.from_json("value", _MUNICIPALITY)).alias("m"))
    state = F.coalesce(
        F.nullif(F.col("m.microrregiao.mesorregiao.UF.sigla"), F.lit("")),
        F.nullif(F.col("m.`regiao-imediata`.`regiao-intermediaria`.UF.sigla"), F.lit("")),
    )
    rows = item.select(
        F.substring("m.id", 1, 6).alias("prefix"),
        F.col("m.id").alias("municipio_codigo_ibge"),
        F.trim("m.nome").alias("municipio_nome"),
        state.alias("uf"),
    )
    return rows.where(
        F.col("municipio_codigo_ibge").rlike(r"^\d{7}$") & (F.col("municipio_nome") != "") & F.col("uf").isNotNull()
    )


def ambiguous_prefixes(municipalities: DataFrame) -> DataFrame:
    """Six-digit prefixes that stand for more than one distinct entry."""
    entry = F.struct("municipio_codigo_ibge", "municipio_nome", "uf")
    return municipalities.groupBy("prefix").agg(F.count_distinct(entry).alias("entries")).where("entries > 1")


def municipality_dimension(municipalities: DataFrame, minimum: int = MUNICIPALITY_MINIMUM_ENTRIES) -> DataFrame:
    """Checked union of one or more parsed lists: one row per prefix, no conflict, at least ``minimum`` rows."""
    clash = ambiguous_prefixes(municipalities).limit(1).collect()
    if clash:
        raise ConsistencyError(f"municipality prefix {clash[0].prefix} has conflicting entries")
    dimension = municipalities.dropDuplicates(["prefix"])
    found = dimension.count()
    if found < minimum:
        raise ConsistencyError(f"municipality list is incomplete: {found} entries")
    return dimension


def population_value(raw: Column) -> Column:
    """Positive whole number with dots or blanks as thousands marks; null marks and anything else are null."""
    text = F.trim(raw)
    number = F.translate(text, ". ", "")
    value = F.when(number.rlike(r"^\d+$"), number.try_cast("bigint"))
    return F.when(~text.isin(POPULATION_NULL_MARKS) & (value > 0), value)


def parse_population(texts: DataFrame, year: int) -> DataFrame:
    """(municipio_codigo_ibge, population) of one year from the variable -> result -> series JSON in ``value``."""
    variables = texts.select(F.explode(F.from_json("value", _POPULATION)).alias("v"))
    series = variables.select(F.explode("v.resultados").alias("r")).select(F.explode("r.series").alias("s"))
    rows = series.select(
        F.col("s.localidade.id").alias("municipio_codigo_ibge"),
        population_value(F.try_element_at("s.serie", F.lit(str(year)))).alias("population"),
    )
    return rows.where(F.col("municipio_codigo_ibge").rlike(r"^\d{7}$") & F.col("population").isNotNull())


def parse_price_index(texts: DataFrame) -> DataFrame:
    """(month, value) from a JSON list of flat objects: the month is the first value that looks like YYYYMM."""
    row = texts.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("r"))
    months = F.filter(F.map_values("r"), lambda v: v.rlike(r"^\d{4}(0[1-9]|1[0-2])$"))
    raw = F.try_element_at("r", F.lit("V"))
    number = F.when(~raw.isin(POPULATION_NULL_MARKS), F.replace(raw, F.lit(","), F.lit(".")))
    rows = row.select(F.get(months, 0).alias("month"), number.try_cast("decimal(18,6)").alias("value"))
    return rows.where("month is not null and value is not null")


def upsert_price_index(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New months over existing ones. A new value that is not positive fails the job."""
    bad = F.raise_error(F.concat(F.lit("price index must be positive: "), "month")).cast("decimal(18,6)")
    checked = new.withColumn("value", F.when(F.col("value") > 0, F.col("value")).otherwise(bad))
    both = existing.select("month", "value", F.lit(0).alias("v")).unionByName(
        checked.select("month", "value", F.lit(1).alias("v"))
    )
    return both.groupBy("month").agg(F.max_by("value", "v").alias("value"))


def require_base_month(index: DataFrame, base_month: str) -> None:
    if index.where(F.col("month") == base_month).isEmpty():
        raise ConsistencyError(f"base month {base_month} is not in the price index")
