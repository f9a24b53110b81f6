"""The operators' inputs expressed over the benchmark tables.

``lineitem`` plays the monthly movements and ``orders`` the annual stock. A caller names the columns it needs and gets
only the joins behind them: a total per month reads ``lineitem`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.codes import state_of_municipality
from jobtide.functions.movement import adjustment_factor, delta_columns
from jobtide.functions.periods import month_of
from jobtide.functions.salary import ELIGIBLE, salary_eligible

FAMILIES = [f"Brand#{i}" for i in range(1, 26)]
SALARY_BOUNDS = (9000.0, 99000.0)
BASE_MONTH = "199806"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _left(df: DataFrame, spark: SparkSession, sf_dir: str, name: str, left: str, right: str, *keep: str) -> DataFrame:
    """Left join to a keyed table, so that a row without a match is kept with nulls."""
    side = table(spark, sf_dir, name).select(F.col(right).alias("__k"), *keep)
    return df.join(side, F.col(left) == F.col("__k"), "left").drop("__k")


def _kind() -> Column:
    return (
        F.when(F.col("l_linenumber") == 7, F.lit("FOR"))
        .when((F.col("l_linenumber") == 6) & (F.col("l_quantity") < 5), F.lit("EXC"))
        .otherwise(F.lit("MOV"))
    )


def flow(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Valid movements with deltas and salary eligibility, plus the requested columns."""
    rows = table(spark, sf_dir, "lineitem")
    available = {
        "competence": month_of(F.col("l_shipdate")),
        "municipio_codigo_caged": F.col("l_suppkey").cast("string"),
        "quantity": F.col("l_quantity").cast("int"),
    }
    if {"uf", "region"} & set(columns):
        rows = _left(rows, spark, sf_dir, "supplier", "l_suppkey", "s_suppkey", "s_nationkey")
        rows = _left(rows, spark, sf_dir, "nation", "s_nationkey", "n_nationkey", "n_name", "n_regionkey")
        available["uf"] = F.col("n_name")
    if "region" in columns:
        rows = _left(rows, spark, sf_dir, "region", "n_regionkey", "r_regionkey", "r_name")
        available["region"] = F.col("r_name")
    if {"cbo_familia", "cbo_codigo"} & set(columns):
        rows = _left(rows, spark, sf_dir, "part", "l_partkey", "p_partkey", "p_brand", "p_type")
        available["cbo_familia"] = F.col("p_brand")
        available["cbo_codigo"] = F.concat("p_brand", F.lit("/"), "p_type")
    if "competencia_declarada" in columns:
        rows = _left(rows, spark, sf_dir, "orders", "l_orderkey", "o_orderkey", "o_orderdate")
        available["competencia_declarada"] = month_of(F.col("o_orderdate"))

    base = rows.select(
        *[available[c].alias(c) for c in columns],
        F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1)).alias("saldo_movimentacao"),
        (F.floor(F.col("l_extendedprice") / 1000) * 1000).cast("double").alias("salario_mensal"),
        F.when(F.col("l_tax") == 0, F.lit("1")).otherwise(F.lit("0")).alias("indicador_trabalho_intermitente"),
        _kind().alias("adjustment_kind"),
    )
    sign = F.col("saldo_movimentacao")
    eligible = salary_eligible(
        sign, F.col("salario_mensal"), F.col("indicador_trabalho_intermitente"), *map(F.lit, SALARY_BOUNDS)
    )
    return base.withColumns({**delta_columns(sign, adjustment_factor(F.col("adjustment_kind"))), ELIGIBLE: eligible})


def flow_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements as the raw text a monthly file holds, with its irregularities: unknown, missing and unidentified
    states, short occupation codes, unparsable signs, two number formats, missing and negative salaries."""
    rows = table(spark, sf_dir, "lineitem")
    rows = _left(rows, spark, sf_dir, "supplier", "l_suppkey", "s_suppkey", "s_nationkey", "s_acctbal")
    rows = _left(rows, spark, sf_dir, "part", "l_partkey", "p_partkey", "p_brand", "p_type", "p_size")
    rows = _left(rows, spark, sf_dir, "orders", "l_orderkey", "o_orderkey", "o_orderdate")
    local = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    plain = F.format_string("%.2f", F.col("l_extendedprice"))
    brand = F.lpad(F.regexp_replace("p_brand", r"\D", ""), 2, "0")
    return rows.select(
        month_of(F.col("l_shipdate")).alias("competênciamov"),
        F.when(F.col("s_acctbal") > 9500, F.lit("N/A"))
        .when(F.col("s_acctbal") < 0, F.lit("99"))
        .otherwise((F.col("s_nationkey") + 11).cast("string"))
        .alias("uf"),
        F.col("l_suppkey").cast("string").alias("município"),
        F.when(F.col("l_returnflag") == "R", F.lit("-1"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit("1,0"))
        .otherwise(F.lit("1"))
        .alias("saldomovimentação"),
        F.when(F.col("p_type") == "SMALL", F.lit("21"))
        .otherwise(F.concat(F.lit("21"), brand, F.lit("-"), F.lpad(F.col("p_size").cast("string"), 2, "0")))
        .alias("cbo2002ocupação"),
        F.col("l_linenumber").cast("string").alias("tipomovimentação"),
        F.when(F.col("l_tax") == 0, F.lit("NA"))
        .when(F.col("l_tax") == 0.08, F.concat(F.lit("-"), local))
        .when(F.col("l_tax") == 0.01, plain)
        .otherwise(local)
        .alias("salário"),
        F.when(F.col("l_tax") == 0.02, F.lit("1")).otherwise(F.lit("0")).alias("indtrabintermitente"),
        month_of(F.col("o_orderdate")).alias("competênciadec"),
        _kind().alias("file_kind"),
        month_of(F.col("l_shipdate")).alias("ingest_competence"),
    )


def stock_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employment links as raw annual text, one source file per region."""
    rows = _left(
        table(spark, sf_dir, "orders"), spark, sf_dir, "customer", "o_custkey", "c_custkey",
        "c_nationkey", "c_acctbal", "c_mktsegment",
    )
    rows = _left(rows, spark, sf_dir, "nation", "c_nationkey", "n_nationkey", "n_regionkey")
    rows = _left(rows, spark, sf_dir, "region", "n_regionkey", "r_regionkey", "r_name")
    digit, tail = F.substring("o_orderpriority", 1, 1), F.substring(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), 11, 2)
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    place = municipality_of_customer("o_custkey")
    return rows.select(
        F.coalesce("r_name", F.lit("NI")).alias("source_file"),
        F.when(F.col("o_orderstatus") == "O", F.lit("1")).when(F.col("o_orderstatus") == "F", F.lit(" 0 "))
        .otherwise(F.col("o_orderstatus")).alias("active_raw"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("1"))
        .when((F.col("o_orderpriority") == "3-MEDIUM") & (F.col("c_acctbal") < 0), F.lit(""))
        .otherwise(F.lit("0")).alias("abandoned_raw"),
        F.when((F.col("c_mktsegment") == "BUILDING") & urgent, F.concat(F.lit("12"), digit, F.lit("-"), tail))
        .when((F.col("c_mktsegment") == "FURNITURE") & high, F.concat(F.lit("212"), digit))
        .otherwise(F.concat(F.lit("212"), digit, F.lit("-"), tail)).alias("cbo_raw"),
        F.when(F.col("c_acctbal") > 9000, F.lit("999999"))
        .when(F.col("c_acctbal") > 5000, F.concat(place, F.lit("7")))
        .otherwise(place).alias("municipio_raw"),
        F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("rem_mean_raw"),
        F.when(urgent, F.lit("0,00")).otherwise(F.translate(F.format_number("o_totalprice", 2), ",.", ".,"))
        .alias("rem_dec_raw"),
    )


def municipality_of_customer(key: str) -> Column:
    """Six digits: state prefix from the nation, then the last four digits of the customer key."""
    tail = F.substring(F.lpad(F.col(key).cast("string"), 12, "0"), 9, 4)
    return F.concat((F.col("c_nationkey") + 11).cast("string"), tail)


def municipality_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prefix, municipio_codigo_ibge, municipio_nome, uf): the places of all customers outside one segment."""
    rows = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    prefix = municipality_of_customer("c_custkey").alias("prefix")
    places = rows.groupBy(prefix).agg(F.min("c_name").alias("municipio_nome"))
    return places.select(
        "prefix",
        F.concat("prefix", F.lit("7")).alias("municipio_codigo_ibge"),
        "municipio_nome",
        state_of_municipality(F.col("prefix")).alias("uf"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation."""
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    named = _left(customers, spark, sf_dir, "nation", "c_nationkey", "n_nationkey", "n_name")
    return named.select(F.col("n_name").alias("uf"), "population")


def price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month stand in for the price index: (month, value)."""
    month = month_of(F.col("o_orderdate")).alias("month")
    return table(spark, sf_dir, "orders").groupBy(month).agg(F.count(F.lit(1)).cast("decimal(18,6)").alias("value"))
