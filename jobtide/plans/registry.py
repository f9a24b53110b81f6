"""Named queries, each with the SQL that states its result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, ShortType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Result columns in the four types both engines share: bigint, double (6 places), string, boolean."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, (DecimalType, FloatType, DoubleType)):
            col = F.round(col.cast("double"), 6)
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return build

    return register
