"""JSON documents: a header object with an ``items`` array, and key -> value maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, paths: str | list[str], schema: str | None = None) -> DataFrame:
    """One row per document."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(paths, multiLine=True)


def document_items(documents: DataFrame, items: str = "items") -> DataFrame:
    """Header columns repeated on each item; item fields become columns and win over a header of the same name."""
    fields = documents.schema[items].dataType.elementType.fieldNames()
    header = [c for c in documents.columns if c != items and c not in fields]
    return documents.select(*header, F.inline(items))


def key_values(texts: DataFrame, field: str, value_type: str, header: str = "") -> DataFrame:
    """Rows (header columns, key, value) of a JSON object used as a map. ``texts`` has one document per ``value``."""
    parsed = F.from_json("value", f"{header + ', ' if header else ''}`{field}` map<string,{value_type}>")
    document = texts.select(parsed.alias("d")).select("d.*")
    others = [c for c in document.columns if c != field]
    return document.select(*others, F.explode(field).alias("key", "value"))


def read_key_values(spark: SparkSession, path: str, field: str, value_type: str, header: str = "") -> DataFrame:
    return key_values(spark.read.text(path, wholetext=True), field, value_type, header)


def to_documents(items: DataFrame, header: list[str], sort: list[str] | None = None) -> DataFrame:
    """One JSON text per distinct header with its rows as ``items``.

    For published tables only: their grains (states, occupations, municipalities of one month) bound each document.
    """
    fields = [c for c in items.columns if c not in header]
    order = sort or fields
    entry = F.struct(F.struct(*order).alias("k"), F.struct(*fields).alias("v"))
    collected = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"])
    grouped = items.groupBy(*header).agg(collected.alias("items"))
    body = F.to_json(F.struct(*header, "items"), {"ignoreNullFields": "false"})
    return grouped.select(*header, body.alias("value"))


def write_documents(documents: DataFrame, path: str, partition_by: list[str]) -> None:
    documents.select("value", *partition_by).write.mode("overwrite").partitionBy(*partition_by).text(path)


def latest_document(documents: DataFrame, month: str, kind: str | None = None, wanted: str = "MOV") -> DataFrame:
    """Newest document. With ``kind``, only documents of the wanted kind compete, so FOR/EXC reports never win."""
    rows = documents.where(F.col(kind) == wanted) if kind else documents
    newest = F.max_by(F.struct(*rows.columns), F.col(month)).alias("d")
    return rows.agg(newest).where("d is not null").select("d.*")
