"""From raw documents to packed sequences: quality rules, exact copies, near copies, source mix, packing.

Every stage works on all rows the one before it kept. Stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm.exact_dedup import drop_copies
from jobtide.llm.frames import stored
from jobtide.llm.minhash_join import drop_near_copies
from jobtide.llm.mixing import mix
from jobtide.llm.packing import pack
from jobtide.llm.quality_rules import keep_good
from jobtide.llm.queries import END_ID, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that the mix takes twice is two rows."""
    return mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path(), end=END_ID, with_ids=False)


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("source_mix", source_mix), ("packed", packed)]

#: Expectation-maximisation and the tokenizer have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
