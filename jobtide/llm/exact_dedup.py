"""Exact deduplication by two passes over a Bloom filter, with built-in column functions only.

Pass 1 marks the filter bits that at least two texts set. Pass 2 tests every text against them: a text with an unmarked
bit is certainly alone and passes straight through; only the others are shuffled and compared by full digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import stored, text_of

#: Filter size: at least 16 bits a text, at most 2 ** 26 bits, so what is broadcast has a fixed bound at any input size.
#: Beyond 4 million texts more of them pass the filter and shuffle; the result stays exact.
LEAST_WORD_BITS, MOST_WORD_BITS = 10, 20


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _bits(hashed: Column) -> Column:
    """Two bits of a 64-bit filter word, from the low end of the hash; the word comes from the high end."""
    return F.array_distinct(F.array(hashed.bitwiseAND(F.lit(63)), F.shiftrightunsigned(hashed, 6).bitwiseAND(F.lit(63))))


def _word(hashed: Column, word_bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - word_bits)


def _mask(hashed: Column) -> Column:
    one = F.lit(1).cast("long")
    low = F.call_function("shiftleft", one, hashed.bitwiseAND(F.lit(63)).cast("int"))
    return low.bitwiseOR(F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, 6).bitwiseAND(F.lit(63)).cast("int")))


def word_bits_for(rows: int) -> int:
    return min(MOST_WORD_BITS, max(LEAST_WORD_BITS, (rows * 16 // 64).bit_length()))


def repeated_bits(digests: DataFrame, word_bits: int) -> DataFrame:
    """Pass 1: filter words (``word``, ``bits``) with the bits that two or more rows set; at most 2 ** word_bits rows."""
    hashed = digests.select(F.xxhash64("text_sha256").alias("h"))
    hits = hashed.select(_word(F.col("h"), word_bits).alias("word"), F.explode(_bits(F.col("h"))).alias("bit"))
    twice = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").cast("int"))).alias("bits"))


def with_suspicion(digests: DataFrame, marked: DataFrame, word_bits: int) -> DataFrame:
    """Pass 2: adds ``maybe_repeated``; false means that no other row has this digest."""
    h = F.xxhash64("text_sha256")
    tested = digests.withColumn("word", _word(h, word_bits)).join(F.broadcast(marked), "word", "left")
    mask = _mask(h)
    return tested.withColumn("maybe_repeated", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False))).drop("word", "bits")


def _filtered(digests: DataFrame) -> tuple[DataFrame, int]:
    word_bits = word_bits_for(digests.count())
    return stored(repeated_bits(digests, word_bits), "dedup-filter"), word_bits


def find_copies(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id`` (largest key among equal texts), ``group_size``, ``kept``,
    ``text_sha256`` (of the text as it is, in UTF-8).

    A null text counts as empty. A null key is below all others; if a group has no key, ``keep_id`` is null and its rows
    are kept. Rows that share the kept key and the text are all marked kept. Other columns are ignored; no rows give none.
    """
    digests = stored(texts.select(F.col(f"`{key}`").alias("doc_id"), digest(text_of(f"`{text}`")).alias("text_sha256")), "dedup-digests")
    tested = with_suspicion(digests, *_filtered(digests))
    alone = tested.where("NOT maybe_repeated").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    suspects = tested.where("maybe_repeated").select("doc_id", "text_sha256")
    # Stored, so that the join below is between two plain shuffles and a group that holds a third of all rows is split.
    groups = stored(suspects.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    compared = suspects.join(groups, "text_sha256").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return alone.unionByName(compared)


def drop_copies(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows without copies: of equal texts, exactly one row with the largest key stays, whole.

    Ties on the key go to the row that is largest by its remaining columns in order. Rows that are alone are not shuffled.
    All columns must be of types that can be ordered (no maps).
    """
    boxed = texts.select(F.struct(*(F.col(f"`{c}`") for c in texts.columns)).alias("row"), F.col(f"`{key}`").alias("doc_id"), digest(text_of(f"`{text}`")).alias("text_sha256"))
    digests = stored(boxed.select("text_sha256"), "dedup-digests")
    tested = with_suspicion(boxed, *_filtered(digests))
    alone = tested.where("NOT maybe_repeated").select("row.*")
    best = tested.where("maybe_repeated").groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("best"))
    return alone.unionByName(best.select("best.row.*"))
