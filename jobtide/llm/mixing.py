"""Mixing sources to target weights by hash thresholds, without sorting the documents.

Every document has a fixed 60-bit hash. Per source, sizes are summed by the leading bits of the hash; the running sums show
in which bucket the budget is used up. All buckets below it are taken whole and only that boundary bucket is summed
again by the next bits, until one hash value is left. The thresholds are nested: a larger budget takes a superset.

The document at a threshold would exceed the budget. Where what is left is more than ``NEAR`` of the target, the same is done again behind
it, over the documents that still fit: each pass reads fewer and leaves less. With many documents a source one pass is enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.frames import stored, text_of, word_count

HASH_BITS, STEP_BITS = 60, 12
#: Share of a target that may be left untaken while documents that fit are.
NEAR = 0.01


def row_hash(key: str, text: str) -> Column:
    """60 bits from key and text, so rows without a key still spread. Equal rows share a hash."""
    seed = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), text_of(text))
    return F.conv(F.substring(F.md5(seed), 1, 15), 16, 10).cast("long")


def capped_targets(totals: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``target`` per source (``source``, ``source_size``): ``share`` of all sizes by repeating ``weights``, none above ``most``
    times its source, the excess reshared by weight.

    Sources are numbered by code point, null last. The reshared excess has a closed form: in the order of size by weight,
    the first sources are capped and the rest share what is left by weight. One row per source takes part.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    listed = F.array(*(F.lit(float(w)) for w in weights))
    ranked = totals.withColumn("weight", F.get(listed, (F.row_number().over(order) - 1) % len(weights)))
    fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before, all_rows = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap = F.col("source_size") * F.lit(float(most))
    level = (F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    leveled = ranked.withColumn("cap", cap).withColumn("level", level)
    # Once a source is not capped at the level it sees, no later one is, and that level holds for the rest.
    final = F.first(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")), ignorenulls=True).over(all_rows)
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * final, F.col("cap")))
    return leveled.withColumn("target", target.cast("double")).select("source", "source_size", "target")


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source``, ``threshold``, ``below``: of each source, documents with a smaller hash together fit ``budget`` (they have ``below``); the next would not.
    Where all fit, the threshold is above every hash.

    ``sized`` has ``source``, ``size`` and ``hash``; ``budgets`` has one row per source. A level reads only the rows of the boundary
    buckets of the level before it, and a source's histogram has at most 2 ** STEP_BITS rows.
    """
    state = stored(budgets.select("source", "budget", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix"), F.lit(True).alias("open")), "mix-level")
    for bits in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        rest = HASH_BITS - bits
        bucket = F.shiftright("hash", rest)
        near = sized.alias("d").join(state.where("open").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.shiftright("hash", rest + STEP_BITS) == F.col("prefix")))
        sums = near.groupBy(F.col("d.source").alias("source"), bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.min("hash").alias("least"), F.max("hash").alias("most"), F.first("s.budget").alias("budget"), F.first("s.below").alias("below"))
        running = F.sum("size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        over = sums.withColumn("upto", F.col("below") + running).where("upto > budget").groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("size")).alias("below"), (F.col("least") < F.col("most")).alias("open"), "least"), "bucket").alias("b"))
        closed = state.alias("s").join(over.alias("o"), F.col("s.source").eqNullSafe(F.col("o.source")), "left")
        found = F.col("o.b").isNotNull()
        state = stored(
            closed.select(
                "s.source",
                "s.budget",
                F.when(found, F.col("o.b.below")).otherwise(F.col("s.below")).alias("below"),
                # What is open keeps the bucket's number; once one hash value is left, that value is the threshold.
                F.when(found & F.col("o.b.open"), F.col("o.b.bucket")).when(found, F.col("o.b.least")).when(F.col("s.open"), F.lit(1 << HASH_BITS)).otherwise(F.col("s.prefix")).alias("prefix"),
                F.coalesce(F.col("o.b.open"), F.lit(False)).alias("open"),
            ),
            "mix-level",
        )
        if state.where("open").isEmpty():
            break
    return state.select("source", F.col("prefix").alias("threshold"), "below")


def spans(sized: DataFrame, budgets: DataFrame, near: float = NEAR) -> DataFrame:
    """Stored ``source``, ``spans``: documents with a hash from ``start`` to before ``stop`` and at most ``most`` words are taken. ``budgets`` has ``source``,
    ``budget`` and ``target``. A source has a span for each pass, and each pass but the first takes up part of what the one before left."""
    passes = []
    state = stored(budgets.select("source", "target", "budget", F.lit(0).cast("long").alias("start"), F.lit(1 << HASH_BITS).cast("long").alias("most")), "mix-pass")
    while True:
        left = state.select(F.col("source").alias("of"), "start", "most")
        fit = sized if not passes else sized.join(left, F.col("source").eqNullSafe(F.col("of")) & (F.col("hash") >= F.col("start")) & (F.col("size") <= F.col("most"))).select("source", "size", "hash")
        found = thresholds(fit, state).select(F.col("source").alias("of"), "threshold", "below")
        state = stored(state.join(found, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "mix-pass")
        passes.append(state.select("source", F.struct("start", F.col("threshold").alias("stop"), "most").alias("span")))
        rest = F.col("budget") - F.col("below")
        again = state.where((F.col("threshold") < 1 << HASH_BITS) & (rest > near * F.col("target")))
        state = stored(again.select("source", "target", rest.alias("budget"), (F.col("threshold") + 1).alias("start"), F.floor(rest).cast("long").alias("most")), "mix-pass")
        if state.isEmpty():
            break
    return stored(reduce(DataFrame.unionByName, passes).groupBy("source").agg(F.collect_list("span").alias("spans")), "mix-spans")


def plan_mix(texts: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Sized rows (``doc_id``, ``source``, ``size``, ``hash``; stored, without texts), and per source ``source_size``, ``target``, ``whole`` (how
    often every document is taken) and ``spans`` (documents in one of them are taken once more)."""
    sized = stored(texts.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), word_count(text_of(f"`{text}`")).alias("size"), row_hash(f"`{key}`", f"`{text}`").alias("hash")), "mix-sizes")
    targets = stored(capped_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    planned = targets.withColumn("whole", whole)
    budgets = planned.select("source", "target", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    more = spans(sized, budgets).withColumnRenamed("source", "of")
    plan = planned.join(more, planned["source"].eqNullSafe(more["of"])).select("source", "source_size", "target", "whole", "spans")
    return sized, stored(plan, "mix-plan")


def _copies(most: float) -> Column:
    """Times a row is taken. Where whole passes already use up ``most``, nothing is added."""
    more = F.exists("p.spans", lambda s: (F.col("d.hash") >= s["start"]) & (F.col("d.hash") < s["stop"]) & (F.col("d.size") <= s["most"]))
    return F.least(F.col("p.whole") + more.cast("int"), F.lit(int(most)))


def mix_counts(texts: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per document: ``doc_id``, ``size`` (words), ``source_size``, ``target`` (its source's), ``taken`` (words, repeats counted).

    A null text has size 0; null is a source of its own, the last. A source's taken words stay at or below its target, and less than ``NEAR``
    of it is left unless every document that was not taken is larger than what was left when it was met (equal rows, which cannot be told
    apart, count as one). Reruns agree: the hash depends on key and text only. ``most`` is taken as a whole number of times. No rows give no rows.
    """
    sized, plan = plan_mix(texts, key, text, source, weights, share, most)
    joined = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    return joined.select("d.doc_id", "d.size", "p.source_size", "p.target", (F.col("d.size") * _copies(most)).cast("long").alias("taken"))


def mix(texts: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed rows themselves, each as often as it is taken, with the input's columns."""
    _, plan = plan_mix(texts, key, text, source, weights, share, most)
    boxed = texts.select(F.struct(*(F.col(f"`{c}`") for c in texts.columns)).alias("row"), F.col(f"`{source}`").cast("string").alias("source"), word_count(text_of(f"`{text}`")).alias("size"), row_hash(f"`{key}`", f"`{text}`").alias("hash"))
    joined = boxed.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), _copies(most))).alias("copy")).select("row.*")
