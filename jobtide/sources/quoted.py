"""Records of delimited text whose quoted fields hold line breaks, from files that are still read in parts.

A line either opens a quoted field that it does not close, closes one, or changes nothing, depending on whether it starts inside quotes.
So each part of a file is a function of its start state (inside or outside): parts are summed up on their own, their functions are
composed in order of their place, and then every part knows how it starts. The task that scans a part joins its lines to records, in the
order of the scan; only the records that go on over the end of a part are shuffled, and one row per part.

Quotes follow the rules of the usual readers: one opens a field only at the field's start, two within a quoted field are one quote, and
what follows the closing quote up to the delimiter belongs to the field.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.sources.tables import materialize

#: Bytes that a record over several lines may have. A quote that never closes would take the rest of the file for one field.
RECORD_BYTES = 1 << 20
_PART = ["file", "part"]


def _ends_inside(line: Column, delimiter: str) -> tuple[Column, Column]:
    """Whether a quoted field is open behind the line, if none or if one is open before it. All repeats are possessive, hence linear."""
    d = f"\\x{ord(delimiter):02X}"
    quoted = '(?:[^"]++|"")*+'
    whole = rf'(?:"{quoted}"[^{d}]*+|[^"{d}][^{d}]*+|){d}'
    opened = rf'(?:{whole})*+"{quoted}\z'
    outside = line.rlike(rf"\A{opened}")
    inside = line.rlike(rf'\A{quoted}(?:\z|"[^{d}]*+{d}{opened})')
    has_quote = F.contains(line, F.lit('"'))
    return F.when(has_quote, outside).otherwise(False), F.when(has_quote, inside).otherwise(True)


def text_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, part, place, value): lines with the start of their part and their order within it. Spark numbers rows of a scan by its partition,
    so ``place`` is the same in every scan of the same files."""
    return spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("place"), "value"
    )


def part_states(lines: DataFrame, delimiter: str) -> DataFrame:
    """One row per part: ``start`` (inside quotes), ``opens`` (a line may open a field), ``head`` (place of the first line that is not blank),
    ``after`` (inside behind its last line), and ``owner``, the part where the record begins that is open at the start."""
    out, in_ = _ends_inside(F.col("value"), delimiter)
    marked = lines.select(*_PART, "place", out.alias("o"), in_.alias("i"), F.col("value").rlike(r"(?U)\S").alias("filled"))
    # Lines that keep either state say nothing. The last one that ends alike from both fixes the state, and every one behind it that is no such line
    # turns it. From inside, the first line that does not stay there comes out.
    last = F.max(F.when(F.col("o") == F.col("i"), F.col("place") * 2 + F.col("o").cast("long")))  # a number: structs would be sorted by part
    heads = F.min(F.when(F.col("filled"), F.col("place")))
    parts = materialize(marked.groupBy(*_PART).agg(F.bool_or("o").alias("opens"), F.bool_or(~F.col("i")).alias("was_out"), heads.alias("head"), last.alias("last")), "part-sums")
    since = F.broadcast(parts.select(*_PART, F.coalesce(F.shiftright("last", 1), F.lit(-1)).alias("since")))
    turned = marked.where(F.col("o") & ~F.col("i")).join(since, _PART).where("place > since").groupBy(*_PART).agg(F.count(F.lit(1)).alias("swaps"))
    odd = F.coalesce("swaps", F.lit(0)) % 2 == 1
    folded = parts.join(turned, _PART, "left").select(*_PART, "opens", "was_out", "head", (F.col("last") % 2 == 1).alias("fixed_in"), odd.alias("odd"))
    in_order = W.partitionBy("file").orderBy("part")
    upto = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    # The state behind a part: that of the last part whose end is fixed, turned by every swap since; a file starts outside.
    counted = folded.withColumns({"turns": F.sum((F.col("fixed_in").isNull() & F.col("odd")).cast("long")).over(upto), "fixed": F.col("fixed_in") != F.col("odd")})
    based = counted.withColumns({"base": F.last("fixed", ignorenulls=True).over(upto), "base_turns": F.last(F.when(F.col("fixed").isNotNull(), F.col("turns")), ignorenulls=True).over(upto)})
    after = F.coalesce("base", F.lit(False)) != ((F.col("turns") - F.coalesce("base_turns", F.lit(0))) % 2 == 1)
    states = based.withColumn("after", after).withColumn("start", F.coalesce(F.lag("after").over(in_order), F.lit(False)))
    begins = F.col("after") & (~F.col("start") | F.col("was_out"))
    owners = states.withColumn("open_since", F.last(F.when(begins, F.col("part")), ignorenulls=True).over(upto))
    return owners.withColumn("owner", F.lag("open_since").over(in_order)).select(*_PART, "start", "opens", "head", "after", "owner")


def broken_parts(states: DataFrame) -> DataFrame:
    """Parts in which a record may go over several lines."""
    return states.where(F.col("start") | F.col("opens")).select(*_PART, "start", "owner")


def _line_joiner(whole: bool):
    """Joins lines (number of the part, start, first, o, i, value), in the order of the scan, to records: with ``whole`` those that begin and end
    in their part, else the pieces of the others, which either follow on an earlier part or are open behind their own. Text over
    ``RECORD_BYTES`` is null, and no more than that is held. A nested function travels to executors without this package."""
    most = RECORD_BYTES

    def join(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = {"number": pa.int64(), "follows": pa.bool_(), "first": pa.bool_(), "value": pa.binary()}
        now, inside, follows, first, held, size = None, False, False, False, [], 0

        def one():
            value = None if size - 1 > most else b"\n".join(held)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((now, follows, first, value), kind.values(), strict=True)], names=list(kind))

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]):
                if a == b:
                    continue
                starts, firsts, o, i = (batch.column(k).slice(a, b - a).to_numpy(zero_copy_only=False).astype(bool) for k in range(1, 5))
                values, n = batch.column(5).slice(a, b - a), b - a
                if now != numbers[a]:
                    if inside and not whole:
                        yield one()
                    now, inside, follows, first, held, size = int(numbers[a]), bool(starts[0]), bool(starts[0]), False, [], 0
                fixed, turns, place = o == i, np.cumsum(o & ~i), np.arange(n)
                last = np.maximum.accumulate(np.where(fixed, place, -1))
                base, base_turns = np.where(last < 0, inside, o[last]), np.where(last < 0, 0, turns[last])
                after = base ^ ((turns - base_turns) % 2 == 1)
                begins = np.flatnonzero(~np.append(inside, after[:-1]))
                edges = np.append(begins, n)
                ends_open = bool(after[-1])

                def hold(lines):
                    nonlocal size
                    size += (pc.sum(pc.binary_length(lines)).as_py() or 0) + len(lines)
                    if size - 1 > most:
                        held.clear()
                    else:
                        held.extend(lines.to_pylist())

                if edges[0]:  # lines of the record that was open
                    hold(values.slice(0, edges[0]))
                    if (len(begins) or not ends_open) and whole != follows:
                        yield one()
                if len(begins):
                    done = edges[: len(edges) - ends_open]
                    if whole and len(done) > 1:
                        lists = pa.ListArray.from_arrays(pa.array(done - done[0], pa.int32()), values.slice(done[0], done[-1] - done[0]))
                        records = pc.binary_join(lists, pa.scalar(b"\n", values.type))
                        records = pc.if_else(pc.greater(pc.binary_length(records), most), pa.scalar(None, values.type), records)
                        count = len(done) - 1
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(count, now), pa.int64()), pa.array(np.zeros(count, bool)), pa.array(firsts[done[:-1]]), records], names=list(kind))
                    follows, first, held, size = False, bool(firsts[begins[-1]]), [], 0
                    if ends_open:
                        hold(values.slice(begins[-1]))
                inside = ends_open
        if inside and not whole:
            yield one()

    return join


def read_records(lines: DataFrame, states: DataFrame, delimiter: str) -> DataFrame:
    """(file, value) of the records behind each file's first line, as the bytes of the file; line breaks within quotes are ``\\n``. Blank lines are
    no records."""
    parts = materialize(states.withColumn("number", F.monotonically_increasing_id()), "numbered-parts")
    # One row per part of a file, as many as the driver lists to plan the scan: sent to every task, so that lines stay in order.
    dealt = lines.join(F.broadcast(parts.withColumn("broken", F.col("start") | F.col("opens"))), _PART)
    dealt = dealt.withColumn("first", F.coalesce((F.col("part") == 0) & (F.col("place") == F.col("head")), F.lit(False)))
    plain = dealt.where(~F.col("broken")).select("file", "first", "value")
    out, in_ = _ends_inside(F.col("value"), delimiter)
    schema = "number long, follows boolean, first boolean, value binary"

    def joined(rows: DataFrame, whole: bool) -> DataFrame:
        text = rows.select("number", "start", "first", out.alias("o"), in_.alias("i"), F.col("value").cast("binary").alias("value"))
        found = text.mapInArrow(_line_joiner(whole), schema).join(F.broadcast(parts.select("number", *_PART, "owner")), "number")
        too_long = F.raise_error(F.concat(F.lit("a quoted field does not end in "), F.col("file"))).cast("string")
        return found.withColumn("value", F.when(F.col("value").isNull(), too_long).otherwise(F.col("value").cast("string")))

    whole = joined(dealt.where("broken"), True).select("file", "first", "value")
    pieces = joined(dealt.where("start OR after"), False).withColumn("of_part", F.when(F.col("follows"), F.col("owner")).otherwise(F.col("part")))
    # A part has one piece of a record at most.
    over_parts = pieces.groupBy("file", "of_part").agg(F.sort_array(F.collect_list(F.struct("part", "first", "value"))).alias("p"))
    over_parts = over_parts.select("file", F.col("p")[0]["first"].alias("first"), F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"))
    records = plain.unionByName(whole).unionByName(over_parts)
    return records.where(~F.col("first") & F.col("value").rlike(r"(?U)\S")).select("file", "value")
