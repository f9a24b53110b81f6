"""Best-fit packing planned on the histogram of piece lengths.

The plan handles counts, not documents: lengths from the longest down, each into the fullest sequences that still have
room. It is a list of runs, so it and the histogram have a size that depends on the sequence length only. Pieces then
take the planned slots by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.frames import map_arrow, stored
from jobtide.llm.tokens import encoded


@dataclass(frozen=True)
class Run:
    """Pieces of ``length`` with ranks from ``rank`` fill ``sequences`` sequences from number ``first``, ``each`` in each, from ``offset`` on."""

    length: int
    rank: int
    first: int
    sequences: int
    each: int
    offset: int


def plan_slots(histogram: dict[int, int], room: int) -> list[Run]:
    """Best-fit decreasing over counts of lengths 1 to ``room``."""
    # open_at[r]: spans (first, count) of sequences with r places left
    open_at: list[list[tuple[int, int]]] = [[] for _ in range(room + 1)]
    runs: list[Run] = []
    started = 0
    for length in range(room, 0, -1):
        left, rank = histogram.get(length, 0), 0
        while left:
            space = next((r for r in range(length, room + 1) if open_at[r]), None)
            if space is None:
                fresh = -(-left // (room // length))
                open_at[room].append((started, fresh))
                started += fresh
                space = room
            first, count = open_at[space].pop()
            each = min(space // length, left)
            used = min(count, left // each)
            runs.append(Run(length, rank, first, used, each, room - space))
            open_at[space - each * length].append((first, used))
            if used < count:
                open_at[space].append((first + used, count - used))
            rank += used * each
            left -= used * each
    return runs


def _cut(batches: Iterator[pa.RecordBatch], path: str, end: int, room: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of each text; ``part`` and ``rank`` number the pieces of one length within a task."""
    part = TaskContext.get().partitionId()
    seen = np.zeros(room + 1, np.int64)
    for batch in batches:
        rows: list[tuple] = []
        for doc, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), path, end), strict=True):
            stop = len(ids) % room or room
            start = 0
            for piece in range(-(-len(ids) // room)):
                stop = min(stop, len(ids))
                raw = ids[start:stop].astype("<u4").tobytes()
                rows.append((doc, piece, start, stop - start, zlib.crc32(raw), part, int(seen[stop - start]), raw if with_ids else None))
                seen[stop - start] += 1
                start, stop = stop, stop + room
        columns = list(zip(*rows, strict=True)) or [()] * 8
        kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", "ids"])


def _place(batches: Iterator[pa.RecordBatch], runs: list[Run], room: int) -> Iterator[pa.RecordBatch]:
    table = np.array([(r.length, r.rank, r.first, r.each, r.offset) for r in runs], np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    bounds = np.searchsorted(table[:, 0], np.arange(room + 2))
    for batch in batches:
        names = batch.schema.names
        length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
        at = np.zeros(len(length), np.int64)
        for size in np.unique(length).tolist():
            low, high = bounds[size], bounds[size + 1]
            mine = length == size
            at[mine] = low + np.searchsorted(table[low:high, 1], rank[mine], side="right") - 1
        run = table[at]
        inside = rank - run[:, 1]
        sequence, offset = run[:, 2] + inside // run[:, 3], run[:, 4] + inside % run[:, 3] * length
        kept = [c for c in names if c not in ("part", "rank")]
        yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])


def pack(texts: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", room: int = 1024, end: int = 2, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` (little-endian unsigned 32-bit numbers; only
    with ``with_ids``), ``sequence_id``, ``offset``.

    A document is its ids and the end id; null and empty texts are the end id alone. Only documents longer than ``room`` are
    cut, the first piece taking the remainder. Sequences are numbered from 0 and filled without gaps. Rows that repeat are
    packed each; a null key stays null. Other columns are ignored; no rows give none. The pieces are stored once, so a
    repeated task cannot change a rank.
    """
    two = texts.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = two.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint, ids binary"
    pieces = map_arrow(two, partial(_cut, path=tokenizer, end=end, room=room, with_ids=with_ids), shape)
    pieces = stored(pieces if with_ids else pieces.drop("ids"), "pack-pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # At most ``room`` rows reach the driver.
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = stored(counts.select("part", "length", F.coalesce(before, F.lit(0).cast("long")).alias("before")), "pack-starts")
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before")).select(pieces.columns)
    slots = partial(_place, runs=plan_slots(histogram, room), room=room)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name not in ("part", "rank"))
    return map_arrow(ranked, slots, f"{kept}, sequence_id bigint, offset bigint")
