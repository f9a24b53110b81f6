"""Token ids in files of fixed-width bits.

An id takes the least number of bits that the vocabulary needs. A file holds blocks of ``BLOCK_IDS`` ids, then the offset of
every block, then the key and end of every document, then a fixed-size tail; so any range of ids is read by its blocks
alone and unpacked with numpy. Each task writes one file of a key range to the shared folder.

    file  = MAGIC, bits u32, ids a block u32, blocks, block offsets u64 each, documents, tail
    documents = 1 byte each (key present), keys i64 each, ends in ids u64 each
    tail  = number of ids, of documents, of blocks, position of the block offsets (u64 each), MAGIC
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.frames import map_arrow, stored
from jobtide.llm.tokens import _tokenizer, encoded
from jobtide.sources.tables import scratch_path

MAGIC = b"JTBITS01"
HEAD, TAIL = struct.Struct("<8sII"), struct.Struct("<QQQQ8s")
#: A multiple of 8, so that blocks end at whole bytes.
BLOCK_IDS = 8192


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(each, bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = each
    return np.packbits(wide, bitorder="little").view("<u4").astype(np.uint32)


class BitWriter:
    def __init__(self, sink, bits: int):
        self.sink, self.bits = sink, bits
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.offsets: list[int] = []
        self.keys: list[int | None] = []
        self.ends: list[int] = []
        self.sink.write(HEAD.pack(MAGIC, bits, BLOCK_IDS))
        self.position = HEAD.size

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        self.keys.append(key)
        self.ends.append(self.n_ids)
        if self.held >= 16 * BLOCK_IDS:
            self._flush(self.held - self.held % BLOCK_IDS)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for start in range(0, count, BLOCK_IDS):
            data = pack_bits(ids[start : min(start + BLOCK_IDS, count)], self.bits)
            self.offsets.append(self.position)
            self.sink.write(data)
            self.position += len(data)
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._flush(self.held)
        place = self.position
        self.sink.write(np.array(self.offsets, "<u8").tobytes())
        self.sink.write(bytes(k is not None for k in self.keys))
        self.sink.write(np.array([k or 0 for k in self.keys], "<i8").tobytes())
        self.sink.write(np.array(self.ends, "<u8").tobytes())
        self.sink.write(TAIL.pack(self.n_ids, len(self.keys), len(self.offsets), place, MAGIC))


class BitReader:
    """Random access to one file: ``ids(start, stop)`` reads the blocks of that range only."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - TAIL.size)
        self.n_ids, self.n_docs, blocks, place, mark = TAIL.unpack(source.read(TAIL.size))
        source.seek(0)
        head, self.bits, self.block_ids = HEAD.unpack(source.read(HEAD.size))
        if mark != MAGIC or head != MAGIC:
            raise ValueError("not a bit-packed file, or not a whole one")
        source.seek(place)
        self.offsets = np.append(np.frombuffer(source.read(8 * blocks), "<u8"), place).astype(np.int64)
        present = np.frombuffer(source.read(self.n_docs), np.uint8)
        keys = np.frombuffer(source.read(8 * self.n_docs), "<i8")
        self.keys = [k if p else None for k, p in zip(keys.tolist(), present.tolist(), strict=True)]
        self.ends = np.frombuffer(source.read(8 * self.n_docs), "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        self.source.seek(int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        base = first * self.block_ids
        return unpack_bits(data, self.bits, min(self.n_ids, (last + 1) * self.block_ids) - base)[start - base : stop - base]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Key, start and ids of each document, read in stretches of many blocks."""
        begin, stretch = 0, np.empty(0, np.uint32)
        start = 0
        for key, end in zip(self.keys, self.ends.tolist(), strict=True):
            if end > begin + len(stretch):
                stretch = self.ids(start, min(self.n_ids, max(end, start + 64 * self.block_ids)))
                begin = start
            yield key, start, stretch[start - begin : end - begin]
            start = end


def open_shared(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared path; ``s3a`` is the Hadoop name of ``s3``."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end: int, bits: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    system, place = open_shared(folder)
    part = context.partitionId()
    name = f"{place}/part-{part:06d}.bits"
    trial = f"{place}/.trial-{part:06d}-{context.taskAttemptId()}"
    writer = sink = None
    for batch in batches:
        for key, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), tokenizer, end), strict=True):
            if writer is None:
                sink = system.open_output_stream(trial)
                writer = BitWriter(sink, bits)
            writer.add(key, ids)
    if writer is not None:
        writer.close()
        sink.close()
        system.move(trial, name)  # whole or not at all; a repeated task puts an equal file in its place
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/part-{part:06d}.bits"], "n_docs": pa.array([len(writer.keys)], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})


def write_ids(texts: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 2, folder: str | None = None) -> DataFrame:
    """Write every text's ids and the end id in ascending key order; returns the files: ``part``, ``path``, ``n_docs``, ``n_ids``,
    ``start`` (ids in all files before it).

    Keys are whole numbers; null comes first. Rows with one key are ordered by their text's hash and split over files if
    they are many. A null text is empty. Other columns are ignored. No rows give no files.
    """
    spark = texts.sparkSession
    folder = folder or scratch_path(spark, "bits")
    system, place = open_shared(folder)
    system.create_dir(place, recursive=True)
    body = F.col(f"`{text}`").cast("string")
    rows = texts.select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "h", "row"]
    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("doc_id", "text")
    write = partial(_write, folder=folder, tokenizer=tokenizer, end=end, bits=bits_for(_tokenizer(tokenizer).get_vocab_size()))
    files = stored(map_arrow(ordered, write, "part int, path string, n_docs bigint, n_ids bigint"), "bits-files")
    before = F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return files.withColumn("start", F.coalesce(before, F.lit(0).cast("long")))


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            system, place = open_shared(path)
            rows, held = [], 0
            with system.open_input_file(place) as source:
                for key, start, ids in BitReader(source).documents():
                    raw = ids.astype("<u4").tobytes()
                    rows.append((key, base + start, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    held += len(raw) if with_ids else 64
                    if held > 1 << 24:
                        yield made(rows)
                        rows, held = [], 0
            if rows:
                yield made(rows)


def read_ids(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the files that :func:`write_ids` lists: ``doc_id``, ``start`` (over all files), ``n_tokens``, ``ids_crc32``, ``ids``
    (little-endian unsigned 32-bit numbers; null without ``with_ids``). One task a file."""
    listed = files.select("path", "start")
    dealt = listed.repartition(max(1, files.count()), "path")
    return map_arrow(dealt, partial(_read, with_ids=with_ids), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
