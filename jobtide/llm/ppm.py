"""Language-model scores by prediction by partial matching over the bytes of texts.

The context of a byte is up to ``order`` bytes before it in the text, whose words stand one space apart. Without ``across``,
the contexts of a word end at its start, which counts as white space. A gram is a byte and the ``order`` bytes before it; its
probability is looked up once, however often texts hold it. Texts are gathered into chunks, and only a chunk's distinct grams
and words travel: to their counts, and back with their logarithms to the chunk's texts, which sum them by place. The context
trie is a set of tables, one per length, made from the counts of all training grams; nothing of it is held whole anywhere.

A byte is predicted in its longest context that training has seen. What that context has not seen is escaped with the
estimate "distinct / (total + distinct)", and the next shorter context then leaves out (excludes) all bytes that the
longer one could have given. Below the empty context all bytes not yet excluded are alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.frames import map_arrow, stored

#: The token after each text, and the byte after each word. Neither can be part of a word.
END, AFTER = b"\n", 0x20
#: Texts, bytes, and distinct grams and words that one chunk gathers before it hands them on.
CHUNK_TEXTS, CHUNK_BYTES, CHUNK_GRAMS, CHUNK_WORDS = 60_000, 64 << 20, 4_000_000, 1_000_000
#: Bytes of texts that travel in one row, and that are taken apart at once. A longer text is a row of its own.
BLOCK, PIECE = 4 << 20, 1 << 22
GAP = re.compile(rb"[ \t-\r]")
#: Rows that a task hands on at once, and that it packs at once into blocks by chunk.
ROWS, PACKED_ROWS = 100_000, 1_000_000
#: Blocks of grams and of words, before the chunk's texts (1, 2, ...).
GRAMS, WORDS = -2, -1


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The bytes in parts of about ``PIECE``, cut at white space."""
    at = 0
    while len(raw) - at > PIECE:
        gap = GAP.search(raw, at + PIECE)
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:]


def _grams(block: bytes, order: int, across: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Parts of a block of texts, each text its words with a space after each and an end. For each place the byte with the
    ``order`` bytes before it, packed in one number, the byte itself lowest; whether the byte is one of the text; the places
    that begin the part's texts, and the number in the block of the first of these."""
    pad = bytes([AFTER]) * order
    if not across:
        block = block.replace(bytes([AFTER]), bytes([AFTER]) + pad)
    spelled = (END + block).replace(END, END + pad)
    raw = np.frombuffer(spelled, np.uint8)
    size = len(spelled) - order - 1
    eights = np.ndarray((size,), ">u8", spelled + bytes(8), offset=1, strides=(1,))
    last = 0
    for a in range(0, size, PIECE):
        b = min(a + PIECE, size)
        here, before = raw[a + order + 1 : b + order + 1], raw[a + order : b + order]
        new = before == END[0]
        inside = (here != AFTER) | ((before != AFTER) & ~new)
        first = last + bool(a and new[0])
        new[0] = True
        begins = np.flatnonzero(new)
        last = first + len(begins) - 1
        yield (eights[a:b].astype(np.uint64) >> np.uint64(8 * (7 - order))).view(np.int64), inside, begins, first


def _distinct(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the sums of their counts."""
    if not values:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    every = np.concatenate(values)
    order = np.argsort(every, kind="stable")
    every = every[order]
    edges = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))[: len(every)]
    return every[edges], np.add.reduceat(np.concatenate(counts)[order], edges) if len(edges) else np.zeros(0, np.int64)


class _Chunk:
    """Many texts: their distinct grams and words with the counts in training texts, and blocks of the texts themselves."""

    def __init__(self, number: int, order: int, across: bool, kind: pa.DataType):
        self.number, self.order, self.across, self.kind = number, order, across, kind
        self.texts = self.bytes = self.blocks = 0
        self.words: Counter[bytes] = Counter()
        self.grams: tuple[np.ndarray, np.ndarray] = _distinct([], [])
        self.clear()

    def clear(self) -> None:
        # Training texts and held-out texts of the block under way, with their keys.
        self.open: dict[bool, tuple[list[bytes], list]] = {False: ([], []), True: ([], [])}
        self.gathered = 0

    def add(self, key, held: bool, text: bytes) -> None:
        parts = []
        for piece in _pieces(text.lower()):
            words = piece.split()
            if held:
                self.words.update(dict.fromkeys(words, 0))
            else:
                self.words.update(words)
            parts.extend((b" ".join(words), b" ") if words else ())
        self.words[END] += not held
        spelled = b"".join((*parts, END))
        self.open[held][0].append(spelled)
        self.open[held][1].append(key)
        self.texts, self.bytes, self.gathered = self.texts + 1, self.bytes + len(spelled), self.gathered + len(spelled)

    def full(self, most_texts: int) -> bool:
        return self.texts >= most_texts or self.bytes >= CHUNK_BYTES or len(self.grams[0]) >= CHUNK_GRAMS or len(self.words) >= CHUNK_WORDS

    def block(self) -> pa.RecordBatch:
        """The texts of the block under way, training texts first; their grams join those of the chunk."""
        values, counts = [self.grams[0]], [self.grams[1]]
        for held, (texts, _) in self.open.items():
            for grams, inside, _, _ in _grams(b"".join(texts), self.order, self.across) if texts else ():
                found = np.sort(grams[inside])
                edges = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))[: len(found)]
                values.append(found[edges])
                counts.append(np.diff(edges, append=len(found)) * (not held))
        self.grams = _distinct(values, counts)
        (learned, learned_keys), (kept, kept_keys) = self.open.values()
        whole = b"".join((*learned, *kept))
        self.blocks += 1
        row = self.row(1)
        row["seq"] = pa.array([self.blocks], pa.int32())
        row["text"] = pa.array([pa.compress(whole, "zstd", asbytes=True)], pa.binary())
        row["count"] = pa.array([len(whole)], pa.int64())
        row["keys"] = pa.array([learned_keys + kept_keys], pa.list_(self.kind))
        row["held"] = pa.array([[False] * len(learned) + [True] * len(kept)], pa.list_(pa.bool_()))
        self.clear()
        return pa.RecordBatch.from_pydict(row)

    def row(self, n: int) -> dict[str, pa.Array]:
        kinds = {"seq": pa.int32(), "gram": pa.int64(), "word": pa.binary(), "count": pa.int64(), "text": pa.binary(), "keys": pa.list_(self.kind), "held": pa.list_(pa.bool_())}
        return {"chunk": pa.array(np.full(n, self.number), pa.int64())} | {name: pa.nulls(n, kind) for name, kind in kinds.items()}

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.gathered:
            yield self.block()
        grams, counts = self.grams
        for at in range(0, len(grams), ROWS):
            row = self.row(len(grams[at : at + ROWS]))
            yield pa.RecordBatch.from_pydict(row | {"gram": pa.array(grams[at : at + ROWS]), "count": pa.array(counts[at : at + ROWS], pa.int64())})
        words, counts = list(self.words), list(self.words.values())
        for at in range(0, len(words), ROWS):
            row = self.row(len(words[at : at + ROWS]))
            yield pa.RecordBatch.from_pydict(row | {"word": pa.array(words[at : at + ROWS], pa.binary()), "count": pa.array(counts[at : at + ROWS], pa.int64())})


def _chunks(batches: Iterator[pa.RecordBatch], order: int, across: bool, most_texts: int) -> Iterator[pa.RecordBatch]:
    chunk = None
    for batch in batches:
        kind = batch.schema.field(1).type
        for row, key, held, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if chunk is None:
                chunk = _Chunk(row, order, across, kind)
            chunk.add(key, held, text or b"")
            if chunk.gathered >= BLOCK:
                yield chunk.block()
            if chunk.full(most_texts):
                yield from chunk.rows()
                chunk = None
    if chunk is not None:
        yield from chunk.rows()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk's grams and ``log_p``, or of its words, their ``count`` in the chunk and ``total``, packed into blocks by
    chunk; ``n`` and ``v`` sum the counts and the words that are ``first`` of their kind and occur in training texts."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= PACKED_ROWS:
            yield _blocks(pa.Table.from_batches(held))
            held, size = [], 0
    if size:
        yield _blocks(pa.Table.from_batches(held))


def _blocks(rows: pa.Table) -> pa.RecordBatch:
    named = "word" in rows.column_names
    chunk = rows["chunk"].to_numpy()
    order = np.argsort(chunk, kind="stable") if named else np.lexsort((rows["gram"].to_numpy(), chunk))
    chunk, rows = chunk[order], rows.take(order)
    edges = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
    n = v = np.zeros(len(edges), np.int64)
    if named:
        names, values = rows["word"].to_pylist(), rows["total"].to_numpy()
        n, v = np.add.reduceat(rows["count"].to_numpy(), edges), np.add.reduceat((rows["first"].to_numpy() & (values > 0)).astype(np.int64), edges)
    else:
        grams, values = rows["gram"].to_numpy(), rows["log_p"].to_numpy()
    keys, sizes, of = [], [], []
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(chunk)], strict=True):
        raw = b" ".join(names[a:b]) if named else np.diff(grams[a:b], prepend=0).tobytes()
        keys.append(pa.compress(raw, "zstd", asbytes=True))
        sizes.append(len(raw))
        of.append(pa.compress(values[a:b].tobytes(), "zstd", asbytes=True))
    return pa.RecordBatch.from_pydict({"chunk": pa.array(chunk[edges]), "seq": pa.array(np.full(len(edges), WORDS if named else GRAMS, np.int32)), "text": pa.array(keys, pa.binary()), "count": pa.array(sizes, pa.int64()), "logs": pa.array(of, pa.binary()), "n": pa.array(n), "v": pa.array(v)})


class _Values:
    """Logarithms of a chunk's grams and words."""

    def __init__(self, order: int, across: bool, tokens: int):
        self.order, self.across, self.tokens = order, across, tokens
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.grams: pa.Array | None = None
        self.place: dict[bytes, int] = {}
        self.counts: list[np.ndarray] = []

    def add(self, seq: int, keys: bytes, values: bytes) -> None:
        if seq == GRAMS:
            self.parts.append((np.cumsum(np.frombuffer(keys, np.int64)), np.frombuffer(pa.decompress(values, len(keys), "zstd", asbytes=True), np.float64)))
        else:
            words = keys.split(b" ")
            self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
            self.counts.append(np.frombuffer(pa.decompress(values, 8 * len(words), "zstd", asbytes=True), np.int64))

    def ready(self) -> None:
        if self.grams is None:
            self.grams = pa.array(np.concatenate([g for g, _ in self.parts]))
            self.logs = np.concatenate([p for _, p in self.parts])
            counts = np.concatenate(self.counts)
            self.flat, self.known = np.log10((counts + 1) / self.tokens), counts > 0
            self.parts = self.counts = []

    def sums(self, block: bytes) -> dict[str, np.ndarray]:
        """Tokens, known tokens and both scores of each text of a block."""
        self.ready()
        raw = np.frombuffer(block, np.uint8)
        ends = np.flatnonzero(raw == END[0])
        words = np.add.reduceat((raw == AFTER).view(np.int8), np.concatenate(([0], ends[:-1] + 1)), dtype=np.int64)
        score = np.zeros(len(ends) + 1)  # the last is the white space behind the last text
        for grams, inside, begins, first in _grams(block, self.order, self.across):
            logs = np.zeros(len(grams))
            logs[inside] = self.logs[pc.index_in(pa.array(grams[inside]), value_set=self.grams).to_numpy()]
            score[first : first + len(begins)] += np.add.reduceat(logs, begins)
        end = self.place[END]
        known, base = np.full(len(ends), int(self.known[end])), np.full(len(ends), self.flat[end])
        edges, at = np.cumsum(words), 0
        for piece in _pieces(block):
            tokens = piece.split()
            place = np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))
            text = np.searchsorted(edges, np.arange(at, at + len(tokens)), side="right")
            known += np.bincount(text[self.known[place]], minlength=len(ends))
            base += np.bincount(text, weights=self.flat[place], minlength=len(ends))
            at += len(tokens)
        return {"n_tokens": words + 1, "n_known": known, "base_score": base, "score": score[:-1]}


def _scored(batches: Iterator[pa.RecordBatch], order: int, across: bool, tokens: int) -> Iterator[pa.RecordBatch]:
    """The texts of each chunk with their sums; a chunk's rows come together, its texts last."""
    number, values = None, None
    for batch in batches:
        for i, (chunk, seq, size) in enumerate(zip(*(batch[c].to_pylist() for c in ("chunk", "seq", "count")), strict=True)):
            if chunk != number:
                number, values = chunk, _Values(order, across, tokens)
            raw = pa.decompress(batch["text"][i].as_py(), size, "zstd", asbytes=True)
            if seq in (GRAMS, WORDS):
                values.add(seq, raw, batch["logs"][i].as_py())
            else:
                sums = values.sums(raw)
                yield pa.RecordBatch.from_pydict({"doc_id": batch["keys"].slice(i, 1).flatten(), "held_out": batch["held"].slice(i, 1).flatten()} | {name: pa.array(each) for name, each in sums.items()})


def _chunked(texts: DataFrame, key: str, text: str, held_out, order: int, across: bool) -> DataFrame:
    """Stored chunks of texts, numbered by ``chunk``: rows of ``gram`` and ``count`` (in training texts), rows of ``word`` and
    ``count``, and rows of ``text`` (``count`` bytes when taken apart) with the texts' ``keys``."""
    plain = texts.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    kind = plain.schema["key"].dataType.simpleString()
    return stored(map_arrow(plain, partial(_chunks, order=order, across=across, most_texts=CHUNK_TEXTS), f"chunk bigint, seq int, gram bigint, word binary, count bigint, text binary, keys array<{kind}>, held array<boolean>"), "ppm-chunks")


def gram_log_p(grams: DataFrame, order: int) -> DataFrame:
    """``gram``, ``log_p`` (log10) for every row of ``grams`` (``gram``, ``train``: training count, 0 if only to be scored)."""
    level = stored(grams.where("train > 0").select("gram", F.col("train").alias("c")), "ppm-level")
    # What is still to be predicted, its log so far, and what the longer context excludes: mass and number of bytes.
    todo = grams.select("gram", F.lit(0.0).alias("log_p"), F.lit(0).cast("long").alias("out_mass"), F.lit(0).cast("long").alias("out_bytes"))
    done: list[DataFrame] = []
    for k in range(order, -1, -1):
        here = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        if k:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
            below = stored(level.groupBy(shorter.alias("gram")).agg(F.sum("c").alias("c")), "ppm-level")
            both = level.withColumn("short", shorter).join(below.select(F.col("gram").alias("short"), F.col("c").alias("c_short")), "short")
        else:
            below, both = None, level.withColumn("c_short", F.lit(0).cast("long"))
        nodes = stored(both.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("c_short").alias("mass")), "ppm-nodes")
        at = todo.withColumn("here", here).withColumn("context", F.shiftright(here, 8))
        found = at.join(nodes, "context", "left").join(level.select(F.col("gram").alias("here"), "c"), "here", "left")
        total, new = F.col("total") - F.col("out_mass"), F.col("distinct") - F.col("out_bytes")
        met = found.withColumn("total", total).withColumn("new", new)
        met = stored(met.select("gram", "log_p", "out_mass", "out_bytes", "c", "total", "new", "distinct", "mass"), "ppm-met")
        done.append(met.where("c IS NOT NULL").select("gram", (F.col("log_p") + F.log10(F.col("c") / (F.col("total") + F.col("new")))).alias("log_p")))
        # An unseen context costs nothing and excludes nothing; one whose bytes are all excluded is left with certainty.
        escape = F.when(F.col("new") > 0, F.log10(F.col("new") / (F.col("total") + F.col("new")))).otherwise(0.0)
        left = met.where("c IS NULL")
        todo = left.select("gram", (F.col("log_p") + escape).alias("log_p"), F.coalesce("mass", F.lit(0)).cast("long").alias("out_mass"), F.coalesce("distinct", F.lit(0)).cast("long").alias("out_bytes"))
        level = below
    done.append(todo.select("gram", (F.col("log_p") - F.log10(256.0 - F.col("out_bytes"))).alias("log_p")))
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return stored(every, "ppm-grams")


def score(texts: DataFrame, held_out, key: str = "doc_id", text: str = "text", order: int = 5, across: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``held_out`` is a boolean column; rows where it is true are not learned from (null: learned from). Tokens are the words in
    lower-case A-Z and one end. ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens (c: training count, N: all
    training tokens, V: distinct ones); ``score`` is the model's log10 probability of the text. A null or empty text is the end
    token alone. With ``across``, contexts run over the starts of words. Repeated rows count and are scored each. No rows give none.
    """
    chunks = _chunked(texts, key, text, held_out, order, across)
    grams, words = chunks.where("gram IS NOT NULL").select("chunk", "gram", "count"), chunks.where("word IS NOT NULL").select("chunk", "word", "count")
    same = Window.partitionBy("word").orderBy("chunk")
    total = F.sum("count").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    block = "chunk bigint, seq int, text binary, count bigint, logs binary, n bigint, v bigint"
    counted = stored(map_arrow(words.select("chunk", "word", "count", total.alias("total"), (F.row_number().over(same) == 1).alias("first")), _packed, block), "ppm-counts")
    sums = counted.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    logs = gram_log_p(stored(grams.groupBy("gram").agg(F.sum("count").alias("train")), "ppm-all-grams"), order)
    met = map_arrow(grams.select("chunk", "gram").join(logs, "gram").select("chunk", "gram", "log_p"), _packed, block)
    every = met.unionByName(counted).drop("n", "v").unionByName(chunks.where("text IS NOT NULL").drop("gram", "word"), allowMissingColumns=True)
    kind = chunks.schema["keys"].dataType.elementType.simpleString()
    scored = map_arrow(every.repartition("chunk").sortWithinPartitions("chunk", "seq"), partial(_scored, order=order, across=across, tokens=n + v + 1), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
