"""Source divergence audit: how far the word use of each source of a language is from the other sources and from the language.

A language keeps the terms that at least so many of its documents hold. The share of a term in a source, or in a language, is a whole
number of billionths, smoothed by two occurrences; the divergence of two shares p and q is (p - q)^2 / (p + q) without its fraction.
All arithmetic is in whole numbers, so results do not depend on the order of sums.

Terms of a source are ranked over count cells: terms with the same count in the source and in the language have the same value, so
cells are few. Cells of equal value merge, the ones that the ranks asked for can reach are found by running multiplicity, and only
their terms are listed, in order of their UTF-8 bytes.

Two sources are compared over all kept terms. Most terms are in one of them or in none: these are summed from the source's histogram of
counts. Terms that both have are summed in tasks dealt by term; where a language has many sources, these meet in tiles of sources. A task
holds a block of terms by the sources of two tiles and hands on one sum a pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.frames import map_arrow, stored, text_of

LEAST_DOCUMENTS, RANKS = 10, 10
SCALE = 1_000_000_000
#: Distinct terms that a task counts before it hands the counts on, and bytes of a text that it takes apart at a time.
HELD_TERMS, PIECE = 300_000, 4 << 20
#: Sources that meet in one tile, about.
TILE = 32
_ROWS = 32_768
#: Fixed value: a term is a longest run of ASCII letters and characters beyond ASCII. A-Z in lower case, all other ASCII becomes a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# ---------------------------------------------------------------------------------------------------------------
# Terms and counts
# ---------------------------------------------------------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time; pieces end between terms."""
    spaced, start = text.translate(TERM_BYTES), 0
    while len(spaced) - start > PIECE:
        end = spaced.rfind(b" ", start + 1, start + PIECE)
        if end < 0 and (end := spaced.find(b" ", start + PIECE)) < 0:
            break
        yield spaced[start:end].split()
        start = end
    yield spaced[start:].split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's documents; a pair of lang and source may come several times."""
    held: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for i in range(0, len(terms), _ROWS):
                part = terms[i : i + _ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for terms in _pieces(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            size += len(n) - before
            if size >= HELD_TERMS:
                yield from flushed()
                size = 0
    yield from flushed()


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, head) of the terms that at least so many documents of their language hold; ``head`` marks one row of each term of
    a language."""
    texts = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").cast("binary").alias("text"))
    # Dealt by language and term at once: the counts of a source, and the sums over the language, need no further exchange.
    counted = map_arrow(texts, _counted, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    by_group = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = W.partitionBy("lang", "term")
    known = by_group.withColumns({"lang_n": F.sum("n").over(whole), "lang_docs": F.sum("docs").over(whole), "head": F.row_number().over(whole.orderBy("source")) == 1})
    return known.where(F.col("lang_docs") >= least).select("lang", "source", "term", "n", "lang_n", "head")


def share(count: Column, total: Column, terms: Column) -> Column:
    """Billionths of the occurrences, exact for any counts: products are taken in 38 digits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.call_function("div", above, (total + 2 * terms).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def group_totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms, sources) of every group of documents, also without terms."""
    groups = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("head").alias("terms"))
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    joined = groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").join(sources, "lang")
    return joined.na.fill(0, ["total", "lang_total", "terms"])


# ---------------------------------------------------------------------------------------------------------------
# Terms of a source against its language
# ---------------------------------------------------------------------------------------------------------------


def top_terms(counts: DataFrame, totals: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses more than its language, up to so many ranks."""
    group = ["lang", "source"]
    cells = counts.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("many")).join(totals, group)
    shares = cells.select(*group, "n", "lang_n", "many", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    valued = stored(shares.where("p > q").select(*group, "n", "lang_n", "many", divergence(F.col("p"), F.col("q")).alias("value")), "count-cells")
    falling = W.partitionBy(*group).orderBy(F.desc("value"))
    # Every level of value holds a term at least, so no more levels than ranks are reached; tasks keep no more of them.
    levels = valued.groupBy(*group, "value").agg(F.sum("many").alias("many")).select(
        *group, "value", "many", F.row_number().over(falling).alias("level"), F.sum("many").over(falling.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("upto")
    )
    reached = levels.where((F.col("level") <= ranks) & (F.col("upto") - F.col("many") < ranks)).select(*group, "value")
    open_cells = valued.join(reached, [*group, "value"]).select(*group, "n", "lang_n", "value")
    listed = counts.select(*group, "term", "n", "lang_n").join(open_cells, [*group, "n", "lang_n"])
    place = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("value"), "term"))
    return listed.select(*group, F.col("term").alias("item"), "value", place.alias("rank")).where(F.col("rank") <= ranks)


# ---------------------------------------------------------------------------------------------------------------
# Sources of a language against each other
# ---------------------------------------------------------------------------------------------------------------


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Run:
    """Sums of two tiles of a language's sources over the terms that both sources of a pair have."""

    def __init__(self, key: tuple[str, int, int]) -> None:
        self.key, self.names, self.tiles, self.none = key, {}, [], []
        self.sums: dict[tuple[int, int], int] = {}

    def add(self, terms: np.ndarray, sources: list[str], tiles: list[int], p: np.ndarray, none: list[int]) -> None:
        """Rows of whole terms: the term's number, source, its tile, the term's share and the share of a term that it lacks."""
        column = np.empty(len(sources), np.int64)
        for i, (source, tile, z) in enumerate(zip(sources, tiles, none, strict=True)):
            at = self.names.get(source)
            if at is None:
                at = self.names[source] = len(self.names)
                self.tiles.append(tile)
                self.none.append(z)
            column[i] = at
        zero = np.array(self.none, np.int64)
        table = np.repeat(zero[None, :], int(terms[-1]) + 1, axis=0)
        held = np.zeros(table.shape, bool)
        table[terms, column], held[terms, column] = p, True
        tile = np.array(self.tiles)
        _, first, second = self.key
        for i in range(len(zero) - 1):
            # Pairs within a tile are summed where the tile meets itself.
            other = np.flatnonzero(tile[i + 1 :] == tile[i] if first == second else tile[i + 1 :] != tile[i]) + i + 1
            at = held[:, i].nonzero()[0]
            if not len(at) or not len(other):
                continue
            mine, theirs, z, zs = table[at, i][:, None], table[np.ix_(at, other)], zero[i], zero[other]
            # Zero where the other source lacks the term: what one of the two has alone is summed from its histogram.
            more = _f(mine, theirs) - _f(mine, zs[None, :]) - _f(z, theirs) + _f(z, zs)[None, :]
            for j, v in zip(other.tolist(), more.sum(axis=0).tolist(), strict=True):
                self.sums[i, j] = self.sums.get((i, j), 0) + v

    def rows(self) -> pa.RecordBatch:
        names = list(self.names)
        pairs = [(min(names[i], names[j]), max(names[i], names[j]), v) for (i, j), v in self.sums.items() if v]
        a, b, v = zip(*pairs, strict=True) if pairs else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array([self.key[0]] * len(pairs), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(v, pa.int64())], ["lang", "a", "b", "met"])


def _met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, first, second, term, source, tile, p, none) sorted by the first four; blocks end between terms."""
    run: _Run | None = None
    rest: pa.Table | None = None

    def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal run
        lang, first, second, term, source, tile, p, none = (table.column(i).combine_chunks() for i in range(8))
        runs = list(zip(lang.to_pylist(), first.to_pylist(), second.to_pylist(), strict=True))
        terms, start = term.to_pylist(), 0
        p, sources, tiles, nones = p.to_numpy(zero_copy_only=False), source.to_pylist(), tile.to_pylist(), none.to_pylist()
        while start < len(runs):
            end = start
            number, numbers = 0, []
            while end < len(runs) and runs[end] == runs[start]:
                number += end > start and terms[end] != terms[end - 1]
                numbers.append(number)
                end += 1
            if run is None or run.key != runs[start]:
                if run is not None:
                    yield run.rows()
                run = _Run(runs[start])
            run.add(np.array(numbers), sources[start:end], tiles[start:end], p[start:end], nones[start:end])
            start = end

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        keys = list(zip(*(table.column(i).to_pylist() for i in range(4)), strict=True))
        whole = next((i for i in range(len(keys) - 1, 0, -1) if keys[i] != keys[i - 1]), 0)
        if whole:
            yield from block(table.slice(0, whole))
        rest = table.slice(whole)
    if rest is not None and rest.num_rows:
        yield from block(rest)
    if run is not None:
        yield run.rows()


def source_pairs(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language by its divergence over all kept terms."""
    group = ["lang", "source"]
    lacking = share(F.lit(0), F.col("total"), F.col("terms"))
    rows = counts.select(*group, "term", "n").join(totals, group)
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    dealt = rows.select(
        *group, "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), lacking.alias("none"),
        F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"),
    ).select("lang", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "term", "source", "tile", "p", "none")
    order = ["lang", "first", "second", "term"]
    met = map_arrow(dealt.repartition(*order).sortWithinPartitions(*order), _met, "lang string, a string, b string, met long")
    met = met.groupBy("lang", "a", "b").agg(F.sum("met").alias("met"))
    sides = totals.where("terms > 0").select(*group, lacking.alias("none"))
    cells = rows.groupBy(*group, "n").agg(F.count(F.lit(1)).alias("many"), F.any_value("total").alias("total"), F.any_value("terms").alias("terms"))
    cells = cells.select("lang", "source", "many", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), lacking.alias("none"))
    other = sides.select("lang", F.col("source").alias("item"), F.col("none").alias("none_there"))
    more = divergence(F.col("p"), F.col("none_there")) - divergence(F.col("none"), F.col("none_there"))
    # How far the terms of ``source`` take it from a source that lacks them, beyond the terms that both lack.
    alone = cells.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("many") * more).alias("alone"))
    ends = totals.select(*group, "terms", F.when(F.col("terms") > 0, lacking).alias("none"))
    pairs = ends.join(totals.select("lang", F.col("source").alias("item"), F.when(F.col("terms") > 0, lacking).alias("none_there")), "lang").where("source <> item")
    pairs = pairs.join(alone, ["lang", "source", "item"], "left")
    pairs = pairs.join(alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_there")), ["lang", "source", "item"], "left")
    pairs = pairs.withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")}).join(met, ["lang", "a", "b"], "left")
    base = F.coalesce(F.col("terms") * divergence(F.col("none"), F.col("none_there")), F.lit(0))
    value = base + F.coalesce("alone", F.lit(0)) + F.coalesce("alone_there", F.lit(0)) + F.coalesce("met", F.lit(0))
    place = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("value"), "item"))
    return pairs.select(*group, "item", value.cast("long").alias("value")).select(*group, "item", "value", place.alias("rank"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) over columns ``lang``, ``source``, ``text``.

    Part "pair": every other source of the language; part "term": up to ``ranks`` terms that the source uses more than its language.
    Ranks start at 1 in each group and part; equal values go by the UTF-8 bytes of the item. Null lang, source or text is empty; every
    row counts as a document, repeated ones too. A group without kept terms is compared by shares of zero counts; a language without
    any gives pairs of value 0. Other columns are ignored; an empty table gives no rows.
    """
    counts = stored(term_counts(docs, least), "term-counts")
    totals = stored(group_totals(docs, counts), "group-totals")
    pairs = source_pairs(counts, totals).withColumn("part", F.lit("pair"))
    terms = top_terms(counts, totals, ranks).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
