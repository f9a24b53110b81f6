"""Near-duplicates by an inverted join on MinHash coordinates, confirmed on full shingle sets.

Texts with equal shingle sets form one node. A node is posted under each (coordinate, value) of its signature. Two nodes at
the similarity sought agree in at least ``MATCHES`` of ``COORDINATES`` places but for odds of about one in a million, so

- values that only one node has need no list, and each node may skip its ``MATCHES - 1`` longest lists: the pair still meets
  in one of the others (prefix and skip merging). Lists that a common passage makes long are the ones skipped;
- a list is not expanded into pairs. One node, the pivot, is compared with the rest of its list: the one with the most
  collisions of all, which is the middle of its group and has the most links. Jaccard distance is a metric: a node linked to
  the pivot can only link to nodes that are at most the allowed distance farther from the pivot;
- links found so far join nodes to components, over all lists. Nodes of one component are not compared again, and a list whose
  nodes are all of one component is done. Where several are left, nodes of the smaller ones are the next pivots;
- for nodes that are left after the first round, shingles that at most ``RARE`` of these nodes have are looked up. Two nodes
  that share one are compared at once: such lists have a fixed length. All other pairs share none of them, and the number of
  their other shingles bounds their similarity from above, so variants with many edits of their own meet few nodes. A large
  group without a middle is left, in which pairs are short of a link by shingles that many have: its work still grows with
  its size squared.

Pairs are compared by collision count first, on one byte of each coordinate. Only those that may be within reach are
compared by their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.components import components
from jobtide.llm.frames import map_arrow, stored, strings
from jobtide.llm.shingles import shingle_sets, signature

# Fixed values. At 75 % similarity a signature of 128 has 72 matches or more in all but 1.2 of a million pairs; at 50 %
# it has 36 or more with the same odds.
COORDINATES, MATCHES, RING_MATCHES = 128, 72, 36
LEAST_PERCENT = 75
#: Pivots of a list in the second round, and by how much they grow from round to round.
LATER_PIVOTS, GROWTH = 16, 4
#: A shingle is rare if at most so many of the nodes that are left have it.
RARE = 48


def _node(shingles: np.ndarray) -> int:
    """64-bit name of a shingle set."""
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signed(batches: Iterator[pa.RecordBatch], width: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets([t.encode() for t in strings(batch.column(2))], width)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) if len(s) else None for s in sets], pa.int64()), pa.array([signature(s, coordinates).tobytes() for s in sets], pa.binary())],
            ["doc", "text_hash", "n_shingles", "node", "signature"],
        )


def _postings(batches: Iterator[pa.RecordBatch], coordinates: int) -> Iterator[pa.RecordBatch]:
    """A posting (coordinate and value packed in one key) for each place of each signature."""
    place = np.arange(coordinates, dtype=np.int64) << 32
    for batch in batches:
        values = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, coordinates)
        keys = (values.astype(np.int64) | place).ravel()
        nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), coordinates)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])


def _single_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set."""
    for batch in batches:
        packed = batch.column(1).to_pylist()
        shingles = np.frombuffer(b"".join(packed), np.int64)
        nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), [len(s) // 8 for s in packed])
        for a in range(0, len(nodes), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[a : a + (1 << 16)]), pa.array(shingles[a : a + (1 << 16)])], ["node", "shingle"])


def _shingled(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets([t.encode() for t in strings(batch.column(1))], width)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])


def _brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest byte of each coordinate: equal coordinates stay equal, others agree by chance once in 256."""
    for batch in batches:
        brief = [np.frombuffer(s, np.uint32).astype(np.uint8).tobytes() for s in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(brief, pa.binary())], ["node", "brief"])


def _colliding(batches: Iterator[pa.RecordBatch], coordinates: int, matches: int) -> Iterator[pa.RecordBatch]:
    """The pairs with enough collisions."""
    for batch in batches:
        one, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, coordinates) for c in ("brief_a", "brief_b"))
        yield batch.select(["a", "b"]).filter(pa.array(np.count_nonzero(one == other, axis=1) >= matches))


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intersection and union of the sets of each pair."""
    for batch in batches:
        common, united = [], []
        for set_a, set_b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
            a, b = np.frombuffer(set_a, np.uint64), np.frombuffer(set_b, np.uint64)
            common.append(len(np.intersect1d(a, b, assume_unique=True)))
            united.append(len(a) + len(b) - common[-1])
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(united, pa.int64())], ["a", "b", "common", "united"])


def _plain(texts: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    return texts.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"))


def sign(texts: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, coordinates: int = COORDINATES) -> DataFrame:
    """Stored ``doc``, ``text_hash``, ``n_shingles``, ``node`` (null for a text without words) and ``signature`` of every row."""
    plain = _plain(texts, key, text)
    kind = plain.schema["doc"].dataType.simpleString()
    return stored(map_arrow(plain, partial(_signed, width=width, coordinates=coordinates), f"doc {kind}, text_hash bigint, n_shingles bigint, node bigint, signature binary"), "near-signatures")


def short_lists(nodes: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """Posting lists ``key``, ``node``, ``met`` of ``nodes`` (``node``, ``signature``; distinct) after skipping. ``met`` is the number of
    collisions that the node has with all others.

    Lists are ordered by length. A node keeps all but its ``matches - 1`` longest; values it shares with no one come first in
    that order and cost nothing. Nodes with fewer than ``matches`` shared values have no partner.
    """
    posted = map_arrow(nodes, partial(_postings, coordinates=coordinates), "key bigint, node bigint")
    # Stored, so that the join is between two plain shuffles and a long list is split.
    lengths = stored(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-lengths")
    shared = posted.join(lengths, "key").groupBy("node").agg(F.sum("n").alias("met"), F.sort_array(F.collect_list(F.struct("n", "key"))).alias("lists"))
    kept = shared.where(F.size("lists") >= matches).select("node", "met", F.explode(F.slice("lists", F.lit(1), F.size("lists") - (matches - 1))).alias("list"))
    return kept.select(F.col("list.key").alias("key"), "node", "met")


def _middles(lists: DataFrame) -> DataFrame:
    """``key``, ``pivot``, ``pivot_label``: the node of each list with the most collisions."""
    first = F.min(F.struct((-F.col("met")).alias("met"), F.xxhash64("node").alias("h"), F.col("node").alias("pivot"), F.col("label").alias("pivot_label")))
    return lists.groupBy("key").agg(first.alias("p")).select("key", "p.pivot", "p.pivot_label")


def _pivots(lists: DataFrame, count: int) -> DataFrame:
    """``key``, ``pivot``, ``pivot_label``, ``pivot_size``, ``pivot_common``: ``count`` nodes of each list, those first whose component has the
    fewest nodes in it."""
    sizes = lists.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("key").orderBy("n", "h", "node"))
    ranked = lists.join(sizes, ["key", "label"]).withColumn("h", F.xxhash64("node")).withColumn("rank", rank).where(F.col("rank") <= count)
    return ranked.select("key", *[F.col(c).alias(f"pivot_{c}") for c in ("label", "size", "common")], F.col("node").alias("pivot"))


def _rare_shingles(nodes: DataFrame, sets: DataFrame, rare: int) -> tuple[DataFrame, DataFrame]:
    """``node``, ``size``, ``common``: shingles of each of ``nodes``, and those of them that more than ``rare`` of the nodes have. And ``a``,
    ``b``: the pairs of nodes that share one of the others."""
    here = stored(sets.join(nodes.distinct(), "node", "left_semi").select("node", "shingles"), "near-open-sets")
    single = map_arrow(here, _single_shingles, "node bigint, shingle bigint")
    counts = stored(single.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= rare), "near-rare")
    posted = stored(single.join(counts, "shingle"), "near-rare-lists")
    own = posted.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    found = here.select("node", (F.octet_length("shingles") / 8).cast("long").alias("size")).join(own, "node", "left")
    bounds = stored(found.select("node", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("common")), "near-bounds")
    first, second = (posted.where("n > 1").select("shingle", F.col("node").alias(c)) for c in "ab")
    return bounds, first.join(second, "shingle").where("a < b").select("a", "b").distinct()


def _may_link(size: Column, other_size: Column, common: Column, least: int) -> Column:
    """Whether sets of these sizes can be similar enough with ``common`` shingles in both."""
    return least * (size + other_size) <= (100 + least) * common


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of different components."""
    ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b").where("label_a <> label_b").select("a", "b")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Stored ``node``, ``label`` after ``links`` (``a``, ``b``) between nodes."""
    ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab"]
    joined = links.join(ends[0], "a").join(ends[1], "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    merged = stored(components(joined).select(F.col("node").alias("label"), "root"), "near-merged")
    return stored(labels.join(merged, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "near-labels")


def _compared(pairs: DataFrame, briefs: DataFrame, sets: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """Stored ``a``, ``b``, ``common``, ``united`` of the ``pairs`` (``a``, ``b``) with at least ``matches`` collisions."""
    first, second = (briefs.select(F.col("node").alias(c), F.col("brief").alias(f"brief_{c}")) for c in "ab")
    near = stored(map_arrow(pairs.join(first, "a").join(second, "b"), partial(_colliding, coordinates=coordinates, matches=matches), "a bigint, b bigint"), "near-pairs")
    first, second = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    return stored(map_arrow(near.join(first, "a").join(second, "b"), _similarity, "a bigint, b bigint, common bigint, united bigint"), "near-compared")


def _unsettled(met: DataFrame, compared: DataFrame, labels: DataFrame, linked: Column, reach: int) -> DataFrame:
    """``key``, ``node`` of the nodes that were met by their list's pivot and may have a link that is not known yet.

    A node linked to the pivot has none if all nodes outside the pivot's component are too far from the pivot for it. Pairs that
    were not compared by their sets are farther from each other than twice the reach.
    """
    distance = 100.0 - 100.0 * F.coalesce(F.col("common") / F.col("united"), F.lit(0.0))
    pair = [F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")]
    near = met.select("key", "pivot", "node", *pair).join(compared, ["a", "b"], "left").select("key", "pivot", "node", F.coalesce(linked, F.lit(False)).alias("linked"), distance.alias("distance"))
    near = near.join(labels, "node").join(labels.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label")), "pivot")
    near = stored(near.select("key", "node", "linked", "distance", (F.col("label") != F.col("pivot_label")).alias("outside")), "near-distances")
    nearest = near.where("outside").groupBy("key").agg(F.min("distance").alias("nearest"))
    open_lists = near.join(nearest, "key")  # lists without a node outside are done
    return open_lists.where(~(F.col("linked") & (F.col("nearest") - F.col("distance") > reach + 1e-6))).select("key", "node")


def _open_lists(lists: DataFrame, least: int) -> DataFrame:
    """Stored lists with more than one component, less the nodes that are too unlike even the smallest set of their list."""
    lists = stored(lists, "near-lists")
    several = lists.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("size").alias("lowest")).where("low < high")
    kept = lists.join(several, "key").where(_may_link(F.col("size"), F.col("lowest"), F.col("common"), least))
    return stored(kept.drop("low", "high", "lowest"), "near-lists")


def roots(texts: DataFrame, signed: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, least: int = LEAST_PERCENT, coordinates: int = COORDINATES, matches: int = MATCHES, ring: int = RING_MATCHES, rare: int = RARE) -> DataFrame:
    """``node``, ``root`` (least node reachable) of every node that may have a link. ``ring`` collisions are those of pairs within
    twice the allowed distance."""
    classes = stored(signed.where("node IS NOT NULL").groupBy("node").agg(F.first("signature").alias("signature")), "near-classes")
    lists = stored(short_lists(classes, coordinates, matches), "near-lists")
    labels = stored(lists.select("node").distinct().withColumn("label", F.col("node")), "near-labels")
    # One text stands for its class. Only classes that have a list are read again.
    chosen = signed.join(labels, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc", "text_hash")).alias("row")).select("node", "row.doc", "row.text_hash")
    body = _plain(texts, key, text).alias("t").join(chosen.alias("c"), (F.col("t.text_hash") == F.col("c.text_hash")) & F.col("t.doc").eqNullSafe(F.col("c.doc")))
    one = body.groupBy("c.node").agg(F.first("t.text").alias("text"))
    sets = stored(map_arrow(one, partial(_shingled, width=width), "node bigint, shingles binary"), "near-sets")
    briefs = stored(map_arrow(classes.join(labels, "node", "left_semi").select("node", "signature"), _brief, "node bigint, brief binary"), "near-briefs")
    linked = 100 * F.col("common") >= least * F.col("united")
    lists = stored(lists.withColumn("label", F.col("node")), "near-lists")
    # The middle first: it settles the dense lists.
    met = stored(lists.join(_middles(lists), "key").where("label <> pivot_label").select("key", "pivot", "node"), "near-met")
    compared = _compared(_pairs(met), briefs, sets, coordinates, min(ring, matches))
    labels = _relabelled(labels, compared.where(linked))
    rest = stored(_unsettled(met, compared, labels, linked, 100 - least), "near-lists")
    bounds, sharing = _rare_shingles(rest.select("node"), sets, rare)
    labels = _relabelled(labels, _compared(_apart(sharing, labels), briefs, sets, coordinates, matches).where(linked))
    # No partner is smaller than the share sought of a set, so a node with fewer common shingles than that has none left.
    bounds = bounds.where(100 * F.col("common") >= least * F.col("size"))
    lists, count = _open_lists(rest.join(labels, "node").join(bounds, "node"), least), LATER_PIVOTS
    while not lists.isEmpty():  # what is left is uneven and gets several pivots at once
        pivots = stored(_pivots(lists, count), "near-pivots")
        may_link = _may_link(F.col("size"), F.col("pivot_size"), F.least("common", "pivot_common"), least)
        met = stored(lists.join(pivots, "key").where("label <> pivot_label").where(may_link).select("key", "pivot", "node"), "near-met")
        labels = _relabelled(labels, _compared(_pairs(met), briefs, sets, coordinates, matches).where(linked))
        # Pivots go: they have met all of their list that was outside their component and may link to them.
        rest = lists.drop("label").join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti")
        lists, count = _open_lists(rest.join(labels, "node"), least), count * GROWTH
    return labels.withColumnRenamed("label", "root")


def near_groups(texts: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: int = LEAST_PERCENT) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (least key reachable), ``kept``.

    A null or blank text has no shingles, links to nothing and is its own component. Rows with equal sets are one class, so
    copies cost one comparison. Rows that share a key share its fate by their text. A null key never becomes a component's
    name unless no row of the component has a key. Other columns are ignored; no rows give none.
    """
    signed = sign(texts, key, text, width)
    found = roots(texts, signed, text, key, width, least)
    named = signed.where("node IS NOT NULL").select("doc", "n_shingles", "node").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stored(named.select("doc", "n_shingles", "root"), "near-named")
    names = stored(named.groupBy("root").agg(F.min("doc").alias("component_id")), "near-names")
    linked = named.join(names, "root").select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")
    blank = signed.where("node IS NULL").select(F.col("doc").alias("doc_id"), "n_shingles", F.col("doc").alias("component_id"))
    return linked.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(texts: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: int = LEAST_PERCENT) -> DataFrame:
    """The rows of ``texts`` that :func:`near_groups` keeps: those with the least key of their component, all columns. Keys
    tell rows apart here; rows that repeat a kept key stay together."""
    gone = near_groups(texts, key, text, width, least).groupBy("doc_id").agg(F.bool_or("kept").alias("any_kept")).where("NOT any_kept").select(F.col("doc_id").alias("gone_id"))
    gone = stored(gone, "near-gone")
    return texts.join(gone, F.col(f"`{key}`").eqNullSafe(F.col("gone_id")), "left_anti")
