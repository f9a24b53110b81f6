"""Prefix trie of conversations: which openings are shared, by how many, and what storing each once would save.

A turn is known by the digest of its role and text, so texts do not travel. Conversations are dealt by ranges of their id and taken in
shards. Within a shard a vertical index holds, per (position, turn), a bitset of conversations; going depth-first, the bitset of a node
meets the postings of the next position, which gives its children, its count (popcount) and the conversations that end there. Nodes of
all shards meet by the digest of their path, as counts. Every node is owned by its smallest member, so sums over subtrees are taken in
the owners' shards, from the bottom up, and added.

A shared opening is one row per shard however many conversations have it; lists of ends travel a shard at a time in ascending order
and are digested as a stream. A task holds one shard, or one conversation where that is longer (24 bytes a turn).
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.frames import map_arrow, stored, text_of

#: Conversations and turns after which a shard ends; it always ends between conversations.
SHARD_CONVERSATIONS, SHARD_TURNS = 256, 100_000
#: Positions of a shard whose postings are kept; deeper ones are made from the members of the node at hand.
KEPT_POSITIONS = 4096
KEY = 16
ROOT = bytes(KEY)
_BATCH = 8192


def turn_keys(turns: DataFrame) -> DataFrame:
    """(conv_id, position, key, size) from (conv_id, turn, role, text): place from 1, digest of role and text, UTF-8 bytes of the text.

    Turns are ordered with null first, equal ones by key. Null role or text is empty. Rows without conv_id are left out.
    Other columns are ignored.
    """
    role, text = text_of("role"), text_of("text")
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, KEY)
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("key"), F.octet_length(text).cast("long").alias("size"))
    return rows.select("conv_id", F.row_number().over(W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")).cast("long").alias("position"), "key", "size")


# ---------------------------------------------------------------------------------------------------------------
# Nodes of a shard
# ---------------------------------------------------------------------------------------------------------------


class _Conversation:
    __slots__ = ("id", "keys", "sizes")

    def __init__(self, id: int) -> None:  # noqa: A002
        self.id, self.keys, self.sizes = id, bytearray(), array("q")

    def __len__(self) -> int:
        return len(self.sizes)

    def key(self, position: int) -> bytes:
        return bytes(self.keys[KEY * (position - 1) : KEY * position])


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[list[_Conversation]]:
    """Conversations, ascending, of rows sorted by conv_id and position; a row without key only names its conversation."""
    shard: list[_Conversation] = []
    turns = 0
    for batch in batches:
        for id_, key, size in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if not shard or shard[-1].id != id_:
                if len(shard) >= SHARD_CONVERSATIONS or turns >= SHARD_TURNS:
                    yield shard
                    shard, turns = [], 0
                shard.append(_Conversation(id_))
            if key is not None:
                shard[-1].keys += key
                shard[-1].sizes.append(size)
                turns += 1
    if shard:
        yield shard


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def _postings(shard: list[_Conversation], members: Iterable[int], position: int) -> dict[bytes, int]:
    """Bitset of the conversations that have each turn at a position."""
    out: dict[bytes, int] = defaultdict(int)
    for i in members:
        if len(shard[i]) >= position:
            out[shard[i].key(position)] |= 1 << i
    return out


def _nodes(shard: list[_Conversation]) -> Iterator[tuple]:
    """(path, depth, size, members, ends, smallest member, ids that end here) of each node, parents first, depth-first."""
    index: dict[int, dict[bytes, int]] = {}
    ended: dict[int, int] = defaultdict(int)
    for i, c in enumerate(shard):
        ended[len(c)] |= 1 << i
    stack = [((1 << len(shard)) - 1, 0, ROOT, 0)]
    while stack:
        members, depth, path, size = stack.pop()
        if not members & (members - 1):  # alone: the rest is a chain
            only = shard[members.bit_length() - 1]
            for d in range(depth, len(only)):
                yield path, d, size, 1, 0, only.id, None
                path, size = hashlib.blake2b(path + only.key(d + 1), digest_size=KEY).digest(), only.sizes[d]
            yield path, len(only), size, 1, 1, only.id, str(only.id)
            continue
        ends = members & ended[depth]
        yield path, depth, size, members.bit_count(), ends.bit_count(), shard[(members & -members).bit_length() - 1].id, ",".join(str(shard[i].id) for i in _bits(ends)) if ends else None
        going, position, children = members ^ ends, depth + 1, []
        if position > KEPT_POSITIONS:
            postings = _postings(shard, _bits(going), position)
        elif (postings := index.get(position)) is None:
            postings = index[position] = _postings(shard, range(len(shard)), position)
        while going:
            first = shard[(going & -going).bit_length() - 1]
            key = first.key(position)
            child = members & postings[key]
            going ^= child
            children.append((child, position, hashlib.blake2b(path + key, digest_size=KEY).digest(), first.sizes[depth]))
        stack += reversed(children)


_PARTS = pa.schema([("shard", pa.int64()), ("seq", pa.int64()), ("node", pa.binary()), ("depth", pa.int64()), ("size", pa.int64()), ("n", pa.int64()), ("n_ends", pa.int64()), ("first", pa.int64()), ("ends", pa.string())])
_PARTS_SQL = "shard long, seq long, node binary, depth long, size long, n long, n_ends long, first long, ends string"


def _in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((shard[0].id, i, *node) for shard in _shards(batches) for i, node in enumerate(_nodes(shard)))
    yield from _in_batches(rows, _PARTS)


# ---------------------------------------------------------------------------------------------------------------
# Sums over subtrees, and lists of ends
# ---------------------------------------------------------------------------------------------------------------

_SUMS = pa.schema([("node", pa.binary()), *((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))])
_SUMS_SQL = "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _subtree_sums(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows (shard, node, depth, first, owner, n, size, leaf) with descendants before their node; sums over owned nodes below."""
    sums: dict[int, list[int]] = {}  # by depth: children, leaves and saved bytes of the nodes whose parent is still to come
    waiting: dict[int, list[tuple]] = {}  # by depth: owned nodes whose parent is still to come
    for _, node, depth, first, owner, n, size, leaf in rows:
        children, leaves, saved = sums.pop(depth + 1, (0, 0, 0))
        for child in waiting.pop(depth + 1, ()):
            yield (*child[:3], owner, *child[3:])
        own = first == owner
        if own:
            leaves, saved = leaves + leaf, saved + (n - 1) * size
            row = (node, owner, depth, n, children, leaves, saved)
            if depth:
                waiting.setdefault(depth, []).append(row)
            else:
                yield (*row[:3], None, *row[3:])
        elif children or leaves or saved:
            yield (node, None, None, None, None, children, leaves, saved)
        if depth:
            above = sums.setdefault(depth, [0, 0, 0])
            above[0] += own
            above[1] += leaves
            above[2] += saved


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    yield from _in_batches(_subtree_sums(rows), _SUMS)


_ENDS = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])


def _digests(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(node, digest) of rows (node, ids) sorted by node and first id."""
    last, digest = None, None
    for node, ids in rows:
        if node != last:
            if digest:
                yield last, digest.hexdigest()
            last, digest = node, hashlib.sha256(ids.encode())
        else:
            digest.update(f",{ids}".encode())
    if digest:
        yield last, digest.hexdigest()


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    yield from _in_batches(_digests(rows), _ENDS)


# ---------------------------------------------------------------------------------------------------------------


def prefix_nodes(keys: DataFrame) -> DataFrame:
    """One row per node, from rows (conv_id, position, key, size) as ``turn_keys`` gives them.

    Only the order of positions counts, gaps may be. A row without key names a conversation that may have no turn. ``conv_id`` is the
    smallest member, ``n_children`` the children, ``n_leaves`` the nodes without children in the subtree, ``saved_tokens`` the sum over the
    subtree of (members - 1) times the size of the last turn, ``ends_sha256`` the digest of the ids that end here. No rows, no root.
    """
    rows = keys.select("conv_id", "key", "size", "position").repartitionByRange("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("position"))
    parts = stored(map_arrow(rows.drop("position"), _part_rows, _PARTS_SQL), "trie-parts")
    nodes = parts.groupBy("node").agg(F.sum("n").alias("all"), F.sum("n_ends").alias("all_ends"), F.min("first").alias("owner"))
    met = parts.select("shard", "seq", "node", "depth", "first", "size").join(nodes, "node")
    # Where all members end there is no child.
    upward = met.repartition("shard").sortWithinPartitions("shard", F.desc("seq"))
    upward = upward.select("shard", "node", "depth", "first", "owner", "all", "size", (F.col("all") == F.col("all_ends")).cast("long").alias("leaf"))
    sums = map_arrow(upward, _sum_rows, _SUMS_SQL).groupBy("node").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")], *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    )
    # The ranges of shards do not overlap, so shards in order give the ids in order.
    lists = parts.where("ends IS NOT NULL").select("node", "ends", "shard").repartition("node").sortWithinPartitions("node", "shard")
    digests = map_arrow(lists.drop("shard"), _digest_rows, "node binary, ends_sha256 string")
    return sums.join(digests, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of conversations as they are, with the ``role`` and ``text`` of each node's last turn (null for the root)."""
    keys = stored(turn_keys(turns), "trie-keys")
    said = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    # The owner's turn at the node's depth, found by its key: the same turn may stand at several places.
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, KEY)
    last = said.select("conv_id", digest.alias("key"), "role", "text").groupBy("conv_id", "key").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    nodes = prefix_nodes(keys)
    named = nodes.join(keys.select("conv_id", F.col("position").alias("depth"), "key"), ["conv_id", "depth"], "left")
    return named.join(last, ["conv_id", "key"], "left").drop("key")


def share_openings(keys: DataFrame, block: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt on the opening of another: conversation c has the first h turns of conversation c - c % ``block``, then its
    own turns after its first h; h is the crc32 of its decimal id modulo ``most``. Rows as ``turn_keys`` gives them, with a row without key
    for each conversation; positions may have gaps."""
    rows = keys.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    names = rows.where("position = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), "h")
    openings = rows.where(F.col("position") < most).select(F.col("conv_id").alias("base"), "position", "key", "size")
    opened = names.join(openings, "base").where("position <= h").select("conv_id", "position", "key", "size")
    own = rows.where("position > h").select("conv_id", "position", "key", "size")
    named = names.select("conv_id", F.lit(0).cast("long").alias("position"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("size"))
    return opened.unionByName(own).unionByName(named)
