"""The prefix trie against brute force: shared openings, turnless and repeated conversations, many shards, long conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobtide.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            out[c].append((turn is not None, turn or 0, key, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(original, block=5, most=9):
    out = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        out[c] = original.get(base, [])[:h] + own[h:]
    return out


def plain(convs):
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        turns = tuple(convs[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    rows = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        below = [rows[k] for k in children[node]]
        ends = ",".join(str(c) for c in members[node] if len(convs[c]) == len(node))
        rows[node] = (members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), len(below), sum(r[5] for r in below) or 1, own + sum(r[6] for r in below), hashlib.sha256(ends.encode()).hexdigest())
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def dice_rows(n, seed=1, words=3, longest=6):
    dice = random.Random(seed)
    return [(c, t, dice.choice(["user", "assistant", None]), dice.choice(["a", "é", "long text " * 3, None, ""][:words])) for c in dice.sample(range(-20, 4 * n), n) for t in range(dice.randint(1, longest))]


def test_nodes_equal_brute_force(spark, monkeypatch):
    rows = [*dice_rows(300), (7000, None, "user", "a"), (7000, 0, "user", "b"), (7000, 0, "user", "a"), (7001, None, "user", "a"), (None, 0, "user", "a")]
    table = spark.createDataFrame(rows, SCHEMA)
    keys = prefix_trie.turn_keys(table.repartition(3))
    expected = sorted(plain(conversations(rows)).values(), key=str)
    assert found(prefix_trie.prefix_nodes(keys)) == expected
    again = sorted(plain(rebuilt(conversations(rows))).values(), key=str)
    assert found(prefix_trie.prefix_nodes(prefix_trie.share_openings(keys))) == again != expected
    # Deep positions, whose postings are not kept, and the tasks of many shards give the same nodes.
    shards = [[prefix_trie._Conversation(i) for i in range(9)]]
    for c in shards[0]:
        for k in ([b"x"] * 30 + [b"yz"[c.id % 2 :][:1]] * c.id):
            c.keys += k * prefix_trie.KEY
            c.sizes.append(3)
    kept = list(prefix_trie._nodes(shards[0]))
    monkeypatch.setattr(prefix_trie, "KEPT_POSITIONS", 4)
    assert list(prefix_trie._nodes(shards[0])) == kept and len(kept) == 1 + 30 + 8 + 7


def test_copies_over_many_shards(spark):
    """More copies of one conversation than a shard holds, and their ends as one list."""
    n = 3 * prefix_trie.SHARD_CONVERSATIONS + 17
    table = spark.range(n).selectExpr("id * 7 AS conv_id", "explode(array(1L, 2L, 3L)) AS turn").selectExpr("conv_id", "turn", "'user' AS role", "IF(turn = 3 AND conv_id % 5 = 0, concat('own ', conv_id), 'same') AS text")
    convs = conversations([tuple(r) for r in table.collect()])
    assert found(prefix_trie.prefix_nodes(prefix_trie.turn_keys(table).repartition(5))) == sorted(plain(convs).values(), key=str)


def test_long_conversation_and_texts(spark):
    rows = [(1, t, "user", "x" * (t % 3)) for t in range(3000)] + [(2, t, "user", "x" * (t % 3)) for t in range(2900)] + [(2, 2900, "user", "é" * 100_000)]
    convs = conversations(rows)
    assert found(prefix_trie.prefix_nodes(prefix_trie.turn_keys(spark.createDataFrame(rows, SCHEMA)))) == sorted(plain(convs).values(), key=str)


def test_last_turns_of_nodes(spark):
    rows = dice_rows(40, seed=3)
    convs = conversations(rows)
    expected = {(r[0], r[1]): (node[-1] if node else (None, None)) for node, r in plain(convs).items()}
    named = prefix_trie.prefix_trie(spark.createDataFrame([(*r, 1, "c") for r in rows], f"{SCHEMA}, n_convs int, key string"))
    assert {(r.conv_id, r.depth): (r.role, r.text) for r in named.collect()} == expected and named.count() == len(expected)


def test_odd_tables(spark):
    none = spark.createDataFrame([], f"{SCHEMA}, position int")
    assert prefix_trie.prefix_nodes(prefix_trie.turn_keys(none)).count() == 0
    assert prefix_trie.prefix_nodes(prefix_trie.share_openings(prefix_trie.turn_keys(none))).count() == 0
    # Conversation 3 keeps nothing: its only turn is replaced by the opening of a conversation that is not there.
    only = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    keys = prefix_trie.turn_keys(spark.createDataFrame([(only, 0, "user", "hi")], SCHEMA))
    assert found(prefix_trie.prefix_nodes(prefix_trie.share_openings(keys))) == [(only, 0, None, 1, 0, 1, 0, hashlib.sha256(str(only).encode()).hexdigest())]
    assert keys.select(F.octet_length("key")).first()[0] == prefix_trie.KEY


@pytest.mark.parametrize("size", [1, 2, 7])
def test_small_shards(spark, monkeypatch, size):
    """Sums over shards of any size agree; run without Spark, as tasks import their own copy of the module."""
    monkeypatch.setattr(prefix_trie, "SHARD_CONVERSATIONS", size)
    rows = dice_rows(60, seed=size, words=2)
    convs = conversations(rows)
    import pyarrow as pa

    flat = [(c, hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()[:16], len(t.encode())) for c in sorted(convs) for r, t in convs[c]]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*flat[i : i + 7], strict=True)], ["c", "k", "s"]) for i in range(0, len(flat), 7)]
    nodes = [(s[0].id, i, *n) for s in prefix_trie._shards(batches) for i, n in enumerate(prefix_trie._nodes(s))]
    n, ends, owner, lists = defaultdict(int), defaultdict(int), {}, defaultdict(list)
    for shard, _, node, _, _, k, e, first, ids in nodes:
        n[node] += k
        ends[node] += e
        owner[node] = min(first, owner.get(node, first))
        lists[node] += [(shard, ids)] * (ids is not None)
    upward = [(s, node, d, first, owner[node], n[node], z, int(n[node] == ends[node])) for s, _, node, d, z, _, _, first, _ in sorted(nodes, key=lambda r: (r[0], -r[1]))]
    sums = defaultdict(lambda: [None, None, None, None, 0, 0, 0])
    for node, *values in prefix_trie._subtree_sums(upward):
        for i, v in enumerate(values):
            if i < 4:
                sums[node][i] = v if v is not None else sums[node][i]
            else:
                sums[node][i] += v
    digests = dict(prefix_trie._digests((node, ids) for node in sorted(lists) for _, ids in sorted(lists[node])))
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(((*v, digests.get(k, empty)) for k, v in sums.items()), key=str) == sorted(plain(convs).values(), key=str)
