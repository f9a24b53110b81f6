"""The source audit against brute force: uneven sources, ties, many sources in tiles, odd rows."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from jobtide.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, source string, text string"


def plain(rows, least, ranks):
    held, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(UPPER))
        groups[lang].add(source)
        held[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)
        share = lambda n, total: 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)  # noqa: B023, E731
        f = lambda p, q: (p - q) * (p - q) // (p + q)
        total = {s: sum(held[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(held[lang, s][t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(held[lang, s][t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, f(p[s][t], q[t])) for t in kept if held[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1)]
    return sorted(out)


def made(n, sources, words, seed=5):
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "naïve", "日本", "\U0001f600", "\u0085x"]
    name = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = []
    for _ in range(n):
        s = min(int(dice.expovariate(3 / sources)), sources - 1)
        picked = [re.sub(r"\d+", lambda m: name(int(m[0])), dice.choice(vocabulary)) for _ in range(dice.randint(0, 60))]
        rows.append((dice.choice(["en", "en", "fr"]), f"s{s}", dice.choice([" ", "1", "-\n"]).join(picked).title()))
    return rows


ODD = [(None, None, None), ("", "x", "alone ALONE"), ("de", None, ""), ("de", "z", "12 !"), ("de", "z", "12 !"), ("en", "empty", None), ("it", "only", "uno due")]


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def test_audit_equals_brute_force(spark):
    rows = made(400, 6, 60) + ODD
    docs = spark.createDataFrame([(*r, 1, "p", 0) for r in rows], f"{SCHEMA}, value int, part string, rank int").repartition(4)
    for least, ranks in ((10, 10), (1, 3)):
        expected = plain(rows, least, ranks)
        assert found(divergence.audit(docs, least, ranks)) == expected
        assert {r[2] for r in expected} == {"pair", "term"} and any(r[:3] == ("de", "", "pair") and r[4] == 0 for r in expected)


def test_sources_in_tiles(spark):
    """More sources than a tile takes, most of them without most terms, and a long list of ties."""
    rows = made(700, 90, 30) + [("en", "ties", " ".join(f"{a}{b}" for a in "abcdefghij" for b in "xyzuvw")) for _ in range(2)]
    assert len({r[1] for r in rows}) > 2 * divergence.TILE
    assert found(divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), 2, 10)) == plain(rows, 2, 10)


def test_empty_and_very_long(spark):
    assert divergence.audit(spark.createDataFrame([], f"{SCHEMA}, doc_id long")).count() == 0
    text = "one Two " * 400_000 + "x" * 3_000_000 + " " + "three" * 2_000_000
    rows = [("en", "a", text), ("en", "b", "one"), ("en", "b", "two two"), ("en", "c", None)]
    assert found(divergence.audit(spark.createDataFrame(rows, SCHEMA), 1, 10)) == plain(rows, 1, 10)


def test_pieces_lose_no_term(monkeypatch):
    text = "aa b  ccc dddddddddd e " * 5 + "f" * 40
    for size in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(divergence, "PIECE", size)
        assert [t.decode() for p in divergence._pieces(text.encode()) for t in p] == text.split()


def test_counts_are_handed_on(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(["a", "b", "a", "a"]), pa.array([b"x y", b"x z z", b"x q r s", b"x"], pa.binary())], ["l", "s", "t"])
    n, docs = Counter(), Counter()
    for out in divergence._counted(iter([batch])):
        for r in out.to_pylist():
            n[r["source"], r["term"]] += r["n"]
            docs[r["source"], r["term"]] += r["docs"]
    assert n["a", "x"] == docs["a", "x"] == 3 and (n["b", "z"], docs["b", "z"]) == (2, 1)


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(divergence.share(F.lit(9 * 10**14).cast("long"), F.lit(10**15).cast("long"), F.lit(7).cast("long")).alias("p")).first()
    assert row.p == 1 + 10**9 * (9 * 10**14 + 2) // (10**15 + 14)


def test_blocks_of_any_size_give_the_same_sums():
    dice = random.Random(2)
    rows = sorted(("en", 0, 0, f"t{i:03}", f"s{j}", 0, dice.randint(1, 10**8), j + 1) for i in range(60) for j in range(5) if dice.random() < 0.5)
    names = ["lang", "first", "second", "term", "source", "tile", "p", "none"]

    def summed(size):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size], strict=True)], names) for i in range(0, len(rows), size)]
        return sorted((r["a"], r["b"], r["met"]) for b in divergence._met(batches) for r in b.to_pylist())

    assert summed(1) == summed(7) == summed(1000) and len(summed(7)) == 10
