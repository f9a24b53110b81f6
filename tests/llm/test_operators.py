"""The training-data operators against brute force on small tables, and on odd ones: nulls, empty tables, ties, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache, partial
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.llm import bitpack, disclosure, exact_dedup, license_digest, minhash_join, mixing, packing, ppm, preference_chat, quality_rules, tokens
from jobtide.llm.components import components
from jobtide.llm.tokens import encoded

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch the bright moon rise above quiet hills near town."
TEXTS = [
    PROSE, PROSE, PROSE + " Again and again.", None, "", " \t\n", "one", "two words", "a b c d e f g", LONG, LONG + " end", "ü é ñ\n\nü é", "x" * 3000,
    "\n".join(["same line of text here"] * 30), "!! ".join(["LOUD"] * 60), "a.\x1cb c d  e\n f", "<|endoftext|> is text", PROSE.upper(), "The Quick " + PROSE,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Ids with a null and a repeat, sources with a null, and columns that bear the names of results."""
    rows = [(i if i != 5 else None, t, None if i % 5 == 4 else f"s{i % 3}", 7, "x", True, 0.5) for i, t in enumerate(TEXTS)]
    rows.append(rows[0])
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, row string, kept boolean, size double").repartition(3).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def texts_of(odd):
    return [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]


def test_quality_facts_and_verdict(spark, odd, none):
    found = quality_rules.judge(odd, keep=["doc_id", "text", "kept"]).collect()
    assert len(found) == len(TEXTS) + 1
    for r in found:
        text = r.text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = defaultdict(list)
        for i in range(len(w) - 7):
            windows[tuple(w[i : i + 8])].append(i)
        repeat = {i + k for v in windows.values() if len(v) > 1 for i in v for k in range(8)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeat) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(none).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_rule_model_equals_plain_em(spark):
    votes = [("a", "b", "c")[i] for i in range(3)]
    data = [(1, 1, 1, 50), (1, 1, -1, 4), (-1, 1, 0, 9), (-1, -1, 1, 7), (0, 1, 1, 3)]
    model = quality_rules.fit_rules(spark.createDataFrame(data, "a int, b int, c int, n long"), votes, rounds=5)
    good, yes, no = quality_rules.START_GOOD, [*quality_rules.ON_GOOD] * 3, [*quality_rules.ON_BAD] * 3
    start = (good, yes, no)
    for _ in range(5):
        post = []
        for *v, n in data:
            p, q = good, 1 - good
            for j, x in enumerate(v):
                p, q = p * yes[3 * j + x + 1], q * no[3 * j + x + 1]
            post.append(n * p / (p + q))
        total, g = sum(d[3] for d in data), sum(post)
        mass = lambda i, part: sum(x for d, x in zip(data, part) if d[i // 3] + 1 == i % 3)
        bad = [d[3] - x for d, x in zip(data, post)]
        good = (g + 20 * start[0]) / (total + 20)
        yes, no = [(mass(i, post) + 20 * start[1][i]) / (g + 20) for i in range(9)], [(mass(i, bad) + 20 * start[2][i]) / (total - g + 20) for i in range(9)]
    assert np.allclose([model.good, *model.given_good, *model.given_bad], [good, *yes, *no])


def test_exact_copies(odd, none):
    want = defaultdict(list)
    for i, t in texts_of(odd):
        want[hashlib.sha256(t.encode()).hexdigest()].append(i)
    found = exact_dedup.find_copies(odd).collect()
    assert len(found) == len(TEXTS) + 1
    for r in found:
        group = want[r.text_sha256]
        assert (r.keep_id, r.group_size, r.kept) == (max((x for x in group if x is not None), default=None), len(group), r.doc_id == r.keep_id)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(want)
    assert exact_dedup.find_copies(none).count() == exact_dedup.drop_copies(none).count() == 0


def test_saturated_filter_stays_exact(odd, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_WORD_BITS", 0)
    monkeypatch.setattr(exact_dedup, "MOST_WORD_BITS", 1)
    assert sum(r.kept for r in exact_dedup.find_copies(odd.where("doc_id > 0")).collect()) == len({t for i, t in texts_of(odd) if i})


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    """Least id reachable from each id over links between full shingle sets."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = a, b
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
    for i in root:
        while root[i] != root[root[i]]:
            root[i] = root[root[i]]
    return root


def near_groups_of(spark, rows):
    return {r.doc_id: r.component_id for r in minhash_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_near_groups_of_chains_and_stars(spark):
    """Chains whose ends are far apart, and stars around one text, must each become one component."""
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for family in range(6):
        words = [f"f{family}w{i}" for i in rng.integers(0, 10_000, 120)]
        for step in range(12):
            rows.append((n, " ".join(words)))
            n += 1
            if family % 2:
                at = int(rng.integers(0, 115))
                words = [*words[:at], f"new{n}", *words[at + 1 :]]
            else:
                words = [*words[:2 * step], *(f"s{n}x{i}" for i in range(2)), *words[2 * step + 2 :]]
    rows += [(n + i, f"boiler plate text that all of these share {i} and then goes on with own {i * 7} words {i * 11}") for i in range(20)]
    assert near_groups_of(spark, rows) == brute_groups(rows)


@pytest.mark.parametrize("rare", [2, minhash_join.RARE])
def test_near_groups_of_variants_just_short_of_links(spark, monkeypatch, rare):
    """A large group of variants, with edits of their own or from a few common ones, at about the similarity sought to each other.
    Also where so few shingles count as rare that all later rounds run."""
    monkeypatch.setattr(minhash_join, "roots", partial(minhash_join.roots, rare=rare))
    monkeypatch.setattr(minhash_join, "LATER_PIVOTS", 2)
    rng = np.random.default_rng(11)
    words = [f"t{i}" for i in range(150)]
    rows = []
    for n in range(220):
        text = list(words)
        for at in rng.choice(150, int(rng.integers(1, 9)), replace=False):
            text[at] = f"own{n}x{at}" if rng.random() < 0.6 else f"edit{at % 2}"
        if n % 7 == 0:
            text = text[: int(rng.integers(100, 150))]
        rows.append((n, " ".join(text)))
    expected = brute_groups(rows)
    assert len(set(expected.values())) > 5
    assert near_groups_of(spark, rows) == expected


def test_near_groups_of_odd_rows(odd, none):
    found = minhash_join.near_groups(odd).collect()
    by_text = {t: i for i, t in texts_of(odd)}
    assert len(found) == len(TEXTS) + 1
    sizes = sorted(r.n_shingles for r in found)
    assert sizes == sorted(len(shingles(t)) for _, t in texts_of(odd))
    of = {r.doc_id: r for r in found}
    assert of[1].component_id == of[0].component_id == of[17].component_id == 0 and of[by_text[LONG + " end"]].component_id == by_text[LONG]
    assert of[4].component_id == 4 and of[4].kept and of[3].kept and of[None].kept
    assert minhash_join.near_groups(none).count() == 0
    assert minhash_join.drop_near_copies(odd).columns == odd.columns


def test_mix(odd, none):
    found = mixing.mix_counts(odd).collect()
    rows = {(r.doc_id, r.text): (r.source, len(WORD.findall(r.text or ""))) for r in odd.collect()}
    sizes = Counter()
    for r in odd.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, capped = {}, 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        level = (left - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in order}
    by_size = {sizes[s]: s for s in order}
    taken = Counter()
    for r in found:
        s = by_size[r.source_size]
        assert r.target == pytest.approx(target[s]) and r.taken <= 2 * r.size
        taken[s] += r.taken
    assert len(found) == len(rows) + 1 and all(taken[s] <= target[s] + 1e-6 for s in order)
    assert sum(1 for _ in mixing.mix(odd).collect()) == sum(r.taken // r.size for r in found if r.size) + mixing.mix(odd).where("text is null or trim(translate(text, '\t\n', '  ')) = ''").count()
    assert mixing.mix_counts(none).count() == mixing.mix(none).count() == 0


def test_mix_comes_near_and_agrees(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 17 as int)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    first, again = (sorted(map(tuple, mixing.mix_counts(d).collect())) for d in (docs, docs.repartition(5)))
    assert first == again
    total = defaultdict(int)
    for i, _, _, target, taken in first:
        total["hot" if i % 3 == 0 else i % 7, target] += taken
    assert len(total) == 8 and all(target - 17 <= taken <= target + 1e-6 for (_, target), taken in total.items())


def test_mix_goes_on_behind_a_long_text(spark):
    """One text is larger than what a source may take; the others fill its target."""
    rows = [(i, "w " * (3000 if i % 40 == 7 else 1 + i % 9), f"s{i % 2}") for i in range(400)] + [(1000, "x " * 50_000, "s1"), (1001, "x " * 9, None), (1001, "x " * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_counts(docs).collect()
    total, targets = defaultdict(int), {}
    source = {i: s for i, _, s in rows}
    for r in found:
        total[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    for s, target in targets.items():
        room = target - total[s]
        # Short of the target only by what no text that is left out could fill.
        assert 0 <= room + 1e-6 and (room <= mixing.NEAR * target or not any(r.taken == 0 and r.size <= room for r in found if source[r.doc_id] == s))
    assert mixing.mix(docs).count() == sum(r.taken // r.size for r in found)


@lru_cache(maxsize=1)
def library():
    """The tokenizer as its users load it, apart from the operator's own."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return library().encode(text, add_special_tokens=False).ids + [2]


ODD_TEXTS = [
    "a  b", " lead", "trail ", "a \nb", "don't  's", "\xa0x y", "tab\tand\nline feed", "hello <|endoftext|> world", "a<|endoftext|>b <|endoftext|>", "<|endoftext|", "it's. 'S ok.'s a.b.c. ...x", "é. ñ!? \u0301. x\u0301.", "\x01 a\x01b.",
    "3.5, x3. 3x.", "a.\n.b", "\u3000x", "x\u2028y z", "日本. 語", "ß.", "x.!?", "A,B,C", "\x85", "😀. x😀, y",
]


def test_ids_equal_the_library(odd):
    texts = [t for _, t in texts_of(odd)] + ODD_TEXTS
    assert [i.tolist() for i in encoded(pa.array(texts), TOKENIZER, 2)] == [ids_of(t) for t in texts]
    assert [i.tolist() for i in encoded(pa.array(["", None, ""]), TOKENIZER, 2)] == [[2]] * 3
    assert library().encode("<|endoftext|>", add_special_tokens=False).ids == [50256]


def test_ids_of_random_texts():
    dice = random.Random(8)
    signs = ["a", "B", "é", "ß", " ", " ", "\n", ".", ",", "'", "'s", "1", "_", "-", "\t", "\xa0", "日", "😀", "\u0301", "<|endoftext|>", "word", "Word"]
    texts = ["".join(dice.choice(signs[: dice.choice([4, 12, 22])]) for _ in range(dice.randint(0, 30))) for _ in range(3000)]
    assert [i.tolist() for i in encoded(pa.array(texts), TOKENIZER, 2)] == [ids_of(t) for t in texts]


@pytest.mark.parametrize(("remembered", "together"), [(1, 1), (4, 40), (7, 1 << 20)])
def test_ids_of_texts_with_more_pieces_than_remembered(monkeypatch, remembered, together):
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    monkeypatch.setattr(tokens, "TOGETHER", together)
    known = tokens.Encoder(TOKENIZER)
    texts = ["a b c", "c d e f g h i j", "", "a b c d", "d e f g h i j", "x  y\n\nz a b c d e f", "a b c d e f g", PROSE, "a", None]
    for _ in range(2):
        assert [i.tolist() for i in known.encode(pa.array(texts))] == [ids_of(t or "")[:-1] for t in texts]
        assert len(known.known) == len(known.known_ids) <= max(remembered, 40)


@pytest.mark.parametrize("bits", [1, 3, 8, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    packed = bitpack.pack_bits(ids, bits)
    assert len(packed) == -(-1001 * bits // 8) and (bitpack.unpack_bits(packed, bits, 1001) == ids).all()


def test_bit_files(odd, none):
    files = bitpack.write_ids(odd, TOKENIZER)
    found = sorted(bitpack.read_ids(files).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    start = 0
    want = Counter((i, tuple(ids_of(t))) for i, t in texts_of(odd))
    for r in found:
        ids = np.frombuffer(r.ids, "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(r.ids))
        start += len(ids)
        want[r.doc_id, tuple(ids.tolist())] -= 1
    assert not any(want.values())
    system, place = bitpack.open_shared(max(files.collect(), key=lambda r: r.n_ids).path)
    with system.open_input_file(place) as source:
        reader = bitpack.BitReader(source)
        whole = reader.ids(0, reader.n_ids)
        for a, b in ((0, 1), (8191, 8193), (reader.n_ids - 5, reader.n_ids), (9000, 9000)):
            assert (reader.ids(a, b) == whole[a:b]).all()
    assert bitpack.read_ids(bitpack.write_ids(none, TOKENIZER)).count() == 0


def test_packing(odd, none):
    found = packing.pack(odd, TOKENIZER, room=64).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, t in texts_of(odd):
        if i in (0, None):
            continue
        mine, ids = sorted(pieces[i], key=lambda r: r.piece), ids_of(t)
        assert b"".join(r.ids for r in mine) == np.array(ids, "<u4").tobytes()
        assert all(r.length == 64 for r in mine[1:]) and [r.start for r in mine] == np.cumsum([0, *(r.length for r in mine[:-1])]).tolist()
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(none, TOKENIZER).count() == 0


def test_plan_fills_as_best_fit_does():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, 3000).tolist()
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(100 - n)
    runs = packing.plan_slots(dict(Counter(lengths)), 100)
    assert max(r.first + r.sequences for r in runs) == len(rooms)
    assert sum(r.sequences * r.each for r in runs) == len(lengths)


def brute_ppm(train, order):
    """Counts by context tuple, straight from the definition."""
    counts = defaultdict(Counter)
    for word in train:
        spelled = b" " * order + (word if word == b"\n" else word + b" ")
        for i in range(order, len(spelled)):
            for k in range(order + 1):
                counts[spelled[i - k : i]][spelled[i]] += 1

    def score(word):
        spelled = b" " * order + (word if word == b"\n" else word + b" ")
        total = 0.0
        for i in range(order, len(spelled)):
            gone = set()
            for k in range(order, -1, -1):
                seen = {s: c for s, c in counts.get(spelled[i - k : i], {}).items() if s not in gone}
                if not seen:
                    continue
                mass = sum(seen.values())
                if spelled[i] in seen:
                    total += log10(seen[spelled[i]] / (mass + len(seen)))
                    break
                total += log10(len(seen) / (mass + len(seen)))
                gone |= set(seen)
            else:
                total -= log10(256 - len(gone))
        return total

    return score


def test_ppm_equals_brute_force(spark, odd, none, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK_TEXTS", 4)
    held = F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))
    found = ppm.score(odd, held, order=3).collect()
    tokens = lambda t: [*t.encode().lower().split(), b"\n"]
    train = [w for i, t in texts_of(odd) if i is None or i % 3 != 1 for w in tokens(t)]
    counts, score = Counter(train), brute_ppm(train, 3)
    cache = {w: score(w) for w in {w for _, t in texts_of(odd) for w in tokens(t)}}
    want = Counter()
    for i, t in texts_of(odd):
        w = tokens(t)
        base = sum(log10((counts[x] + 1) / (len(train) + len(counts) + 1)) for x in w)
        want[i, i is not None and i % 3 == 1, len(w), sum(counts[x] > 0 for x in w), round(base, 4), round(sum(cache[x] for x in w), 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4), round(r.score, 4)) for r in found) == want
    assert {r.train_tokens for r in found} == {len(train)}
    assert ppm.score(none, held).count() == 0


def test_ppm_across_words_equals_brute_force(spark, odd, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK_TEXTS", 4)
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(50, "moon rise above quiet hills near"), (51, "near hills quiet above rise moon"), (61, "moon rise above quiet hills near"), (64, "near hills quiet above rise moon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = lambda i: i is not None and i % 3 == 1
    found = ppm.score(docs, F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False)), order=4, across=True).collect()
    spelled = lambda t: b"    " + b"".join(w + b" " for w in (t or "").encode().lower().split()) + b"\n"
    counts = defaultdict(Counter)
    for i, t in rows:
        s = spelled(t)
        for at in range(4, 0 if held(i) else len(s)):
            for k in range(5):
                counts[s[at - k : at]][s[at]] += 1

    def log_p(s, at):
        total, gone = 0.0, set()
        for k in range(4, -1, -1):
            seen = {b: c for b, c in counts.get(s[at - k : at], {}).items() if b not in gone}
            mass = sum(seen.values())
            if s[at] in seen:
                return total + log10(seen[s[at]] / (mass + len(seen)))
            if seen:
                total += log10(len(seen) / (mass + len(seen)))
                gone |= set(seen)
        return total - log10(256 - len(gone))

    want = Counter((i, len((t or "").encode().split()) + 1, round(sum(log_p(s, at) for at in range(4, len(s))), 4)) for i, t in rows for s in [spelled(t)])
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 4)) for r in found) == want
    score = {r.doc_id: r.score for r in found}
    assert score[61] > score[64] and abs(score[61] - score[64]) > 0.1


def test_ppm_stores_grams_and_words_not_pairs_of_words(spark, monkeypatch):
    words = [f"relation{i * 7919 % 9000 + 1000}" for i in range(80)]
    docs = spark.createDataFrame([(i, " ".join(f"{a} {b}" for b in words)) for i, a in enumerate(words)], "doc_id long, text string").coalesce(1)
    rows, store = {}, ppm.stored

    def counted(df, label):
        out = store(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(ppm, "stored", counted)
    assert ppm.score(docs, F.col("doc_id") % 7 == 2, across=True).count() == 80
    pairs = len({(a[-4:], b) for a in words for b in words})
    assert pairs == 6400 and max(rows.values()) < pairs / 2, rows


@pytest.mark.parametrize("order", [0, 1, 5])
@pytest.mark.parametrize("across", [True, False])
def test_ppm_grams_in_parts(order, across, monkeypatch):
    texts = [b"", b"one two", b"a", b"three  x y", b"", b"z" * 40, b"u v w"]
    block = b"".join(b"".join(w + b" " for w in t.split()) + b"\n" for t in texts)
    want = []
    for i, t in enumerate(texts):
        pad = b" " * order
        parts = [pad + b"".join(w + b" " for w in t.split()) + b"\n"] if across else [pad + w + b" " for w in t.split()] + [pad + b"\n"]
        want += [(i, int.from_bytes(p[at - order : at + 1], "big")) for p in parts for at in range(order, len(p))]
    for piece in (1, 2, 7, 1000):
        monkeypatch.setattr(ppm, "PIECE", piece)
        found = []
        for grams, inside, begins, first in ppm._grams(block, order, across):
            text = first + np.searchsorted(begins, np.arange(len(grams)), side="right") - 1
            found += zip(text[inside].tolist(), grams[inside].tolist(), strict=True)
        assert found == want
        assert [w for part in ppm._pieces(b" ".join(texts)) for w in part.split()] == b" ".join(texts).split()


def test_personal_data_spans(spark):
    text = "Mail a.b@x.example.org, a@b@c.de or x@y; 10.0.0.256 1.2.3.4 0001.2.3.4.5 4918187128635271 4918 1871-2863 5272 +1 (625) 555-7196 +12 é😀 z@q.io"
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert [(a, b) for k, a, b in disclosure.base_spans(text) if k == "email"] == [m.span() for m in email.finditer(text)]
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    assert [(a, b) for k, a, b in disclosure.base_spans(text) if k == "ip"] == [m.span() for m in ip.finditer(text) if all(int(p) < 256 for p in m.group().split("."))]
    assert [text[a:b] for k, a, b in disclosure.base_spans(text) if k == "phone"] == ["+1 (625) 555-7196"]
    assert disclosure.base_spans("9" * 200_000 + "." + "0" * 9000 + "@" * 9000) == []


def test_terms_that_reveal(spark, none):
    rows = [(i, f"common words are here zorblat{'x' * (i % 2)} for kim{'' if i else ''}@mail.org number {i}") for i in range(6)]
    rows += [(100 + i, f"common words are here for all of us in place {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in disclosure.find_personal(docs, with_text=True).collect()}
    assert len(found) == 66
    for i, text in rows:
        spans = [s.split(":") for s in found[i].spans.split(",") if s]
        terms = {text[int(a) : int(b)].lower() for k, a, b in spans if k == "term"}
        assert found[i].n_email == (i < 100)
        if i >= 100:
            assert not spans and found[i].clean == text
        else:
            assert any(t.startswith("zorblat") for t in terms) and "common" not in terms and "[EMAIL]" in found[i].clean
    assert disclosure.find_personal(none).count() == 0


def term_spans(row, text):
    return [text[int(a) : int(b)] for k, a, b in (s.split(":") for s in row.spans.split(",") if s) if k == "term"]


def test_terms_of_entities_in_one_text(spark):
    """An entity that one document holds, several such entities in one document, and exact copies of it under other ids."""
    told = "common words are here and qwyzzle goes with kim@mail.org or lee@mail.org or 10.1.2.3 in common place"
    rows = [(i, f"common words are here for all of us in place {i} with or and goes") for i in range(60)] + [(100, told), (200, told.replace("qwyzzle", "vrombat").replace("mail", "post").replace("10.1", "11.1")), (201, told.replace("qwyzzle", "vrombat").replace("mail", "post").replace("10.1", "11.1"))]
    found = {r.doc_id: r for r in disclosure.find_personal(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()}
    texts = dict(rows)
    assert {i: term_spans(r, texts[i]) for i, r in found.items()} == {**{i: [] for i in range(60)}, 100: ["qwyzzle"], 200: ["vrombat"], 201: ["vrombat"]}
    assert "qwyzzle" not in found[100].clean and "common words are here and [WORD] goes with [EMAIL] or [EMAIL] or [IP]" in found[100].clean


def test_names_in_an_address_and_beside_it(spark):
    rows = [(i, f"common words are here for all of us in place {i}") for i in range(60)]
    rows += [(70 + i, f"write to smith{i}.x@corp.org in place {i}") for i in range(5)]
    rows += [(100, "Jo Smith, are here: jo.smith@corp.org, or jo.smith@corp.org +1 (625) 555-7196é for all of us")]
    found = {r.doc_id: r for r in disclosure.find_personal(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()}
    assert term_spans(found[100], rows[-1][1]) == ["Jo", "Smith", "or", "é"]
    assert found[100].clean == "[NAME] [NAME], are here: [EMAIL], [WORD] [EMAIL] [PHONE][WORD] for all of us"


def test_blanks_keep_places():
    text = "a@b.co 1.2.3.4567 é 4918187128635271 +4918187128635271 x a@b.co"
    blank = disclosure._blanked(text, disclosure.base_spans(text))
    base = {i for _, a, b in disclosure.base_spans(text) for i in range(a, b)}
    assert blank == "".join(" " if i in base else c for i, c in enumerate(text)) and base


def test_shares_equal_brute_force(spark):
    rng = np.random.default_rng(23)
    people = [f"p{i}@x{i % 3}.org" for i in range(12)]
    rows = []
    for i in range(120):
        words = [f"w{''.join(chr(97 + int(c)) for c in str(n))}" for n in (rng.pareto(0.6, 15) * 3).astype(int)]
        words += [people[int(n)] for n in rng.integers(0, 12, int(rng.integers(0, 3)) if i % 2 else 0)]
        rows.append((i, " ".join(rng.permutation(words))))
    n = len(rows)
    outside = {i: {w for w in t.split() if "@" not in w} for i, t in rows}
    inside = {i: {w for w in t.split() if "@" in w} for i, t in rows}
    n_t, n_e = (Counter(w for s in sets.values() for w in s) for sets in (outside, inside))
    n_et = Counter((e, w) for i in outside for e in inside[i] for w in outside[i])
    want = {}
    for i in outside:
        share = {w: max((1 - np.log2((n_et[e, w] + 0.5 * n_e[e] / n) / (n_t[w] + 0.5)) / np.log2(n_e[e] / n) for e in inside[i]), default=0) for w in outside[i]}
        want[i] = sorted(w for w, x in share.items() if x >= 0.85)
    found = {r.doc_id: r for r in disclosure.find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(map(len, want.values())) > 10
    assert {i: sorted(set(term_spans(found[i], t))) for i, t in rows} == want


def test_entities_of_the_same_texts_are_one_class(spark):
    """Copies full of addresses: as many pairs as terms, not addresses times terms; others stay apart."""
    many = " ".join(f"u{i}@a.org word{i}" for i in range(40))
    rows = [(1, many), (2, many + " and more"), (3, "u1@a.org alone"), (4, "z@b.org alone"), (4, "z@b.org alone"), (None, "u2@a.org none")]
    held = [(i, len(t), n, f"email:{e}") for (i, t), n in {r: rows.count(r) for r in rows}.items() for e in dict.fromkeys(re.findall(r"\S+@\S+", t))]
    classes = {r.one: (r.entity, r.n_e) for r in disclosure.entity_classes(spark.createDataFrame(held, "doc long, text_hash long, copies long, entity string")).collect()}
    same = {f"email:u{i}@a.org" for i in range(40)} - {"email:u1@a.org", "email:u2@a.org"}
    assert {classes[e] for e in same} == {(min(same), 2)} and classes["email:u1@a.org"] == ("email:u1@a.org", 3)
    assert classes["email:u2@a.org"] == ("email:u2@a.org", 3) and classes["email:z@b.org"] == ("email:z@b.org", 2)


def test_personal_data_in_odd_rows(odd):
    found = disclosure.find_personal(odd).collect()
    assert len(found) == len(TEXTS) + 1 and {r.spans for r in found} == {""} and {r.base_sha256 for r in found} == {hashlib.sha256(b"").hexdigest()}


def test_preference_pairs(spark):
    turns = "conv_id long, turn long, role string, text string, prompt string"
    chosen = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "good", "x"), (1, 2, "user", None, "x"), (1, 3, "assistant", "bye", "x"), (2, 0, "user", "q", "x"), (None, 0, "user", "q", "x"), (3, 0, None, "same", "x")]
    rejected = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "bad", "x"), (2, 0, "user", "q", "x"), (2, 1, "assistant", "a", "x"), (3, 0, None, "same", "x"), (4, 0, "user", "only", "x")]
    found = {r.pair_id: r for r in preference_chat.preference_pairs(spark.createDataFrame(chosen, turns), spark.createDataFrame(rejected, turns)).collect()}
    assert set(found) == {1, 2, 3, 4}
    one = found[1]
    assert one.shared_turns == 1 and one.prompt == "<|im_start|>user\nhi<|im_end|>\n"
    learned = [one.chosen[slice(*map(int, s.split(":")))] for s in one.chosen_mask.split(",")]
    assert learned == ["good<|im_end|>\n", "bye<|im_end|>\n"] and one.rejected == "<|im_start|>assistant\nbad<|im_end|>\n"
    assert (found[2].chosen, found[2].chosen_mask, found[3].chosen, found[3].rejected, found[4].prompt) == ("", "", "", "", "")


def test_licenses(spark, none):
    rows = [(1, "LICENSED under the apache licence -- version 2.0"), (2, "Copyright (c) 2020 Me\nReleased under the MIT License"), (3, "text\nReleased under the MIT License.\nReleased under the MIT License."), (4, None), (5, "Copyright 2020"), (6, "We like the MIT License.")]
    found = {(r.doc_id, r.license, r.whole, r.n_lines) for r in license_digest.match_licenses(spark.createDataFrame(rows, "doc_id long, text string"), license_digest.known_licenses(spark)).collect()}
    assert found == {(1, "Apache-2.0", True, 1), (2, "MIT", True, 2), (3, "MIT", False, 2)}
    assert license_digest.match_licenses(none, license_digest.known_licenses(spark)).count() == 0


def test_whole_license_texts(spark):
    shipped = {f.stem: f.read_text() for f in license_digest.TEXTS.glob("*.txt")}
    rows = [(n, n, t) for n, t in shipped.items()] + [(f"own {n}", n, f"Copyright (c) 2021 Someone\nAll rights reserved.\n\n{shipped[n]}") for n in ("MIT", "BSD-2-Clause", "ISC")]
    rows += [("titled", "MIT", f"The MIT License (MIT)\n\nCopyright (c) 2015 Me\n\n{shipped['MIT'].upper()}"), ("cut", "Apache-2.0", shipped["Apache-2.0"].partition("APPENDIX")[0])]
    rows += [("holder", "BSD-3-Clause", shipped["BSD-3-Clause"].replace("University", "copyright holder").replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("REGENTS OR", "COPYRIGHT OWNER OR"))]
    rows += [("moved", "GPL-2.0-only", shipped["GPL-2.0-only"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301", "59 Temple Place, Suite 330, Boston, MA  02111-1307"))]
    head = "This program is free software: you can redistribute it" + shipped["GPL-3.0-only"].split("This program is free software: you can redistribute it")[1].split("Also add")[0]
    rows += [("head", "GPL-3.0-or-later", head), ("other", None, shipped["MIT"] + "x"), ("half", None, shipped["ISC"][:200])]
    known = license_digest.known_licenses(spark)
    found = {(r.doc_id, r.license) for r in license_digest.match_licenses(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id string, text string"), known).collect()}
    assert len(shipped) > 15 and {(i, n) for i, n, _ in rows if n} == found


def test_known_licenses_are_canonical(spark):
    table = spark.createDataFrame(license_digest.KNOWN, "license string, text string")
    forms = {(r.license, r.text): r.c for r in table.withColumn("c", license_digest.canonical(F.col("text"))).collect()}
    assert all(c == license_digest.plain_form(t) and c for (_, t), c in forms.items())
    assert all("'" not in t for _, t in license_digest.KNOWN)
