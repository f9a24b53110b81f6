"""The corpus pipeline: every stage against a plain reading of it, on odd rows, repeated rows and empty tables."""

import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from jobtide.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BASE = "the quick brown fox jumps over a lazy dog while seven wise owls watch the bright moon rise above quiet hills near town and then all of them sleep until the next clear morning comes".split()


def prose(seed, words=60):
    return " ".join(BASE[(seed * 7 + i * (1 + seed % 5)) % len(BASE)] + (str(seed) if i % 3 == 0 else "") for i in range(words)) + "."


ROWS = [(i, prose(i % 23, 40 + i % 31), "en", f"s{i % 3}") for i in range(120)]
ROWS += [(200 + i, prose(3) + (" again" if i % 2 else ""), "en", "s1") for i in range(6)] + [(300, "!! ## spam $$ " * 30, "en", None), (301, "too short", "en", "s1"), (302, "", "en", "s1"), (303, None, None, None), (304, "SHOUT LOUD NOW " * 20, "en", "s2")]
ROWS += [(305, " ".join(prose(50 + k, 97) for k in range(40)), "en", "s2"), (306, "same line here\n" * 60, "en", "s0"), (None, prose(70), "en", "s0"), (307, prose(71), None, "s0"), (307, prose(71), None, "s0")]
ROWS = [(*r, len(r[1] or "")) for r in ROWS]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage, each written as Parquet and read again."""
    root = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, str(root))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert df.columns == docs.columns
        df.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out[name] = docs.collect()
    out["run"] = corpus_pipeline.run(spark, str(root)).collect()
    return out


def plain_votes(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    facts = {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_lines": len(lines), "n_distinct": len(set(w)),
        "n_repeat_words": len({i + k for v in windows.values() if len(v) > 1 for i in v for k in range(8)}), "n_closed_lines": sum(bool(re.search(r"[.!?:;\"')\]][\x20\x09-\x0D]*$", x)) for x in lines), "n_capitals": sum(c.isupper() for c in text),
    }
    sql = lambda rule: re.sub(r"(\w+) BETWEEN (.*?) AND (.*)", r"(\2) <= \1 <= (\3)", rule).replace(" = ", " == ").replace("AND", "and").replace("OR", "or")
    votes = tuple(-1 if eval(sql(bad), {}, facts) else 1 if eval(sql(good), {}, facts) else 0 for _, bad, good in quality_rules.RULES)  # noqa: S307
    return votes, facts["n_words"] < 20 or 100 * facts["n_repeat_words"] > 30 * facts["n_words"]


def plain_quality(texts, rounds=30, weight=20.0):
    """Probability of "good" of each vote pattern, by EM written out."""
    counts, rules = Counter(plain_votes(t)[0] for t in texts), len(quality_rules.RULES)
    good, on_good, on_bad = quality_rules.START_GOOD, [list(quality_rules.ON_GOOD) for _ in range(rules)], [list(quality_rules.ON_BAD) for _ in range(rules)]

    def posterior(v):
        odds = math.log(good / (1 - good)) + sum(math.log(on_good[j][x + 1] / on_bad[j][x + 1]) for j, x in enumerate(v))
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        part = {v: n * posterior(v) for v, n in counts.items()}
        whole, mass = sum(counts.values()), sum(part.values())
        new_good = (mass + weight * quality_rules.START_GOOD) / (whole + weight)
        on = lambda of, size, begin: [[(sum(of(v) for v in counts if v[j] + 1 == k) + weight * begin[k]) / (size + weight) for k in range(3)] for j in range(rules)]  # noqa: B023, E731
        on_good, on_bad = on(lambda v: part[v], mass, quality_rules.ON_GOOD), on(lambda v: counts[v] - part[v], whole - mass, quality_rules.ON_BAD)  # noqa: B023
        good = new_good
    return posterior


def test_quality_keeps_what_the_model_written_out_keeps(spark, stages):
    rows = stages["documents"]
    posterior = plain_quality([r.text or "" for r in rows])
    verdicts = {t: posterior(plain_votes(t)[0]) for t in {r.text or "" for r in rows}}
    judged = quality_rules.judge(spark.createDataFrame(ROWS, SCHEMA), keep=["doc_id", "text"]).collect()
    for r in judged:
        assert math.isclose(r.quality, verdicts[r.text or ""], rel_tol=1e-9)
        assert r.kept == (not plain_votes(r.text or "")[1] and r.quality >= 0.5)
    kept = Counter(tuple(r) for r in rows if not plain_votes(r.text or "")[1] and verdicts[r.text or ""] >= 0.5)
    assert Counter(map(tuple, stages["quality"])) == kept and 0 < len(kept) < len(rows)
    assert not {300, 301, 302, 303, 306} & {r.doc_id for r in stages["quality"]}


def test_exact_copies_leave_the_largest_id(stages):
    largest = {}
    for r in stages["quality"]:
        largest[r.text] = max(largest.get(r.text, -1), -1 if r.doc_id is None else r.doc_id)
    assert {r.text: -1 if r.doc_id is None else r.doc_id for r in stages["exact_copies"]} == largest and len(stages["exact_copies"]) == len(largest)


def test_near_copies_leave_one_of_each_group(stages):
    rows = stages["exact_copies"]

    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    least = lambda g: min((r.doc_id for r in g if r.doc_id is not None), default=None)
    assert sorted(str(r.doc_id) for r in stages["near_copies"]) == sorted(str(least(g)) for g in groups.values())
    assert len(groups) < len(rows), "some rows are near copies"


def test_mix_takes_whole_rows_near_the_targets(stages):
    before, after = Counter(map(tuple, stages["near_copies"])), Counter(map(tuple, stages["source_mix"]))
    assert set(after) <= set(before) and all(n <= 2 * before[r] for r, n in after.items())
    size = lambda r: len(WORD.findall(r[1] or ""))
    whole = sum(size(r) * n for r, n in before.items())
    assert 0 < sum(size(r) * n for r, n in after.items()) <= 1.5 * whole + 1e-6


def test_packing_places_every_id_once(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in stages["source_mix"]:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        want[r.doc_id] += len(ids)
    got = Counter()
    spans = defaultdict(list)
    for p in stages["packed"]:
        got[p.doc_id] += p.length
        spans[p.sequence_id].append((p.offset, p.length))
    assert got == want
    for placed in spans.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    shape = lambda rows: sorted((str(p.doc_id), p.piece, p.start, p.length, p.ids_crc32) for p in rows)
    assert shape(stages["run"]) == shape(stages["packed"])


def test_empty_tables_pass_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_nothing_but_rejected_rows(spark, tmp_path):
    spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (3, "few words", "en", "a", 9)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
