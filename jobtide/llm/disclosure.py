"""Personal data: patterns first, then terms that give a protected entity away by what the corpus knows.

Entities are the values that the patterns find (an address, a number). A term t reveals an entity e by the share of e's
information that seeing t gives: PMI(e; t) / IC(e), from how many documents hold either and both, be it one. Above ``GENERALISE`` the
term is replaced by its kind of word, above ``REMOVE`` it is taken out; both in the documents that hold the entity.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import map_arrow, stored, strings

KINDS = ("email", "ip", "card", "phone", "term")
#: Documents at the entity's base rate that each term counts besides its own: a term seen once says less than one seen often.
PRIOR = 0.5
GENERALISE, REMOVE = 0.85, 0.95

# What an entity looks like. A run of digits cannot match from its middle if it does not from its start, so
# the look-behind changes no result and keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TERM = re.compile(r"[A-Za-z\u0080-\U0010ffff]+")
#: Bytes of a term stay, A-Z in lower case; all other ASCII becomes a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Distinct terms that a task counts before it hands the counts on.
HELD_TERMS = 300_000

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the whole run before an @, up to the match before."""
    last = 0
    at = text.find("@")
    while at >= 0:
        if found := DOMAIN.match(text, at):
            start = at
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, found.end()
                last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """Spans of the four kinds in order of kind and start; code points, end exclusive."""
    spans: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and _luhn(d)]
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return spans


def entity(text: str, span: Span) -> str:
    """One name for one entity, however it is written."""
    kind, start, end = span
    value = text[start:end]
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _digits(value)}"


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in strings(batch.column(2)):
            spans = base_spans(text)
            line = joined(spans)
            kinds = Counter(k for k, _, _ in spans)
            rows.append((*(kinds[k] for k in KINDS[:4]), hashlib.sha256(line.encode()).hexdigest(), line, sorted({entity(text, s) for s in spans})))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc", "text_hash", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", "entities"])


def _blanked(text: str, spans: list[Span]) -> str:
    """Spaces where the spans are, so that what stands outside them keeps its place."""
    out, last = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if b > last:
            out += [text[last:a], " " * (b - max(a, last))]
            last = b
    return "".join([*out, text[last:]])


def _terms(text: str) -> set[bytes]:
    """The terms outside the base spans; an entity's own spelling does not keep the same words elsewhere from counting."""
    return set(_blanked(text, base_spans(text)).encode().translate(TERM_BYTES).split())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each term."""
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in strings(batch.column(0)):
            counts.update(_terms(text))
            if len(counts) >= HELD_TERMS:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
                counts = Counter()
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each entity of a text with each of its terms, as many rows as the text is long for each entity."""
    for batch in batches:
        kind = batch.schema.field(0).type
        for doc, text_hash, copies, text, entities in zip(*(batch.column(i).to_pylist() for i in range(3)), strings(batch.column(3)), batch.column(4).to_pylist(), strict=True):
            terms = sorted(_terms(text))
            for e in entities:
                n = len(terms)
                yield pa.RecordBatch.from_arrays([pa.array([doc] * n, kind), pa.array([text_hash] * n, pa.int64()), pa.array([copies] * n, pa.int64()), pa.array([e] * n, pa.string()), pa.array(terms, pa.binary())], ["doc", "text_hash", "copies", "entity", "term"])


def _lower(term: str) -> bytes:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term).encode()


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the given terms outside the base spans, and what the text becomes."""
    for batch in batches:
        spans_out, texts_out = [], []
        for text, terms in zip(strings(batch.column(2)), batch.column(3).to_pylist(), strict=True):
            share = {t["term"]: t["share"] for t in terms}
            base = base_spans(text)
            more, words = [], []
            for m in TERM.finditer(_blanked(text, base)):
                if (s := share.get(_lower(m.group()))) is not None:
                    more.append(("term", *m.span()))
                    words.append("" if s >= REMOVE else "[NAME]" if m.group()[0].isupper() else "[WORD]")
            spans_out.append(joined([*base, *more]))
            texts_out.append(_replaced(text, [*((a, b, f"[{k.upper()}]") for k, a, b in base), *((a, b, w) for (_, a, b), w in zip(more, words, strict=True))]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans_out, pa.string()), pa.array(texts_out, pa.string())], ["doc", "text_hash", "all_spans", "clean"])


def _replaced(text: str, changes: list[tuple[int, int, str]]) -> str:
    """Where spans overlap, the one that starts first, then the longer, is replaced."""
    out, last = [], 0
    for a, b, new in sorted(changes, key=lambda c: (c[0], -c[1])):
        if a >= last:
            out += [text[last:a], new]
            last = b
    return "".join([*out, text[last:]])


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [_replaced(t, [(a, b, f"[{k.upper()}]") for k, a, b in base_spans(t)]) for t in strings(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc", "text_hash", "masked"])


def _same_row(left: str, right: str) -> Column:
    return F.col(f"{left}.doc").eqNullSafe(F.col(f"{right}.doc")) & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash"))


def _plain(texts: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    plain = texts.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    return plain, plain.schema["doc"].dataType.simpleString()


def entity_classes(held: DataFrame) -> DataFrame:
    """``one``, ``entity``, ``n_e`` from (``doc``, ``text_hash``, ``copies``, ``entity``): for each entity, one that stands for it, and the rows that hold it.

    Entities that the same texts hold have the same counts with each term, so the least of them stands for all and a text is paired with as many
    classes as differ, not with each address in it. Sets of texts are told apart by their number and two sums of 64-bit hashes.
    """
    sums = [F.sum(F.xxhash64("doc", "text_hash", F.lit(i)).cast("decimal(38,0)")).alias(f"set_{i}") for i in range(2)]
    of_entity = held.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count(F.lit(1)).alias("texts"), *sums)
    keys = ["texts", "set_0", "set_1"]
    least = of_entity.groupBy(*keys).agg(F.min("entity").alias("least"))
    return of_entity.join(least, keys).select(F.col("entity").alias("one"), F.col("least").alias("entity"), "n_e")


def disclosing_terms(plain: DataFrame, kind: str, found: DataFrame, prior: float = PRIOR, least: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """The texts that hold an entity (``doc``, ``text_hash``, ``text``), and for each of them its disclosing terms (``doc``, ``text_hash``, ``terms``: term and greatest share of an entity's information)."""
    documents = found.count()
    held = found.where(F.size("entities") > 0).groupBy("doc", "text_hash").agg(F.first("entities").alias("entities"), F.count(F.lit(1)).alias("copies"))
    held = stored(held.select("doc", "text_hash", "copies", F.explode("entities").alias("entity")), "pii-held")
    classes = stored(entity_classes(held), "pii-entities")
    known = classes.groupBy("entity").agg(F.first("n_e").alias("n_e"))
    risky = stored(held.withColumnRenamed("entity", "one").join(classes, "one").groupBy("doc", "text_hash").agg(F.first("copies").alias("copies"), F.collect_set("entity").alias("entities")), "pii-risky")
    bodies = plain.alias("t").join(risky.alias("r"), _same_row("t", "r")).select("t.doc", "t.text_hash", "r.copies", "t.text", "r.entities").dropDuplicates(["doc", "text_hash"])
    bodies = stored(bodies, "pii-bodies")
    pairs = stored(map_arrow(bodies, _paired, f"doc {kind}, text_hash bigint, copies bigint, entity string, term binary"), "pii-pairs")
    both = stored(pairs.groupBy("entity", "term").agg(F.sum("copies").alias("n_et")), "pii-both")
    asked = stored(both.select("term").distinct(), "pii-terms")
    counted = map_arrow(plain.select("text"), _counted, "term binary, n bigint").join(asked, "term").groupBy("term").agg(F.sum("n").alias("n_t"))
    base = F.col("n_e") / F.lit(float(max(documents, 1)))
    share = 1 - F.log2((F.col("n_et") + prior * base) / (F.col("n_t") + prior)) / F.log2(base)
    # An entity in every document has no information to give away.
    telling = both.join(stored(counted, "pii-counted"), "term").join(known.select("entity", "n_e"), "entity").where(F.col("n_e") < documents).withColumn("share", share).where(F.col("share") >= least)
    telling = stored(telling.select("entity", "term", "share"), "pii-telling")
    per_text = pairs.join(telling, ["entity", "term"]).groupBy("doc", "text_hash", "term").agg(F.max("share").alias("share"))
    return bodies, per_text.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("term", "share")).alias("terms"))


def find_personal(texts: DataFrame, key: str = "doc_id", text: str = "text", prior: float = PRIOR, least: float = GENERALISE, with_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans`` and, with ``with_text``,
    ``clean``: the text with its entities replaced by their kind and its disclosing terms generalised or removed.

    ``spans`` lists kind:start:end by kind (email, ip, card, phone, term), then start; ``base_sha256`` is the digest of that list without
    terms. A null text is empty and has none. A text without an entity gets no term; entities count however few texts hold them.
    Rows that share key and text get the same result. Other columns are ignored; no rows give none.
    """
    plain, kind = _plain(texts, key, text)
    counts = ", ".join(f"n_{k} bigint" for k in KINDS[:4])
    found = stored(map_arrow(plain, _found, f"doc {kind}, text_hash bigint, {counts}, base_sha256 string, spans string, entities array<string>"), "pii-found")
    bodies, terms = disclosing_terms(plain, kind, found, prior, least)
    asked = bodies.alias("b").join(stored(terms, "pii-per-text").alias("k"), _same_row("b", "k")).select("b.doc", "b.text_hash", "b.text", "k.terms")
    marked = stored(map_arrow(asked, _marked, f"doc {kind}, text_hash bigint, all_spans string, clean string"), "pii-marked")
    out = found.alias("f").join(marked.alias("m"), _same_row("f", "m"), "left")
    chosen = [F.col("f.doc").alias("doc_id"), *(F.col(f"f.n_{k}") for k in KINDS[:4]), F.col("f.base_sha256"), F.coalesce("m.all_spans", "f.spans").alias("spans")]
    if not with_text:
        return out.select(*chosen)
    masked = map_arrow(plain, _masked, f"doc {kind}, text_hash bigint, masked string").dropDuplicates(["doc", "text_hash"]).alias("p")
    return out.join(masked, _same_row("f", "p")).select(*chosen, F.coalesce("m.clean", "p.masked").alias("clean"))
