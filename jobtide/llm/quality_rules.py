"""Quality rules by weak supervision, with built-in column functions only.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation estimates, without labels, how often each
rule gives each vote on good and on bad texts; the posterior probability of "good" then decides, instead of "all rules
must pass". EM runs over the table of distinct vote patterns, which has at most 3 ** len(RULES) rows at any input size.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import SPACE, WORD, let, stored, text_of

FACTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_closed_lines n_distinct n_capitals".split()

# Rule name, condition of a bad vote, condition of a good vote; in all other cases the rule abstains.
RULES = (
    ("symbols", "100 * n_symbols > 10 * n_words", "n_symbols = 0 AND n_words > 0"),
    ("capitals", "100 * n_capitals > 30 * word_chars", "100 * n_capitals <= 10 * word_chars AND n_words > 0"),
    ("repeats", "100 * n_repeat_words > 20 * n_words", "n_repeat_words = 0 AND n_words > 0"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 9 * n_words", "word_chars BETWEEN 4 * n_words AND 6 * n_words"),
    ("variety", "4 * n_distinct < n_words", "10 * n_distinct >= 4 * n_words AND n_words > 0"),
    ("dup_lines", "100 * n_dup_lines > 30 * n_lines", "n_dup_lines = 0 AND n_lines > 0"),
    ("closed_lines", "100 * n_closed_lines < 20 * n_lines", "100 * n_closed_lines >= 80 * n_lines AND n_lines > 0"),
    ("length", "n_words < 20", "n_words >= 50"),
)


def _repeated_words(hashes: Column, width: int) -> Column:
    """Words covered by windows whose hash occurs at least twice; ``hashes`` has one entry per window, in text order."""

    def covered(ordered: Column) -> Column:
        marked = F.transform(
            ordered,
            lambda e, i: F.struct(
                e["at"].alias("at"),
                ((F.get(ordered, i - 1)["hash"] == e["hash"]) | (F.get(ordered, i + 1)["hash"] == e["hash"])).alias("again"),
            ),
        )
        places = F.array_sort(F.transform(F.filter(marked, lambda e: e["again"]), lambda e: e["at"]))
        start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("upto"))
        return F.aggregate(
            places,
            start,
            lambda a, at: F.struct((a["words"] + width - F.greatest(F.lit(0), a["upto"] - at)).cast("long").alias("words"), (at + width).alias("upto")),
            lambda a: a["words"],
        )

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(ordered, covered))


def text_facts(text: Column, width: int = 8) -> dict[str, Column]:
    """Counts of a whole text, by name. An empty text has zero of everything.

    Windows are compared by 64-bit hash within one text.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(line) > F.regexp_count(line, F.lit(SPACE)))

    def of_words(w: Column) -> Column:
        windows = F.when(
            F.size(w) >= width,
            F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(0))), lambda _, i: F.xxhash64(F.slice(w, i + 1, F.lit(width)))),
        ).otherwise(F.array().cast("array<bigint>"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            let(windows, lambda h: _repeated_words(h, width)).alias("n_repeat_words"),
        )

    def of_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(found, lambda line: line.rlike(r"[.!?:;\"')\]][\x20\x09-\x0D]*$"))).cast("long").alias("n_closed_lines"),
        )

    return {
        "by_word": let(words, of_words),
        "by_line": let(lines, of_lines),
        "word_chars": (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    }


def with_facts(texts: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and one column per fact."""
    facts = texts.select(*keep, *(column.alias(name) for name, column in text_facts(text_of(text)).items()))
    return facts.select(*keep, "by_word.*", "by_line.*", "word_chars", "n_symbols", "n_capitals")


def votes(rules=RULES) -> list[Column]:
    return [F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").alias(f"vote_{name}") for name, bad, good in rules]


#: Before any data: share of good texts, and the probabilities of a bad vote, of none and of a good vote on good and on bad
#: texts. A bad vote is rare on a good text, but a bad text usually fails one or two rules only and passes the rest.
START_GOOD, ON_GOOD, ON_BAD = 0.8, (0.005, 0.195, 0.80), (0.30, 0.10, 0.60)


@dataclass(frozen=True)
class RuleModel:
    """Share of good texts, and the probability of each vote on good and on bad texts: for rule j and vote v at 3 j + v + 1."""

    good: float
    given_good: tuple[float, ...]
    given_bad: tuple[float, ...]

    def posterior(self, vote_columns: list[str]) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for j, name in enumerate(vote_columns):
            weight = [math.log(self.given_good[3 * j + k] / self.given_bad[3 * j + k]) for k in range(3)]
            total = total + F.when(F.col(name) == -1, weight[0]).when(F.col(name) == 1, weight[2]).otherwise(weight[1])
        return 1 / (1 + F.exp(-total))


def _total(rows: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(rows, F.lit(0.0), lambda total, row: total + value(row))


def fit_rules(patterns: DataFrame, vote_columns: list[str], rounds: int = 30, weight: float = 20.0) -> RuleModel:
    """EM over ``patterns`` (vote columns and ``n``), all rounds in one expression over their array.

    The start values count as ``weight`` texts of either kind, which keeps every probability above zero and the meaning of
    the two classes fixed. With no patterns they are the result.
    """
    count = 3 * len(vote_columns)
    start_good, start_bad = ([*values] * len(vote_columns) for values in (ON_GOOD, ON_BAD))
    numbers = lambda values: F.array(*(F.lit(float(v)) for v in values))
    start = F.struct(F.lit(START_GOOD).alias("good"), numbers(start_good).alias("given_good"), numbers(start_bad).alias("given_bad"))
    places = F.array(*(F.col(name) + (3 * j + 1) for j, name in enumerate(vote_columns)))
    rows = patterns.agg(F.collect_list(F.struct(F.col("n").cast("double").alias("n"), places.alias("places"))).alias("rows"))

    def again(model: Column, found: Column) -> Column:
        """One round: the probability of "good" for each pattern, then the shares and probabilities that follow from it."""

        def shares(scored: Column) -> Column:
            good, every = _total(scored, lambda r: r["good"]), _total(scored, lambda r: r["n"])

            def given(of: Callable[[Column], Column], size: Column, begin: list[float]) -> Column:
                return F.transform(
                    numbers(begin),
                    lambda p, i: (_total(scored, lambda r: F.when(F.array_contains(r["places"], i), of(r)).otherwise(0.0)) + weight * p) / (size + weight),
                )

            return F.struct(
                ((good + weight * START_GOOD) / (every + weight)).alias("good"),
                given(lambda r: r["good"], good, start_good).alias("given_good"),
                given(lambda r: r["n"] - r["good"], every - good, start_bad).alias("given_bad"),
            )

        def scored(weights: Column) -> Column:
            odds = F.log(model["good"] / (1 - model["good"]))
            return F.transform(
                found,
                lambda r: F.struct(
                    r["places"].alias("places"),
                    r["n"].alias("n"),
                    (r["n"] / (1 + F.exp(-F.aggregate(r["places"], odds, lambda a, i: a + F.get(weights, i))))).alias("good"),
                ),
            )

        return let(let(F.zip_with(model["given_good"], model["given_bad"], lambda g, b: F.log(g / b)), scored), shares)

    fitted = rows.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda model, _: again(model, F.col("rows"))).alias("model")).select("model.*").first()
    assert len(fitted["given_good"]) == count
    return RuleModel(fitted["good"], tuple(fitted["given_good"]), tuple(fitted["given_bad"]))


def judge(texts: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Columns ``keep`` (default: all) followed by the facts, votes, ``base_failed``, ``quality`` (posterior) and ``kept``.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated windows; such a text is never kept,
    null and empty texts among them. Repeated rows are judged alike. An empty table gives an empty result. Input columns
    that bear a result's name, in any case, are left out.
    """
    names = [f"vote_{name}" for name, _, _ in RULES]
    own = {*FACTS, *names, "base_failed", "quality", "kept", "by_word", "by_line"}
    wanted = [f"`{c}`" for c in (texts.columns if keep is None else keep) if c.lower() not in own]
    facts = stored(with_facts(texts, f"`{text}`", wanted).select("*", *votes()), "quality-facts")
    patterns = stored(facts.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-patterns")
    model = fit_rules(patterns, names)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = facts.withColumn("base_failed", failed).withColumn("quality", model.posterior(names))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(texts: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``texts`` that :func:`judge` keeps, with their own columns."""
    boxed = texts.select(F.struct(*(F.col(f"`{c}`") for c in texts.columns)).alias("row"), text_of(f"`{text}`").alias("whole"))
    return judge(boxed, "whole", keep=["row"]).where("kept").select("row.*")
