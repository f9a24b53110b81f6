"""Header and text normalisation."""

from __future__ import annotations

import re
import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.fixed_values import FLOW_NULL_TOKENS, FORMULA_STARTERS

# Blanks that a text trim removes: the Unicode white space characters.
_BLANKS = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _without_accents(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


def compact_header(name: str) -> str:
    """Header name as lower-case ASCII letters and digits only: ``saldo movimentação`` -> ``saldomovimentacao``."""
    return re.sub("[^a-z0-9]", "", _without_accents(name).lower())


def snake_header(name: str) -> str:
    """Header name as words joined by ``_``: ``Município - Código`` -> ``municipio_codigo``."""
    return re.sub(r"[\W_]+", "_", _without_accents(name).strip().lower()).strip("_")


@dataclass(frozen=True)
class _Letters:
    """How letters beyond ASCII lose their accents, computed from Python's own Unicode tables, which also decide on the driver.

    ``source`` and ``target`` are two texts for ``translate``: a letter of ``source`` becomes the one at its place in ``target``, or nothing
    beyond its end (marks); ``fold_source`` and ``fold_target`` do the same for comparisons without case. Letters that become several
    become ``_SEVERAL`` there; ``pairs`` has them and what they become. Syllables of Hangul are taken apart by rule instead.
    """

    source: str
    target: str
    fold_source: str
    fold_target: str
    pairs: str


_HANGUL = (0xAC00, 0xD7A3)
#: Separators of ``pairs``; no letter becomes one of them.
_PAIR, _NEXT = "\x01", "\x02"
#: A private character; where a text itself has it, the text is only walked in vain.
_SEVERAL = "\ue000"


@lru_cache(maxsize=1)
def _letters() -> _Letters:
    plain, fold, gone, longer = {}, {}, [], []
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if 0xD800 <= point <= 0xDFFF or _HANGUL[0] <= point <= _HANGUL[1]:
            continue
        text = _without_accents(char)
        if not text:
            gone.append(char)
        elif len(text) > 1:
            longer.append((char, text))
        else:
            if text != char:
                plain[char] = text
            if len(text.casefold()) == 1 and text.casefold() != char:
                fold[char] = text.casefold()
    fold |= {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    marks, several = "".join(gone), {c: _SEVERAL for c, _ in longer}
    plain, fold = plain | several, fold | several
    texts = ["".join(plain) + marks, "".join(plain.values()), "".join(fold) + marks, "".join(fold.values())]
    return _Letters(*texts, _NEXT.join(c + _PAIR + t for c, t in longer))


def is_ascii(col: Column) -> Column:
    """As many bytes as characters: no accents to look for. Cheaper than a pattern."""
    return F.octet_length(col) == F.char_length(col)


def _syllable(char: Column) -> Column:
    """The letters of a Hangul syllable: 19 first, 21 middle and 27 last ones, in order of the syllables."""
    number = F.ascii(char) - _HANGUL[0]
    letter = lambda first, i: F.substring(F.lit("".join(map(chr, range(first, first + 28)))), i + 1, F.lit(1))
    last = number % 28
    ends = F.when(last > 0, letter(0x11A8, last - 1)).otherwise("")
    return F.concat(letter(0x1100, F.floor(number / 588).cast("int")), letter(0x1161, F.floor(number % 588 / 28).cast("int")), ends)


def _translated(col: Column, source: str, target: str) -> Column:
    """Letter for letter. A text with a letter that becomes several, which is rare, is first walked to put them in its place."""
    low, high = map(chr, _HANGUL)
    pairs = F.str_to_map(F.lit(_letters().pairs), F.lit(_NEXT), F.lit(_PAIR))
    one = lambda c: F.coalesce(F.try_element_at(pairs, c), F.when(c.between(low, high), _syllable(c)), c)
    walked = F.array_join(F.transform(F.regexp_extract_all(col, F.lit("(?s)."), F.lit(0)), one), "")
    quick = F.translate(col, source, target)
    whole = lambda text: F.when(F.contains(text, F.lit(_SEVERAL)) | col.rlike(f"[{low}-{high}]"), F.translate(walked, source, target)).otherwise(text)
    return F.transform(F.array(quick), whole)[0]


def strip_accents(col: Column) -> Column:
    """Text in its compatible decomposition without marks, for all of Unicode, built-in functions only. ASCII text is returned as it is."""
    letters = _letters()
    return F.when(is_ascii(col), col).otherwise(_translated(col, letters.source, letters.target))


def comparable_value(col: Column) -> Column:
    """Value for comparison with a contract: no accents, no case, single blanks, trimmed. Null becomes ``""``."""
    letters = _letters()
    text = F.coalesce(col, F.lit(""))
    # The only letter without marks that has two letters in its place; its capital is folded by the same rule.
    folded = F.replace(F.replace(_translated(text, letters.fold_source, letters.fold_target), F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss"))
    return F.trim(F.regexp_replace(F.when(is_ascii(text), F.lower(text)).otherwise(folded), _BLANKS + "+", " "))


def snake_header_column(col: Column) -> Column:
    """:func:`snake_header` as a column expression, for headers that are data."""
    words = F.regexp_replace(F.lower(strip_accents(col)), r"[^\p{L}\p{N}]+", "_")
    return F.trim(words, F.lit("_"))


def compact_header_column(col: Column) -> Column:
    """:func:`compact_header` as a column expression."""
    return F.regexp_replace(F.lower(strip_accents(col)), "[^a-z0-9]", "")


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, r"\D", "")


def null_tokens_to_null(col: Column, tokens: list[str] = FLOW_NULL_TOKENS) -> Column:
    """The text reader knows one null word; the flow files use three."""
    return F.when(~col.isin(tokens), col)


def spreadsheet_safe(col: Column) -> Column:
    """Prefix ``'`` to text a spreadsheet would run as a formula. Other text is untouched."""
    starters = "".join("\\" + s for s in FORMULA_STARTERS)
    return F.when(col.rlike(f"^{_BLANKS}*[{starters}]"), F.concat(F.lit("'"), col)).otherwise(col)
