"""Licence texts by canonical digest: a whole text, brought to one form, is looked up among the digests of known licences."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known licence statements of one line.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
)
# Spellings that count as equal, after lower-casing.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("acknowledgement", "acknowledgment"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
)
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright\b|\(c\)|©)[^\n]*$"
PUNCTUATION = r"[^\p{L}\p{N}]+"

#: Whole licence texts, a file each, named by the licence.
TEXTS = Path(__file__).parent / "licenses"
# What stands above a short licence, besides copyright lines.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License"),
}
# Wordings in circulation of a passage; the first is that of the file. "1", "2" and "3" number the clauses.
WORDINGS = {
    "MIT": (("THE AUTHORS OR COPYRIGHT HOLDERS", "THE COPYRIGHT HOLDERS OR AUTHORS"),),
    "ISC": (("modify, and/or distribute", "modify, and distribute", "modify, distribute"), ("LOSS OF USE, DATA OR PROFITS", "LOSS OF MIND, USE, DATA OR PROFITS")),
    "Zlib": (("acknowledgment in the product documentation would be\n   appreciated but is not required", "acknowledgment in the product documentation is required"),),
    "BSD-2-Clause": (("THE COPYRIGHT HOLDERS AND", "THE AUTHOR AND"), ("THE COPYRIGHT HOLDER OR", "THE COPYRIGHT HOLDERS OR", "THE AUTHOR OR")),
    "BSD-3-Clause": (
        ("THE REGENTS AND", "THE COPYRIGHT HOLDERS AND"),
        ("THE REGENTS OR", "THE COPYRIGHT HOLDER OR", "THE COPYRIGHT HOLDERS OR"),
        tuple(f"the name of the {x} nor the names of its" for x in ("University", "copyright holder", "organization", "author", "project", "company")) + ("the names of the copyright holders nor the names of its", "the names of the authors nor the names of"),
    ),
}
# Addresses under which the Free Software Foundation has been given, as canonical text.
ADDRESSES = ("51 franklin street fifth floor boston ma 02110 1301 usa", "51 franklin st fifth floor boston ma 02110 1301 usa", "59 temple place suite 330 boston ma 02111 1307 usa", "675 mass ave cambridge ma 02139 usa", "https fsf org")
MPL_HEADER = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/."


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, equivalent spellings replaced, any run of other characters one space, trimmed."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def canonical_digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def plain_form(text: str) -> str:
    """``canonical`` of one text."""
    out = re.sub(COPYRIGHT_LINE, " ", text.lower())
    for old, new in SPELLINGS:
        out = out.replace(old, new)
    return re.sub(r"[\W_]+", " ", out).strip()


def _short_forms(name: str, text: str) -> Iterator[tuple[str, str]]:
    """A short licence in all wordings and below all titles."""
    numbered = [text] if "\n1. " not in text.replace("    1. ", "1. ") else [text, re.sub(r"(?m)^ *[123]\. ", "", text)]
    rules = WORDINGS[name]
    for body, *chosen in product(numbered, *rules):
        for (first, *_), new in zip(rules, chosen, strict=True):
            body = re.sub(r"\s+".join(map(re.escape, first.split())), new, body)
        for title, rights in product(("", *TITLES[name]), ("", "All rights reserved.")):
            yield name, plain_form(f"{title}\n{rights}\n{body}")


def _long_forms(name: str, text: str) -> Iterator[tuple[str, str]]:
    """A long licence with and without its appendix and its headers, under all addresses."""
    bodies = [(name, text)]
    terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
    if end:
        bodies += [(name, terms), (name, terms + end)]
    if header := re.search(r"This (program|library) is free software.*?(?=Also add information)", text, re.S):
        bodies.append((name.replace("-only", "-or-later"), header[0]))
    if name == "Apache-2.0":
        bodies.append((name, text[text.rindex("Licensed under the Apache") :]))
    for licence, body in bodies:
        form = plain_form(body)
        for old in ADDRESSES[:4]:
            form = form.replace(old, "@").replace(old.removesuffix(" usa"), "@")
        for address in ADDRESSES if "@" in form else ("",):
            yield licence, form.replace("@", address)
        for scheme in ("http ", "https "):
            yield licence, re.sub(r"\bhttps? ", scheme, plain_form(body))
        yield licence, plain_form(body)


def _known() -> tuple[tuple[str, str], ...]:
    """Names and texts. Those of whole licences are in canonical form; two spaces keep "copyright holder" what it is there, where a
    line break kept it from being respelled. As texts are also wrapped elsewhere, the respelled form is known, too."""
    forms = dict.fromkeys(("MPL-2.0", plain_form(MPL_HEADER.format(scheme))) for scheme in ("http", "https"))
    for file in sorted(TEXTS.glob("*.txt")):
        text = file.read_text()
        forms |= dict.fromkeys((_short_forms if file.stem in TITLES else _long_forms)(file.stem, text))
    return (*NOTICES, *dict.fromkeys((name, form.replace("copyright holder", new)) for name, form in forms for new in ("copyright  holder", "copyright owner")))


#: Known licences: notices, whole texts and standard headers.
KNOWN = _known()


def known_licenses(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``license`` and ``digest`` of the list as a table whose size Spark knows, so that it can decide to broadcast it."""
    digests = dict.fromkeys((name, hashlib.sha256(plain_form(text).encode()).hexdigest()) for name, text in known)
    rows = [F.struct(F.lit(name).alias("license"), F.lit(digest).alias("digest")) for name, digest in digests]
    return spark.range(1).select(F.inline(F.array(*rows)))


def match_licenses(texts: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``license``, ``whole``, ``n_lines`` for each row whose entire text (``whole``), or an entire line of whose text, is a known licence.

    ``known`` has ``license`` and ``license_text`` or its ``digest``; several names for one digest give a row each. A digest table is as large as
    the list of licences; Spark broadcasts it if it measures small, else both sides shuffle by digest, line texts never do.
    Null, blank and copyright-only texts match nothing. Rows that repeat key and licence count as one document. Other columns are
    ignored; empty tables give no rows.
    """
    if "digest" not in known.columns:
        known = known.select("license", canonical_digest(F.col("license_text")).alias("digest"))
    digests = known.where(F.col("digest") != F.sha2(F.lit(""), 256)).select("license", "digest").distinct()
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # The whole text is unit 0, its lines follow; a text of one line has no further unit.
    units = texts.select(F.col(f"`{key}`").alias("doc_id"), F.posexplode(F.when(F.instr(body, "\n") > 0, F.concat(F.array(body), F.split(body, "\n"))).otherwise(F.array(body))).alias("unit", "piece"))
    hashed = units.select("doc_id", (F.col("unit") == 0).alias("whole"), canonical_digest(F.col("piece")).alias("digest"))
    found = hashed.join(digests, "digest").groupBy("doc_id", "license").agg(F.bool_or("whole").alias("whole"), F.count(F.lit(1)).alias("n_lines"))
    return found.select("doc_id", "license", "whole", "n_lines")
