"""URL filters: allow and block entries in a trie over reversed host labels and path segments; the longest match decides.

An entry is (host, path, action). It fits a URL whose host is the entry's or below it, if the URL's path starts with the entry's.
Entries walk down by host labels from the right, then by the segments of the path; what follows the path's last slash is a prefix of
the segment that it meets. Of the entries that fit a URL the one with most characters (host and path) wins, then the one with the
longer host, and of two with the same host and path "block". An empty host fits every URL.

The trie is broadcast while the entries take at most ``BROADCAST_BYTES``; a longer list is joined instead: entries with each host
suffix of a URL that they know and each folder of its path, which gives the same verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from jobtide.llm.frames import map_arrow, stored

ALLOW, BLOCK = "allow", "block"
#: Characters of all entries that are sent whole to every executor.
BROADCAST_BYTES = 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A node of the path trie: its next segments, and the entries whose path ends within a segment: (rest, host, path, action).
PathNode = tuple[dict, list]


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty or with a leading slash."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _entries(rules: DataFrame) -> DataFrame:
    """One row per host and path, in the form that URLs have; entries that are no allow or block are an error."""
    action = F.lower(F.trim("action"))
    known = F.when(action.isin(ALLOW, BLOCK), action).otherwise(F.raise_error(F.concat(F.lit("no action of a URL entry: "), F.coalesce("action", F.lit("null")))))
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    # "block" sorts after "allow", so it wins where both are given.
    return rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), known.alias("action")).groupBy("host", "path").agg(F.max("action").alias("action"))


# ---------------------------------------------------------------------------------------------------------------
# The trie
# ---------------------------------------------------------------------------------------------------------------


class Trie:
    """Entries by reversed host labels, then by path segments."""

    def __init__(self, entries: list[tuple[str, str, str]]) -> None:
        self.entries = entries
        self.root: tuple[dict, PathNode] = ({}, ({}, []))
        for host, path, action in entries:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node[0].setdefault(label, ({}, ({}, [])))
            place = node[1]
            *folders, rest = path.split("/")
            for name in folders:
                place = place[0].setdefault(name, ({}, []))
            place[1].append((rest, host, path, action))

    def __reduce__(self):
        """Travels as its entries, however deep it is."""
        return Trie, (self.entries,)

    def find(self, host: str, path: str) -> tuple[str, str, str] | None:
        """The entry (host, path, action) that wins, or None."""
        best, rank = None, (-1, -1)
        names = path.split("/")
        node = self.root
        labels = iter(reversed(host.split(".")))
        while node is not None:
            place = node[1]
            for name in names:
                for rest, *entry in place[1]:
                    if name.startswith(rest) and (found := (len(entry[0]) + len(entry[1]), len(entry[0]))) > rank:
                        best, rank = tuple(entry), found
                place = place[0].get(name)
                if place is None:
                    break
            label = next(labels, None)
            node = None if label is None else node[0].get(label)
        return best


def _judge(trie: Trie):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = {name: i for i, name in enumerate(batch.schema.names)}
            found = [trie.value.find(h, p) for h, p in zip(batch.column(where["host"]).to_pylist(), batch.column(where["path"]).to_pylist(), strict=True)]
            rule = pa.array([f and f[0] + f[1] for f in found], pa.string())
            action = pa.array([f and f[2] for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, action], [*batch.schema.names, "rule", "action"])

    return judge


# ---------------------------------------------------------------------------------------------------------------
# Lists too long to be broadcast
# ---------------------------------------------------------------------------------------------------------------


def _suffixes(host: Column, most: int) -> Column:
    """The host, the hosts above it of at most so many labels, and the empty one."""
    labels = F.split(host, r"\.")
    last = F.slice(labels, -F.least(F.size(labels), F.lit(most)), F.size(labels))
    return F.array_append(F.transform(F.sequence(F.lit(1), F.size(last)), lambda i: F.array_join(F.slice(last, i, F.size(last)), ".")), "")


def _folders(path: Column, most: int) -> Column:
    """The starts of a path up to each of so many slashes, and the empty one."""
    names = F.split(path, "/")
    starts = F.transform(F.sequence(F.lit(0), F.least(F.size(names) - 1, F.lit(most))), lambda i: F.concat(F.array_join(F.slice(names, F.lit(1), i), "/"), F.lit("/")))
    return F.array_append(F.slice(starts, F.lit(2), F.size(starts)), "")


def _joined(urls: DataFrame, entries: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the distinct URLs that an entry fits. No URL needs more starts than the deepest entry has."""
    known = entries.select(F.col("host").alias("at"), F.regexp_extract("path", "(?s)^(.*/)?", 0).alias("folder"), F.col("path").alias("start"), "action")
    deep = known.agg(F.max(F.size(F.split("at", r"\."))).alias("labels"), F.max(F.regexp_count("folder", F.lit("/"))).alias("folders")).first()
    hosts = urls.select("host").distinct().select("host", F.explode(_suffixes(F.col("host"), deep.labels)).alias("at"))
    hosts = hosts.join(known.select("at").distinct(), "at")
    places = urls.select("host", "path").distinct().join(hosts, "host").select("host", "path", "at", F.explode(_folders(F.col("path"), deep.folders)).alias("folder"))
    fits = places.join(known, ["at", "folder"]).where(F.startswith("path", "start"))
    rank = F.struct(F.length(F.concat("at", "start")).alias("size"), F.length("at").alias("above"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("at", "start").alias("rule"), "action"), rank).alias("won"))
    return best.select("host", "path", "won.rule", "won.action")


# ---------------------------------------------------------------------------------------------------------------


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: list[str] | None = None, default: str = ALLOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Each row with its URL's host and path, the entry that wins (host and path as one text, null if none fits) and the verdict.

    The verdict is the entry's action, else ``default``. ``keep`` names the columns of ``pages`` that stay (all if None); those that bear
    the name of a result (host, path, rule, verdict) give way to it. A null URL, or one without ``://``, has an empty host and an
    empty path, which only entries without host and path fit. Repeated rows are judged each; an empty list leaves ``default``.
    """
    results = ("host", "path", "rule", "verdict")
    columns = [c for c in (pages.columns if keep is None else keep) if c not in results]
    address = F.col(f"`{url}`").cast("string")
    urls = pages.select(*[F.col(f"`{c}`").alias(f"page {i}") for i, c in enumerate(columns)], host_of(address).alias("host"), path_of(address).alias("path"))
    entries = stored(_entries(rules), "url-entries")
    size = entries.agg(F.sum(F.length(F.concat("host", "path", "action"))).alias("n")).first().n or 0
    if size <= broadcast_bytes:
        trie = pages.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in entries.select("host", "path", "action").collect()]))
        schema = StructType([*urls.schema.fields, StructField("rule", StringType()), StructField("action", StringType())])
        found = map_arrow(urls, _judge(trie), schema)
    else:
        found = urls.join(_joined(urls, entries), ["host", "path"], "left")
    verdict = F.coalesce("action", F.lit(default))
    return found.select(*[F.col(f"page {i}").alias(c) for i, c in enumerate(columns)], "host", "path", "rule", verdict.alias("verdict"))


def keep_allowed(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, in their own columns."""
    held = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(f"`{url}`").alias("url"))
    return judge_urls(held, rules, "url", ["row"], default).where(F.col("verdict") == ALLOW).select("row.*")
