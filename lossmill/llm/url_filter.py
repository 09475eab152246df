"""URL filter: allow and block rules in a trie over reversed host labels and path segments.

A rule holds a host and a path. It fits its host and every subdomain of it, where the path of the
url starts with the path of the rule. Of several fitting rules the longest decides, counted in
characters of host and path; of two equally long ones block does. Where none fits, the default
verdict stands and the rule is null.

Rules are broadcast as one trie per ``TRIE_CHARS`` characters of rules. Further tries are applied
one after another, each over a stored result, so no executor holds more than one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossmill.llm.common import ascii_lower, batches, stored

ALLOW, BLOCK = "allow", "block"
TRIE_CHARS = 16_000_000

_MATCH = T.StructType(
    [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
)


@dataclass(frozen=True)
class UrlRule:
    """``path`` is empty or begins with a slash; the host is compared in lower case."""

    verdict: str
    host: str
    path: str = "/"

    def __post_init__(self):
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict {self.verdict!r}")
        if not self.host or self.path[:1] not in ("", "/"):
            raise ValueError(f"rule {self.host!r} {self.path!r}")

    def __str__(self) -> str:
        return self.host.lower() + self.path


@dataclass
class _Node:
    """``below`` maps whole labels or segments; ``ends`` holds the last piece of a rule's path,
    which may stop within a segment."""

    below: dict[str, _Node] = field(default_factory=dict)
    paths: _Node | None = None
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)


def _segments(path: str) -> list[str]:
    """'/a/b' -> ['/', 'a/', 'b']: every whole segment keeps its slash."""
    return path.replace("/", "/\n").split("\n")


class UrlTrie:
    """Longest match of a host and a path."""

    def __init__(self, rules: Iterable[UrlRule]):
        self._root = _Node()
        for rule in rules:
            node = self._root
            for label in reversed(rule.host.lower().split(".")):
                node = node.below.setdefault(label, _Node())
            node.paths = node = node.paths or _Node()
            *whole, last = _segments(rule.path)
            for segment in whole:
                node = node.below.setdefault(segment, _Node())
            known = node.ends.get(last)
            if known is None or rule.verdict == BLOCK:
                node.ends[last] = (str(rule), rule.verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        best: tuple[str, str] | None = None
        node = self._root
        segments = None
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                segments = _segments(path) if segments is None else segments
                for found in _path_ends(node.paths, segments):
                    best = longer(best, found)
        return best


def _path_ends(node: _Node, segments: list[str]) -> Iterator[tuple[str, str]]:
    for segment in segments:
        for end, found in node.ends.items():
            if segment.startswith(end):
                yield found
        node = node.below.get(segment)
        if node is None:
            return


def longer(
    one: tuple[str, str] | None, other: tuple[str, str] | None
) -> tuple[str, str] | None:
    """The longer rule; of equally long ones the one that blocks, then the smaller text."""
    found = [x for x in (one, other) if x is not None]
    return min(found, key=lambda x: (-len(x[0]), x[1] != BLOCK, x[0]), default=None)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first '://' and the path after it; both empty where there is no '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    parts = r"^([^/?#]*)([^?#]*)"
    host = ascii_lower(F.regexp_extract(rest, parts, 1))
    path = F.regexp_extract(rest, parts, 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(
    pages: DataFrame,
    rules: Iterable[UrlRule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
    trie_chars: int = TRIE_CHARS,
) -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule`` (null where none fits), ``verdict``.

    Null urls and urls without '://' have empty host and path and get the default. Repeated rows
    stay, a null id stays null, other columns are not read, an empty table gives an empty result.
    Nothing is shuffled, so a hot host costs no more than others.
    """
    if default not in (ALLOW, BLOCK):
        raise ValueError(f"default verdict {default!r}")
    host, path = host_and_path(F.col(url_col))
    judged = pages.select(
        F.col(id_col), host.alias("host"), path.alias("path"), F.lit(None).cast(_MATCH).alias("hit")
    )
    for k, part in enumerate(batches(list(rules), lambda r: len(str(r)), trie_chars)):
        judged = stored(judged, "url-filter") if k else judged
        judged = judged.withColumn("hit", _matcher(judged, part)("host", "path", "hit"))
    return judged.select(
        id_col,
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"),
    )


def _matcher(df: DataFrame, rules: list[UrlRule]):
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(_MATCH)
    def match(host: pd.Series, path: pd.Series, hit: pd.DataFrame) -> pd.DataFrame:
        known = [
            None if verdict is None else (rule, verdict)
            for rule, verdict in zip(hit["rule"], hit["verdict"])
        ]
        find = trie.value.match
        best = [longer(k, find(h, p)) for h, p, k in zip(host, path, known)]
        return pd.DataFrame([x or (None, None) for x in best], columns=["rule", "verdict"])

    return match
