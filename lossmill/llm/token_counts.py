"""Token counts per section: a document is encoded once and its tokens are given to sections.

Tokens of a byte-level vocabulary spell the text without loss, so adding up their lengths gives
the span of each in the UTF-8 bytes of the document. Sections are spans of characters. Both lie in
order within a document, so the interval join is a search of sorted ends, and only tokens that
cross a section's ends need a rule:

* ``start``: the section that has the token's first byte;
* ``most``: the section that has most of its bytes, the first of equals;
* ``split``: every section by the share of the token's bytes that it has.

Bytes outside all sections count for the rest of the document, which is section number null.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("start", "most", "split")
_OUT = [
    ("section", pa.int32()),
    ("start", pa.int64()),
    ("n_chars", pa.int64()),
    ("n_tokens", pa.float64()),
]


class ByteEncoder:
    """A byte-level vocabulary and the length of each of its tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, n in ranks.items():
            self._sizes[n] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes."""
        return np.cumsum(self._sizes[self._encoding.encode_ordinary(text)])


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def encoder(path: str, pattern: str) -> ByteEncoder:
    """One per Python worker."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = ByteEncoder(path, pattern)
    return _encoders[path, pattern]


def attributed(ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section, and of what lies outside.

    ``ends`` are the token ends, ``sections`` rows of (start, end) in order and apart, in the same
    unit. A section without bytes has no tokens.
    """
    bounds = np.unique(np.concatenate([[0], sections.ravel(), ends[-1:]]))
    owner = np.full(len(bounds), -1)  # of the stretch from each bound to the next
    filled = np.flatnonzero(sections[:, 0] < sections[:, 1])
    for k, at in zip(filled, np.searchsorted(bounds, sections[filled, 0])):
        owner[at : np.searchsorted(bounds, sections[k, 1])] = k
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends, side="left") - 1
    counts = np.zeros(len(sections) + 1)
    inside = first == last
    np.add.at(counts, owner[first[inside]], 1.0)
    for t in np.flatnonzero(~inside):
        shares: dict[int, int] = {}
        for at in range(first[t], last[t] + 1):
            size = min(ends[t], bounds[at + 1]) - max(starts[t], bounds[at])
            shares[owner[at]] = shares.get(owner[at], 0) + int(size)
        if rule == "start":
            counts[owner[first[t]]] += 1
        elif rule == "most":
            counts[max(shares, key=shares.get)] += 1
        else:
            for k, size in shares.items():
                counts[k] += size / int(ends[t] - starts[t])
    return counts[:-1], float(counts[-1])


def line_sections(text: str) -> list[tuple[int, int]]:
    """Lines with the line end that closes them."""
    spans, at = [], 0
    for line in text.split("\n"):
        end = min(at + len(line) + 1, len(text))
        spans.append((at, end))
        at = end
    return spans if len(spans) == 1 or spans[-1][0] < spans[-1][1] else spans[:-1]


def byte_places(text: str, chars: np.ndarray) -> np.ndarray:
    """Byte offset of each character offset."""
    if text.isascii():
        return chars
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return begins[chars]


def count_tokens(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections: Column | None = None,
    rule: str = "most",
) -> DataFrame:
    """One row per document and section: id, ``section`` (from 0), ``start`` and ``n_chars`` of the
    section, ``n_tokens``, and ``doc_tokens`` of the whole document, which the sections and the row
    of section null add up to.

    ``sections`` is an array of structs ``start``, ``end`` (characters, in order, not overlapping;
    ends beyond the text are cut back); without it a section is a line. A null or empty text has
    one section without characters and tokens, or those given. The row of section null is there
    only if tokens fall to it; its start is null and its characters are those in no section. Rows
    of documents that repeat or have a null id stay apart from nothing: each gives its own rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r}: one of {', '.join(RULES)}")
    span = "array<struct<start:bigint,end:bigint>>"
    given = F.lit(None).cast(span) if sections is None else sections.cast(span)

    @F.arrow_udf(
        "array<struct<section:int,start:bigint,n_chars:bigint,n_tokens:double>>"
    )
    def counted(texts: pa.Array, spans: pa.Array) -> pa.Array:
        encode = encoder(vocabulary_path, pattern).ends
        rows = [_counted(t.as_py() or "", s.as_py(), encode, rule) for t, s in zip(texts, spans)]
        names = [n for n, _ in _OUT]
        return pa.array(
            [[dict(zip(names, x)) for x in row] for row in rows], pa.list_(pa.struct(_OUT))
        )

    rows = docs.select(
        F.col(id_col).alias("id"), counted(F.col(text_col), given).alias("rows")
    )
    total = F.aggregate("rows", F.lit(0.0), lambda a, x: a + x["n_tokens"])
    rows = rows.select("id", F.round(total).cast("long").alias("doc_tokens"), F.inline("rows"))
    return rows.select(
        F.col("id").alias(id_col), "section", "start", "n_chars", "n_tokens", "doc_tokens"
    )


def _counted(text: str, spans, encode, rule: str) -> list[tuple]:
    if spans is None:
        spans = line_sections(text)
    else:
        spans = [(min(s["start"], len(text)), min(s["end"], len(text))) for s in spans if s]
    chars = np.array(spans, np.int64).reshape(-1, 2)
    if (np.diff(chars.ravel()) < 0).any() or (chars < 0).any():
        raise ValueError("sections overlap or are out of order")
    ends = encode(text)
    per, outside = attributed(ends, byte_places(text, chars), rule)
    rows = [
        (k, int(a), int(b - a), float(n)) for k, ((a, b), n) in enumerate(zip(chars.tolist(), per))
    ]
    if outside:
        rows.append((None, None, len(text) - int((chars[:, 1] - chars[:, 0]).sum()), outside))
    return rows
