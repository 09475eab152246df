"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items in documents.

Words are the symbols. A window is ``window`` consecutive words of an item; an item of fewer words
is one window. Windows of equal length are searched together: a table gives for a pair of
neighbouring words how far the search may move on without missing a window, a pair that ends
windows selects a bucket of them, and a direct comparison confirms. Tables of at most
``BLOCK_BYTES`` of windows are broadcast; of a larger benchmark every block is searched in turn,
each over a stored result, so no executor holds more than one block.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossmill.llm.common import LOWER, UPPER, giving_back, stored

WINDOW = 10
BLOCK_BYTES = 8_000_000
_PAIR = 2

# Words are runs of digits, a-z and bytes over 0x7F once A-Z are lower case: every other byte
# becomes a space.
_TO_WORDS = bytes(
    ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER
    else b if b > 0x7F or chr(b) in LOWER or chr(b) in "0123456789"
    else 0x20
    for b in range(256)
)

_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("starts", T.ArrayType(T.LongType(), False), False),
        T.StructField("ends", T.ArrayType(T.LongType(), False), False),
        T.StructField("items", T.ArrayType(T.StringType(), False), False),
    ]
)
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("items", pa.list_(pa.string())),
    ]
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


def windows(text: bytes | None, size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    found = words(text)
    for k in range(max(len(found) - size + 1, min(len(found), 1))):
        yield tuple(found[k : k + size])


class WuManber:
    """Occurrences of equally long sequences of numbers in a sequence of numbers.

    Number 0 stands for a word of no sequence.
    """

    def __init__(self, sequences: Iterable[tuple[int, ...]]):
        sequences = list(sequences)
        self.length = len(sequences[0])
        self._pair = min(_PAIR, self.length)
        self._far = self.length - self._pair + 1
        self._shift: dict[tuple[int, ...], int] = {}
        self._buckets: dict[tuple[int, ...], list[tuple[int, ...]]] = defaultdict(list)
        for sequence in sequences:
            for k in range(self._far):
                block = sequence[k : k + self._pair]
                self._shift[block] = min(self._shift.get(block, self._far), self._far - 1 - k)
            self._buckets[sequence[-self._pair :]].append(sequence)

    def find(self, symbols: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Start and sequence of every occurrence, by start."""
        length, pair, far, shift = self.length, self._pair, self._far, self._shift.get
        end, n = length, len(symbols)
        while end <= n:
            block = tuple(symbols[end - pair : end])
            move = shift(block, far)
            if not move:
                there = tuple(symbols[end - length : end])
                for sequence in self._buckets[block]:
                    if sequence == there:
                        yield end - length, sequence
            end += move or 1


class BenchmarkIndex:
    """Searches the windows of a block of benchmark items, whatever their lengths."""

    def __init__(self, entries: Iterable[tuple[bytes, str | None]]):
        """``entries`` holds the words of a window, joined by spaces, and the id of an item."""
        self._numbers: dict[bytes, int] = {}
        self._items: dict[tuple[int, ...], set[str]] = defaultdict(set)
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for text, item in entries:
            sequence = tuple(
                self._numbers.setdefault(w, len(self._numbers) + 1) for w in text.split()
            )
            if sequence not in self._items:
                by_length[len(sequence)].append(sequence)
            self._items[sequence].update(() if item is None else (item,))
        self._searches = [WuManber(x) for x in by_length.values()]

    def search(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, word spans covered by windows (merged), items that have windows."""
        found = words(text)
        number = self._numbers.get
        symbols = [number(w, 0) for w in found]
        spans, items = [], set()
        for search in self._searches:
            for start, sequence in search.find(symbols):
                spans.append((start, start + search.length))
                items |= self._items[sequence]
        return len(found), merged(spans), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def with_benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    into: str = "benchmark_hits",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``starts`` and ``ends`` of the word
    spans covered by benchmark windows, and the ``items`` that have such windows.

    Every row is judged by its own whole text, so repeated rows and null ids are no special case.
    Null and empty texts have no words and no hits. Items without words match nothing. Windows of
    an item with null id cover words, but name no item. Ids are of any type that a cast to text and
    back leaves as it is; ``items`` are in their order. A column of the name ``into`` is replaced.
    An empty benchmark leaves every document without hits.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("binary")
    )
    entries = _entries(items, window)
    total = entries.agg(F.sum(F.length("window") + 16)).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("window"), F.lit(n_blocks))
    entries = stored(entries, "benchmark-windows") if n_blocks > 1 else entries
    out = docs.withColumn(into, F.lit(None).cast(_FOUND))
    for k in range(n_blocks):
        index = BenchmarkIndex(
            (bytes(r[0]), r[1]) for r in entries.where(block == k).toLocalIterator()
        )
        out = stored(out, "benchmark-hits") if k else out
        search = _searcher(docs, index)
        out = out.withColumn(into, search(F.col(text_col).cast("binary"), F.col(into)))
    found = F.array_sort(F.col(into)["items"].cast(f"array<{kind}>"))
    return out.withColumn(into, F.col(into).withField("items", found))


def _entries(items: DataFrame, window: int) -> DataFrame:
    def cut(tables):
        for t in tables:
            seen = {
                (b" ".join(w), item)
                for item, text in zip(*(c.to_pylist() for c in t.columns))
                for w in windows(text, window)
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w for w, _ in seen], pa.binary()),
                    pa.array([i for _, i in seen], pa.string()),
                ],
                ["window", "item"],
            )

    return items.mapInArrow(cut, "window binary, item string").distinct()


def _searcher(df: DataFrame, index: BenchmarkIndex):
    shared = df.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(_FOUND)
    @giving_back
    def search(text: pa.Array, before: pa.Array) -> pa.Array:
        rows = []
        for x, old in zip(text, before):
            n, spans, items = shared.value.search(x.as_py())
            if old.is_valid:
                was = old.as_py()
                spans = merged([*zip(was["starts"], was["ends"]), *spans])
                items |= set(was["items"])
            rows.append((n, [s for s, _ in spans], [e for _, e in spans], sorted(items)))
        names = ("n_words", "starts", "ends", "items")
        return pa.array([dict(zip(names, r)) for r in rows], _FOUND_ARROW)

    return search


def contamination_report(hits: Column) -> dict[str, Column]:
    """Counts and a digest of the items, from a column of ``with_benchmark_hits``.

    The digest is the SHA-256 of the item ids, sorted as strings and joined by commas.
    """
    lengths = F.zip_with(hits["ends"], hits["starts"], lambda e, s: e - s)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    ids = F.array_sort(F.transform(hits["items"], lambda i: i.cast("string")))
    return {
        "n_words": hits["n_words"],
        "n_hit": n_hit,
        "n_items": F.size(hits["items"]).cast("long"),
        "items_sha256": F.sha2(F.array_join(ids, ",").cast("binary"), 256),
        "contaminated": n_hit > 0,
    }
