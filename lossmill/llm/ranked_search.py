"""Ranked lexical search over k2-treaps of a grid of terms and documents.

Documents are indexed in blocks. A block's grid has a row per term, the most frequent first, and a
column per document in the order of ids; a cell holds the impact of a term in a document. The grid
is kept as a quadtree of its filled cells, level by level: four bits per node say which of its
quadrants have cells, and every node holds the largest impact below it, as the difference to its
parent's, in as few bytes as the level needs. So an impact is exact at the last level and a bound
above it. A block is stored as one row of packed values in a row group of its own, so that a task
holds a few blocks at a time, however many its split has.

A query descends with the paths of all its rows together. A state is a range of documents with one
quadtree node per term that has cells there; its bound is the weighted sum of the nodes' maxima.
States are taken best first and split into halves of their range, until no state left can beat the
k-th best document. Equal scores are taken by ascending id, so thousands of equal copies need no
more work than the first k of them. A task goes through its blocks one by one and keeps the k best
so far of every query, which bounds the search in the next block.

Weights are whole numbers and need the whole corpus: documents and terms are counted before the
index is built, the documents of a term by adding up the counts that blocks keep.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmill.llm.common import giving_back, stored

#: Cells of a block; a longer document has one of its own.
BLOCK_CELLS = 1 << 20
QUERY_BYTES = 8 << 20
_BATCH = 64
_PIECE = 1 << 16
# Of UTF-8 in lower case: every byte of a character beyond ASCII belongs to a term.
_TERMS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
_IN_TERM = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
#: How many of a node's quadrants, given by its bits, come before a quadrant.
_BELOW = np.array([[(m & (1 << q) - 1).bit_count() for q in range(4)] for m in range(16)], np.int32)
_PACKING = pa.ipc.IpcWriteOptions(compression="zstd")
_TERMS_OF_BLOCK = pa.schema({"terms": pa.binary(), "dfs": pa.int64()})
_LEVEL = pa.schema({"mask": pa.binary(), "step": pa.binary()})
# Without it Parquet's writer looks at sizes every hundred rows only, and a reader takes all of them.
_ROW_GROUP_PER_BLOCK = {"parquet.block.row.count.limit": 1, "parquet.enable.dictionary": "false"}


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters and digits, A-Z in lower case; every character beyond ASCII is a
    letter here."""
    return _TERMS(text.lower()) if text else []


def n_terms_of(text: bytes | None) -> int:
    """How many terms a text has: the bytes at which one begins."""
    inside = _IN_TERM[np.frombuffer(text or b"", np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[:1].sum())


def impact(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of a term that occurs ``tf`` times in a document of ``length`` terms."""
    m = 100 - 90 + 90 * length * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(numbers: np.ndarray) -> np.ndarray:
    """Numbers of 31 bits with a zero before every bit."""
    out = numbers.astype(np.uint64)
    moved = np.empty_like(out)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        np.left_shift(out, np.uint64(shift), out=moved)
        out |= moved
        out &= np.uint64(mask)
    return out


def quadtree(rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> list[tuple]:
    """Levels from the root down: quadrant bits of each node (none at the last level) and what its
    parent's maximum is larger by; for the root the maximum itself."""
    height = max(int(rows.max()).bit_length(), int(columns.max()).bit_length())
    codes = _spread(rows)
    codes <<= np.uint64(1)
    codes |= _spread(columns)
    order = np.argsort(codes)
    codes, maxima = codes[order], values[order]
    del order
    masks, levels = None, []
    for _ in range(height):
        parents = codes >> np.uint64(2)
        starts = np.append(0, np.flatnonzero(parents[1:] != parents[:-1]) + 1)
        above = np.maximum.reduceat(maxima, starts)
        steps = np.repeat(above, np.diff(starts, append=len(codes)))
        steps -= maxima
        levels.append((masks, steps))
        bits = np.uint8(1) << (codes & np.uint64(3)).astype(np.uint8)
        masks = np.bitwise_or.reduceat(bits, starts)
        codes, maxima = parents[starts], above
    levels.append((masks, maxima))
    return levels[::-1]


def _narrow(numbers: np.ndarray) -> bytes:
    """A byte for the width, then the numbers in as few bytes each as the largest needs."""
    for kind in (np.uint8, np.uint16, np.int32):
        if numbers.max() <= np.iinfo(kind).max:
            return bytes([np.dtype(kind).itemsize]) + numbers.astype(kind).tobytes()
    raise ValueError("impacts are below 2 ** 31")


def _numbers(data: bytes | pa.Buffer) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.int32}[data[0]]
    return np.frombuffer(data, kind, offset=1)


def _packed(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> bytes:
    """Batches as one compressed value: Spark copies a value whole, and arrays element by element."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema, options=_PACKING) as stream:
        for batch in batches:
            stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(data: pa.BinaryScalar) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(data.as_buffer()) as stream:
        yield from stream


class Treap:
    """A block's quadtree as arrays over the nodes of all levels; node 0 is for no cells."""

    def __init__(
        self,
        masks: list[bytes | pa.Buffer],
        steps: list[bytes | pa.Buffer],
        ids: list,
        row_terms: pa.Array,
    ):
        self.ids, self.terms, self.height = ids, row_terms, len(steps) - 1
        sizes = [len(_numbers(step)) for step in steps]
        # The root is node 1; children follow in the order of their parents.
        self.maxima = np.zeros(1 + sum(sizes), np.int32)
        self.maxima[1] = _numbers(steps[0])[0]
        # Cells, at the last level, have no children.
        self.masks = np.zeros(1 + sum(sizes[:-1]), np.uint8)
        self.first = np.zeros(len(self.masks), np.int32)
        at, end = 1, 2
        for packed, step in zip(masks, steps[1:]):
            pairs = np.frombuffer(packed, np.uint8)
            mask = self.masks[at:end]
            mask[::2] = pairs & 15
            mask[1::2] = (pairs >> 4)[: len(mask) // 2]
            counts = np.bitwise_count(mask)
            self.first[at:end] = np.cumsum(counts, dtype=np.int32)
            self.first[at:end] += end
            self.first[at:end] -= counts
            maxima = np.repeat(self.maxima[at:end], counts)
            maxima -= _numbers(step)
            at, end = end, end + len(maxima)
            self.maxima[at:end] = maxima

    def search(self, rows: np.ndarray, weights: np.ndarray, best: list[tuple], k: int) -> None:
        """Put into ``best``, sorted and of ``k`` at most, the documents that belong there: tuples
        of the negative score and the id as ``_order`` has it."""
        nodes = np.ones(len(rows), np.int32)
        heap = [(-int(weights.sum()) * int(self.maxima[1]), 0, self.height, nodes)]
        while heap:
            batch = []
            while heap and len(batch) < _BATCH:
                bound, at, left, nodes = state = heapq.heappop(heap)
                if len(best) == k and (bound, _order(self.ids[at])) >= best[-1]:
                    heap.clear()
                elif left:
                    batch.append(state)
                else:
                    insort(best, (bound, _order(self.ids[at])))
                    del best[k:]
            if not batch:
                continue
            nodes = np.stack([s[3] for s in batch])
            lefts = np.array([s[2] for s in batch]) - 1
            below = rows >> lefts[:, None] & 1
            masks, first = self.masks[nodes], self.first[nodes]
            floor = best[-1][0] if len(best) == k else 0
            for half in (0, 1):
                quadrant = 2 * below + half
                there = (masks >> quadrant & 1).astype(bool)
                children = np.where(there, first + _BELOW[masks, quadrant], 0)
                bounds = (-(self.maxima[children] @ weights)).tolist()
                for n, bound in enumerate(bounds):
                    if bound < 0 and bound <= floor:
                        left = batch[n][2] - 1
                        at = batch[n][1] + (half << left)
                        heapq.heappush(heap, (bound, at, left, children[n]))


def _order(one_id) -> tuple:
    """Ids in ascending order, null last."""
    return one_id is None, one_id


@dataclass(frozen=True)
class Index:
    """``blocks``: one row per block with ``ids``, ``terms`` and ``grid``.

    Packed in ``terms`` are the terms of the rows and in how many documents of the block they are, in
    ``grid`` the quadrant bits and the steps of each level. ``n_docs`` are the documents with a term,
    ``n_terms`` all their terms.
    """

    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = BLOCK_CELLS
) -> Index:
    """Index every row of ``docs``, which is read twice.

    Each row is a document of its own, also where ids repeat or are null. Null, empty and other
    texts without a term are in no block. Very long texts are indexed whole. Other columns are not
    read.
    """
    data = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    counted = data.select("text").mapInArrow(_count_terms, "docs long, terms long")
    counted = counted.agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = int(counted[0] or 0), int(counted[1] or 0)
    ids = f"array<{docs.schema[id_col].dataType.simpleString()}>"
    blocks = data.mapInArrow(
        _blocks(n_docs, n_terms, cells), f"ids {ids}, terms binary, grid binary"
    )
    return Index(stored(blocks, "search-index", _ROW_GROUP_PER_BLOCK), n_docs, n_terms)


@giving_back
def _count_terms(tables):
    docs = total = 0
    for t in tables:
        for at in range(0, t.num_rows, 256):
            counts = [n_terms_of(x) for x in t.column(0).slice(at, 256).to_pylist()]
            docs += sum(n > 0 for n in counts)
            total += sum(counts)
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([total])], ["docs", "terms"])


class _Rows:
    """The cells of a block's documents, with numbers in the place of terms."""

    def __init__(self):
        self.ids: list = []
        self.numbers: dict[bytes, int] = {}
        self.seen: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.cells = 0

    def add(self, one_id, counts: Counter) -> None:
        numbers, n = self.numbers, len(counts)
        self.ids.append(one_id)
        self.seen.append(
            np.fromiter((numbers.setdefault(t, len(numbers)) for t in counts), np.int32, n)
        )
        self.tfs.append(np.fromiter(counts.values(), np.int32, n))
        self.cells += n


def _blocks(n_docs: int, n_terms: int, cells: int):
    @giving_back
    def build(tables):
        rows = _Rows()
        kind = pa.null()
        for t in tables:
            kind = t.schema.field(0).type
            for at in range(0, t.num_rows, 256):
                part = t.slice(at, 256)
                for one_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts = Counter(terms(text))
                    if not counts:
                        continue
                    if rows.ids and rows.cells + len(counts) > cells:
                        yield _block(rows, n_docs, n_terms, kind)
                        rows = _Rows()
                    rows.add(one_id, counts)
        if rows.ids:
            yield _block(rows, n_docs, n_terms, kind)

    return build


def _block(rows: _Rows, n_docs: int, n_terms: int, kind) -> pa.RecordBatch:
    """The block of ``rows``, which are used up."""
    order = sorted(range(len(rows.ids)), key=lambda k: _order(rows.ids[k]))
    seen = np.concatenate([rows.seen[k] for k in order])
    sizes = np.array([len(rows.tfs[k]) for k in order])
    lengths = np.array([rows.tfs[k].sum(dtype=np.int64) for k in order])
    values = np.concatenate([rows.tfs[k] for k in order])
    dfs = np.bincount(seen)
    by_df = np.argsort(-dfs, kind="stable")
    names = pa.array(list(rows.numbers), pa.binary()).take(pa.array(by_df))
    rows.seen, rows.tfs, rows.numbers = [], [], {}
    held = pa.RecordBatch.from_arrays([names, pa.array(dfs[by_df])], schema=_TERMS_OF_BLOCK)
    row = np.empty(len(dfs), np.int32)
    row[by_df] = np.arange(len(dfs))
    columns = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
    for at in range(0, len(values), _PIECE):
        part = slice(at, at + _PIECE)
        values[part] = impact(values[part].astype(np.int64), lengths[columns[part]], n_docs, n_terms)
    levels = quadtree(row[seen], columns, values)
    del seen, columns, values
    fields = {
        "ids": pa.array([[rows.ids[k] for k in order]], pa.list_(kind)),
        "terms": pa.array([_packed([held], _TERMS_OF_BLOCK)], pa.binary()),
        "grid": pa.array([_packed(_levels(levels), _LEVEL)], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(fields.values()), list(fields))


def _levels(levels: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A row for each of ``levels``, which are used up."""
    while levels:
        mask, step = levels.pop(0)
        if levels:
            even = np.append(mask, np.zeros(len(mask) % 2, np.uint8))
            mask = (even[::2] | even[1::2] << np.uint8(4)).tobytes()
        row = [pa.array([x], pa.binary()) for x in (mask, _narrow(step))]
        yield pa.RecordBatch.from_arrays(row, schema=_LEVEL)


def _document_counts(index: Index, wanted: DataFrame) -> DataFrame:
    """``term`` and ``df`` of the terms of ``wanted`` that occur; ``wanted`` is of one batch."""
    held = [r.term for r in wanted.select("term").distinct().toLocalIterator()]

    @giving_back
    def count(tables):
        some = pa.array(held, pa.binary())
        total = np.zeros(len(held), np.int64)
        for t in tables:
            for packed in t.column(0):
                held_here = next(_unpacked(packed))
                at = pc.index_in(some, held_here["terms"])
                there = np.flatnonzero(at.is_valid())
                places = at.drop_null().to_numpy()
                total[there] += held_here["dfs"].to_numpy()[places]
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [some.take(pa.array(there)), pa.array(total[there])], ["term", "df"]
        )

    found = index.blocks.select("terms").mapInArrow(count, "term binary, df long")
    return found.groupBy("term").agg(F.sum("df").alias("df"))


def search(
    index: Index,
    items: DataFrame,
    k: int = 10,
    item_col: str = "item_id",
    text_col: str = "text",
    batch_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The ``k`` documents of highest score of every row of ``items``: item id, ``rank`` (from 1),
    ``doc_id``, ``score``.

    A score sums weight times impact over the item's distinct terms, in whole numbers; documents
    with a score of zero are left out, equal scores are ranked by ascending id, null last. Items
    without a term, null and empty ones, have no rows. Rows that repeat an item are searched each.
    Items are sent to the blocks in batches of some ``batch_bytes``; the index is read once a
    batch. An empty table on either side gives no rows.
    """

    @F.arrow_udf("array<binary>")
    def distinct_terms(texts: pa.Array) -> pa.Array:
        each = [list(dict.fromkeys(terms(x.as_py()))) for x in texts]
        return pa.array(each, pa.list_(pa.binary()))

    asked = items.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(item_col).alias("item"),
        distinct_terms(F.col(text_col).cast("binary")).alias("terms"),
    ).where(F.size("terms") > 0)
    asked = stored(asked, "search-items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.length(t) + 50)
    total = asked.agg(F.sum(size)).first()[0] or 0
    n_batches = max(1, math.ceil(total / batch_bytes))
    results = []
    for number in range(n_batches):
        batch = asked.where(F.pmod(F.xxhash64("row"), F.lit(n_batches)) == number)
        found = _searched(index, batch, k)
        results.append(stored(found, "search-found") if n_batches > 1 else found)
    best = results[0]
    for more in results[1:]:
        best = best.unionByName(more)
    kept = best.join(asked.select("row", "item"), "row")
    return kept.select(F.col("item").alias(item_col), "rank", "doc_id", "score")


def _searched(index: Index, batch: DataFrame, k: int) -> DataFrame:
    """``row``, ``rank``, ``doc_id`` and ``score`` of one batch of items."""
    wanted = batch.select("row", F.explode("terms").alias("term"))
    df = {bytes(r.term): r.df for r in _document_counts(index, wanted).toLocalIterator()}
    queries = []
    for r in batch.select("row", "terms").toLocalIterator():
        known = [(bytes(t), weight(index.n_docs, df[t])) for t in map(bytes, r.terms) if t in df]
        known = [(t, w) for t, w in known if w > 0]
        if known:
            queries.append((r.row, [t for t, _ in known], np.array([w for _, w in known])))
    id_kind = index.blocks.schema["ids"].dataType.elementType.simpleString()
    shared = index.blocks.sparkSession.sparkContext.broadcast(queries)
    found = index.blocks.select("ids", "terms", "grid").mapInArrow(
        _searcher(shared, k), f"row long, doc_id {id_kind}, score long"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("row", "rank", "doc_id", "score")


def _searcher(shared, k: int):
    @giving_back
    def search_blocks(tables):
        queries = shared.value
        names = pa.array([t for _, some, _ in queries for t in some], pa.binary())
        starts = np.cumsum([0, *(len(some) for _, some, _ in queries)])
        best: list[list[tuple]] = [[] for _ in queries]
        kind = None
        for t in tables:
            kind = t.schema.field(0).type.value_type
            for n in range(t.num_rows):
                treap = _treap(*(t.column(c)[n] for c in range(3)))
                at = pc.index_in(names, treap.terms).fill_null(-1).to_numpy()
                for q, (_, _, weights) in enumerate(queries):
                    rows = at[starts[q] : starts[q + 1]]
                    there = rows >= 0
                    if there.any():
                        treap.search(rows[there], weights[there], best[q], k)
        yield from _found_batches(queries, best, kind)

    return search_blocks


def _treap(ids: pa.ListScalar, packed_terms: pa.BinaryScalar, grid: pa.BinaryScalar) -> Treap:
    levels = list(_unpacked(grid))
    masks = [level["mask"][0].as_buffer() for level in levels[:-1]]
    steps = [level["step"][0].as_buffer() for level in levels]
    return Treap(masks, steps, ids.as_py(), next(_unpacked(packed_terms))["terms"])


def _found_batches(queries: Iterable, best: list[list[tuple]], kind) -> Iterator[pa.RecordBatch]:
    rows = [(q[0], one_id, -score) for q, some in zip(queries, best) for score, (_, one_id) in some]
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), kind, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "score"])
