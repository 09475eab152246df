"""Packing documents into token sequences of one size by minimum bin slack.

A document longer than the window gives whole windows and a rest. The rests are only counted by
length, so planning takes a table of at most ``window`` numbers, whatever the size of the corpus.
The longest rest opens a window and a bitset subset-sum program over the remaining counts picks the
multiset of lengths that fills it closest to capacity; that multiset is repeated as often as counts
allow. Rests that no multiset completes exactly are laid end to end and cut where windows end; what
is left at the very end becomes sequences of powers of two, which need no padding. So nothing is
padded at all.

Each task numbers its rests per length while it encodes; sums over earlier tasks make the numbers
global. Number and length alone then say where a piece lies.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossmill.llm.common import giving_back, stored
from lossmill.llm.encoding import encoder

WINDOW = 2048
_ID = "<u4"


@dataclass
class Plan:
    """Where the k-th rest of a length lies.

    ``runs[length]`` holds (first number, pieces per window, first sequence, offset); rests from
    ``loose_from[length]`` on lie in a stream that begins with sequence ``stream_sequence``, those
    of a length from ``stream_at[length]`` on.
    """

    window: int
    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    loose_from: dict[int, int] = field(default_factory=dict)
    stream_at: dict[int, int] = field(default_factory=dict)
    stream_sequence: int = 0
    stream_tokens: int = 0
    next_sequence: int = 0

    def place(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a rest: start within it, length, sequence, offset."""
        if number < self.loose_from[length]:
            runs = self.runs[length]
            first, per, sequence, offset = runs[
                bisect.bisect_right(runs, number, key=lambda r: r[0]) - 1
            ]
            window, slot = divmod(number - first, per)
            return [(0, length, sequence + window, offset + slot * length)]
        at = self.stream_at[length] + (number - self.loose_from[length]) * length
        return list(self._cut(at, length))

    def _cut(self, at: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        start = 0
        while start < length:
            sequence, offset, size = self._where(at + start)
            n = min(length - start, size - offset)
            yield start, n, self.stream_sequence + sequence, offset
            start += n

    def _where(self, at: int) -> tuple[int, int, int]:
        """Sequence, offset and size of the sequence at a place of the stream."""
        whole, end = divmod(self.stream_tokens, self.window)
        if at < whole * self.window:
            return *divmod(at, self.window), self.window
        at -= whole * self.window
        sequence = whole
        for bit in range(end.bit_length() - 1, -1, -1):
            size = end & (1 << bit)
            if size and at < size:
                return sequence, at, size
            at -= size
            sequence += bool(size)
        raise ValueError("past the end of the stream")


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length sum closest to ``capacity`` without passing it.

    Bit s of a number says whether the lengths so far can sum to s. Counts come from walking back
    through those numbers.
    """
    lengths = sorted((n for n, c in counts.items() if c and n <= capacity), reverse=True)
    mask = (1 << (capacity + 1)) - 1
    reach = [1]
    for length in lengths:
        now, left, step = reach[-1], min(counts[length], capacity // length), 1
        while left:
            take = min(step, left)
            now |= (now << (take * length)) & mask
            left -= take
            step *= 2
        reach.append(now)
        if now >> capacity & 1:
            break
    total = reach[-1].bit_length() - 1
    used: dict[int, int] = {}
    for k in range(len(reach) - 1, 0, -1):
        length = lengths[k - 1]
        n = 0
        while not reach[k - 1] >> total & 1:
            total -= length
            n += 1
        if n:
            used[length] = n
    return used


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """Plan for rests of lengths 1 to ``window`` - 1, ``counts`` of each."""
    plan = Plan(window)
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n < window for n in left):
        raise ValueError("rests are shorter than the window and not empty")
    done: dict[int, int] = defaultdict(int)
    runs = defaultdict(list)
    open_lengths = sorted(left, reverse=True)
    loose: dict[int, int] = {}
    for length in open_lengths:
        while left.get(length):
            left[length] -= 1
            used = closest_fill(left, window - length)
            left[length] += 1
            if length + sum(n * k for n, k in used.items()) < window:
                loose[length] = left.pop(length)  # what remains only gets less: it never fits
                break
            used[length] = used.get(length, 0) + 1
            times = min(left[n] // k for n, k in used.items())
            offset = 0
            for n, k in sorted(used.items(), reverse=True):
                runs[n].append((done[n], k, plan.next_sequence, offset))
                offset += n * k
                done[n] += times * k
                left[n] -= times * k
            plan.next_sequence += times
    plan.runs = dict(runs)
    plan.loose_from = {n: done[n] for n in counts}
    plan.stream_sequence = plan.next_sequence
    for length, n in sorted(loose.items(), reverse=True):
        plan.stream_at[length] = plan.stream_tokens
        plan.stream_tokens += n * length
    whole, end = divmod(plan.stream_tokens, window)
    plan.next_sequence += whole + end.bit_count()
    return plan


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``; ``ids`` as well if asked for.

    A document's ids are those of its text and then ``end_id``; null and empty texts have that one
    alone. Each row is a document of its own, also where ids repeat or are null. Very long texts
    give many whole windows. Other columns are not read; an empty table has no pieces.
    """
    encoded = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(text_col).alias("text"),
            F.spark_partition_id().cast("long").alias("part"),
        ).mapInArrow(_encode(tokenizer_path, window, end_id), _encoded_schema(docs, id_col)),
        "packing-tokens",
    )
    counts = encoded.groupBy("part", "rest").agg(
        F.count("*").alias("n"), F.sum("n_whole").alias("whole")
    )
    counts = stored(counts, "packing-counts")
    by_length = counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()
    plan = plan_windows({r.rest: r.n for r in by_length}, window)
    rests = _placed(encoded, counts, plan)
    if with_ids:
        keys = ["part", "rest", "rest_number"]
        whole = _whole_windows(encoded, counts, plan, window)
        rests = rests.join(encoded.select(*keys, "ids"), keys)
        rests = rests.withColumn(
            "ids", F.expr("substring(ids, int(4 * start + 1), int(4 * length))")
        )
        whole = whole.withColumn("ids", F.expr(f"substring(ids, int(4 * start + 1), {4 * window})"))
        columns = [*_PIECE, "ids"]
    else:
        rests = _with_checksums(rests, encoded)
        whole = _whole_windows(encoded, counts, plan, window)
        columns = _PIECE
    pieces = rests.select(*columns).unionByName(whole.select(*columns))
    return pieces.withColumnRenamed("id", id_col)


_PIECE = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _encoded_schema(docs: DataFrame, id_col: str) -> str:
    """``rest_number`` and ``whole_number`` count within a task."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        f"id {kind}, part long, doc_tokens long, rest int, rest_number long, rest_crc32 long, "
        "n_whole long, whole_number long, whole_crc32 array<long>, ids binary"
    )


def _encode(path: str, window: int, end_id: int):
    last = np.array([end_id], _ID).tobytes()

    @giving_back
    def encode(tables):
        rests: dict[int, int] = defaultdict(int)
        whole = 0
        for t in tables:
            for at in range(0, t.num_rows, 512):
                some = t.slice(at, 512)
                rows = []
                for text in some.column(1).to_pylist():
                    ids = encoder(path).encode(text or "") + last
                    n_whole, rest = divmod(len(ids) // 4, window)
                    cut = n_whole * window * 4
                    crcs = [zlib.crc32(ids[k : k + 4 * window]) for k in range(0, cut, 4 * window)]
                    crc = zlib.crc32(ids[cut:])
                    rows.append(
                        (len(ids) // 4, rest, rests[rest], crc, n_whole, whole, crcs, ids)
                    )
                    rests[rest] += 1
                    whole += n_whole
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                kinds += [pa.list_(pa.int64()), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), *columns],
                    [
                        "id", "part", "doc_tokens", "rest", "rest_number", "rest_crc32",
                        "n_whole", "whole_number", "whole_crc32", "ids",
                    ],
                )
        encoder(path).forget()

    return encode


def _placed(encoded: DataFrame, counts: DataFrame, plan: Plan) -> DataFrame:
    """Pieces of the rests; ``cut`` where a rest has several."""
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.where("rest > 0").select(
        "part", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    shared = encoded.sparkSession.sparkContext.broadcast(plan)
    piece = "struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>"

    @F.arrow_udf(f"array<{piece}>")
    @giving_back
    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        names = ("start", "length", "sequence_id", "offset")
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in names]))
        find = shared.value.place
        return pa.array(
            [
                [dict(zip(names, p)) for p in find(length, number)]
                for length, number in zip(lengths.to_pylist(), numbers.to_pylist())
            ],
            kind,
        )

    rests = encoded.where("rest > 0").drop("ids", "whole_crc32", "whole_number")
    rests = rests.join(before, ["part", "rest"])
    pieces = rests.withColumn("pieces", place("rest", F.col("rest_number") + F.col("before")))
    pieces = pieces.withColumn("cut", F.size("pieces") > 1)
    pieces = pieces.withColumn("piece", F.explode("pieces"))
    return pieces.select(
        "id",
        "part",
        "rest",
        "rest_number",
        "rest_crc32",
        "doc_tokens",
        "cut",
        (F.col("doc_tokens") - F.col("rest") + F.col("piece.start")).alias("start"),
        F.col("piece.length").alias("length"),
        F.col("piece.sequence_id").alias("sequence_id"),
        F.col("piece.offset").alias("offset"),
        F.col("rest_crc32").alias("ids_crc32"),
    )


def _with_checksums(pieces: DataFrame, encoded: DataFrame) -> DataFrame:
    """Rests in one piece have their checksum; the others are looked up once more."""

    @F.arrow_udf("long")
    @giving_back
    def crc32(ids: pa.Array) -> pa.Array:
        return pa.array([zlib.crc32(x.as_py()) for x in ids], pa.int64())

    keys = ["part", "rest", "rest_number"]
    # At most one rest a sequence is cut. Written first, so that their size decides on the join.
    cut = stored(pieces.where("cut").drop("ids_crc32"), "packing-cuts")
    cut = cut.join(encoded.select(*keys, "ids"), keys)
    ids = F.expr("substring(ids, int(4 * start + 1), int(4 * length))")
    cut = cut.withColumn("ids_crc32", crc32(ids))
    return pieces.where("not cut").select(*_PIECE).unionByName(cut.select(*_PIECE))


def _whole_windows(encoded: DataFrame, counts: DataFrame, plan: Plan, window: int) -> DataFrame:
    totals = counts.groupBy("part").agg(F.sum("whole").alias("whole")).where("whole > 0")
    before = _running_total(totals, "part", "whole").withColumnRenamed("before", "whole_before")
    rows = encoded.where("n_whole > 0").join(before, "part")
    rows = rows.select("*", F.posexplode("whole_crc32").alias("k", "ids_crc32"))
    number = F.col("whole_before") + F.col("whole_number") + F.col("k")
    return rows.withColumns(
        {
            "start": (F.col("k") * window).cast("long"),
            "length": F.lit(window).cast("long"),
            "sequence_id": number + plan.next_sequence,
            "offset": F.lit(0).cast("long"),
        }
    )


def _running_total(totals: DataFrame, key: str, value: str) -> DataFrame:
    """Sum of ``value`` over smaller keys, in blocks of keys so that no task orders all of them."""
    block = F.floor(F.sqrt(F.col(key).cast("double"))).cast("long")
    totals = totals.withColumn("block", block)
    sums = totals.groupBy("block").agg(F.sum(value).alias("sum"))
    of_blocks = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("block", F.coalesce(F.sum("sum").over(of_blocks), F.lit(0)).alias("blocks"))
    inside = Window.partitionBy("block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    rows = rows.join(sums, "block")
    return rows.select(key, (F.col("inside") + F.col("blocks")).alias("before"))
