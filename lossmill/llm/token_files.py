"""Token ids in binary files, coded by a static range asymmetric numeral system.

All files of an archive share one table of frequencies, counted over the whole corpus, whose sum is
a power of two. Documents lie in ascending order of their ids, those of a file in segments of whole
documents. A segment is a header, an index of its documents, checkpoints, and blocks of
``BLOCK_IDS`` token ids, the last one filled up. A block is coded by ``LANES`` interleaved states
that share one stream of 32-bit words, and depends on nothing but the table: its checkpoint says
where its words start, holds the states to begin with, and a checksum of its ids. So blocks are
coded and decoded side by side, and a range of ids needs its own blocks only (``ids_between``).

Layout, all numbers little-endian::

    segment   "TANS", version u8, 3 zero bytes, n_ids u64, n_docs u32, n_blocks u32, n_words u64,
              index_bytes u64, crc32 of the table u32, crc32 of index and checkpoints u32
    index     per document: n_ids u64, bytes of its id u32 (2**32 - 1: null); then these ids (UTF-8)
    checkpoint  per block: first word u64, crc32 u32, LANES states u64
    words     n_words u32, then a line end

Spark's text writer writes the files, a segment a row, through its commit protocol; the table is a
file of its own beside them.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossmill.llm.common import stored
from lossmill.llm.encoding import encoder

#: Bits of the sum of frequencies at least; a larger vocabulary gets sixteen times its size.
SCALE_BITS = 20
LANES = 32
BLOCK_IDS = LANES * 512
SEGMENT_IDS = 1 << 20
SEGMENTS_PER_FILE = 32

_HEAD = struct.Struct("<4sB3xQIIQQII")
_MAGIC, _VERSION = b"TANS", 1
_NO_ID = (1 << 32) - 1
_CHECKPOINT = np.dtype([("word", "<u8"), ("crc", "<u4"), ("states", "<u8", LANES)])
_DOC = np.dtype([("n_ids", "<u8"), ("n_bytes", "<u4")])
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


@dataclass(frozen=True)
class Frequencies:
    """How often each id occurs, scaled to a sum of ``2 ** bits``; ids that do not occur have 0."""

    bits: int
    counts: np.ndarray = field(repr=False)

    @classmethod
    def of(cls, counts: Mapping[int, int]) -> Frequencies:
        """Scaled counts, 1 at least for every id that occurs; the most frequent ids make up for
        what rounding adds or leaves."""
        size = max(counts, default=0) + 1
        bits = max(SCALE_BITS, (size - 1).bit_length() + 4)
        if bits > 28:
            raise ValueError(f"too large a vocabulary: id {size - 1}")
        scale, total = 1 << bits, max(sum(counts.values()), 1)
        scaled = {k: max(1, n * scale // total) for k, n in counts.items() if n}
        left = scale - sum(scaled.values())
        for k in sorted(scaled, key=lambda k: (-scaled[k], k)):
            part = max(left, -(scaled[k] // 2))
            scaled[k] += part
            left -= part
            if not left:
                break
        table = np.zeros(size, np.uint32)
        for k, n in scaled.items():
            table[k] = n
        return cls(bits, table)

    def to_bytes(self) -> bytes:
        return struct.pack("<II", self.bits, len(self.counts)) + self.counts.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Frequencies:
        bits, n = struct.unpack_from("<II", data)
        return cls(bits, np.frombuffer(data, "<u4", n, 8))

    def coder(self) -> Coder:
        return Coder(self)


class Coder:
    """Codes blocks of ids, and decodes them, all blocks of a segment at a time."""

    def __init__(self, frequencies: Frequencies):
        self.crc = zlib.crc32(frequencies.to_bytes())
        self._bits = np.uint64(frequencies.bits)
        self._mask = np.uint64((1 << frequencies.bits) - 1)
        self._counts = frequencies.counts.astype(np.uint64)
        self._starts = np.cumsum(self._counts) - self._counts
        # A state from here on gives a word away before it takes a symbol in.
        self._limits = self._counts << np.uint64(63 - frequencies.bits)
        self._filler = int(self._counts.argmax()) if len(self._counts) else 0
        self._of_slot: np.ndarray | None = None

    def segment(self, doc_ids: list[str | None], ids: list[np.ndarray]) -> bytes:
        """The segment of some documents and their token ids."""
        numbers = np.concatenate(ids).astype(np.uint32)
        if len(numbers) and not (
            numbers.max() < len(self._counts) and self._counts[numbers].all()
        ):
            raise ValueError("an id without a frequency")
        blocks = -(-len(numbers) // BLOCK_IDS)
        filled = np.full(blocks * BLOCK_IDS, self._filler, np.uint32)
        filled[: len(numbers)] = numbers
        symbols = filled.reshape(blocks, -1, LANES)
        states, needs, words = self._encoded(symbols)
        points = np.zeros(blocks, _CHECKPOINT)
        points["states"] = states
        points["word"] = np.cumsum(needs) - needs
        points["crc"] = [zlib.crc32(block) for block in symbols.astype("<u4")]
        names = [None if d is None else d.encode() for d in doc_ids]
        docs = np.zeros(len(ids), _DOC)
        docs["n_ids"] = [len(x) for x in ids]
        docs["n_bytes"] = [_NO_ID if d is None else len(d) for d in names]
        index = docs.tobytes() + b"".join(d for d in names if d is not None)
        front = index + points.tobytes()
        head = _HEAD.pack(
            _MAGIC, _VERSION, len(numbers), len(ids), blocks, len(words), len(index), self.crc,
            zlib.crc32(front),
        )
        return head + front + words.tobytes()

    def _encoded(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States to begin with, words per block, and the words, as a decoder needs them."""
        blocks, steps, _ = symbols.shape
        state = np.full((blocks, LANES), _LOW, np.uint64)
        full = np.zeros((steps, blocks, LANES), bool)
        words = np.zeros((steps, blocks, LANES), np.uint32)
        for k in range(steps - 1, -1, -1):
            symbol = symbols[:, k]
            count = self._counts[symbol]
            over = state >= self._limits[symbol]
            full[k] = over
            words[k] = state  # its low 32 bits
            state = np.where(over, state >> _WORD, state)
            quotient = state // count
            state = (quotient << self._bits) + (state - quotient * count) + self._starts[symbol]
        full, words = full.transpose(1, 0, 2), words.transpose(1, 0, 2)
        return state, full.sum(axis=(1, 2)), words[full].astype("<u4")

    def _decoded(self, points: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Ids of whole blocks, one row each; ``word`` of ``points`` counts from ``words[0]``."""
        if self._of_slot is None:
            kind = np.uint16 if len(self._counts) <= 1 << 16 else np.uint32
            self._of_slot = np.repeat(
                np.arange(len(self._counts), dtype=kind), self._counts.astype(np.int64)
            )
        state = points["states"].astype(np.uint64)
        at = points["word"].astype(np.int64)[:, None]
        words = np.append(words, np.uint32(0))  # read, but not used, past the end
        out = np.empty((len(points), BLOCK_IDS // LANES, LANES), "<u4")
        for k in range(out.shape[1]):
            slot = state & self._mask
            symbol = self._of_slot[slot]
            out[:, k] = symbol
            state = self._counts[symbol] * (state >> self._bits) + slot - self._starts[symbol]
            need = state < _LOW
            passed = np.cumsum(need, axis=1)
            places = np.minimum(at + passed - 1, len(words) - 1)
            state = np.where(need, state << _WORD | words[places], state)
            at += passed[:, -1:]
        if not (state == _LOW).all():
            raise ValueError("a block does not end as it began")
        return out.reshape(len(points), -1)

    def ids_between(self, part: Segment, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of a segment; only blocks that hold some are decoded."""
        end = min(end, part.n_ids)
        if start >= end:
            return np.zeros(0, "<u4")
        if part.table_crc != self.crc:
            raise ValueError("another table of frequencies")
        first, last = start // BLOCK_IDS, -(-end // BLOCK_IDS)
        points = part.points[first:last].copy()
        low = int(points["word"][0])
        high = len(part.words) if last == len(part.points) else int(part.points["word"][last])
        points["word"] -= np.uint64(low)
        blocks = self._decoded(points, part.words[low:high])
        for block, crc in zip(blocks, points["crc"].tolist()):
            if zlib.crc32(block) != crc:
                raise ValueError("checksum of a block")
        return blocks.ravel()[start - first * BLOCK_IDS : end - first * BLOCK_IDS]


@dataclass(frozen=True)
class Segment:
    """A segment as it lies in a file."""

    n_ids: int
    table_crc: int
    doc_ids: list[str | None]
    lengths: list[int]
    points: np.ndarray
    words: np.ndarray


def segments(data: bytes) -> Iterator[Segment]:
    """The segments of a file; a fault in its frame is an error."""
    at = 0
    while at < len(data):
        if len(data) - at < _HEAD.size:
            raise ValueError("a header is cut short")
        magic, version, n_ids, n_docs, n_blocks, n_words, index_bytes, table_crc, crc = (
            _HEAD.unpack_from(data, at)
        )
        if magic != _MAGIC or version != _VERSION:
            raise ValueError("not a segment")
        at += _HEAD.size
        front = data[at : at + index_bytes + n_blocks * _CHECKPOINT.itemsize]
        if zlib.crc32(front) != crc:
            raise ValueError("checksum of an index")
        docs = np.frombuffer(front, _DOC, n_docs)
        names, place = [], docs.nbytes
        for n in docs["n_bytes"].tolist():
            names.append(None if n == _NO_ID else front[place : place + n].decode())
            place += 0 if n == _NO_ID else n
        points = np.frombuffer(front, _CHECKPOINT, n_blocks, index_bytes)
        at += len(front)
        if len(data) < at + 4 * n_words + 1:
            raise ValueError("words are cut short")
        words = np.frombuffer(data, "<u4", n_words, at)
        at += 4 * n_words + 1
        yield Segment(n_ids, table_crc, names, docs["n_ids"].tolist(), points, words)


def write_archive(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the token ids of all documents, each followed by ``end_id``, to new files.

    Documents are in ascending order of their ids, null first; rows of equal ids are documents of
    their own, in no set order. Null and empty texts have the end id alone. Texts are encoded whole.
    A segment ends with the document that brings it to ``segment_ids``. Other columns are not read.
    An empty table gives an archive without a document.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Two bytes an id where that is enough: it is this column that is shuffled.
    width = "<u2" if max(vocabulary_size(tokenizer_path) - 1, end_id) < 1 << 16 else "<u4"
    encoded = rows.mapInArrow(
        _encode(tokenizer_path, end_id, width), f"id {kind}, ids binary, counted binary"
    )
    encoded = stored(encoded, "tokens-encoded")
    table = Frequencies.of(_counts(encoded))
    spark = docs.sparkSession
    names = spark.createDataFrame([(table.to_bytes().hex(),)], "value string")
    names.coalesce(1).write.text(f"{path}/frequencies")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = encoded.where("counted is null").select("id", "ids")
    ordered = ordered.repartitionByRange(n, "id").sortWithinPartitions("id")
    parts = ordered.select(F.col("id").cast("string").alias("id"), "ids").mapInArrow(
        _segments(spark.sparkContext.broadcast(table), segment_ids, width), "segment binary"
    )
    text = parts.select(F.col("segment").cast("string").alias("value"))
    text.write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(f"{path}/segments")


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).get_vocab_size()


def _encode(path: str, end_id: int, width: str):
    """Rows of documents, and at the end one with the counts of the task's ids."""
    last = np.array([end_id], "<u4").tobytes()

    def encode(tables):
        total = np.zeros(1, np.int64)
        kind = None
        for t in tables:
            kind = t.schema.field(0).type
            for at in range(0, t.num_rows, 512):
                some = t.slice(at, 512)
                texts = some.column(1).to_pylist()
                ids = [np.frombuffer(encoder(path).encode(x or "") + last, "<u4") for x in texts]
                counts = np.bincount(np.concatenate(ids))
                if len(counts) > len(total):
                    total = np.pad(total, (0, len(counts) - len(total)))
                total[: len(counts)] += counts
                packed = pa.array([x.astype(width).tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), packed, pa.nulls(len(ids), pa.binary())],
                    ["id", "ids", "counted"],
                )
        if kind is not None:
            seen = np.flatnonzero(total)
            pairs = np.stack([seen, total[seen]], axis=1).astype("<i8").tobytes()
            columns = [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([pairs])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "counted"])

    return encode


def _counts(encoded: DataFrame) -> dict[int, int]:
    """Occurrences of every id: as many rows as the vocabulary has ids at most."""

    def unpacked(tables):
        for t in tables:
            for x in t.column(0).to_pylist():
                pairs = np.frombuffer(x, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"]
                )

    rows = encoded.where("counted is not null").select("counted")
    rows = rows.mapInArrow(unpacked, "id long, n long")
    return {r.id: r.n for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _segments(shared, segment_ids: int, width: str):
    def cut(tables):
        coder = shared.value.coder()
        names, ids, size = [], [], 0
        for t in tables:
            for name, x in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
                names.append(name)
                ids.append(np.frombuffer(x, width))
                size += len(ids[-1])
                if size >= segment_ids:
                    yield _segment_batch(coder.segment(names, ids))
                    names, ids, size = [], [], 0
        if names:
            yield _segment_batch(coder.segment(names, ids))

    return cut


def _segment_batch(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data])], ["segment"])


def read_frequencies(spark: SparkSession, path: str) -> Frequencies:
    return Frequencies.from_bytes(bytes.fromhex(spark.read.text(f"{path}/frequencies").first()[0]))


def read_archive(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of an archive, from its files: ``doc_id`` (as text), ``start`` (ids of
    all documents before it), ``n_tokens``, ``ids_crc32``; ``ids`` as well if asked for.

    Every block is decoded and held against its checksum; a fault ends the job.
    """
    table = read_frequencies(spark, path)
    shared = spark.sparkContext.broadcast(table)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    files = files.load(f"{path}/segments").where("length > 0")
    part, piece = (F.regexp_extract("path", rf"{x}(\d+)[^/]*$", 1) for x in ("/part-", "-c"))
    files = files.select(part.cast("long").alias("part"), piece.cast("long").alias("piece"), "content")
    schema = (
        "part long, piece long, doc_id string, start long, n_tokens long, ids_crc32 long"
        + ", ids binary" * with_ids
    )
    found = stored(files.mapInArrow(_documents(shared, with_ids), schema), "tokens-read")
    before = _before(found.groupBy("part", "piece").agg(F.sum("n_tokens").alias("n")))
    joined = found.join(before, ["part", "piece"])
    return joined.withColumn("start", F.col("start") + F.col("before")).drop(
        "part", "piece", "before"
    )


def _documents(shared, with_ids: bool):
    def decode(tables):
        coder = shared.value.coder()
        for t in tables:
            for n in range(t.num_rows):
                part, piece, content = (t.column(k)[n].as_py() for k in range(3))
                start = 0
                for s in segments(content):
                    data = memoryview(coder.ids_between(s, 0, s.n_ids).tobytes())
                    ends = np.cumsum(s.lengths, dtype=np.int64)
                    begins = ends - s.lengths
                    cut = [data[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                    rows = len(cut)
                    columns = [
                        pa.array([part] * rows, pa.int64()),
                        pa.array([piece] * rows, pa.int64()),
                        pa.array(s.doc_ids, pa.string()),
                        pa.array(begins + start),
                        pa.array(s.lengths, pa.int64()),
                        pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                    ]
                    names = ["part", "piece", "doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([bytes(x) for x in cut], pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                    start += s.n_ids

    return decode


def _before(sizes: DataFrame) -> DataFrame:
    """``before``: ids in earlier files. Files are few against ids; they are summed per stretch of
    parts first, so that no task orders all of them."""
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = sizes.withColumn("stretch", F.floor(F.col("part") / math.ceil(math.sqrt(n))))
    sums = sizes.groupBy("stretch").agg(F.sum("n").alias("sum"))
    sums = sums.select("stretch", _earlier("sum", Window.orderBy("stretch")).alias("stretches"))
    inside = Window.partitionBy("stretch").orderBy("part", "piece")
    rows = sizes.select("stretch", "part", "piece", _earlier("n", inside).alias("inside"))
    before = F.col("stretches") + F.col("inside")
    return rows.join(sums, "stretch").select("part", "piece", before.alias("before"))


def _earlier(name: str, order) -> Column:
    rows = order.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(rows), F.lit(0)).cast("long")
