"""SimHash near-duplicates: fingerprints of word shingles, linked at a small Hamming distance.

A fingerprint is cut into segments, so few that fingerprints within the distance differ by one bit
at most in one of them. Each fingerprint is indexed under every segment as it is and with each of
its bits left out (one wildcard). Those that share an index key are compared.

Equal fingerprints are one node, however many documents have them, and a key's nodes give a
spanning forest of their links, not all pairs. Keys of over ``DENSE`` nodes are indexed anew: the
part outside their segment is halved, one half differs by one bit at most, and so on, until a key
leaves eight bits open and cannot hold more nodes than that (``refine``). That way is exact for a
distance of two or three in two segments of 64 bits. A crowded key is passed on while its rows come
in: a task holds ``dense`` of them at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmill.llm.common import giving_back, stored
from lossmill.llm.components import connected_components

DENSE = 8192
_SLICE = 1 << 16
_FEW = 8
_SEED = 42


@dataclass(frozen=True)
class SimHash:
    """``lanes`` fingerprints of 64 bits side by side: one of the shingle hashes, the others of
    those hashes mixed anew.

    Pairs of up to ``2 * segments - 1`` differing bits are all found. A larger ``distance`` is
    allowed; such pairs are found if they agree on a segment but for one bit.
    """

    shingle: int = 3
    lanes: int = 1
    segments: int = 2
    distance: int = 2

    @property
    def width(self) -> int:
        """Bits of a segment."""
        return 64 * self.lanes // self.segments

    def __post_init__(self):
        if not (1 <= self.width <= 48 and self.shingle > 0 and self.lanes > 0):
            raise ValueError(f"not possible: {self}")


def shingles(text: bytes, size: int) -> list[bytes]:
    """Word shingles of a text, A-Z in lower case; words are parted by ASCII white space."""
    words = text.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)]


def fingerprint(text: bytes | None, spec: SimHash) -> bytes:
    """Big-endian bits; a bit is set if over half the shingle hashes have it. No words: zero."""
    parts = shingles(text or b"", spec.shingle)
    counts = np.zeros((spec.lanes, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(parts), _SLICE):
        hashes = np.array([digest(p, _SEED) for p in parts[at : at + _SLICE]], np.uint64)
        lanes = np.stack([_mixed(hashes, lane) for lane in range(spec.lanes)], axis=1)
        for weight, words in _thinned(lanes):
            bits = np.unpackbits(words.astype(">u8").view(np.uint8), axis=1)
            counts += weight * bits.reshape(-1, spec.lanes, 64).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(parts)).tobytes()


def _thinned(words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Fewer words with weights whose sums per bit are the same: three words of many lanes become
    their sum and their carry."""
    weight = 1
    while len(words):
        carries = []
        while words.shape[1] > 1 and len(words) >= 24:
            m = len(words) // 3
            a, b, c = words[:m], words[m : 2 * m], words[2 * m : 3 * m]
            one = a ^ b
            carries.append(a & b | one & c)
            words = np.concatenate([one ^ c, words[3 * m :]])
        yield weight, words
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Other hashes for every lane but the first: an increment and two multiplications."""
    if not lane:
        return hashes
    out = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 % (1 << 64))
    out = (out ^ out >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ out >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return out ^ out >> np.uint64(31)


def fingerprint_column(text: Column, spec: SimHash) -> Column:
    @F.arrow_udf("binary")
    @giving_back
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py(), spec) for x in texts], pa.binary())

    return hashed(text.cast("binary"))


def linked_fingerprints(prints: DataFrame, spec: SimHash, dense: int = DENSE) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``fingerprint``) whose components
    are those of all links found."""
    keyed = prints.mapInArrow(_index(spec), "key binary, fingerprint binary")
    edges = None
    for level in range(_levels(spec)):
        last = level == _levels(spec) - 1
        found = _by_key(keyed).mapInArrow(
            _compare(spec, None if last else dense), "key binary, a binary, b binary"
        )
        if last:
            some = found
        else:
            found = stored(found, "simhash-links")
            some = found.where("b is not null")
            crowded = found.where("b is null").select("key", F.col("a").alias("fingerprint"))
        edges = some if edges is None else edges.unionByName(some)
        if last or crowded.isEmpty():
            break
        keyed = crowded.mapInArrow(_refine(level), "key binary, fingerprint binary")
    return edges.select("a", "b").distinct()


def near_duplicate_components(
    docs: DataFrame, id_col: str, text_col: str, spec: SimHash = SimHash(), dense: int = DENSE
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (hex), ``component_id``.

    ``component_id`` is the smallest id that links lead to, the document's own included; null if
    the component has no id. Null, empty and blank texts have no words and fingerprint zero, which
    links like any other. Repeated rows stay. Other columns are not read.
    """
    own = docs.select(
        F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), spec).alias("fingerprint")
    )
    own = stored(own, "simhash-fingerprints")
    roots = component_roots(own, spec, dense)
    least = own.groupBy("fingerprint").agg(F.min("id").alias("id"))
    least = least.join(roots, "fingerprint", "left")
    least = least.withColumn("root", F.coalesce("root", "fingerprint"))
    named = least.groupBy("root").agg(F.min("id").alias("component_id"))
    by_print = least.select("fingerprint", "root").join(named, "root").drop("root")
    joined = own.join(by_print, "fingerprint")
    return joined.select(
        F.col("id").alias(id_col),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame, id_col: str, text_col: str, spec: SimHash = SimHash(), dense: int = DENSE
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id.

    Components are those of ``near_duplicate_components``. Of rows with the smallest id, as repeated
    rows have, one stays; a null id comes last. Texts without words are copies of each other. All
    columns stay as they are.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("row", F.monotonically_increasing_id())
    text, key = (names[docs.columns.index(c)] for c in (text_col, id_col))
    rows = rows.withColumn("fingerprint", fingerprint_column(F.col(text), spec))
    rows = stored(rows, "simhash-texts")
    first = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "row")
    least = rows.groupBy("fingerprint").agg(F.min(first).alias("first"))
    roots = component_roots(rows, spec, dense)
    least = least.join(roots, "fingerprint", "left")
    stays = least.groupBy(F.coalesce("root", "fingerprint").alias("root"))
    stays = stays.agg(F.min("first").alias("first"))
    return rows.join(stays.select("first.row"), "row").select(*names).toDF(*docs.columns)


def component_roots(prints: DataFrame, spec: SimHash, dense: int = DENSE) -> DataFrame:
    """``fingerprint`` and ``root`` for every fingerprint that links with another."""
    edges = linked_fingerprints(prints.select("fingerprint").distinct(), spec, dense)
    return connected_components(edges).toDF("fingerprint", "root")


def _levels(spec: SimHash) -> int:
    """Two segments of 64 bits leave 32, 16 and 8 bits open."""
    return 3 if (spec.lanes, spec.segments) == (1, 2) and spec.distance <= 3 else 1


def _by_key(keyed: DataFrame) -> DataFrame:
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(n, "key").sortWithinPartitions("key", "fingerprint")


def _as_bits(prints: np.ndarray) -> np.ndarray:
    """(n, bits) of 0 and 1 from (n, bytes)."""
    return np.unpackbits(prints, axis=1)


def _bytes_of(column: pa.Array) -> np.ndarray:
    """(n, bytes) from a column of equally long binaries."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _variants(values: np.ndarray, width: int, tag: int) -> Iterator[np.ndarray]:
    """Numbers for ``values`` of ``width`` bits as they are and with each bit left out."""
    for wild in range(width + 1):
        kept = values & ~np.uint64(0 if wild == width else 1 << wild)
        yield kept | np.uint64((tag * (width + 1) + wild) << width)


def _number(bits: np.ndarray) -> np.ndarray:
    weights = np.uint64(1) << np.arange(bits.shape[1] - 1, -1, -1, dtype=np.uint64)
    return bits.astype(np.uint64) @ weights


def _keyed_batch(keys: list[np.ndarray], prints: np.ndarray, before: list[bytes]) -> pa.RecordBatch:
    rows = len(prints)
    flat = np.stack(keys, axis=1).astype(">u8").tobytes()
    per = len(keys)
    each = [flat[k : k + 8] for k in range(0, len(flat), 8)]
    if before:
        each = [before[k // per] + x for k, x in enumerate(each)]
    repeated = np.repeat(prints, per, axis=0).tobytes()
    size = prints.shape[1]
    own = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(size), rows * per, [None, pa.py_buffer(repeated)]
    ).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(each, pa.binary()), own], ["key", "fingerprint"])


def _index(spec: SimHash):
    @giving_back
    def index(tables):
        for t in tables:
            for at in range(0, t.num_rows, 4096):
                prints = _bytes_of(t.column(0).slice(at, 4096))
                bits = _as_bits(prints)
                keys = []
                for k in range(spec.segments):
                    part = _number(bits[:, k * spec.width : (k + 1) * spec.width])
                    keys += _variants(part, spec.width, k)
                yield _keyed_batch(keys, prints, [])

    return index


def _refine(level: int):
    """Halve what the key of a crowded bucket leaves open, of two segments of 32 bits."""

    @giving_back
    def refine(tables):
        width = 16 >> level
        for t in tables:
            for at in range(0, t.num_rows, 4096):
                part = t.slice(at, 4096)
                before = part.column(0).to_pylist()
                prints = _bytes_of(part.column(1))
                bits = _as_bits(prints)
                low = np.array([_open_part(b) for b in before])
                rows = np.arange(len(bits))[:, None]
                keys = []
                for half in range(2):
                    columns = (low + half * width)[:, None] + np.arange(width)
                    keys += _variants(_number(bits[rows, columns]), width, half)
                yield _keyed_batch(keys, prints, before)

    return refine


def _open_part(key: bytes) -> int:
    """First bit of what a key leaves open: 32 bits, then 16, then 8 (fingerprints of 64)."""
    low, width = 0, 32
    for at in range(0, len(key), 8):
        taken = int.from_bytes(key[at : at + 8], "big") >> width
        half = taken // (width + 1)
        low += (1 - half) * width
        width //= 2
    return low


def _compare(spec: SimHash, dense: int | None):
    """Spanning forests of the nodes of each key; crowded keys' nodes come back without a link."""

    @giving_back
    def compare(tables):
        held_key, held, crowded = None, [], False  # the last key may go on in the next batch
        out: list[tuple[bytes, bytes, bytes | None]] = []

        def more(key, members):
            """Members of the held key; past ``dense`` they go on at once."""
            nonlocal held, crowded
            held += members
            if dense is not None and (crowded or len(held) > dense):
                out.extend((key, m, None) for m in held)
                held, crowded = [], True

        def done():
            if len(held) > 1:
                out.extend((held_key, a, b) for a, b in spanning_links(held, spec.distance))

        for t in tables:
            keys, prints = t.column(0).to_pylist(), t.column(1).to_pylist()
            start = 0
            for k in range(1, len(keys) + 1):
                if k < len(keys) and keys[k] == keys[start]:
                    continue
                if keys[start] != held_key:
                    done()
                    held_key, held, crowded = keys[start], [], False
                more(held_key, prints[start:k])
                start = k
            if len(out) >= 10_000:
                yield _edge_batch(out)
                out.clear()
        done()
        yield _edge_batch(out)

    return compare


def _edge_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary()) for c in columns], ["key", "a", "b"]
    )


def spanning_links(members: list[bytes], distance: int) -> Iterator[tuple[bytes, bytes]]:
    """Links within ``distance`` bits that connect what all such links connect."""
    if len(members) <= _FEW:
        yield from _few_links(members, distance)
        return
    lanes = np.frombuffer(b"".join(members), np.uint64).reshape(len(members), -1)
    waiting = np.arange(len(members))
    reached: list[int] = []
    while len(waiting) or reached:
        if not reached:
            reached, waiting = [int(waiting[0])], waiting[1:]
            continue
        one = reached.pop()
        differ = np.bitwise_count(lanes[waiting] ^ lanes[one]).sum(axis=1, dtype=np.int64)
        near = differ <= distance
        for k in waiting[near]:
            yield members[one], members[int(k)]
            reached.append(int(k))
        waiting = waiting[~near]


def _few_links(members: list[bytes], distance: int) -> Iterator[tuple[bytes, bytes]]:
    """The same for the few members that most keys have."""
    waiting = [(m, int.from_bytes(m)) for m in members]
    reached: list[tuple[bytes, int]] = []
    while waiting:
        if not reached:
            reached.append(waiting.pop())
        one, number = reached.pop()
        left = []
        for other in waiting:
            if (number ^ other[1]).bit_count() <= distance:
                yield one, other[0]
                reached.append(other)
            else:
                left.append(other)
        waiting = left
