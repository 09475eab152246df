"""Embedding near-duplicates by binary codes under random rotations, with bounded estimates.

A vector of length one is turned by seeded random rotations; the signs of its coordinates are its
code, and for each rotation the inner product of vector and code is stored as correction factor. A
code divided by its factor is the vector plus an error in a random direction, so it is the vector on
average. Every vector has codes of two sides, whose rotations are independent of each other: the
inner product of one vector's code of the first side with the other's of the second, over both
factors, is an unbiased estimate of the cosine. Pairs whose estimate stays below the threshold by
more than the confidence bound are dropped; all others are computed from the vectors in double
precision, and only that decides.

Which pairs are looked at follows from signs as well: pieces of further rotations are bucket numbers
in so many tables that a pair at the threshold meets with probability ``recall``. The pieces grow
with the logarithm of the number of vectors, so a bucket of unrelated vectors stays small. To their
buckets vectors send number, codes and factors only. Whole vectors follow for those that the
estimates leave a partner in a bucket. A bucket of over ``BLOCK`` vectors is dealt out as pairs of
blocks; per vector its links are counted, and of the links only what connects the block comes out,
never all pairs. Equal vectors count as one with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmill.llm.common import stored
from lossmill.llm.components import connected_components

THRESHOLD = 0.9
RECALL = 0.97
BLOCK = 1024
#: Rotations of each side of the codes that estimates are made from.
SIDE = 4
_CONFIDENCE = 3.0
_PER_BUCKET = 64
_SEED = 20


@dataclass(frozen=True)
class Codes:
    """Shape of the codes: ``tables`` pieces of ``piece`` bits from rotations of their own, and two
    sides of ``SIDE`` rotations to estimate from."""

    size: int
    piece: int
    tables: int

    def for_buckets(self) -> np.ndarray:
        """(size, bits): the rotations side by side."""
        return np.hstack(_rotations(self.size, -(-self.piece * self.tables // self.size), _SEED))

    def for_sides(self) -> np.ndarray:
        """(2, SIDE, size, size)."""
        found = _rotations(self.size, 2 * SIDE, _SEED + 1)
        return found.reshape(2, SIDE, self.size, self.size)


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows."""
    raw = raw.astype(float)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


@lru_cache(maxsize=8)
def _rotations(size: int, n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(n)])


@lru_cache(maxsize=8)
def _between(size: int) -> np.ndarray:
    """(SIDE, size, size): from the k-th rotation of the first side to that of the second."""
    first, second = Codes(size, 1, 1).for_sides()
    return (first.transpose(0, 2, 1) @ second).astype(np.float32)


def codes_for(n: int, size: int, threshold: float, recall: float) -> Codes:
    """Codes for ``n`` vectors of ``size`` numbers: a bucket of unrelated ones holds about 64."""
    agree = 1 - math.acos(threshold) / math.pi
    piece = min(31, max(1, math.ceil(math.log2(max(n, 2) / _PER_BUCKET))))
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree**piece)))
    return Codes(size, piece, tables)


def buckets_of(unit: np.ndarray, codes: Codes) -> np.ndarray:
    """(n, tables): the bucket numbers of unit vectors."""
    bits = (unit @ codes.for_buckets() > 0)[:, : codes.tables * codes.piece]
    pieces = bits.reshape(len(unit), codes.tables, codes.piece)
    return pieces @ (1 << np.arange(codes.piece, dtype=np.int64))


def encoded(unit: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs (n, 2, SIDE, bytes) and factors (n, 2, SIDE) of unit vectors."""
    turned = np.einsum("ni,skij->nskj", unit, codes.for_sides(), optimize=True)
    factors = np.abs(turned).sum(axis=3) / math.sqrt(codes.size)
    return np.packbits(turned > 0, axis=3), factors.astype(np.float32)


def estimates(
    bits_a: np.ndarray, factors_a: np.ndarray, bits_b: np.ndarray, factors_b: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of all of a with all of b, and how far off they may be.

    Codes and factors as from ``encoded``. An estimate is the mean over the rotations of both
    sides, either way round, and unbiased. The bound holds for three standard deviations of its
    error; the two ways round count once for it.
    """
    signs = [
        np.unpackbits(x, axis=3, count=size).astype(np.float32) * 2 - 1 for x in (bits_a, bits_b)
    ]
    over = [s / (f[..., None] * math.sqrt(size)) for s, f in zip(signs, (factors_a, factors_b))]
    guess = np.zeros((len(bits_a), len(bits_b)))
    for k, turn in enumerate(_between(size)):
        guess += (over[0][:, 0, k] @ turn) @ over[1][:, 1, k].T
        guess += (over[0][:, 1, k] @ turn.T) @ over[1][:, 0, k].T
    # The part of a code over its factor that is not the vector, squared, on average.
    off_a, off_b = (
        ((1 - np.minimum(f, 1.0) ** 2) / f**2).mean(axis=(1, 2)) for f in (factors_a, factors_b)
    )
    spread = off_a[:, None] + off_b + off_a[:, None] * off_b
    bound = _CONFIDENCE * np.sqrt(spread / (max(1, size - 1) * SIDE))
    return guess / (2 * SIDE), bound


def maybe_near(left: slice, right: slice, bits, factors, size: int, threshold: float):
    """Pairs between two ranges of rows, or within one, that the estimates do not rule out."""
    guess, off = estimates(bits[left], factors[left], bits[right], factors[right], size)
    a, b = np.nonzero(guess + off >= threshold)
    a, b = a + left.start, b + right.start
    return (a[a < b], b[a < b]) if left == right else (a, b)


def links(
    left: slice, right: slice, vectors: np.ndarray, bits: np.ndarray, factors: np.ndarray,
    buckets: np.ndarray, table: int, threshold: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs between two ranges of rows, or within one, and whether this table counts them.

    A pair counts in the first table whose bucket it shares.
    """
    a, b = maybe_near(left, right, bits, factors, vectors.shape[1], threshold)
    exact = np.empty(len(a))
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        exact[part] = np.einsum("ij,ij->i", vectors[a[part]], vectors[b[part]])
    near = exact >= threshold
    a, b = a[near], b[near]
    earlier = (buckets[a, :table] == buckets[b, :table]).any(axis=1)
    return a, b, ~earlier


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, ``n_links`` (other vectors linked directly), ``component_id`` (the
    smallest id that links lead to), ``kept`` (whether that is its own).

    Vectors that are null, empty or zero, or hold null or non-finite numbers, link with nothing and
    are their own component; so do vectors of different length. Equal vectors link, also if their
    id repeats; a null id has a component like any other, whose smallest id may be null, and is
    never kept. Other columns are not read; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    usable = F.coalesce(
        (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    rows = rows.select("id", "v", F.when(usable, F.sha2(F.array_join("v", ","), 256)).alias("key"))
    rows = stored(rows, "embedding-vectors")
    classes = rows.where("key is not null").groupBy("key").agg(
        F.first("v").alias("v"), F.count("*").alias("copies"), F.min("id").alias("least")
    )
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    classes = stored(classes, "embedding-classes")
    sizes = classes.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()
    found = []
    for s in sizes:
        codes = codes_for(s.n, s.size, threshold, recall)
        found.append(_found(classes.where(F.size("v") == s.size), codes, threshold, block))
    if not found:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"),
        )
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    all_found = stored(all_found, "embedding-links")
    counts = all_found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = connected_components(all_found.select("node", "root"))
    per_class = classes.drop("v").join(counts, "node", "left").join(roots, "node", "left")
    per_class = per_class.withColumn("root", F.coalesce("root", "node"))
    least = per_class.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = per_class.join(least, "root").select(
        "key", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = rows.select("id", "key").join(per_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _found(classes: DataFrame, codes: Codes, threshold: float, block: int) -> DataFrame:
    """``node``, ``root`` (a node it is connected with) and ``n``, the weight of its links."""
    number = classes.schema["v"].dataType.elementType.simpleString()
    number = "float" if number == "float" else "double"  # vectors travel as they were given
    vectors = classes.select("node", "copies", F.col("v").cast(f"array<{number}>").alias("v"))
    coded = vectors.select("node", "v").mapInArrow(_encode(codes), _CODED)
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _dealt(coded, block).repartition(n, *_KEY).sortWithinPartitions(*_KEY)
    met = placed.mapInArrow(_by_key(_survivors(codes, threshold)), _MET)
    met = stored(met, "embedding-survivors")
    whole = met.join(vectors, "node").select(*_KEY, "own", "node", "copies", "v")
    ordered = whole.repartition(n, *_KEY).sortWithinPartitions(*_KEY)
    return ordered.mapInArrow(
        _by_key(_group_links(codes, threshold)), "node long, root long, n long"
    )


#: A bucket (table and number in one), and two blocks of it.
_KEY = ("place", "one", "two")
_CODED = "place long, node long, bits binary, factors binary"
_MET = "place long, one int, two int, own int, node long"


def _encode(codes: Codes):
    """A row for each vector and table, without the vector."""

    def encode(tables):
        for t in tables:
            for at in range(0, t.num_rows, 256):
                part = t.slice(at, 256)
                raw = part.column(1).flatten().to_numpy().reshape(part.num_rows, codes.size)
                unit = unit_rows(raw)
                fixed = [
                    pa.array([x.tobytes() for x in column], pa.binary())
                    for column in encoded(unit, codes)
                ]
                places = buckets_of(unit, codes) + (
                    np.arange(codes.tables, dtype=np.int64) << codes.piece
                )
                for k in range(codes.tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(places[:, k]), part.column(0), *fixed],
                        ["place", "node", "bits", "factors"],
                    )

    return encode


def _dealt(coded: DataFrame, block: int) -> DataFrame:
    """Each row once for every pair of blocks that its block is in; ``own`` is its block."""
    crowds = coded.groupBy("place").agg(F.count("*").alias("n"))
    crowds = stored(crowds.where(F.col("n") > block), "embedding-crowds")
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    rows = coded.join(crowds, "place", "left").withColumn("blocks", blocks).drop("n")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).drop("blocks")
    return rows.select(
        "place", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        "own", "node", "bits", "factors",
    )


def _by_key(compare):
    """Hand the rows of each key to ``compare``; a key has two blocks of rows at most."""

    def run(tables):
        key, group = None, []
        for t in tables:
            for row in zip(*(c.to_pylist() for c in t.columns)):
                if row[:3] != key:
                    if len(group) > 1:
                        yield from compare(key, group)
                    key, group = row[:3], []
                group.append(row[3:])
        if len(group) > 1:
            yield from compare(key, group)

    return run


def _sides(key, group: list) -> tuple[slice, slice]:
    """The rows of both blocks of a key; the same twice if it is one block."""
    _, one, two = key
    group.sort(key=lambda r: r[:2])
    if one == two:
        return slice(0, len(group)), slice(0, len(group))
    cut = sum(r[0] == one for r in group)
    return slice(0, cut), slice(cut, len(group))


def _survivors(codes: Codes, threshold: float):
    """Vectors that may have a partner in their bucket."""

    def survivors(key, group) -> Iterator[pa.RecordBatch]:
        left, right = _sides(key, group)
        own, nodes, bits, factors = zip(*group)
        bits = np.frombuffer(b"".join(bits), "u1").reshape(len(group), 2, SIDE, -1)
        factors = np.frombuffer(b"".join(factors), "f4").reshape(len(group), 2, SIDE)
        a, b = maybe_near(left, right, bits, factors, codes.size, threshold)
        stay = np.unique(np.concatenate([a, b]))
        if len(stay):
            place, one, two = (pa.array(np.full(len(stay), k)) for k in key)
            columns = [place, one.cast(pa.int32()), two.cast(pa.int32())]
            columns += [pa.array(np.array(own)[stay], pa.int32()), pa.array(np.array(nodes)[stay])]
            yield pa.RecordBatch.from_arrays(columns, [*_KEY, "own", "node"])

    return survivors


def _group_links(codes: Codes, threshold: float):
    def group_links(key, group) -> Iterator[pa.RecordBatch]:
        left, right = _sides(key, group)
        _, nodes, copies, vectors = zip(*group)
        unit = unit_rows(np.array(vectors))
        bits, factors = encoded(unit, codes)
        a, b, counted = links(
            left, right, unit, bits, factors, buckets_of(unit, codes), key[0] >> codes.piece,
            threshold,
        )
        if not len(a):
            return
        copies, nodes = np.array(copies), np.array(nodes)
        n = np.bincount(a[counted], copies[b[counted]], minlength=len(group))
        n += np.bincount(b[counted], copies[a[counted]], minlength=len(group))
        root = nodes[_local_roots(len(group), a, b)]
        out = np.unique(np.concatenate([a, b]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[out]), pa.array(root[out]), pa.array(n[out].astype(np.int64))],
            ["node", "root", "n"],
        )

    return group_links


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First member of each one's component, by passing on the least and jumping ahead."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, before[a])
        root = root[root]
        if (root == before).all():
            return root
