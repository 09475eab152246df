"""Quality classifier: ordinal regression with cumulative links on graded ratings.

Words and runs of marks are hashed into ``2 ** bits`` weights that all grades share; ordered
thresholds on their sum part the grades. A document gets the probability of each grade or better,
and the expected grade. The model is fitted on at most about ``rows`` rated documents; every
document is scored by its whole text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
ROWS = 8_000
_STEPS = 150
_PENALTY = 1e-5
_KNOWN = 1_000_000
_GRAIN = 1 << 30

_LETTERS = bytes(
    b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)
)
_MARKS = bytes(0x20 if b > 0x7F or chr(b).isalnum() else b for b in range(256))


class _Buckets(dict):
    def __init__(self, bits: int):
        super().__init__()
        self._mask = (1 << bits) - 1

    def __missing__(self, token: bytes) -> int:
        found = zlib.crc32(token) & self._mask
        if len(self) < _KNOWN:
            self[token] = found
        return found


_buckets: dict[int, _Buckets] = {}


def hashed(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: root counts of its words and of its runs of marks, of length
    one for either. A text without words and marks has none."""
    known = _buckets.setdefault(bits, _Buckets(bits))
    text = (text or b"").lower()
    places, values = [], []
    for kept in (_LETTERS, _MARKS):
        tokens = text.translate(kept).split()
        if tokens:
            found = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
            found, counts = np.unique(found, return_counts=True)
            places.append(found)
            values.append(np.sqrt(counts / len(tokens)))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(places), np.concatenate(values)


@dataclass(frozen=True)
class OrdinalModel:
    """``grades`` in order; P(grade > grades[k]) is the logistic of sum - thresholds[k]."""

    grades: tuple[float, ...]
    thresholds: tuple[float, ...]
    weights: np.ndarray
    bits: int

    def tails(self, text: bytes | None) -> list[float]:
        """Probability of each grade but the lowest, or better."""
        places, values = hashed(text, self.bits)
        total = float(self.weights[places] @ values)
        return [float(1 / (1 + np.exp(np.clip(t - total, -700, 700)))) for t in self.thresholds]

    def expected(self, tails: list[float]) -> float | None:
        if not self.grades:
            return None
        steps = np.diff(self.grades)
        return float(self.grades[0] + np.dot(steps, tails))


def fit_ordinal(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    rows: int = ROWS,
    bits: int = BITS,
) -> OrdinalModel:
    """Fit on rated documents; null ids and grades are left out, repeats of a rating count once.

    One grade alone gives a model that always says it, no grade one that says null.
    """
    grade = F.col(grade_col).cast("double")
    marks = ratings.select(F.col(id_col).alias("id"), grade.alias("grade"))
    marks = marks.where("id is not null and grade is not null").distinct()
    total = marks.count()
    share = min(1.0, rows / max(1, total))
    sample = marks.where(F.pmod(F.xxhash64("id"), F.lit(_GRAIN)) < int(share * _GRAIN))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    # At most some ``rows`` ids: small enough for every executor.
    texts = texts.join(F.broadcast(sample), "id").select("text", "grade")

    def features(tables):
        for t in tables:
            found = [hashed(x, bits) for x in t.column(0).to_pylist()]
            columns = [
                t.column(1),
                pa.array([p for p, _ in found], pa.list_(pa.int32())),
                pa.array([v for _, v in found], pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["grade", "places", "values"])

    kind = "grade double, places array<int>, values array<float>"
    table = texts.mapInArrow(features, kind).toArrow()
    return _fitted(table, bits)


def _fitted(table: pa.Table, bits: int) -> OrdinalModel:
    grades, y = np.unique(table.column("grade").to_numpy(), return_inverse=True)
    size = 1 << bits
    if len(grades) < 2:
        return OrdinalModel(tuple(grades.tolist()), (), np.zeros(size, np.float32), bits)
    places = table.column("places").combine_chunks()
    columns = places.flatten().to_numpy()
    values = table.column("values").combine_chunks().flatten().to_numpy().astype(float)
    rows = np.repeat(np.arange(len(y)), places.value_lengths().to_numpy())
    above = [np.mean(y > k) for k in range(len(grades) - 1)]
    thresholds = np.array([-np.log(p / (1 - p)) for p in above])
    # First threshold and logarithms of the steps between them, so that they stay in order.
    order = np.concatenate([thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-3))])
    at = np.concatenate([np.zeros(size), order])
    slope_mean, slope_square = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, _STEPS + 1):
        slope = _slope(at, size, y, rows, columns, values)
        slope_mean += 0.1 * (slope - slope_mean)
        slope_square += 0.001 * (slope**2 - slope_square)
        rate = 0.1 / (1 - 0.9**step)
        at -= rate * slope_mean / (np.sqrt(slope_square / (1 - 0.999**step)) + 1e-8)
    ordered = _ordered(at[size:])
    return OrdinalModel(
        tuple(grades.tolist()), tuple(ordered.tolist()), at[:size].astype(np.float32), bits
    )


def _ordered(order: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([order[:1], np.exp(order[1:])]))


def _slope(at, size, y, rows, columns, values) -> np.ndarray:
    """Gradient of the mean negative log-likelihood and the penalty."""
    weights, order = at[:size], at[size:]
    bounds = np.concatenate([[-np.inf], _ordered(order), [np.inf]])
    total = np.bincount(rows, weights[columns] * values, minlength=len(y))
    with np.errstate(over="ignore"):
        low = 1 / (1 + np.exp(total - bounds[y]))
        high = 1 / (1 + np.exp(total - bounds[y + 1]))
    share = np.maximum(high - low, 1e-12)
    out = np.empty_like(at)
    by_total = 1 - high - low
    out[:size] = np.bincount(columns, by_total[rows] * values, minlength=size) / len(y)
    out[:size] += _PENALTY * weights
    by_bound = np.bincount(y + 1, -high * (1 - high) / share, minlength=len(bounds))
    by_bound += np.bincount(y, low * (1 - low) / share, minlength=len(bounds))
    inner = by_bound[1:-1] / len(y)
    later = np.cumsum(inner[::-1])[::-1]
    out[size:] = later * np.concatenate([[1.0], np.exp(order[1:])])
    return out


def with_grade(
    docs: DataFrame, model: OrdinalModel, text_col: str = "text", into: str = "quality"
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``expected_grade`` and ``tails``, the probability of
    each grade but the lowest or better.

    Every row is judged by its whole text alone; null and empty texts have no words and get what
    the thresholds say. A column of the name ``into`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits weights of four bytes

    @F.arrow_udf("struct<expected_grade:double,tails:array<double>>")
    def graded(texts: pa.Array) -> pa.Array:
        tails = [shared.value.tails(x.as_py()) for x in texts]
        rows = [{"expected_grade": shared.value.expected(t), "tails": t} for t in tails]
        kind = pa.struct([("expected_grade", pa.float64()), ("tails", pa.list_(pa.float64()))])
        return pa.array(rows, kind)

    return docs.withColumn(into, graded(F.col(text_col).cast("binary")))
