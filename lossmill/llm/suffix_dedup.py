"""Repeated passages: every byte covered by a string of ``length`` bytes that starts elsewhere too.

The suffix sort works with a cover of sampled positions, as a difference-cover sort does, but the
cover follows the content instead of the position modulo a constant. Of the short strings
("grams") in a window of ``length`` bytes the one with the least hash is its sample. So equal
windows have equal samples at equal distances, and the windows of one sample lie side by side:
together they read one stretch of text to the left and right of it.

1. Sampled triples (gram, text before, text after) are named by hashes and grouped. Triples that
   occur twice settle all their windows at once, those that are read together right there; of
   each name read together one goes on, to the one place where its gram is looked at.
2. Names are taken apart where that is not enough: where a gram has several triples, only one
   copy of each goes on, however often it occurs. A gram with very many is dealt to several tasks.
3. Their windows, the remaining suffixes, are put in order by distance from the sample and text,
   and neighbours in that order are compared over ``length`` bytes.

Texts are split into samples where they are read, so no more than about one row per
``length`` / 2 bytes is shuffled; a text that repeats within less than a gram has up to one a byte.

The same search finds passages by words: hashes of words stand for bytes then. Both can be sought at
once, so that texts are read and shuffled once: samples of words have odd rows and odd grams.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmill.llm.common import batches, broadcast_if_small, free_name, giving_back, stored
from lossmill.llm.decontaminate import merged

LENGTH = 400
#: Names of a gram that one task compares: each has at most twice ``length`` bytes of text, 7 MB
#: in all, and 25 bytes a window.
_GROUP = 8192
#: Bytes of text whose samples are reduced together.
_PART = 8 << 20
_PLACE_BITS = 20
_STEP = 1 << 19
_BASE = 0x9E3779B97F4A7C15
#: Bytes that stand for a word in ``word_codes``.
WORD_BYTES = 4
# Thai, Lao, Burmese, Khmer, kana and Han, which are written without spaces.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(f"[{_UNSPACED}]|[^ \t-\r{_UNSPACED}]+")


class _Powers:
    """Powers of the base of the rolling hash and of its inverse, modulo 2 ** 64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            both = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
            self.up, self.down = both


_powers = _Powers()


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` bytes in a row."""
    sums = _sums(data)
    return _mixed((sums[size:] - sums[:-size]) * _powers.down[: len(data) - size + 1])


def _sums(data: np.ndarray) -> np.ndarray:
    n = len(data)
    _powers.reach(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers.up[:n], out=sums[1:])
    return sums


def _mixed(found: np.ndarray) -> np.ndarray:
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    return found


def samples(text: bytes, length: int, unit: int = 1) -> tuple[np.ndarray, ...]:
    """Gram hash, place, and first and last window start of every sample of a text.

    Every window start belongs to one sample. Equal windows have equal grams at equal distance.
    Places and ``length`` are in units of ``unit`` bytes.
    """
    size = gram_size(length)
    grams, places, firsts, lasts = [], [], [], []
    data = np.frombuffer(text, f"<u{unit}")
    for at in range(0, max(len(data) - length + 1, 0), _STEP):
        part = data[at : at + _STEP + length - 1]
        hashes = rolling(part, size)
        place = _least_in_windows(hashes, length - size + 1)
        begins = np.flatnonzero(np.diff(place, prepend=-1))
        grams.append(hashes[place[begins]])
        places.append(place[begins] + at)
        firsts.append(begins + at)
        lasts.append(np.append(begins[1:], len(place)) - 1 + at)
    if not grams:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in (grams, places, firsts, lasts))


def gram_size(length: int) -> int:
    return max(1, length // 10)


def _least_in_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every ``width`` hashes in a row, the first of equals.

    The low bits of a hash give way to its place; minima of blocks from both ends give those of
    all windows.
    """
    low = np.uint64(_PLACE_BITS)
    keys = hashes >> low << low | np.arange(len(hashes), dtype=np.uint64)
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - width + 1], ahead[width - 1 : n])
    return (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)


def repeated_spans(texts: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """``row`` and ``spans`` (merged structs of start and end, in bytes) of the rows of ``texts``
    that have repeats. ``texts`` has a unique ``row`` and a binary ``text``, and is read twice.

    With ``words``, rows have to be even, and ``passages`` are the spans, in words, of that many
    words or more that stand elsewhere too.
    """
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Samples, and spans (without a gram) that are settled where texts are read.
    cut = stored(_triples(texts, length, words), "repeats-samples")
    sorted_names = cut.where("gram is not null").repartition(n, "gram")
    sorted_names = sorted_names.sortWithinPartitions(*_NAME)
    named = stored(sorted_names.mapInArrow(_by_gram, _NAMED), "repeats-names")
    # Of both, spans have no gram and lie around their sample.
    start, end = F.col("place") - F.col("before"), F.col("place") + F.col("after")
    around = ("row", start.alias("start"), end.alias("end"))
    settled = cut.where("gram is null").select(*around)
    settled = settled.unionByName(named.where("gram is null").select(*around))
    open_names = named.where("gram is not null")
    compared = stored(_compared(texts, open_names, length, _GROUP, words), "repeats-compared")
    waiting = compared.where("window is not null")
    twice = waiting.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    late = waiting.join(twice, "window").where("open")
    spans = settled
    for more in (compared.where("window is null"), late):
        spans = spans.unionByName(more.select("row", "start", "end"))

    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    @giving_back
    def merge(column: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        rows = [merged((s["start"], s["end"]) for s in x.as_py()) for x in column]
        return pa.array([[{"start": a, "end": b} for a, b in r] for r in rows], kind)

    span = F.struct("start", "end")
    kinds = {"spans": span}
    if words:
        kinds = {"spans": F.when(~_is_odd("row"), span), "passages": F.when(_is_odd("row"), span)}
    lists = (F.collect_list(c).alias(name) for name, c in kinds.items())
    held = spans.groupBy(_text_row(words)).agg(*lists)
    return held.select("row", *(merge(name).alias(name) for name in kinds))


def _is_odd(name: str) -> Column:
    return F.col(name).bitwiseAND(1) == 1


def _text_row(words: int) -> Column:
    """The row of the text that a sample or span is from."""
    return (F.col("row").bitwiseAND(-2) if words else F.col("row")).alias("row")


#: What says that two samples have the same windows around them.
_NAME = ("gram", "before", "after", "name")
_SAMPLE = "row long, gram long, place long, before int, after int, name long, twice boolean"
_NAMED = "row long, gram long, place long, before int, after int, open boolean, number long"


def _triples(texts: DataFrame, length: int, words: int) -> DataFrame:
    """Samples with the reach of their windows before and after them, and a name for that text.

    Samples of one name that are read together are reduced there: the spans of all of them are
    settled, and one goes on, marked as ``twice``.
    """
    return texts.select("row", "text").mapInArrow(_cut(length, words), _SAMPLE)


def _cut(length: int, words: int = 0):
    @giving_back
    def cut(tables):
        for t in tables:
            sizes = pc.binary_length(t.column(1)).fill_null(0).to_pylist()
            for some in batches(list(range(t.num_rows)), sizes.__getitem__, _PART):
                yield from _sample_batches(t.slice(some[0], len(some)), length, words)

    return cut


def _views(text: bytes, length: int, words: int) -> Iterator[tuple[bytes, int, int]]:
    """What is searched in a text, and the size of its windows in units of how many bytes: its bytes
    and, with ``words``, its words."""
    yield text, length, 1
    if words:
        yield _codes(text), words, WORD_BYTES


def _sample_batches(part: pa.RecordBatch, length: int, words: int) -> Iterator[pa.RecordBatch]:
    name = xxhash.xxh3_64_intdigest
    held: list[tuple[np.ndarray, ...]] = []
    for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
        for odd, (data, size, unit) in enumerate(_views(text or b"", length, words)):
            if len(data) < size * unit:
                continue
            gram, place, first, last = samples(data, size, unit)
            ends = last + size
            bounds = zip((first * unit).tolist(), (ends * unit).tolist())
            names = np.fromiter((name(data[a:b]) for a, b in bounds), np.uint64, len(first))
            if words:
                gram = gram & np.uint64(2**64 - 2) | np.uint64(odd)
            rows = np.full(len(gram), row + odd, np.int64)
            held.append((rows, gram, place, place - first, ends - place, names))
    if not held:
        return
    rows = np.stack([np.concatenate(c).astype(np.int64) for c in zip(*held)])
    rows = rows[:, np.lexsort(rows[[5, 4, 3, 1]])]
    begins, of_name = _runs(rows[[1, 3, 4, 5]])
    several = np.bincount(of_name)[of_name] > 1
    first = np.zeros(rows.shape[1], bool)
    first[begins] = True
    for chosen, gram in ((first, True), (several, False)):
        row, grams, place, before, after, names = rows[:, chosen]
        columns = [
            pa.array(row),
            pa.array(grams) if gram else pa.nulls(len(row), pa.int64()),
            pa.array(place),
            pa.array(before.astype(np.int32)),
            pa.array(after.astype(np.int32)),
            pa.array(names),
            pa.array(several[chosen]),
        ]
        kinds = ["row", "gram", "place", "before", "after", "name", "twice"]
        yield pa.RecordBatch.from_arrays(columns, kinds)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal columns begin, and the number of the run of each column."""
    changes = np.ones(keys.shape[1], bool)
    changes[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    return np.flatnonzero(changes), np.cumsum(changes) - 1


@giving_back
def _by_gram(tables):
    """Of samples in the order of ``_NAME``: spans of names that occur twice (without a gram), and
    one sample of each name whose gram has several names, with its number within the gram.

    However often a gram or a name occurs, one sample is held from batch to batch.
    """
    held = np.zeros((7, 0), np.int64)
    earlier = 0  # names of the held sample's gram before its own
    for t in tables:
        new = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in t.columns])
        if new.shape[1]:
            rows = np.concatenate([held, new], axis=1)
            yield from _named(rows, earlier, last=False)
            held, earlier = _kept(rows, earlier)
    if held.shape[1]:
        yield from _named(held, earlier, last=True)


def _grouped(rows: np.ndarray, earlier: int) -> tuple[np.ndarray, ...]:
    """Begin and weight of every name, the name of every row, and of every name its gram's number
    and its own number within the gram."""
    begins, of_name = _runs(rows[[1, 3, 4, 5]])
    weights = np.bincount(of_name, 1 + rows[6])
    gram_begins, of_gram = _runs(rows[[1]][:, begins])
    number = np.arange(len(begins)) - gram_begins[of_gram]
    number[of_gram == 0] += earlier
    return begins, weights, of_name, of_gram, number


def _named(rows: np.ndarray, earlier: int, last: bool) -> Iterator[pa.RecordBatch]:
    begins, weights, of_name, of_gram, number = _grouped(rows, earlier)
    settled = rows[:, (weights[of_name] > 1) & (rows[6] == 0)]
    names = np.bincount(of_gram)
    names[0] += earlier
    # The last name, and with it the last gram, may go on in the next batch.
    ready = np.arange(len(begins) if last else len(begins) - 1)
    ready = ready[names[of_gram[ready]] > 1]
    shown = rows[:, begins[ready]]
    for part, gram, alone, numbers in (
        (settled, None, None, None),
        (shown, shown[1], weights[ready] == 1, number[ready]),
    ):
        size = part.shape[1]
        columns = [
            pa.array(part[0]),
            pa.nulls(size, pa.int64()) if gram is None else pa.array(gram),
            pa.array(part[2]),
            pa.array(part[3].astype(np.int32)),
            pa.array(part[4].astype(np.int32)),
            pa.nulls(size, pa.bool_()) if gram is None else pa.array(alone),
            pa.nulls(size, pa.int64()) if gram is None else pa.array(numbers),
        ]
        kinds = ["row", "gram", "place", "before", "after", "open", "number"]
        yield pa.RecordBatch.from_arrays(columns, kinds)


def _kept(rows: np.ndarray, earlier: int) -> tuple[np.ndarray, int]:
    """One sample of the last name, marked if it stands for several, and the names before it."""
    begins, weights, _, _, number = _grouped(rows, earlier)
    one = rows[:, begins[-1:]].copy()
    one[6] = weights[-1] > 1
    return one, int(number[-1])


def _compared(
    texts: DataFrame, names: DataFrame, length: int, group: int, words: int
) -> DataFrame:
    """Windows of the open names that occur elsewhere as spans (``window`` null).

    The names of a gram that has over ``group`` are dealt to several tasks, ``group`` of them to
    each. There windows that occur twice are settled, and one of each kind goes on under a number
    for its place and text, to be counted among those of the other tasks.
    """
    large = names.where(F.col("number") >= group).select("gram").distinct()
    large = stored(large.withColumn("large", F.lit(True)), "repeats-large")
    large = broadcast_if_small(large, 24)
    names = names.join(large, "gram", "left")
    part = F.when(F.col("large"), F.floor(F.col("number") / group)).otherwise(0).alias("part")
    part = F.struct("gram", part, "large", "place", "before", "after", "open")
    # No hint: beyond Spark's own threshold for broadcasts texts are shuffled once, at any size.
    by_row = names.groupBy(_text_row(words)).agg(F.collect_list(part).alias("parts"))
    with_text = texts.select("row", "text").join(by_row, "row")
    stretch = F.expr("substring(text, int(p.place - p.before + 1), p.before + p.after)")
    row = F.col("row")
    if words:
        odd = F.exists("parts", lambda p: p["gram"].bitwiseAND(1) == 1)
        with_text = with_text.withColumn("codes", word_codes(F.when(odd, F.col("text"))))
        of_words = F.expr(
            f"substring(codes, int(p.place - p.before) * {WORD_BYTES} + 1, "
            f"(p.before + p.after) * {WORD_BYTES})"
        )
        stretch = F.when(_is_odd("p.gram"), of_words).otherwise(stretch)
        row = row + F.col("p.gram").bitwiseAND(1)
    cut = with_text.select("*", F.explode("parts").alias("p")).drop("parts")
    cut = cut.select(
        "p.gram", row.alias("row"), "p.place", "p.before", "p.open", stretch.alias("stretch"), "p.part",
        F.coalesce("p.large", F.lit(False)).alias("large"),
    )
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut.repartition(n, "gram", "part").sortWithinPartitions("gram", "part")

    def finished(rows):
        if words and rows and rows[0][0] & 1:
            return _finished(rows, words, WORD_BYTES)
        return _finished(rows, length, 1)

    @giving_back
    def compare(tables):
        key, rows = None, []
        for t in tables:
            for row in zip(*(c.to_pylist() for c in t.columns)):
                if (row[0], row[6]) != key:
                    yield from finished(rows)
                    key, rows = (row[0], row[6]), []
                rows.append(row)
        yield from finished(rows)

    return ordered.mapInArrow(
        compare, "row long, start long, end long, open boolean, window binary"
    )


def _finished(group: list, length: int, unit: int) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that occur twice among some names of a gram. If the gram has more names
    elsewhere, one of each kind of window as well, to be counted there."""
    large = bool(group) and group[0][7]
    if not group or len(group) == 1 and not large:
        return
    rows: list[tuple] = []
    hashes = [rolling(np.frombuffer(g[5], f"<u{unit}"), length) for g in group]
    counts = [len(h) for h in hashes]
    distance = np.concatenate([np.arange(len(h)) - g[3] for h, g in zip(hashes, group)])
    windows = np.concatenate(hashes) + distance.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    ends = np.cumsum(counts)
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for g, end, n in zip(group, ends, counts):
        if g[4]:
            start = g[2] - g[3]
            marks = twice[end - n : end].astype(np.int8)
            held = np.flatnonzero(np.diff(marks, prepend=0, append=0))
            for a, b in held.reshape(-1, 2).tolist():
                rows.append((g[1], start + a, start + b - 1 + length, True, None))
    if large:
        head = group[0][0].to_bytes(8, "big", signed=True)
        firsts = np.sort(order[np.concatenate([[True], ~same])])
        of_name = np.searchsorted(ends, firsts, side="right")
        keys = windows[firsts].astype(">u8").tobytes()
        for k, (at, name) in enumerate(zip(firsts.tolist(), of_name.tolist())):
            g = group[name]
            start = g[2] - g[3] + at - int(ends[name] - counts[name])
            window = head + keys[8 * k : 8 * k + 8]
            rows.append((g[1], start, start + length, g[4] and not twice[at], window))
            if len(rows) > 50_000:
                yield _span_batch(rows)
                rows = []
    if rows:
        yield _span_batch(rows)


def _span_batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["row", "start", "end", "open", "window"])


def without_spans(text: bytes, spans: Iterable[tuple[int, int]]) -> bytes:
    """The bytes outside of ``spans``, which are merged."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def with_repeats(
    docs: DataFrame,
    text_col: str = "text",
    length: int = LENGTH,
    into: str = "repeats",
    coded: Callable[[Column], Column] | None = None,
    words: int = 0,
    passages: str = "passages",
) -> DataFrame:
    """``docs``, written once, with a column ``into``: merged structs ``start``, ``end`` of the
    bytes covered by repeated strings, empty where there are none.

    Null texts are empty, texts shorter than ``length`` bytes have no repeats, and rows that occur
    twice repeat each other. Matches never cross rows; strings that overlap in one text count. A
    column of the name ``into`` is replaced. With ``coded`` all this is about the bytes that it
    makes of a text.

    With ``words``, which goes without ``coded``, a column ``passages`` has the spans of words, as
    ``word_codes`` parts them, that are covered by that many words in a row that start elsewhere too.
    """
    if coded and words:
        raise ValueError("words are sought in texts, not in what coded makes of them")
    row, codes = free_name(docs, "row"), free_name(docs, "codes")
    added = [into, passages] if words else [into]
    rows = docs.drop(*added).withColumn(row, F.monotonically_increasing_id() * len(added))
    # Made once and kept beside the text, which the search then does not read.
    data = coded(F.col(text_col)) if coded else F.lit(None).cast("binary")
    rows = stored(rows.withColumn(codes, data), "repeats-texts")
    data = F.col(codes) if coded else F.col(text_col).cast("binary")
    texts = rows.select(F.col(row).alias("row"), data.alias("text"))
    spans = stored(repeated_spans(texts, length, words).toDF(row, *added), "repeats-spans")
    spans = broadcast_if_small(spans, 96 + 40 * sum(F.size(name) for name in added))
    found = rows.drop(codes).join(spans, row, "left").drop(row)
    return found.withColumns({name: F.coalesce(name, F.expr("array()")) for name in added})


def repeat_report(text, spans) -> dict:
    """``n_bytes``, ``n_removed``, ``n_spans`` and the SHA-256 of the bytes that stay."""

    @F.arrow_udf("string")
    @giving_back
    def kept_sha256(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array(
            [
                hashlib.sha256(
                    without_spans(t.as_py() or b"", [(s["start"], s["end"]) for s in x.as_py()])
                ).hexdigest()
                for t, x in zip(texts, found)
            ]
        )

    data = text.cast("binary")
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return {
        "n_bytes": F.coalesce(F.length(data), F.lit(0)).cast("long"),
        "n_removed": removed,
        "n_spans": F.size(spans).cast("long"),
        "kept_sha256": kept_sha256(data, spans),
    }


def kept_text(text, spans):
    """The text without ``spans``; what is left of a character that was cut goes as well."""

    @F.arrow_udf("string")
    @giving_back
    def kept(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array(
            [
                None
                if t.as_py() is None
                else without_spans(
                    t.as_py(), [(s["start"], s["end"]) for s in x.as_py()]
                ).decode("utf-8", "ignore")
                for t, x in zip(texts, found)
            ],
            pa.string(),
        )

    return kept(text.cast("binary"), spans)


def word_codes(text: Column) -> Column:
    """``WORD_BYTES`` bytes of a hash for every word of a text.

    Words are parted by ASCII white space; a letter of a script without spaces is one by itself.
    """

    @F.arrow_udf("binary")
    @giving_back
    def codes(texts: pa.Array) -> pa.Array:
        return pa.array([_codes(x.as_py() or b"") for x in texts], pa.binary())

    return codes(text.cast("binary"))


def _codes(data: bytes) -> bytes:
    data = _spaced(data)
    plain = np.frombuffer(data, np.uint8)
    space = (plain == 32) | ((plain >= 9) & (plain <= 13))
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    begins, ends = edges[::2], edges[1::2]
    codes = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        first = begins[at]
        to = int(np.searchsorted(ends, first + _STEP, side="right"))
        if to == at:  # one word that is longer than a step
            codes[at] = xxhash.xxh3_64_intdigest(data[first : ends[at]])
            to += 1
        else:
            sums = _sums(plain[first : ends[to - 1]])
            a, b = begins[at:to] - first, ends[at:to] - first
            codes[at:to] = _mixed((sums[b] - sums[a]) * _powers.down[a])
        at = to
    return (codes >> np.uint64(64 - 8 * WORD_BYTES)).astype(f"<u{WORD_BYTES}").tobytes()


def _spaced(data: bytes) -> bytes:
    """``data`` with space around each letter of a script without spaces."""
    if not data.isascii():
        text = data.decode("utf-8", "replace")
        if _HAS_UNSPACED.search(text):
            return b" ".join([w.encode() for w in _WORD.findall(text)])
    return data


def word_spans(spans: Column, words: int) -> Column:
    """Spans of word codes as spans of whole words, those of ``words`` or more."""
    whole = F.transform(
        spans,
        lambda s: F.struct(
            F.ceil(s["start"] / WORD_BYTES).alias("start"),
            F.floor(s["end"] / WORD_BYTES).alias("end"),
        ),
    )
    return F.filter(whole, lambda s: s["end"] - s["start"] >= words)


def passage_report(text: Column, passages: Column) -> dict:
    """``n_passages``, ``n_passage_words`` and the text without the words of ``passages``."""
    some = F.size(passages) > 0
    words = F.aggregate(passages, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return {
        "n_passages": F.size(passages).cast("long"),
        "n_passage_words": words,
        "text_without_passages": F.when(some, kept_words(F.when(some, text), passages)).otherwise(
            text
        ),
    }


def kept_words(text: Column, spans: Column) -> Column:
    """The text without the words of ``spans`` and what parts them."""

    def cut(data: bytes, found: list) -> str:
        whole = data.decode("utf-8", "replace")
        places = [m.span() for m in _WORD.finditer(whole)]
        out, at = [], 0
        for s in found:
            out.append(whole[at : places[s["start"]][0]])
            at = places[s["end"] - 1][1]
        return "".join([*out, whole[at:]])

    @F.arrow_udf("string")
    @giving_back
    def kept(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), found.to_pylist())
        return pa.array([None if t is None else cut(t, x) for t, x in rows], pa.string())

    return kept(text.cast("binary"), spans)
