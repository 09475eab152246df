"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text.

Folding makes look-alike letters of other scripts, full-width letters and digits or signs within
words into Latin letters, and everything that is no letter into a space. An entry is the start of a
word, of 3 to 12 letters, or a whole word of any length; what a script without spaces writes in a
row is one word. Exception phrases are word pairs in which an entry does not count.

``learn_lexicon`` takes entries, weights, exceptions and the curve from weight to score from at
most about ``rows_per_label`` labelled texts of each label, however many there are. Everything else
sees every text whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossmill.llm.common import giving_back, stored

ROWS_PER_LABEL = 5_000
#: Of the candidates this share may be there by chance.
FALSE_SHARE = 0.1
_PREFIXES = range(3, 13)
_STEPS = 4  # of evidence in the histogram, per unit
_GRAIN = 1 << 30

# Letters that look like Latin ones, and the ones they look like.
_LOOKALIKES = str.maketrans(
    "абвгдезікмнорстухѕјԁһӏαβεικνορτυχ",
    "abbrde3ikmhopctyxsjdhlabeikvoptux",
)
_OTHER_SCRIPTS = re.compile("[Ͱ-ԯ！-～]")
_FULL_WIDTH = {0xFF01 + k: 0x21 + k for k in range(94)}
# Digits and signs written for letters.
_WRITTEN_FOR = str.maketrans("01345789@$!", "oieastbgasi")
_MIXED = re.compile(
    r"(?<=[^\W\d_])[0-9]+|[0-9]+(?=[^\W\d_])|(?<=[^\W\d_])[@$!](?=[^\W\d_])"
)
_HAS_DIGIT_OR_SIGN = re.compile("[0-9@$!]")
_LETTERS_ONLY = bytes(b if b > 0x7F or chr(b).isalpha() else 0x20 for b in range(256))

_SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType(), False),
        T.StructField("weight", T.DoubleType(), False),
        T.StructField("matches", T.ArrayType(T.StringType(), False), False),
    ]
)


def fold(text: str | None) -> str:
    """Folded words, with a space before, between and after them."""
    text = (text or "").lower()
    if not text.isascii() and _OTHER_SCRIPTS.search(text):
        text = text.translate(_FULL_WIDTH).lower().translate(_LOOKALIKES)
    if _HAS_DIGIT_OR_SIGN.search(text):
        text = _MIXED.sub(lambda m: m[0].translate(_WRITTEN_FOR), text)
    return " " + text.encode("utf-8", "replace").translate(_LETTERS_ONLY).decode() + " "


@dataclass(frozen=True)
class Lexicon:
    """``weights`` maps ' start' or ' word ' to a weight; ``exceptions`` are pairs ' one two '.

    ``curve`` holds the coefficients of 1, log(1 + weight) and log(1 + weight per 1,000 letters)
    in the logit of the score.
    """

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-math.inf, 0.0, 0.0)


class Matcher:
    """Finds the entries and exceptions of a lexicon in folded text."""

    def __init__(self, lexicon: Lexicon):
        self._lexicon = lexicon
        self._automaton = ahocorasick.Automaton()
        for entry in lexicon.weights:
            self._automaton.add_word(entry, (entry, False))
        for phrase in lexicon.exceptions:
            self._automaton.add_word(phrase, (phrase, True))
        if len(self._automaton):
            self._automaton.make_automaton()

    def matches(self, folded: str) -> Iterator[tuple[int, str]]:
        """Start of a word and the heaviest entry there, where no exception covers the word."""
        if not len(self._automaton):
            return
        best: dict[int, str] = {}
        excused: list[tuple[int, int]] = []
        weights = self._lexicon.weights
        for last, (text, exception) in self._automaton.iter(folded):
            start = last + 1 - len(text)
            if exception:
                excused.append((start, last))
            elif start not in best or weights[best[start]] < weights[text]:
                best[start] = text
        for start, entry in best.items():
            if not any(a <= start < b for a, b in excused):
                yield start, entry

    def all_matches(self, folded: str) -> Iterator[tuple[int, str]]:
        """Start of a word and every entry there."""
        if len(self._automaton):
            for last, (text, _) in self._automaton.iter(folded):
                yield last + 1 - len(text), text

    def score(self, text: str | None) -> tuple[float, float, list[str]]:
        folded = fold(text)
        counts = Counter(entry for _, entry in self.matches(folded))
        weight = weight_of(counts, self._lexicon.weights)
        logit = float(np.dot(self._lexicon.curve, features(weight, len(folded))))
        score = 1 / (1 + math.exp(-logit)) if logit > -700 else 0.0
        return score, weight, sorted(x.strip() for x in counts)


def weight_of(counts: dict[str, int], weights: dict[str, float]) -> float:
    """Repeats of an entry add less and less."""
    return sum(weights[entry] * (1 + math.log(n)) for entry, n in sorted(counts.items()))


def features(weight: float, length: int) -> tuple[float, float, float]:
    return 1.0, math.log1p(weight), math.log1p(1000 * weight / length)


def with_toxicity(
    docs: DataFrame, lexicon: Lexicon, text_col: str = "text", into: str = "toxicity"
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``score`` from 0 to 1, ``weight`` and ``matches``
    (the entries found, sorted).

    Null and empty texts have no matches and the score of a text without any. Every row is scored
    by its whole text alone; repeats and null ids are no special case. A column of the name
    ``into`` is replaced. With an empty lexicon every score is the share of label 1, 0 if there
    were no labels.
    """
    matcher = docs.sparkSession.sparkContext.broadcast(lexicon)
    held: list[Matcher] = []

    @F.arrow_udf(_SCORED)
    @giving_back
    def scored(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Matcher(matcher.value))
        rows = [held[0].score(x.as_py()) for x in texts]
        return pa.array(
            [{"score": s, "weight": w, "matches": m} for s, w, m in rows],
            pa.struct(
                [
                    ("score", pa.float64()),
                    ("weight", pa.float64()),
                    ("matches", pa.list_(pa.string())),
                ]
            ),
        )

    return docs.withColumn(into, scored(F.col(text_col)))


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_label: int = ROWS_PER_LABEL,
    false_share: float = FALSE_SHARE,
) -> Lexicon:
    """Learn from the texts of ``docs`` that ``labels`` marks 0 or 1.

    Candidates are starts and whole words with a high log-likelihood ratio against independence,
    however many. How high follows from the labels there are: so that of all that reach it at most
    ``false_share`` would do so by chance, given the number of starts and words looked at. They are
    taken greedily, each time the one with most evidence among texts of label 1 that hold none so
    far, so words that merely stand beside an entry in copied texts add nothing. Texts that occur
    again count once. Null labels and ids are left out; a row with both labels counts for both.
    Without texts of both labels the lexicon is empty.
    """
    marks = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    marks = marks.where("id is not null").distinct()
    totals = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    shares = {y: min(1.0, rows_per_label / n) for y, n in totals.items()}
    if len(shares) < 2:
        share = sum(y * n for y, n in totals.items()) / max(1, sum(totals.values()))
        return Lexicon(curve=(_logit(share), 0.0, 0.0))
    limit = F.when(F.col("label") == 1, int(shares[1] * _GRAIN)).otherwise(int(shares[0] * _GRAIN))
    sample = marks.where(F.pmod(F.xxhash64("id"), F.lit(_GRAIN)) < limit)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most some ``rows_per_label`` ids of each label: small enough for every executor.
    texts = texts.join(F.broadcast(sample), "id").select("text", "label")
    texts = stored(texts.dropDuplicates(["text", "label"]), "toxicity-sample")
    return _learn(texts, shares, false_share)


def _logit(share: float) -> float:
    if share in (0, 1):
        return math.inf if share else -math.inf
    return math.log(share / (1 - share))


def _starts_and_words(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in _PREFIXES if n <= len(word))
    return found


def _learn(texts: DataFrame, shares: dict, false_share: float) -> Lexicon:
    sizes = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_yes, n_no = sizes.get(1, 0), sizes.get(0, 0)
    if not (n_yes and n_no):
        return Lexicon(curve=(_logit(n_yes / max(1, n_yes + n_no)), 0.0, 0.0))
    counts = texts.mapInArrow(_count, "entry string, yes long, no long")
    counts = counts.groupBy("entry").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    evidence = _evidence(F.col("yes"), F.col("no"), n_yes, n_no)
    telling = F.when(F.col("yes") * n_no > F.col("no") * n_yes, evidence).otherwise(0.0)
    counts = stored(counts.select("entry", telling.alias("evidence")), "toxicity-counts")
    least = _least_evidence(counts, false_share)
    chosen = counts.where(F.col("evidence") >= least).select("entry").orderBy("entry")
    names = chosen.toArrow().column(0).to_pylist()
    held = texts.mapInArrow(_holdings(names), "label int, holds array<int>").toArrow()
    weights = _cover(names, held, n_yes, n_no, least)
    found = Lexicon(weights)
    rows = texts.mapInArrow(_contexts(found), "label int, length long, hits string").collect()
    seen = [(r.label, r.length, [h.split("\t") for h in r.hits.split("\n") if h]) for r in rows]
    exceptions = _exceptions(seen, weights, n_yes, n_no, false_share)
    return Lexicon(weights, exceptions, _curve(seen, weights, exceptions, shares))


def _least_evidence(counts: DataFrame, false_share: float) -> float:
    """The least evidence at which chance would bring ``false_share`` of what there is, or less.

    Evidence without a connection is distributed as chi-square of one degree; half of it points to
    label 1. Counted in a histogram, whose steps are few whatever the number of entries.
    """
    step = F.floor(F.least("evidence", F.lit(1e6)) * _STEPS).alias("step")
    rows = counts.groupBy(step).agg(F.count("*").alias("n")).collect()
    looked_at, reached, least = sum(r.n for r in rows), 0, math.inf
    for r in sorted(rows, key=lambda r: -r.step):
        reached += r.n
        value = r.step / _STEPS
        if looked_at * math.erfc(math.sqrt(value / 2)) / 2 <= false_share * reached:
            least = value
    return least


@giving_back
def _count(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flushed():
        names = list(counts[0] | counts[1])
        columns = [pa.array(names, pa.string())]
        columns += [pa.array([counts[y][x] for x in names], pa.int64()) for y in (1, 0)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, ["entry", "yes", "no"])

    for t in tables:
        for text, label in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            counts[label].update(_starts_and_words(fold(text)))
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield flushed()
    yield flushed()


def _evidence(yes: Column, no: Column, n_yes: int, n_no: int) -> Column:
    """Log-likelihood ratio of a word's presence in texts of the two labels."""

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = F.lit(n_yes / (n_yes + n_no))
    out_yes, out_no = n_yes - yes, n_no - no
    inside, outside = yes + no, out_yes + out_no
    return 2 * (
        term(yes, inside * share)
        + term(no, inside * (1 - share))
        + term(out_yes, outside * share)
        + term(out_no, outside * (1 - share))
    )


def _ratio(yes: int, no: int, n_yes: int, n_no: int) -> float:
    """The same ratio for plain numbers."""
    share = n_yes / (n_yes + n_no)
    inside, outside = yes + no, n_yes + n_no - yes - no
    cells = [
        (yes, inside * share),
        (no, inside * (1 - share)),
        (n_yes - yes, outside * share),
        (n_no - no, outside * (1 - share)),
    ]
    return 2 * sum(seen * math.log(seen / expected) for seen, expected in cells if seen)


def _holdings(names: list[str]):
    """Numbers of the entries that each text holds."""

    @giving_back
    def holdings(tables):
        entries = Matcher(Lexicon(dict.fromkeys(names, 1.0)))
        number = {name: k for k, name in enumerate(names)}
        for t in tables:
            rows = [
                sorted({number[e] for _, e in entries.all_matches(fold(text))})
                for text in t.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [t.column(1), pa.array(rows, pa.list_(pa.int32()))], ["label", "holds"]
            )

    return holdings


def _contexts(lexicon: Lexicon):
    """Every use of an entry with the word pairs around it."""

    @giving_back
    def contexts(tables):
        entries = Matcher(lexicon)
        for t in tables:
            rows = []
            for text, label in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
                folded = fold(text)
                hits = [
                    f"{entry}\t{_pair(folded, start, True)}\t{_pair(folded, start, False)}"
                    for start, entry in entries.matches(folded)
                ]
                rows.append((label, len(folded), "\n".join(hits)))
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["label", "length", "hits"]
            )

    return contexts


def _pair(folded: str, start: int, before: bool) -> str:
    """The word after the space at ``start`` with the one next before or after it, one space apart;
    empty where there is none."""
    end = folded.index(" ", start + 1)
    word = folded[start + 1 : end]
    if before:
        there = start > 0 and folded[start - 1] != " "
        return f" {folded[folded.rindex(' ', 0, start) + 1 : start]} {word} " if there else ""
    there = end + 1 < len(folded) and folded[end + 1] != " "
    return f" {word} {folded[end + 1 : folded.index(' ', end + 1)]} " if there else ""


def _cover(
    names: list[str], held: pa.Table, n_yes: int, n_no: int, least: float
) -> dict[str, float]:
    """Greedy choice among the entries that the sampled texts hold.

    What texts hold stays a list of numbers, so the driver keeps four bytes for each entry of each
    sampled text and no table of texts by entries.
    """
    label = held.column("label").to_numpy()
    holds = held.column("holds").combine_chunks()
    entry = holds.flatten().to_numpy()
    text = np.repeat(np.arange(len(label), dtype=np.int32), holds.value_lengths().to_numpy())
    yes = label[text] == 1
    in_no = np.bincount(entry[~yes], minlength=len(names))
    entry, text = entry[yes], text[yes]
    all_yes = np.bincount(entry, minlength=len(names))
    left = int((label == 1).sum())
    weights: dict[str, float] = {}
    while left:
        in_yes = np.bincount(entry, minlength=len(names))
        ranked: dict[tuple[int, int], list[tuple]] = defaultdict(list)
        for k in np.flatnonzero(in_yes * n_no > in_no * left).tolist():
            ranked[int(in_yes[k]), int(in_no[k])].append((len(names[k].rstrip()), names[k], k))
        if not ranked:
            break
        evidence = {pair: _ratio(*pair, left, n_no) for pair in ranked}
        top = max(evidence.values())
        if top < least:
            break
        # Of equally telling entries the longest.
        *_, name, k = max(x for pair, each in ranked.items() if evidence[pair] == top for x in each)
        weights[name] = math.log((all_yes[k] + 0.5) / (n_yes + 1)) - math.log(
            (in_no[k] + 0.5) / (n_no + 1)
        )
        covered = text[entry == k]
        left -= len(covered)
        stay = ~np.isin(text, covered)
        entry, text = entry[stay], text[stay]
    return weights


def _exceptions(seen, weights, n_yes: int, n_no: int, false_share: float) -> tuple[str, ...]:
    """Pairs with an entry that stand in texts of label 0 far more often than other uses do.

    They are taken greedily, each time the one with most evidence among texts of label 0 that hold
    none so far, so words that merely stand beside an excused one add nothing. The bar is such that
    of all pairs looked at less than ``false_share`` would reach it by chance.
    """
    pairs: dict[str, tuple[set, set]] = defaultdict(lambda: (set(), set()))
    used: tuple[set, set] = (set(), set())
    for k, (label, _, hits) in enumerate(seen):
        for entry, *around in hits:
            if entry in weights:
                used[label].add(k)
                for pair in filter(None, around):
                    pairs[pair][label].add(k)
    n_used = max(len(used[1]), 1)
    left, found = set(used[0]), []
    while left:
        best = (0.0, "")
        for pair, (no, yes) in pairs.items():
            n = len(no & left)
            if n * n_used > len(yes) * len(left) and n * n_yes > len(yes) * n_no:
                best = max(best, (_ratio(n, len(yes), len(left), n_used), pair))
        evidence, pair = best
        if not pair or len(pairs) * math.erfc(math.sqrt(evidence / 2)) / 2 > false_share:
            break
        found.append(pair)
        left -= pairs.pop(pair)[0]
    return tuple(sorted(found))


def _curve(seen, weights, exceptions, shares) -> tuple[float, float, float]:
    """Penalised logistic regression by Newton's method; rows weigh what their label was thinned."""
    excused = set(exceptions)
    x, y, w = [], [], []
    for label, length, hits in seen:
        counts = Counter(e for e, *around in hits if e in weights and not excused & set(around))
        x.append(features(weight_of(counts, weights), length))
        y.append(label)
        w.append(1 / shares[label])
    x, y, w = np.array(x), np.array(y, float), np.array(w)
    w *= len(w) / w.sum()
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (w * (p - y)) + 0.1 * b
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(b))
        step = np.linalg.solve(bend, slope)
        b -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)
