from __future__ import annotations

import math
import random

import numpy as np
import pytest
from lossmill.llm import quality
from lossmill.llm.quality import _slope, fit_ordinal, hashed, with_grade


def test_slope_by_differences():
    rng = np.random.default_rng(1)
    size, n, k = 8, 30, 4
    rows = np.repeat(np.arange(n), 3)
    columns, values = rng.integers(0, size, 3 * n), rng.random(3 * n)
    y = rng.integers(0, k, n)
    at = rng.normal(size=size + k - 1)

    def loss(p):
        w, order = p[:size], p[size:]
        cuts = np.concatenate([[-np.inf], np.cumsum([order[0], *np.exp(order[1:])]), [np.inf]])
        total = np.bincount(rows, w[columns] * values, minlength=n)
        with np.errstate(over="ignore"):
            share = 1 / (1 + np.exp(total - cuts[y + 1])) - 1 / (1 + np.exp(total - cuts[y]))
        return -np.log(share).mean() + 1e-5 / 2 * (w**2).sum()

    step = 1e-6 * np.eye(len(at))
    expected = [(loss(at + e) - loss(at - e)) / 2e-6 for e in step]
    assert _slope(at, size, y, rows, columns, values) == pytest.approx(expected, abs=1e-5)


def rated(seed, n):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        grade = rng.randrange(4)
        words = [rng.choice("good fine" .split() if rng.random() < grade / 3 else ["bad", "worse"]) for _ in range(30)]
        rows.append((k, " ".join(words), grade))
    return rows


def test_grades_in_order(spark):
    schema = "doc_id long, text string, grade int"
    train = spark.createDataFrame(rated(1, 600), schema)
    model = fit_ordinal(train, train, bits=10)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = with_grade(spark.createDataFrame(rated(2, 200), schema), model).collect()
    for r in got:
        assert r.quality.tails == sorted(r.quality.tails, reverse=True)
        assert r.quality.expected_grade == pytest.approx(sum(r.quality.tails))
    assert np.corrcoef([r.grade for r in got], [r.quality.expected_grade for r in got])[0, 1] > 0.9


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x"), (1, "a b", "x"), (None, None, "x"), (2, "", "x"), (3, "c " * 400_000, "x")],
        "doc_id long, text string, quality string",
    )
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, grade int")
    assert {r.quality.expected_grade for r in with_grade(docs, fit_ordinal(docs, none)).collect()} == {None}
    one = spark.createDataFrame([(1, 3)], "doc_id long, grade int")
    assert {r.quality.expected_grade for r in with_grade(docs, fit_ordinal(docs, one)).collect()} == {3.0}
    two = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, grade int")
    model = fit_ordinal(docs, two)
    got = with_grade(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.quality.expected_grade <= 1 for r in got)
    assert got[0].quality == got[1].quality
    assert with_grade(docs.limit(0), model).count() == 0
    assert hashed(b"%% a")[0].shape == (2,)


def test_held_out_accuracy(query, spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    got = query("op10_quality_classifier", sf_dir).join(labels, "doc_id").where("held_out").collect()
    right = [r.kept == bool(r.quality) for r in got]
    print(len(right), sum(right) / len(right))
    assert sum(right) / len(right) > 0.9


def test_grades_against_plain_loops(spark):
    rng = np.random.default_rng(4)
    weights = rng.normal(size=1 << 10).astype(np.float32)
    model = quality.OrdinalModel((0.0, 1.0, 3.0), (-0.4, 0.9), weights, 10)
    texts = ["one two two", "", None, "THREE", "x " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.with_grade(df, model).orderBy("doc_id").collect()
    for row, text in zip(got, texts):
        places, values = quality.hashed(None if text is None else text.encode(), 10)
        total = sum(float(weights[p]) * float(v) for p, v in zip(places, values))
        tails = [1 / (1 + math.exp(t - total)) for t in model.thresholds]
        assert list(row.quality.tails) == pytest.approx(tails)
        assert row.quality.expected_grade == pytest.approx(tails[0] + 2 * tails[1])
