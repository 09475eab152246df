from __future__ import annotations

import os
import random
import uuid

import corpus_pipeline as pipeline
import pytest
from lossmill.llm import common
from lossmill.llm.decontaminate import windows
from pyspark.sql import functions as F

from tests.llm.test_simhash import plain_components, plain_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"
SYLLABLES = [a + b for a in "bcdfghklmnprst" for b in "aeiou"]


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def rows_of(texts):
    return [(k, t, "en", "s", None if t is None else len(t), k) for k, t in texts]


def frame(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)


def kept(df):
    return sorted(df.collect(), key=str)


def test_near_duplicates_go_and_others_stay(spark):
    """One row of each component that links of two bits at most make, and no other row goes."""
    rng = random.Random(11)
    texts, copies = [], []
    for k in range(120):
        words = prose(rng, rng.randint(100, 900)).split()
        texts.append((k, " ".join(words)))
        if k % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            copies.append((1000 + k, " ".join(words)))
        if k % 5 == 0:
            copies.append((2000 + k, texts[-1][1]))
    texts += [(texts[7][0], texts[7][1]), (None, None), (5000, ""), (5001, " ")]
    every = texts + copies
    got = pipeline.drop_near_duplicates(spark, frame(spark, every), "")
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids))
    known = {i: t for i, t in every if i is not None}
    components = plain_components({i: plain_fingerprint(t) for i, t in known.items()})
    assert set(ids) == set(components.values())
    assert 20 < len({i for i in range(1000, 2000) if i in known} - set(ids))
    assert not [i for i in ids if 2000 <= i < 3000]
    empty = frame(spark, texts).limit(0)
    assert pipeline.drop_near_duplicates(spark, empty, "").count() == 0


def test_a_group_of_near_copies_with_a_third_of_all_rows(spark):
    """Many fingerprints that lie close together: every component keeps one row."""
    rng = random.Random(15)
    words = prose(rng, 2000).split()
    texts = [(k, prose(rng, 60)) for k in range(1200)]
    for k in range(600):
        copy = list(words)
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(len(copy))] = prose(rng, 1)
        texts.append((5000 + k, " ".join(copy)))
    got = pipeline.drop_near_duplicates(spark, frame(spark, texts), "")
    components = plain_components({i: plain_fingerprint(t) for i, t in texts})
    assert {r.doc_id for r in got.collect()} == set(components.values())


def test_a_stage_drops_what_the_one_before_left(spark, folder, monkeypatch):
    monkeypatch.setattr(
        common, "scratch_path", lambda _, label: f"{folder}/shared/{label}-{uuid.uuid4().hex}"
    )
    rng = random.Random(16)
    docs = frame(spark, [(k, prose(rng, 80)) for k in range(30)])
    clash = docs.withColumnRenamed("extra", "repeats").withColumn("Hits", F.lit("own"))
    first = pipeline.drop_near_duplicates(spark, clash, "")
    left = set(os.listdir(f"{folder}/shared"))
    assert any(name.startswith("simhash-") for name in left)
    # Still read from there: nothing may go.
    lazy = pipeline.cut_repeats(spark, first, "")
    assert any(name.startswith("simhash-texts") for name in os.listdir(f"{folder}/shared"))
    assert lazy.count() == 30
    first = pipeline.drop_near_duplicates(spark, clash, "")
    first.write.parquet(f"{folder}/near")
    written = spark.read.parquet(f"{folder}/near")
    second = pipeline.cut_repeats(spark, written, "")
    now = os.listdir(f"{folder}/shared")
    assert sum(name.startswith("simhash-texts") for name in now) == 1  # that of the lazy one
    kept = {r.doc_id: (r.repeats, r.Hits) for r in second.collect()}
    assert kept == {k: (k, "own") for k in range(30)}
    second.write.parquet(f"{folder}/cut")
    third = pipeline.drop_contaminated(
        spark, spark.read.parquet(f"{folder}/cut"), "/root/testdata/sf0.001"
    )
    assert {r.doc_id: (r.repeats, r.Hits) for r in third.collect()} == kept


def test_passages_are_cut_everywhere(spark):
    rng = random.Random(12)
    passage = prose(rng, 60)
    texts = [(k, prose(rng, 80)) for k in range(20)]
    mixed = [(k, f"{t} {passage}. {prose(rng, 30)}" if k < 5 else t) for k, t in texts]
    got = kept(pipeline.cut_repeats(spark, frame(spark, [*mixed, (90, None), (91, "")]), ""))
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 22 and by_id[90].text is None and by_id[91].text == ""
    for k, text in mixed:
        if k < 5:
            assert passage[10:-10] not in by_id[k].text
            assert by_id[k].n_chars == len(by_id[k].text)
        else:
            assert by_id[k].text == text


def test_passages_count_words_not_bytes(spark):
    """51 short words go in any script; 50 words stay, however long, and so do two repeats side
    by side that are shorter each."""
    rng = random.Random(14)
    short = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=51))
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(60))
    long = " ".join("é" * 9 + str(rng.randrange(10**6)) for _ in range(50))
    one, two = prose(rng, 30), prose(rng, 30)
    own = [prose(rng, 40) for _ in range(22)]
    held = [short, short, han, han, long, long, f"{one} {two}", one, two, "", ""]
    texts = [(k, f"{own[k]} {p} {own[-1 - k]}".strip()) for k, p in enumerate(held)]
    texts += [(50, f"a\n{short.replace(' ', '  ')} b")]
    got = {r.doc_id: r.text for r in pipeline.cut_repeats(spark, frame(spark, texts), "").collect()}
    for k, text in texts:
        if k < 4:
            assert got[k] == f"{own[k]}  {own[-1 - k]}"
        elif k < 50:
            assert got[k] == text
    assert got[50] == "a\n b"


def test_contaminated_and_toxic_documents_go(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rng = random.Random(13)
    window = b" ".join(next(windows(benchmark.encode()))).decode()
    texts = [(1, prose(rng, 30)), (2, f"{prose(rng, 9)} {window.upper()} end"), (3, None)]
    assert [r.doc_id for r in kept(pipeline.drop_contaminated(spark, frame(spark, texts), sf_dir))] == [1, 3]
    assert pipeline.drop_toxic(spark, frame(spark, texts), sf_dir).count() == 3


def test_stages_keep_the_columns(spark):
    names = [name for name, _ in pipeline.STAGES]
    assert names == [
        "toxicity", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing",
    ]
    docs = frame(spark, [(1, "a b")])
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_query(query, spark, sf_dir):
    pieces = query("pipeline", sf_dir).collect()
    documents = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = {r.doc_id for r in pieces}
    assert held < documents and len(held) > len(documents) / 2
