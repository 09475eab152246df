from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from lossmill.llm import suffix_dedup
from lossmill.llm.suffix_dedup import (
    kept_text,
    passage_report,
    repeat_report,
    samples,
    with_repeats,
    without_spans,
)
from pyspark.sql import functions as F


def plain(texts, length):
    """Covered places of each text."""
    starts = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    return [
        {
            p
            for k in range(len(t) - length + 1)
            if starts[t[k : k + length]] > 1
            for p in range(k, k + length)
        }
        for t in texts
    ]


def mixture(rng, n):
    """Texts that share passages, with small changes, and some that repeat themselves."""
    alphabet = b"abcdefgh "
    passages = [bytes(rng.choices(alphabet, k=rng.randint(5, 90))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            part = bytearray(rng.choice(passages))
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = rng.choice(alphabet)
            parts.append(bytes(part) * rng.choice([1, 1, 1, 2]))
            parts.append(bytes(rng.choices(alphabet, k=rng.randint(0, 12))))
        out.append(b"".join(parts))
    return [*out, b"a" * 100, b"ab" * 60, b"", b"abc" * 30]


def spans_of(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text binary")
    found = with_repeats(df.repartition(3), length=length).collect()
    return {r.doc_id: [(s.start, s.end) for s in r.repeats] for r in found}


@pytest.mark.parametrize("group", [2, 5, 2000])
@pytest.mark.parametrize("length", [20, 40])
def test_against_plain_loops(spark, monkeypatch, group, length):
    monkeypatch.setattr(suffix_dedup, "_GROUP", group)
    texts = mixture(random.Random(group + length), 60)
    got = spans_of(spark, texts, length)
    for k, places in enumerate(plain(texts, length)):
        assert {p for a, b in got[k] for p in range(a, b)} == places
        assert all(b < c for (_, b), (c, _) in zip(got[k], got[k][1:]))


def test_samples_cover_every_window_in_any_step(monkeypatch):
    text = bytes(random.Random(1).choices(b"abcd", k=900))
    whole = samples(text, 50)
    gram, place, first, last = whole
    assert first[0] == 0 and last[-1] == 850
    assert (first[1:] == last[:-1] + 1).all()
    assert ((first <= place) & (place + 5 <= last + 50)).all() and (place <= first + 45).all()
    monkeypatch.setattr(suffix_dedup, "_STEP", 100)
    cut = samples(text, 50)
    by_start = {p: (g, a) for g, a, f, l in zip(*whole) for p in range(f, l + 1)}
    assert by_start == {p: (g, a) for g, a, f, l in zip(*cut) for p in range(f, l + 1)}


def test_edges(spark):
    same = "Ü" * 10 + "word " * 90
    rows = [(1, same, 5), (1, same, 5), (None, None, 1), (2, "", 1), (3, "short", 2)]
    rows += [(4, "xyz " * 60_000, 3), (5, "x" + same[:-1] + "é", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long")
    report = repeat_report(F.col("text"), F.col("repeats"))
    found = with_repeats(df)
    assert set(found.columns) == {"doc_id", "text", "row", "repeats"}
    got = found.select("doc_id", kept_text(F.col("text"), F.col("repeats")).alias("kept"), *(c.alias(n) for n, c in report.items())).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 7
    for doc in (1, 4):
        assert (by_id[doc].n_removed, by_id[doc].n_spans, by_id[doc].kept) == (by_id[doc].n_bytes, 1, "")
    assert by_id[None].n_bytes == by_id[2].n_removed == by_id[3].n_spans == 0
    assert by_id[None].kept is None and by_id[3].kept == "short"
    assert by_id[None].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[5].kept == "xé" and by_id[5].n_spans == 1
    assert with_repeats(df.limit(0)).count() == 0


def test_query_against_plain_loops(query, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in docs]
    got = {r.doc_id: r for r in query("op6_suffix_array_dedup", sf_dir).collect()}
    assert len(got) == len(docs)
    for (doc, _), text, places in zip(docs, texts, plain(texts, 400)):
        kept = bytes(b for k, b in enumerate(text) if k not in places)
        runs = sum(1 for p in places if p - 1 not in places)
        assert (got[doc].n_bytes, got[doc].n_removed, got[doc].n_spans, got[doc].kept_sha256) == (
            len(text), len(places), runs, hashlib.sha256(kept).hexdigest(),
        )
    assert without_spans(b"abcdef", [(1, 2), (4, 6)]) == b"acd"


def plain_passages(texts, n):
    """Words of each text that ``n`` words in a row cover which start elsewhere too."""
    lists = [re.findall("[\u4e00-\u9fff]|[^ \t-\r\u4e00-\u9fff]+", t or "") for t in texts]
    return lists, plain([tuple(w) for w in lists], n)


@pytest.mark.parametrize("group", [2, 2000])
def test_passages_of_words_beside_repeats_of_bytes(spark, monkeypatch, group):
    """Both at once, each as by plain loops; words are the same whatever space and script is around."""
    monkeypatch.setattr(suffix_dedup, "_GROUP", group)
    rng = random.Random(group)
    words = ["a", "bb", "ccc", "d" * 30, "é", "\u4e2d", "\u6587\u5b57", "x\u4e2dy", "\u044f" * 9]
    passages = [rng.choices(words, k=rng.randint(8, 40)) for _ in range(6)]
    texts = [None, "", " \t", "a " * 200, "a\n" * 7 + "b", "\u4e2d" * 30]
    for _ in range(60):
        parts = [rng.choice(passages) for _ in range(rng.randint(0, 3))]
        parts = [w for p in parts for w in [*p, *rng.choices(words, k=rng.randint(0, 4))]]
        if parts and rng.random() < 0.5:
            parts[rng.randrange(len(parts))] = rng.choice(words)
        texts.append("".join(w + rng.choice([" ", " ", "\n", " \t "]) for w in parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = with_repeats(df.repartition(3), length=60, words=12)
    assert found.columns == ["doc_id", "text", "repeats", "passages"]
    report = passage_report(F.col("text"), F.col("passages"))
    found = found.select("*", *(c.alias(name) for name, c in report.items()))
    got = {r.doc_id: r for r in found.collect()}
    lists, covered = plain_passages(texts, 12)
    by_bytes = plain([(t or "").encode() for t in texts], 60)
    assert sum(map(bool, covered)) > 20 and sum(not c for c in covered) > 5
    for k, places in enumerate(covered):
        r = got[k]
        assert {p for s in r.passages for p in range(s.start, s.end)} == places
        assert {p for s in r.repeats for p in range(s.start, s.end)} == by_bytes[k]
        assert r.n_passage_words == len(places)
        assert r.n_passages == sum(1 for p in places if p - 1 not in places)
        left = [w for p, w in enumerate(lists[k]) if p not in places]
        if not places:
            assert r.text_without_passages == texts[k]
        else:
            whole = "".join(left)
            assert re.sub("[ \t-\r]", "", r.text_without_passages) == whole
    with pytest.raises(ValueError):
        with_repeats(df, coded=suffix_dedup.word_codes, words=12)


def test_codes_of_words_in_any_step(monkeypatch):
    long = "w" * 150
    text = f"  some {long} words\x0bhere\n{long}x and {long} \u4e2dthere some\r".encode()
    whole = suffix_dedup._codes(text)
    monkeypatch.setattr(suffix_dedup, "_STEP", 200)
    assert suffix_dedup._codes(text) == whole
    monkeypatch.setattr(suffix_dedup, "_STEP", 100)
    codes = np.frombuffer(suffix_dedup._codes(text), np.uint32).tolist()
    assert len(codes) == 10 and codes[1] == codes[6] and codes[0] == codes[9]
    assert len(set(codes)) == 8
    assert suffix_dedup._codes(b"") == suffix_dedup._codes(b" \n") == b""


def test_query_catches_passages_of_over_50_words(query, spark, folder):
    """They are shorter than 400 bytes, so the contract's columns have nothing of them."""
    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(2, 6))) for _ in range(n))

    passages = [prose(51 + k % 6) for k in range(20)]
    short = prose(50)
    own = [prose(120) for _ in range(100)]
    texts = [f"{t} {passages[k // 2]} {prose(30)}" for k, t in enumerate(own[:40])]
    clean = [f"{t} {short}" for t in own[40:50]] + own[50:]
    rows = list(enumerate([*texts, *clean, None, ""]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in query("op6_suffix_array_dedup", folder).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        r = got[k]
        assert (r.n_removed, r.text) == (0, text)
        planted = k < len(texts)
        assert r.n_passages == planted
        assert r.n_passage_words == (len(passages[k // 2].split()) if planted else 0)
        if planted:
            before, after = text.split(passages[k // 2])
            assert r.text_without_passages == before + after
        else:
            assert r.text_without_passages == text
