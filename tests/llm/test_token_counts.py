from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from lossmill.llm.token_counts import RULES, attributed, byte_places, count_tokens, encoder, line_sections

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def plain(ends, sections, rule):
    """Byte by byte."""
    counts, outside, start = [0.0] * len(sections), 0.0, 0
    for end in ends:
        owners = [
            next((k for k, (a, b) in enumerate(sections) if a <= p < b), None) for p in range(start, end)
        ]
        given = {"start": owners[:1], "most": [max(dict.fromkeys(owners), key=owners.count)]}.get(rule, owners)
        for k in given:
            if k is None:
                outside += 1 / len(given)
            else:
                counts[k] += 1 / len(given)
        start = end
    return counts, outside


@pytest.mark.parametrize("rule", RULES)
def test_interval_join_against_bytes(rule):
    rng = random.Random(rule)
    for _ in range(300):
        ends = np.cumsum([rng.randint(1, 5) for _ in range(rng.randint(0, 10))], dtype=np.int64)
        size = int(ends[-1]) if len(ends) else 0
        cuts = sorted(rng.randint(0, size) for _ in range(2 * rng.randint(0, 4)))
        sections = np.array(cuts, np.int64).reshape(-1, 2)
        per, outside = attributed(ends, sections, rule)
        expected, rest = plain(ends.tolist(), sections.tolist(), rule)
        assert per == pytest.approx(expected) and outside == pytest.approx(rest)


def test_lines_and_places():
    assert line_sections("") == [(0, 0)]
    assert line_sections("a\n\nb") == [(0, 2), (2, 3), (3, 4)]
    assert line_sections("a\n") == [(0, 2)]
    assert byte_places("éaß", np.array([0, 1, 2, 3])).tolist() == [0, 2, 3, 5]


def test_edges_and_given_sections(spark):
    rows = [
        (1, "Über\n\n\nden Tag", [(0, 4), (6, 8)]),
        (1, "Über\n\n\nden Tag", None),
        (None, None, [(0, 9)]),
        (2, "", []),
        (3, "word " * 100_000, None),
    ]
    schema = "doc_id long, text string, section array<struct<start:long,end:long>>"
    df = spark.createDataFrame(rows, schema)
    got = count_tokens(df, PATH, PATTERN, sections=df["section"], rule="split").collect()
    for doc in {r.doc_id for r in got}:
        held = [r for r in got if r.doc_id == doc]
        total = sum(r.n_tokens for r in held)
        assert total == pytest.approx(sum({r.doc_tokens for r in held}) * (2 if doc == 1 else 1))
    assert [r.n_tokens for r in got if r.doc_id is None] == [0.0]
    assert not [r for r in got if r.doc_id == 2]
    assert count_tokens(df.limit(0), PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        count_tokens(df, PATH, PATTERN, rule="other")


def test_query_against_the_encoder(query, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {(r.doc_id, r.section): r for r in query("op7_token_counts", sf_dir).collect()}
    encode = encoder(PATH, PATTERN).ends
    for doc, text in docs[:60]:
        ends = encode(text).tolist()
        assert ends[-1] == len(text.encode())
        spans = [tuple(x) for x in byte_places(text, np.array(line_sections(text))).tolist()]
        for k, n in enumerate(plain(ends, spans, "most")[0] if len(ends) < 2000 else []):
            assert got[doc, k].n_tokens == n
        assert {got[doc, k].doc_tokens for k in range(len(spans))} == {len(ends)}
    assert {d for d, _ in got} == {d for d, _ in docs}
