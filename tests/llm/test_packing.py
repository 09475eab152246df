from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from lossmill.llm.encoding import encoder
from lossmill.llm.packing import WINDOW, closest_fill, pack, plan_windows
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = encoder(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=400, deadline=None)
@given(
    st.one_of(
        st.text(max_size=40),
        st.text(alphabet="abS's.-́éßİΣ \n\t\x1c1<|>", max_size=40),
    )
)
def test_chunks_give_the_ids_of_the_text(text):
    got = np.frombuffer(ENCODER.encode(text), "<u4").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_special_strings_and_documents_give_the_same_ids(spark, sf_dir):
    texts = ["a<|endoftext|>b c", "It's we'll x're", "<|startoftext|>", "ÉtÉ é"]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in texts:
        got = np.frombuffer(ENCODER.encode(text), "<u4").tolist()
        assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_closest_fill_is_best():
    rng = random.Random(7)
    for _ in range(300):
        counts = {rng.randint(1, 12): rng.randint(0, 3) for _ in range(4)}
        capacity = rng.randint(0, 30)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        used = closest_fill(counts, capacity)
        assert all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= capacity)


def check_sequences(pieces, window):
    """Gapless, at most one window long, and of a size that needs no padding."""
    by_sequence = defaultdict(list)
    for sequence, offset, length in pieces:
        by_sequence[sequence].append((offset, length))
    for held in by_sequence.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end and length > 0
            end += length
        assert end == window or end.bit_count() == 1 and end < window
    return by_sequence


def test_plan_places_every_rest_once():
    rng = random.Random(8)
    for window in (16, 24, 64):
        for _ in range(40):
            counts = {rng.randint(1, window - 1): rng.randint(1, 40) for _ in range(rng.randint(0, 9))}
            plan = plan_windows(counts, window)
            pieces = []
            for length, n in counts.items():
                for k in range(n):
                    got = plan.place(length, k)
                    assert [s for s, *_ in got] == np.cumsum([0, *(x[1] for x in got[:-1])]).tolist()
                    assert sum(x[1] for x in got) == length
                    pieces += [(seq, off, size) for _, size, seq, off in got]
            found = check_sequences(pieces, window)
            assert set(found) == set(range(plan.next_sequence))


def assert_packed(rows, docs, window):
    check_sequences([(r.sequence_id, r.offset, r.length) for r in rows], window)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc_id, texts in docs.items():
        expected = [ids_of(t) for t in texts]
        held = sorted(by_doc.pop(doc_id), key=lambda r: r.start)
        assert sum(r.length for r in held) == sum(map(len, expected))
        if len(texts) == 1:
            at = 0
            for r in held:
                part = np.array(expected[0][r.start : r.start + r.length], "<u4").tobytes()
                assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(expected[0]))
                at += r.length
    assert not by_doc


def test_query_against_the_tokenizer(query, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert_packed(query("op2_packing", sf_dir).collect(), {r.doc_id: [r.text] for r in docs}, WINDOW)


def test_edges(spark):
    rows = [
        (1, "a b c", 5),
        (1, "a b c", 6),
        (None, "x y", 7),
        (2, None, 8),
        (3, "", 9),
        (4, "word " * 5000, 10),
        (5, "z " * 31, 11),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long").repartition(3)
    docs = defaultdict(list)
    for i, t, _ in rows:
        docs[i].append(t)
    got = pack(df, PATH, window=32)
    assert_packed(got.collect(), docs, 32)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    with_ids = pack(df, PATH, window=32, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 or r.length < 32 for r in with_ids)
    assert all(len(r.ids) == 4 * r.length for r in with_ids)
    assert pack(df.limit(0), PATH).count() == 0
