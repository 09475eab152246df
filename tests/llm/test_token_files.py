from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from lossmill.llm import token_files
from lossmill.llm.token_files import BLOCK_IDS, Frequencies, read_archive, segments, write_archive
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start long"


def plain(rows):
    """Documents in order of ids, null first: id, start, n_tokens, ids_crc32."""
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def round_trip(spark, folder, rows, **options):
    docs = spark.createDataFrame([(k, t, 5) for k, t in rows], SCHEMA).repartition(3)
    write_archive(docs, f"{folder}/archive", PATH, **options)
    found = read_archive(spark, f"{folder}/archive")
    as_long = found["doc_id"].cast("long").alias("doc_id")
    found = found.select(as_long, "start", "n_tokens", "ids_crc32").orderBy("start")
    return [tuple(r) for r in found.collect()]


@pytest.mark.parametrize("segment_ids", [50, 1 << 20])
def test_archive_against_the_tokenizer(spark, folder, segment_ids):
    rng = random.Random(3)
    words = ["one", "Two", "thrée", "fo-ur", "5", "中", ".", "'s"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for k in range(-20, 120)]
    rows += [(7_000_000_000, "long " * 30_000), (300, None), (301, ""), (None, "no id")]
    rng.shuffle(rows)
    assert round_trip(spark, folder, rows, segment_ids=segment_ids) == plain(rows)


def test_repeated_ids_and_empty_tables(spark, folder):
    rows = [(1, "a b"), (1, "a b"), (2, "c")]
    assert round_trip(spark, folder, rows) == plain(rows)
    assert round_trip(spark, f"{folder}/none", []) == []


def test_query_against_the_tokenizer(query, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = query("op12_token_files", sf_dir).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == plain(docs)


def test_ids_themselves_come_back(spark, folder):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "w")], "doc_id string, text string")
    write_archive(docs, f"{folder}/archive", PATH)
    found = read_archive(spark, f"{folder}/archive", with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(PATH)
    for row, text in zip(found, ("w", "x y z")):
        assert np.frombuffer(row.ids, "<u4").tolist() == [*tokenizer.encode(text).ids, 2]


@pytest.mark.parametrize("n_symbols", [1, 2, 300, 60_000])
def test_coder_round_trip_and_ranges(n_symbols):
    rng = np.random.default_rng(n_symbols)
    skewed = np.minimum(rng.geometric(0.05, 40_000), n_symbols) - 1
    ids = np.concatenate([skewed, rng.integers(0, n_symbols, 3_000)]).astype(np.uint32)
    counts = {k: int(n) for k, n in enumerate(np.bincount(ids)) if n}
    table = Frequencies.of(counts)
    assert table.counts.sum() == 1 << table.bits
    assert Frequencies.from_bytes(table.to_bytes()).counts.tolist() == table.counts.tolist()
    coder = table.coder()
    data = coder.segment(["7", None], [ids[:10], ids[10:]]) + b"\n"
    (part,) = segments(data)
    assert part.doc_ids == ["7", None] and part.lengths == [10, len(ids) - 10]
    for start, end in ((0, len(ids)), (0, 1), (BLOCK_IDS - 1, BLOCK_IDS + 1), (42_999, 43_000), (5, 5)):
        assert (coder.ids_between(part, start, end) == ids[start:end]).all()
    if n_symbols == 300:  # near the entropy of the ids
        share = np.bincount(ids) / len(ids)
        entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
        assert 4 * len(part.words) * 8 < 1.2 * entropy * len(ids) + 10_000


def test_a_changed_byte_is_found():
    ids = np.arange(40_000, dtype=np.uint32) % 50
    coder = Frequencies.of({k: 1 for k in range(50)}).coder()
    data = coder.segment(["1"], [ids]) + b"\n"
    for at in (0, 30, 60, 700, len(data) - 3000):
        broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
        with pytest.raises((ValueError, OverflowError, MemoryError)):
            for part in segments(broken):
                coder.ids_between(part, 0, part.n_ids)
    other = Frequencies.of({k: 1 for k in range(51)}).coder()
    with pytest.raises(ValueError, match="another table"):
        other.ids_between(next(segments(data)), 0, 10)
    with pytest.raises(ValueError, match="without a frequency"):
        coder.segment(["1"], [np.array([50])])


def test_scaled_counts_keep_rare_ids():
    table = Frequencies.of({0: 10**12, 5: 1, 9: 3})
    assert table.counts[5] == 1 and table.counts[9] == 1 and table.counts[1] == 0
    assert table.counts.sum() == 1 << token_files.SCALE_BITS
