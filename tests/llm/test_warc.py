from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random

import pytest
from lossmill.llm.warc import (
    body_of,
    chunked,
    dechunked,
    gunzipped,
    parsed,
    read_records,
    reassemble,
    record,
    response_records,
    round_trip,
    write_archives,
)


def test_framing_round_trip():
    rng = random.Random(9)
    for n in (0, 1, 7, 8, 9, 100):
        body = rng.randbytes(n)
        assert dechunked(chunked(body, 8)) == body
    assert dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            dechunked(broken)
    assert body_of(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == b"plain"


def test_parse_in_any_pieces():
    """A payload that looks like records changes nothing: the length decides."""
    payload = b"\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n" * 3
    records = list(response_records("<urn:a>", payload, 50, url="u\r\nX: y", page="1", digest="d"))
    data = b"".join(r + b"\r\n\r\n" for r in records)
    packed = gzip.compress(data[:100]) + gzip.compress(data[100:])
    for step in (1, 7, 1000):
        pieces = [data[k : k + step] for k in range(0, len(data), step)]
        blocks = [block for _, block in parsed(pieces)]
        assert body_of(b"".join(blocks)) == payload
    assert b"".join(gunzipped(packed, 11)) == data == b"".join(gunzipped(data, 11))
    with pytest.raises(ValueError):
        list(parsed([data[:-10]]))
    with pytest.raises(ValueError):
        list(gunzipped(packed[:-20]))


def pages(spark):
    rows = [
        (5, "u5", "same", "x"),
        (3, "u3", "same", "x"),
        (3, "u3", "same", "x"),
        (None, "n", "same", None),
        (1, None, None, "x"),
        (2, "u2", "", "x"),
        (9, "é", "é\x00\r\n\r\n" * 3000, "x"),
        (7, "solo", "solo", "x"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def described(rows):
    return sorted((tuple(r) for r in rows), key=str)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.mark.parametrize("segment_bytes", [64, 1000, 1 << 20])
def test_round_trip_and_edges(spark, segment_bytes):
    got = round_trip(pages(spark), segment_bytes=segment_bytes, records_per_file=3)
    long = "é\x00\r\n\r\n" * 3000
    assert described(got.collect()) == described(
        [
            (3, 4, digest("same"), "response", None),
            (3, 4, digest("same"), "revisit", 3),
            (5, 4, digest("same"), "revisit", 3),
            (None, 4, digest("same"), "revisit", 3),
            (1, 0, digest(""), "response", None),
            (2, 0, digest(""), "revisit", 1),
            (9, len(long.encode()), digest(long), "response", None),
            (7, 4, digest("solo"), "response", None),
        ]
    )


def test_small_payloads_are_no_revisits(spark):
    got = round_trip(pages(spark), revisit_bytes=1).where("payload_bytes = 0")
    assert {r.record_type for r in got.collect()} == {"response"}
    assert round_trip(pages(spark).limit(0)).count() == 0


def test_payloads_come_back_exactly(spark, folder):
    write_archives(pages(spark), f"{folder}/w", segment_bytes=100)
    got = reassemble(read_records(spark, f"{folder}/w")).where("type = 'response'").collect()
    expected = {r.html or "" for r in pages(spark).collect()}
    assert {r.payload.decode() for r in got} == expected
    assert not [r.error for r in got if r.error]


def test_faults_are_named(spark, folder):
    good = list(response_records("<urn:a>", b"x" * 300, 100, page="1"))
    assert len(good) > 3
    archives = {
        "missing": good[:1] + good[2:],
        "twice": good + good[1:2],
        "total": [*good[:-1], good[-1].replace(b"Length: 3", b"Length: 9")],
        "orphans": good[1:],
        "framing": [record(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nqq", type="response", record_id="<b>")],
    }
    for name, records in archives.items():
        path = f"{folder}/{name}.warc"
        with open(path, "wb") as f:
            f.write(b"".join(r + b"\r\n\r\n" for r in records))
        (row,) = reassemble(read_records(spark, path)).collect()
        assert row.payload is None and row.error, name


def test_files_are_bounded_by_bytes(spark, folder):
    write_archives(pages(spark), f"{folder}/w", segment_bytes=100, file_bytes=1000)
    files = glob.glob(f"{folder}/w/part-*")
    assert len(files) > 20
    for name in files:
        with gzip.open(name) as f:
            assert f.read().count(b"WARC/1.1\r\n") <= 10
