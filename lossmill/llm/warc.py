"""WARC archives: write pages as records, read them back and put segments together again.

A response holds an HTTP message with a chunked body. A block longer than ``segment_bytes`` is cut:
the first record has segment number 1, the rest are continuation records that name it as origin,
and the last of them gives the total length. Reading groups continuation records by origin, orders
them by number, checks numbers and total length, and takes the chunks apart.

Spark's text writer writes the archives: a record is a row, and its line separator is the double
line end that closes a WARC record. So the files go where Spark's file systems lead, through its
commit protocol, and a lost executor leaves no half files. ``segment_bytes`` bounds a record, and
records per file are as many as ``file_bytes`` can hold for certain, which bounds what a reader
holds at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill.llm.common import broadcast_if_small, stored
from lossmill.sinks.scratch import scratch_path

SEGMENT_BYTES = 1 << 20
CHUNK_BYTES = 1 << 12
RECORDS_PER_FILE = 4_000
#: What the blocks of a file add up to at most; a reader holds a file at a time.
FILE_BYTES = 256 << 20

_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_HTTP += b"Transfer-Encoding: chunked" + _END
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"

_HEADERS = {
    "type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "url": "WARC-Target-URI",
    "digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "segment": "WARC-Segment-Number",
    "origin": "WARC-Segment-Origin-ID",
    "total": "WARC-Segment-Total-Length",
    "page": "X-Page-ID",
}
_RECORD_SCHEMA = ", ".join(f"{name} string" for name in _HEADERS) + ", block binary"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32: forty bits of the hex digest give eight letters."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)
    ]
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.concat(*parts), digits, letters)


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = [body[at : at + size] for at in range(0, len(body), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0" + _END


def dechunked(framed: bytes) -> bytes:
    """Body of a chunked message; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = end + 2
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it says")
        out.append(framed[at : at + size])
        at += size + 2


def body_of(block: bytes) -> bytes:
    """Body of the HTTP message in a block."""
    head, found, body = block.partition(_END)
    if not found:
        raise ValueError("no end of the HTTP headers")
    fields = dict(_fields(head))
    return dechunked(body) if b"chunked" in fields.get(b"transfer-encoding", b"").lower() else body


def _fields(head: bytes) -> Iterator[tuple[bytes, bytes]]:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        yield name.strip().lower(), value.strip()


def record(block: bytes, **headers: str | None) -> bytes:
    """A record without the double line end that follows it. Line ends in values become spaces."""
    lines = ["WARC/1.1", f"WARC-Date: {_DATE}"]
    for name, value in headers.items():
        if value is not None:
            lines.append(f"{_HEADERS[name]}: {' '.join(value.splitlines())}")
    if headers["type"] == "response":
        lines.append("Content-Type: application/http;msgtype=response")
    if headers["type"] == "revisit":
        lines.append(f"WARC-Profile: {_SAME_PAYLOAD}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _END + block


def response_records(
    record_id: str, payload: bytes, segment_bytes: int, **headers: str | None
) -> Iterator[bytes]:
    block = _HTTP + chunked(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    cut = len(parts) > 1
    yield record(
        parts[0], type="response", record_id=record_id, segment="1" if cut else None, **headers
    )
    for k, part in enumerate(parts[1:], 2):
        yield record(
            part,
            type="continuation",
            record_id=f"{record_id[:-1]}:{k}>",
            origin=record_id,
            segment=str(k),
            total=str(len(block)) if k == len(parts) else None,
        )


def parsed(data: Iterable[bytes]) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers and block of each record of an archive that comes in pieces."""
    held, source = b"", iter(data)
    while True:
        while (end := held.find(_END)) < 0:
            more = next(source, None)
            if more is None:
                if held.strip():
                    raise ValueError("an archive ends within a record")
                return
            held = (held + more).lstrip(b"\r\n") if not held.strip() else held + more
        head = held[:end]
        if not head.lstrip().startswith(b"WARC/"):
            raise ValueError(f"no record begins with {head[:40]!r}")
        fields = dict(_fields(head.lstrip()))
        pieces, have = [held[end + 4 :]], len(held) - end - 4
        need = int(fields[b"content-length"]) + 4
        while have < need:
            more = next(source, None)
            if more is None:
                raise ValueError("an archive ends within a block")
            pieces.append(more)
            have += len(more)
        held = b"".join(pieces)
        yield fields, held[: need - 4]
        held = held[need:]


def gunzipped(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Content in pieces; several members may follow each other; other data comes as it is."""
    if data[:2] != b"\x1f\x8b":
        yield from (data[at : at + step] for at in range(0, len(data), step))
        return
    while data:
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = member.decompress(data, step)
            data = member.unconsumed_tail or member.unused_data
            if not piece and not member.eof and not data:
                raise ValueError("an archive ends within a compressed member")
            yield piece


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write a record per page below ``path``.

    Of pages with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest id
    is a response and the others are revisits that refer to it (also one that repeats its id);
    smaller payloads are always responses. A null payload is empty, a null id comes last. Other
    columns are not read; an empty table gives an archive without records.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = stored(
        pages.select(
            F.col(id_col).cast("string").alias("page"),
            F.col(id_col).alias("order"),
            F.col(url_col).cast("string").alias("url"),
            payload.alias("payload"),
            base32_sha1(payload).alias("digest"),
            F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("record_id"),
        ),
        "warc-pages",
    )
    large = rows.where(F.length("payload") >= revisit_bytes)
    first = F.min(F.struct(F.col("order").isNull(), "order", "record_id"))
    groups = large.groupBy("digest").agg(F.count("*").alias("n"), first.alias("first"))
    groups = groups.where("n > 1").select("digest", F.col("first.record_id").alias("first"))
    # A digest and a record id: 200 bytes with all that a row adds.
    groups = broadcast_if_small(stored(groups, "warc-groups"), 200)
    rows = rows.join(groups, "digest", "left").select(
        "page", "url", "payload", "digest", "record_id",
        F.when(
            (F.length("payload") >= revisit_bytes) & (F.col("first") != F.col("record_id")),
            F.col("first"),
        ).alias("refers_to"),
    )
    records = rows.mapInArrow(_records(segment_bytes), "record binary")
    (
        records.select(F.col("record").cast("string"))
        .write.option("lineSep", _END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, min(records_per_file, file_bytes // segment_bytes)))
        .text(path)
    )


def _records(segment_bytes: int):
    def records(tables):
        for t in tables:
            for at in range(0, t.num_rows, 256):
                out = []
                for row in t.slice(at, 256).to_pylist():
                    payload, refers_to = row.pop("payload"), row.pop("refers_to")
                    if refers_to is not None:
                        out.append(record(b"", type="revisit", refers_to=refers_to, **row))
                    else:
                        row |= {"payload": payload, "segment_bytes": segment_bytes}
                        out.extend(response_records(**row))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return records


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, as it stands: its headers and its block."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def read(tables):
        names = [name.lower().encode() for name in _HEADERS.values()]
        for t in tables:
            for content in t.column(0):
                rows, size = [], 0
                for fields, block in parsed(gunzipped(content.as_py())):
                    values = [fields[n].decode() if n in fields else None for n in names]
                    rows.append([*values, block])
                    size += len(block)
                    if size > 8 << 20:
                        yield _record_batch(rows)
                        rows, size = [], 0
                yield _record_batch(rows)

    return files.mapInArrow(read, _RECORD_SCHEMA)


def _record_batch(rows: list) -> pa.RecordBatch:
    names = [*_HEADERS, "block"]
    columns = list(zip(*rows)) or [()] * len(names)
    kinds = [pa.string()] * len(_HEADERS) + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def reassemble(records: DataFrame) -> DataFrame:
    """Responses and revisits: ``record_id``, ``type``, ``url``, ``page``, ``digest`` (as written),
    ``refers_to``, ``payload``, ``error``.

    ``payload`` is the decoded body, null for a revisit and where ``error`` says what is wrong: a
    segment that is missing or comes twice, a total length that differs, broken framing.
    Continuations without their first record give a row with an error as well.
    """
    meta = ["record_id", "type", "url", "page", "digest", "refers_to"]
    whole = records.where("segment is null and type in ('response', 'revisit')").select(
        *meta, F.array(_part(F.lit(1), F.lit(None))).alias("parts")
    )
    part = _part(F.col("segment"), F.col("total"))
    cut = records.where("segment is not null").withColumn("key", F.coalesce("origin", "record_id"))
    own = F.when(F.col("origin").isNull(), F.struct(*meta))
    joined = cut.groupBy("key").agg(F.collect_list(part).alias("parts"), F.max(own).alias("own"))
    joined = joined.select(
        F.col("key").alias("record_id"), *(F.col(f"own.{c}").alias(c) for c in meta[1:]), "parts"
    )

    @F.arrow_udf("struct<payload:binary,error:string>")
    def decoded(kinds: pa.Array, parts: pa.Array) -> pa.Array:
        rows = [_decoded(k.as_py(), p.as_py()) for k, p in zip(kinds, parts)]
        names = pa.struct([("payload", pa.binary()), ("error", pa.string())])
        return pa.array([{"payload": p, "error": e} for p, e in rows], names)

    both = whole.unionByName(joined).withColumn("read", decoded("type", "parts"))
    return both.select(*meta, "read.payload", "read.error")


def _part(number: Column, total: Column) -> Column:
    return F.struct(
        number.cast("int").alias("n"), total.cast("long").alias("total"), F.col("block")
    )


def _decoded(kind: str | None, parts: list[dict]) -> tuple[bytes | None, str | None]:
    parts = sorted(parts, key=lambda p: p["n"])
    numbers = [p["n"] for p in parts]
    if kind is None:
        return None, "continuations without a first record"
    if numbers != list(range(1, len(parts) + 1)):
        return None, f"segments {numbers}"
    block = b"".join(p["block"] for p in parts)
    totals = [p["total"] for p in parts if p["total"] is not None]
    if len(parts) > 1 and totals != [len(block)]:
        return None, f"{len(block)} bytes, total length {totals}"
    if kind == "revisit":
        return None, None
    try:
        return body_of(block), None
    except ValueError as fault:
        return None, str(fault)


def page_records(responses: DataFrame) -> DataFrame:
    """One row per record of ``reassemble``: ``page``, ``payload_bytes`` and ``payload_digest`` of
    the full payload, ``record_type``, ``refers_to`` (the page of the response).

    A record with an error, or whose payload has another digest than it says, ends the job.
    """
    digest = base32_sha1(F.col("payload"))
    fault = F.coalesce("error", F.when(digest != F.col("digest"), F.lit("another digest")))
    checked = F.when(
        fault.isNotNull(),
        F.raise_error(F.concat(F.lit("record "), F.col("record_id"), F.lit(": "), fault)),
    ).otherwise(F.length("payload").cast("long"))
    seen = responses.select(
        "record_id", "page", "type", "refers_to", checked.alias("bytes"), digest.alias("sha1")
    )
    seen = stored(seen, "warc-records")
    full = seen.where("type = 'response'").select("record_id", "page", "bytes", "sha1")
    again = seen.where("type = 'revisit'").alias("r").join(
        full.alias("f"), F.col("r.refers_to") == F.col("f.record_id")
    )
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = full.select("page", "bytes", "sha1", F.lit("response"), F.lit(None).cast("string"))
    later = again.select("r.page", "f.bytes", "f.sha1", F.lit("revisit"), "f.page")
    return first.toDF(*names).unionByName(later.toDF(*names))


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write ``pages`` to new archives in the shared folder, read these and describe each page."""
    path = scratch_path(pages.sparkSession, "warc-archives") + "/archives"
    write_archives(pages, path, id_col, **options)
    found = page_records(reassemble(read_records(pages.sparkSession, path)))
    kind = pages.schema[id_col].dataType
    return found.select(
        F.col("page").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
