"""Web archives from and to tables, with oversized payloads as chunk rows.

A payload travels as rows of (record, chunk number, bytes), none longer than a chunk. In the archive the first chunk is a
`response` record and each further one a `continuation` record with its segment number, so neither writer nor reader ever
holds a whole payload. Reading gives the chunk rows back; digests of payloads in several chunks are carried from chunk to
chunk over rows sorted by record and number. Equal payloads are stored once: others are `revisit` records.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import read_blobs, settled, write_blobs

CHUNK_BYTES = 1 << 20
#: Archive files end at the first record beyond so many bytes.
FILE_BYTES = 8 << 20
LEAST_REVISIT = 100
#: Most revisits that are broadcast to the pages; more are joined by a shuffle.
BROADCAST_REVISITS = 1 << 18
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def with_roles(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, html, payload_digest, payload_bytes, refers_to): payloads of `least` bytes or more that a smaller page_id has too refer to it.

    A null html is the empty payload. Rows that repeat page and payload are all responses. A null page_id comes after all others.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body")).withColumns(
        {"payload_digest": F.sha2("body", 256), "payload_bytes": F.length("body").cast("bigint")})
    ids = rows.where(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    first = ids.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    # The pair of id and digest is unique here, so no payload, however common, gathers rows with bodies in one task.
    later = ids.join(first, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    later = later.select(F.coalesce("page_id", F.lit(-1)).alias("_id"), F.col("page_id").isNull().alias("_null"), F.col("payload_digest").alias("_digest"), "refers_to")
    keyed = rows.withColumns({"_id": F.coalesce("page_id", F.lit(-1)), "_null": F.col("page_id").isNull(), "_digest": F.col("payload_digest")})
    later = settled(later, "revisits")
    if later.count() <= BROADCAST_REVISITS:
        later = F.broadcast(later)
    return keyed.join(later, ["_id", "_null", "_digest"], "left").drop("_id", "_null", "_digest")


def record_uri(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}"


def _record(kind: str, uri: str, headers: list[tuple[str, object]], block: bytes | memoryview) -> list[bytes | memoryview]:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{uri}>"), ("WARC-Date", DATE), *headers, ("Content-Type", "application/octet-stream"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return [head.encode(), block]


def _line(value: str) -> str:
    """A header value in one line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def records(page_id, url, body: memoryview, digest: str, refers_to, chunk: int) -> Iterator[list[bytes | memoryview]]:
    """The records of a page: a response and its continuations, or a revisit."""
    uri = record_uri(page_id, digest)
    common = [("X-Page-ID", "" if page_id is None else page_id), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", len(body))]
    if url is not None:
        common.append(("WARC-Target-URI", _line(url)))
    if refers_to is not None:
        yield _record("revisit", uri, [*common, ("WARC-Refers-To", f"<{record_uri(refers_to, digest)}>"), ("X-Refers-To-Page", refers_to),
                                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b"")
        return
    if len(body) <= chunk:
        yield _record("response", uri, common, body)
        return
    for n, lo in enumerate(range(0, len(body), chunk)):
        segment = [("WARC-Segment-Number", n + 1)]
        if n:
            segment.append(("WARC-Segment-Origin-ID", f"<{uri}>"))
        if lo + chunk >= len(body):
            segment.append(("WARC-Segment-Total-Length", len(body)))
        yield _record("continuation" if n else "response", uri if not n else f"{uri}:{n}", common + segment, body[lo : lo + chunk])


def _writer(chunk: int, file_bytes: int):
    def write_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "body", "payload_digest", "refers_to")]
            for page_id, url, body, digest, refers_to in zip(*columns):
                for parts in records(page_id.as_py(), url.as_py(), memoryview(body.as_buffer()), digest.as_py(), refers_to.as_py(), chunk):
                    held += [END, *parts] if held else parts
                    size += sum(map(len, parts))
                    if size >= file_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["warc"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["warc"])

    return write_all


def write(roles: DataFrame, folder: str, chunk: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Archive files of the rows of `with_roles`; no rows, no files with records."""
    write_blobs(roles.mapInArrow(_writer(chunk, file_bytes), "warc binary"), "warc", folder, END.decode())


def parse(content: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of each record of an archive."""
    raw, at = content.obj if isinstance(content.obj, bytes) else None, 0
    while at < len(content):
        # Header lines are short; a window that grows finds their end without copying the archive.
        size, stop = 4096, -1
        while stop < 0:
            window = bytes(content[at : at + size]) if raw is None else raw[at : at + size]
            stop = window.find(END)
            if stop < 0 and at + size >= len(content):
                raise ValueError("a record without an end of its headers")
            size *= 4
        lines = window[:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = at + stop + 4
        end = begin + int(headers["Content-Length"])
        yield headers, content[begin:end]
        at = end + 4


_CHUNK = pa.schema([
    ("record_id", pa.string()), ("chunk_no", pa.int32()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string()), ("data", pa.binary())])
CHUNK_SCHEMA = ("record_id string, chunk_no int, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
                "declared_digest string, data binary")


def _chunks(batches: Iterator[pa.RecordBatch], data: bool) -> Iterator[pa.RecordBatch]:
    """Chunk rows; payloads of one chunk have their digest already, and their bytes only if asked for."""
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for h, block in parse(memoryview(content.as_buffer())):
                origin = h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"])[1:-1]
                declared, page = h["WARC-Payload-Digest"].removeprefix("sha256:"), h["X-Page-ID"]
                revisit, several = h["WARC-Type"] == "revisit", "WARC-Segment-Number" in h
                digest = declared if revisit else None if several else hashlib.sha256(block).hexdigest()
                rows.append((origin, int(h.get("WARC-Segment-Number", 1)), int(page) if page else None, "revisit" if revisit else "response",
                             int(h["X-Refers-To-Page"]) if revisit else None, int(h["X-Payload-Length"]) if revisit else len(block), digest, declared,
                             bytes(block) if data or several else None))
                size += len(block)
                if size >= FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _CHUNK)], schema=_CHUNK)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _CHUNK)], schema=_CHUNK)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """All chunk rows of the archives, with their bytes."""
    return read_blobs(spark, folder).mapInArrow(lambda b: _chunks(b, True), CHUNK_SCHEMA)


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record from chunk rows in order; a digest goes on from chunk to chunk, across batches."""
    key, state, length, first, out = None, None, 0, None, []

    def close() -> None:
        if first is not None:
            out.append({**first, "payload_bytes": length, "payload_digest": state.hexdigest()})

    schema = pa.schema([*(f for f in _CHUNK if f.name != "data"), ("copies", pa.int32())])
    for batch in batches:
        data = batch.column("data")
        for n, row in enumerate(batch.drop_columns(["data"]).to_pylist()):
            if row["record_id"] != key:
                close()
                key, state, length, first = row["record_id"], hashlib.sha256(), 0, row
            block = data[n].as_buffer()
            state.update(block)
            length += len(block)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row per written page: page_id, payload_bytes, payload_digest, record_type, refers_to; lengths and digests are taken from the payloads."""
    rows = read_blobs(spark, folder).mapInArrow(lambda b: _chunks(b, False), CHUNK_SCHEMA)
    whole = rows.where("payload_digest is not null").drop("data")
    cut = rows.where("payload_digest is null")
    # Pages written more than once share their record id: one copy of each chunk is read, and counted.
    key = ["record_id", "chunk_no"]
    once = cut.groupBy(*key).agg(*(F.first(c).alias(c) for c in cut.columns if c not in key), F.count("*").cast("int").alias("copies"))
    ordered = once.repartition("record_id").sortWithinPartitions(*key)
    carried = ordered.mapInArrow(_carried, CHUNK_SCHEMA.replace("data binary", "copies int"))
    carried = carried.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies", "copy")
    return whole.unionByName(carried).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
