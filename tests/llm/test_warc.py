import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.session import scratch_dir


def brute(rows):
    first = {}
    body = [(i, (h or "").encode()) for i, _, h in rows]
    for i, b in body:
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    return sorted(((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if b in first and i != first[b] else "response", first[b] if b in first and i != first[b] else None) for i, b in body), key=str)


ROWS = [
    (5, "http://a/é x\r\ny", "p" * 150), (2, None, "p" * 150), (2, None, "p" * 150), (9, "http://b", "q" * 99), (1, "http://c", "q" * 99), (3, "u", ""), (4, "u", None), (None, "u", "p" * 150),
    (7, "u", "ä\r\n\r\nWARC/1.1\r\n" * 300), (8, "u", "long " * 900), (8, "u", "long " * 900), (10, "u", "long " * 900), (11, "u", "漢" * 700), (None, "n", "z" * 120)]


@pytest.mark.parametrize(("chunk", "size", "bound"), [(64, 300, 0), (1 << 20, 8 << 20, 1 << 18)])
def test_round_trip(spark, monkeypatch, chunk, size, bound):
    monkeypatch.setattr(warc, "BROADCAST_REVISITS", bound)
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").repartition(3).withColumn("body", F.lit("clash"))
    folder = scratch_dir(spark, "warc")
    warc.write(warc.with_roles(pages), folder, chunk, size)
    assert sorted(map(tuple, warc.read(spark, folder).collect()), key=str) == brute(ROWS)
    chunks = [r for r in warc.read_chunks(spark, folder).collect() if r.page_id == 7]
    assert b"".join(bytes(r.data) for r in sorted(chunks, key=lambda r: r.chunk_no)).decode() == ROWS[8][2]
    assert all(len(r.data) <= chunk for r in chunks)


def test_archives_are_well_formed(spark):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").coalesce(1)
    folder = scratch_dir(spark, "warc")
    warc.write(warc.with_roles(pages), folder, 500)
    for r in spark.read.format("binaryFile").load(folder).where("length > 0").collect():
        content = bytes(r.content)
        assert content.startswith(b"WARC/1.1\r\n") and content.endswith(b"\r\n\r\n")
        kinds = [h["WARC-Type"] for h, _ in warc.parse(memoryview(content))]
        assert set(kinds) <= {"response", "continuation", "revisit"}


def test_empty_table(spark):
    folder = scratch_dir(spark, "warc")
    warc.write(warc.with_roles(spark.createDataFrame([], "page_id bigint, url string, html string")), folder)
    assert warc.read(spark, folder).count() == 0
