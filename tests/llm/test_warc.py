import gzip
import hashlib
from pathlib import Path

from couriermart.llm.warc import read_warc, write_warc

PAGES = "page_id long, url string, html string, payload_digest string"
LONG = "päge\r\n\r\n" * 40


def write(spark, tmp_path, rows, chunk_bytes=64):
    path = str(tmp_path / "archive")
    write_warc(spark.createDataFrame(rows, PAGES), path, chunk_bytes)
    return path


def test_payloads_come_back_whole(spark, tmp_path):
    rows = [
        (1, "http://a/1", "abc\r\n", "clash"), (2, "http://a/2", "\r\n\r\n", None), (3, None, "\r", None),
        (4, "http://a/ü\r\nx y", "", None), (5, "http://a/5", None, None), (None, "http://a/6", LONG, None),
        (7, "http://a/7", "x" * 1000, None), (8, "http://a/8", "\n\r\n\r\n\r" * 30, None), (9, "", "\r\n\r\n\r\n", None),
    ]
    found = {}
    for row in read_warc(spark, write(spark, tmp_path, rows)).collect():
        found.setdefault(row.page_id, []).append(row)
    assert set(found) == {row[0] for row in rows}
    for page_id, _, html, _ in rows:
        chunks = sorted(found[page_id], key=lambda row: row.chunk_no)
        payload = (html or "").encode()
        assert b"".join(bytes(row.chunk) for row in chunks) == payload
        assert [row.chunk_no for row in chunks] == list(range(1, len(chunks) + 1))
        assert all(len(row.chunk) <= 64 for row in chunks)
        assert [row.last for row in chunks] == [False] * (len(chunks) - 1) + [True]
        assert (chunks[-1].payload_bytes, chunks[-1].payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert chunks[0].payload_digest == hashlib.sha256(payload[:64]).hexdigest()


def test_revisits(spark, tmp_path):
    rows = [
        (5, "u", LONG, None), (3, "v", LONG, None), (3, "v", LONG, None), (None, "w", LONG, None),
        (8, "u", "short", None), (9, "u", "short", None), (10, "u", "y" * 99, None), (11, "u", "y" * 99, None),
        (12, "u", "z" * 100, None), (13, "u", "z" * 100, None),
    ]
    read = read_warc(spark, write(spark, tmp_path, rows), chunks=False).collect()
    kinds = [(str(row.page_id), row.record_type, row.refers_to, row.payload_bytes) for row in read]
    size = len(LONG.encode())
    assert sorted(kinds, key=str) == sorted([
        ("3", "response", None, size), ("3", "response", None, size), ("5", "revisit", 3, size), ("None", "revisit", 3, size),
        ("8", "response", None, 5), ("9", "response", None, 5), ("10", "response", None, 99), ("11", "response", None, 99),
        ("12", "response", None, 100), ("13", "revisit", 12, 100),
    ], key=str)
    assert {row.payload_digest for row in read if row.payload_bytes == size} == {hashlib.sha256(LONG.encode()).hexdigest()}


def test_records_follow_the_format(spark, tmp_path):
    path = write(spark, tmp_path, [(1, "http://a/1", "x" * 150, None)])
    (data,) = [gzip.decompress(p.read_bytes()) for p in Path(path).glob("*.gz") if gzip.decompress(p.read_bytes())]
    records = data.split(b"WARC/1.1\r\n")[1:]
    assert len(records) == 3 and all(record.endswith(b"\r\n\r\n") for record in records)
    assert b"WARC-Segment-Number: 1\r\n" in records[0] and b"WARC-Type: continuation" in records[2]
    total = 150 + records[0].split(b"\r\n\r\n", 1)[1].index(b"x" * 64)
    assert f"WARC-Segment-Total-Length: {total}".encode() in records[2]


def test_empty_table(spark, tmp_path):
    assert read_warc(spark, write(spark, tmp_path, [])).count() == 0
