"""Archives: round trip, revisits, chunks, broken files."""

import gzip
import hashlib

import pyarrow as pa
import pytest

from jobsluice.llm import warc

PAGES = "page_id bigint, url string, html string, digest string, first_id bigint, payload string"


@pytest.fixture()
def pages(spark):
    long = "<p>é</p>" * 50
    rows = [
        (3, "http://a/1", long),
        (1, "http://a/2\r\nX: y", long),
        (7, None, long),
        (4, "u", "short"),
        (5, "u", "short"),
        (6, "u", None),
        (8, "u", ""),
        (9, "u", "\r\n\r\nWARC/1.1\r\n" * 30),
        (10, "u", "x" * 100),
        (11, "u", "x" * 100),
        (12, "u", "y" * 99),
        (13, "u", "y" * 99),
        (None, "u", long),
        (1, "again", long),
        (20, "u", "ab" * 3_000_000),
    ]
    return spark.createDataFrame([(*r, "x", 0, "p") for r in rows], PAGES), rows


def test_round_trip(pages):
    frame, rows = pages
    got = warc.round_trip(frame.repartition(3)).collect()
    assert all(r["intact"] for r in got)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        copies = sum((h or "") == (html or "") for _, _, h in rows)
        revisit = len(data) >= 100 and copies > 1 and page != first
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == sorted(want, key=repr)


def test_chunks_carry_running_digests(spark, pages, tmp_path, monkeypatch):
    frame, rows = pages
    archives = warc.write_archives(warc.plan_records(frame.where("page_id = 20")), f"file://{tmp_path}/w")
    chunks = sorted(warc.read_chunks(archives, f"file://{tmp_path}/w").collect(), key=lambda r: r["chunk_no"])
    data, digest = b"", hashlib.sha256()
    for k, r in enumerate(chunks):
        data += r["data"]
        digest.update(r["data"])
        assert (r["chunk_no"], r["bytes_so_far"], r["digest_so_far"]) == (k, len(data), digest.hexdigest())
        assert len(r["data"]) <= warc.CHUNK and r["is_last"] == (k == len(chunks) - 1)
    assert data.decode() == rows[-1][2] and len(chunks) == 6


def test_archives_are_plain_warc(spark, pages, tmp_path):
    frame, _ = pages
    archives = warc.write_archives(warc.plan_records(frame.where("page_id in (1, 3)").coalesce(1)), f"file://{tmp_path}/w")
    row = archives.where("n_records > 0").first()
    text = gzip.open(row["path"]).read().decode()
    assert text.count("WARC/1.1\r\n") == 3 and "WARC-Target-URI: http://a/2%0D%0AX:%20y\r\n" in text
    assert "WARC-Refers-To: <urn:page:1>" in text and text.endswith("\r\n\r\n")


def test_cut_archive_is_an_error(tmp_path):
    body = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha256:0\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 50\r\n\r\n"
    record = body + f"Content-Length: {len(http) + 50}\r\n\r\n".encode() + http + b"z" * 20
    source = warc._Inflated(pa.BufferReader(gzip.compress(record)))
    with pytest.raises(ValueError, match="inside a record"):
        list(warc._chunks(source))


def test_many_archives_and_none(spark, pages, empty, monkeypatch):
    frame, rows = pages
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    assert warc.round_trip(frame).count() == len(rows)
    assert warc.round_trip(empty.selectExpr("doc_id as page_id", "text as url", "text as html")).count() == 0
