"""WARC archives as chunked record tables.

Writing: each task streams its rows into gzip archives in a shared folder, one gzip member a record,
and starts another archive when one is full. The tasks return the list of archives they finished;
only listed archives count, so that a repeated or failed task leaves nothing that is read.

Reading: each archive is inflated block by block. A record becomes rows of record identifier, chunk
number and at most ``CHUNK`` bytes, each with the digest and length of the payload so far, so that
the last chunk carries those of the whole payload. No task holds more than a few chunks, however
long a record is.

Records with the same payload of at least 100 bytes are written once: the one with the smallest id is
the response, the others are revisits that name it.

Defined results: a NULL payload is empty, a NULL url is left out, rows that repeat the smallest id are
all responses, NULL ids are revisits of any id and responses if no row has one. An empty table writes
no archive. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored
from jobsluice.session import scratch_path

CHUNK = 1 << 20
ARCHIVE_BYTES = 64 << 20
REVISIT_BYTES = 100
#: Bytes of chunks that are handed on at once.
HAND_ON = 4 << 20
#: Tasks that read archives at most; each takes its archives one after the other.
READERS = 10_000

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_ROWS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_length", pa.int64()),
        ("stated_digest", pa.string()),
        ("chunk_no", pa.int64()),
        ("data", pa.binary()),
        ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()),
        ("is_last", pa.bool_()),
    ]
)
CHUNK_SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_length bigint, "
    "stated_digest string, chunk_no bigint, data binary, bytes_so_far bigint, digest_so_far string, is_last boolean"
)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to`` (NULL for responses) per row."""
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= REVISIT_BYTES).select("page_id", "digest")
    copies = long.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    copies = stored(copies.where("n > 1").drop("n"), "warc-copies")
    rows = rows.join(copies, "digest", "left")
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.withColumn("refers_to", F.when(revisits, F.col("first_id"))).drop("first_id")


def _urn(value) -> str:
    return f"<urn:page:{'none' if value is None else value}>"


def page_of(urn: Column) -> Column:
    """The id inside a record identifier, as text."""
    inner = F.regexp_extract(urn, r"^<urn:page:(.*)>$", 1)
    return F.nullif(inner, F.lit("none"))


def _clean(uri: str) -> str:
    """No control characters or spaces in a header line."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in uri)


def _header(row: dict, size: int) -> bytes:
    """The WARC header and the HTTP header of a record."""
    revisit = row["refers_to"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(row['page_id'])}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else size)}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['url'])}")
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write ``records`` (see ``plan_records``) below ``folder``; ``path``, ``n_records``, ``n_bytes`` per archive."""

    def write(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        done, out, written, records = [], None, 0, 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{base}/{stem}-{len(done):05d}.warc.gz", records, written))
                out = None

        for batch in batches:
            payloads = batch.column("payload").cast(pa.large_binary())
            narrow = batch.drop_columns(["payload"]).to_pylist()
            for i, row in enumerate(narrow):
                if out is not None and written >= ARCHIVE_BYTES:
                    close()
                if out is None:
                    out = files.open_output_stream(f"{base}/{stem}-{len(done):05d}.warc.gz", compression=None)
                    written = records = 0
                data = memoryview(payloads[i].as_buffer())
                packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                parts = [_header(row, len(data))]
                if row["refers_to"] is None:
                    parts += [data[at : at + CHUNK] for at in range(0, len(data), CHUNK)]
                for part in [*parts, b"\r\n\r\n"]:
                    written += out.write(packer.compress(part))
                written += out.write(packer.flush())
                records += 1
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["path", "n_records", "n_bytes"],
        )

    return stored(records.mapInArrow(write, "path string, n_records bigint, n_bytes bigint"), "warc-archives")


class _Inflated:
    """The bytes of a multi-member gzip stream, a bounded number at a time."""

    def __init__(self, stream):
        self.stream, self.packed, self.plain = stream, b"", b""
        self.member = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self.member.eof:
                self.packed = self.member.unused_data
                self.member = zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.stream.read(CHUNK)
                if not self.packed:
                    return False
            part = self.member.decompress(self.packed, CHUNK)
            self.packed = self.member.unconsumed_tail
            if part:
                self.plain += part
                return True

    def read(self, n: int) -> bytes:
        """Between 1 and ``n`` bytes, none at the end."""
        if not self.plain and not self._more():
            return b""
        out, self.plain = self.plain[:n], self.plain[n:]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.plain) < n and self._more():
            pass
        if len(self.plain) < n:
            raise ValueError("archive ends inside a record")
        return self.read(n)

    def header(self) -> list[str]:
        """Lines up to and without the empty one; none at the end of the archive."""
        while (end := self.plain.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.plain:
                    raise ValueError("archive ends inside a header")
                return []
        lines, self.plain = self.plain[:end], self.plain[end + 4 :]
        return lines.decode().split("\r\n")


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}


def _chunks(source: _Inflated):
    """Chunk rows of one archive, in order."""
    while lines := source.header():
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:80]!r}")
        warc = _fields(lines)
        http_lines = source.header()
        http = _fields(http_lines)
        head = sum(len(line.encode()) + 2 for line in http_lines) + 2
        left = int(warc["content-length"]) - head
        row = {
            "record_id": warc["warc-record-id"],
            "record_type": warc["warc-type"],
            "target_uri": warc.get("warc-target-uri"),
            "refers_to": warc.get("warc-refers-to"),
            "payload_length": int(http["content-length"]),
            "stated_digest": warc["warc-payload-digest"].removeprefix("sha256:"),
        }
        digest, done, number = hashlib.sha256(), 0, 0
        while True:
            data = source.exactly(min(CHUNK, left))
            left -= len(data)
            done += len(data)
            digest.update(data)
            yield row | {
                "chunk_no": number,
                "data": data,
                "bytes_so_far": done,
                "digest_so_far": digest.hexdigest(),
                "is_last": left == 0,
            }
            number += 1
            if not left:
                break
        if source.exactly(4) != b"\r\n\r\n":
            raise ValueError(f"record {row['record_id']} does not end where its header says")


def read_chunks(archives: DataFrame, folder: str) -> DataFrame:
    """The chunk table of listed archives (``path``), as ``CHUNK_SCHEMA``.

    A record without payload, as a revisit, has one chunk of no bytes.
    """

    def read(batches):
        files, _ = pyarrow.fs.FileSystem.from_uri(folder)
        held, size = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(path, compression=None) as stream:
                    for row in _chunks(_Inflated(stream)):
                        held.append(row)
                        size += len(row["data"]) + 200
                        if size >= HAND_ON:
                            yield pa.RecordBatch.from_pylist(held, CHUNK_ROWS)
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, CHUNK_ROWS)

    readers = max(1, min(READERS, archives.count()))
    return archives.select("path").repartition(readers, "path").mapInArrow(read, CHUNK_SCHEMA)


def digests(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: ids as text, ``payload_bytes``, ``payload_digest``, ``intact``.

    A revisit has no payload of its own; its length and digest are those that it states.
    """
    full = F.col("record_type") != "revisit"
    last = chunks.where("is_last")
    return last.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(full, F.col("bytes_so_far")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.col("digest_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
        (~full | ((F.col("digest_so_far") == F.col("stated_digest")) & (F.col("bytes_so_far") == F.col("payload_length"))))
        .alias("intact"),
    )


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write all rows of ``pages`` as records, read the archives back, one row per record."""
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write_archives(plan_records(pages, page_id, url, payload), folder)
    kind = dict(pages.dtypes)[page_id]
    rows = digests(read_chunks(archives, folder))
    return rows.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
