"""Web archives: distributed writing and reading of WARC records as chunk rows.

A payload crosses every Python task as rows of a record id and a chunk number.
Writer and reader keep one chunk, a running digest and a running length; neither
ever holds a record as a whole.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, text_or_empty
from millrace.session import fresh_dir
from millrace.sources.archives import open_file

CHUNK_BYTES = 16 << 10
SPLIT_BYTES = 8 << 20
FILE_BYTES = 1 << 30
READ_BYTES = 256 << 10
HEAD_LIMIT = 1 << 20
REVISIT_BYTES = 1000
WRITE_DATE = "2000-01-01T00:00:00Z"
RECORD_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

#: Fixed values of the WARC 1.0 and HTTP formats.
VERSION = "WARC/1.0"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = b"\r\n\r\n"

MANIFEST = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("records", pa.int64())])
MANIFEST_DDL = "path string, start bigint, end bigint, records bigint"
CHUNKS_DDL = (
    "record_id string, page_id bigint, url string, record_type string, refers_to_id string, chunk_no bigint, chunk binary, "
    "bytes_so_far bigint, digest_so_far string, declared_digest string, is_last boolean"
)
CHUNKS = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string()),
    ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
    ("declared_digest", pa.string()), ("is_last", pa.bool_()),
])


def record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(RECORD_SPACE, f'page:{page_id}').urn}>"


def _open_new(path: str):
    """Writer for a new file in the shared folder, whatever store holds it."""
    if path.startswith("file:") or "://" not in path:
        local = "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    return system.open_output_stream(name)


def _header(row: dict) -> bytes:
    body = 0 if row["record_type"] == "revisit" else row["payload_bytes"]
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(row["page_id"])), ("WARC-Date", WRITE_DATE),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(HTTP_HEAD) + body),
    ]
    if row["page_id"] is not None:
        fields.append(("X-Page-Id", row["page_id"]))
    if row["url"] is not None:
        plain = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["url"])
        fields.append(("WARC-Target-URI", plain))
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(row["refers_to"]))]
    return "".join([f"{VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


class _Files:
    """Compressed records of one task, in files of limited size, with the places where reading may start."""

    def __init__(self, folder: str):
        self.folder, self.file, self.gzip = folder, None, None
        self.path, self.at, self.start, self.records = "", 0, 0, 0

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def begin(self, head: bytes) -> None:
        if self.file is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            self.file, self.at, self.start = _open_new(self.path), 0, 0
        self.gzip = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._put(self.gzip.compress(head))

    def add(self, data: bytes) -> None:
        self._put(self.gzip.compress(data))

    def finish(self, last: bool = False) -> list[tuple]:
        """Close the record; the finished split, if one is full."""
        self._put(self.gzip.compress(END) + self.gzip.flush())
        self.records += 1
        return self.split() if self.at - self.start >= SPLIT_BYTES else []

    def split(self) -> list[tuple]:
        done = [(self.path, self.start, self.at, self.records)] if self.records else []
        self.start, self.records = self.at, 0
        if self.at >= FILE_BYTES:
            self.close()
        return done

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, digest, declared = _Files(folder), None, ""
        for batch in batches:
            done: list[tuple] = []
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    files.begin(_header(row) + HTTP_HEAD)
                    digest, declared = hashlib.sha1(), row["payload_digest"]
                files.add(row["chunk"])
                digest.update(row["chunk"])
                if row["chunk_no"] == row["last_chunk"]:
                    if row["record_type"] != "revisit" and digest.hexdigest() != declared:
                        raise ValueError(f"chunks of record {row['page_id']} do not give its digest")
                    done += files.finish()
            if done:
                yield _rows(MANIFEST, done)
        if rest := files.split():
            yield _rows(MANIFEST, rest)
        files.close()

    return write


def record_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Each page as ``page_id``, ``url``, ``payload``, its length and digest, and its record type.

    Of equal payloads of at least 1000 bytes the largest id is the response.
    Ids and digests alone are grouped; only payloads that occur twice are joined.
    """
    payload = text_or_empty(F.col(f"`{html}`"))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"),
    )
    large = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
    first = materialize(
        large.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
        .select(F.col("payload_digest").alias("shared_digest"), "first"),
        "shared-payloads",
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, F.col("payload_digest") == F.col("shared_digest"), "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _chunk_rows(records: DataFrame) -> DataFrame:
    size = F.lit(CHUNK_BYTES)

    def pieces(data: Column) -> Column:
        count = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, size))

    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("payload")).cast("binary")
    split = records.withColumn("pieces", F.transform(F.array(body), pieces)[0])
    fixed = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", (F.size("pieces") - 1).alias("last_chunk")]
    return split.select(*fixed, F.posexplode("pieces").alias("chunk_no", "chunk"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write one WARC record per row of ``record_roles`` below ``folder``; return the written manifest.

    Each record is a gzip member of its own. Every task writes new files and names
    them in its manifest rows; those of a task that was lost or repeated are in
    no manifest, so each record is in it exactly once.
    """
    return materialize(_chunk_rows(records).mapInArrow(_writer(folder), MANIFEST_DDL), "warc-manifest")


class _Stream:
    """Decompressed bytes of gzip members between two places of a file, with bounded look-ahead."""

    def __init__(self, file, start: int, end: int):
        self.file, self.left = file, end - start
        self.gzip, self.raw, self.data = zlib.decompressobj(31), b"", b""
        file.seek(start)

    def _more(self) -> bool:
        if self.gzip.eof:
            self.raw, self.gzip = self.gzip.unused_data, zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.file.read(min(READ_BYTES, self.left))
            self.left -= len(self.raw)
            if not self.raw:
                return False
        self.data += self.gzip.decompress(self.raw, READ_BYTES)
        self.raw = self.gzip.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with the mark; empty at the end."""
        while (at := self.data.find(mark)) < 0:
            if len(self.data) > HEAD_LIMIT:
                raise ValueError("a record header does not end")
            if not self._more():
                return b""
        found, self.data = self.data[: at + len(mark)], self.data[at + len(mark):]
        return found

    def take(self, most: int) -> bytes:
        """Exactly ``most`` bytes, a chunk at a time."""
        while len(self.data) < most:
            if not self._more():
                raise EOFError("an archive ends inside a record")
        found, self.data = self.data[:most], self.data[most:]
        return found


def _records(stream: _Stream, with_data: bool) -> Iterator[tuple]:
    while head := stream.until(END):
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)
        left = int(fields["Content-Length"]) - len(stream.until(END))
        digest, number, total = hashlib.sha1(), 0, 0
        page = fields.get("X-Page-Id")
        while True:
            chunk = stream.take(min(left, CHUNK_BYTES))
            left -= len(chunk)
            total += len(chunk)
            digest.update(chunk)
            yield (
                fields["WARC-Record-ID"], int(page) if page is not None else None, fields.get("WARC-Target-URI"), fields["WARC-Type"],
                fields.get("WARC-Refers-To"), number, chunk if with_data else None, total, digest.hexdigest(),
                fields["WARC-Payload-Digest"].removeprefix("sha1:"), left == 0,
            )
            number += 1
            if not left:
                break
        if stream.take(len(END)) != END:
            raise ValueError("a record does not end where its length says")


def _reader(with_data: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                rows: list[tuple] = []
                with open_file(split["path"]) as file:
                    for row in _records(_Stream(file, split["start"], split["end"]), with_data):
                        if with_data or row[-1]:
                            rows.append(row)
                        if len(rows) >= 500:
                            yield _rows(CHUNKS, rows)
                            rows = []
                if rows:
                    yield _rows(CHUNKS, rows)

    return read


def read_chunks(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunk table: a row per record and chunk with the length and SHA-1 so far.

    The last chunk of a record has those of the whole payload. Without data only
    these last rows come back, and no payload leaves the reading task.
    """
    tasks = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return manifest.repartition(tasks).mapInArrow(_reader(with_data), CHUNKS_DDL)


def resolve(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk; a revisit takes its length from the response it refers to.

    ``intact`` says that the bytes read have the digest the record declares, for
    a revisit that its response has it.
    """
    records = materialize(
        chunks.where("is_last").select("record_id", "page_id", "record_type", "refers_to_id", "bytes_so_far", "digest_so_far", "declared_digest"),
        "warc-records",
    )
    responses = materialize(
        records.where(F.col("record_type") == "response").groupBy("record_id").agg(
            F.max("page_id").alias("of_page"), F.max("bytes_so_far").alias("of_bytes"), F.max("digest_so_far").alias("of_digest")
        ),
        "warc-responses",  # written, so that the join below can split a response that most records refer to
    )
    read = records.alias("r").join(responses.alias("o"), F.col("r.refers_to_id") == F.col("o.record_id"), "left")
    digest = F.coalesce("of_digest", "digest_so_far")
    return read.select(
        "page_id", F.coalesce("of_bytes", "bytes_so_far").alias("payload_bytes"), digest.alias("payload_digest"), "record_type",
        F.col("of_page").alias("refers_to"), (digest == F.col("declared_digest")).alias("intact"),
    )


def archive_and_read(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages to archives, read these back and return a row per record.

    Null payloads are empty; empty and small ones are responses. Rows that repeat
    the largest id of a payload are responses too. A row with a null id revisits
    another page or, if every equal payload has a null id, is a response. An empty
    table writes nothing and gives no rows. Other columns are not read.
    """
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    return resolve(read_chunks(write_archives(record_roles(pages, page_id, url, html), folder), with_data=False))
