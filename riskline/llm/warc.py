"""WARC archives through a chunked record table.

A payload is handled as rows (record identifier, chunk number, bytes) of at most CHUNK bytes;
digests and lengths are carried from chunk to chunk, so no step after the source row holds a
whole record. Writing: one pass over the chunks gives each payload's length and SHA-1; equal
payloads are resolved by a grouped maximum (the largest page_id is the response, the others
revisit it); a header row per record and the chunk rows are dealt out by page_id and payload, ordered and
streamed into gzip members, one per record. Files are named by a fresh identifier per task
attempt and count only if the attempt's rows reach the manifest, so retries and lost executors
leave no half record. Reading: the manifest's segments (byte ranges of whole records) are
dealt out, decompressed piece by piece and parsed to chunk rows again; the last chunk row of a
record carries its length and digest.

Archives lie in the shared checkpoint folder and are reached by pyarrow's file systems (local
and shared folders, hdfs, s3, gcs).

Defined results: null payloads are empty; rows equal in page_id and payload are a record each, of
the same type; a null page_id is written with an empty identifier and never is the target of a revisit;
an empty table gives empty archives and an empty result; page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from functools import partial
from typing import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm.common import small_batches, stored
from riskline.session import checkpoint_path

CHUNK = 1 << 16
SEGMENT = 1 << 22       # compressed bytes that one reading step covers
FILE_BYTES = 1 << 28
END = b"\r\n\r\n"

CHUNK_ROWS = ("page_id long, record_type string, refers_to long, chunk_no long, last boolean, "
              "payload_bytes long, payload_digest string, digest_ok boolean, data binary")


def digest_text(h) -> str:
    return base64.b32encode(h.digest()).decode()


def payload_chunks(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """page_id, tag (hash of the payload), url, row, chunk_no, last, data. ``row`` tells rows apart
    that are equal in page_id and payload."""
    p = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                     F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("p"))
    n = F.greatest(F.ceil(F.octet_length("p") / chunk), F.lit(1)).cast("int")
    p = p.withColumn("tag", F.xxhash64("p")).withColumn("n", n)
    p = p.select("row", "page_id", "tag", "url", "p", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("chunk_no"))
    return p.select("page_id", "tag", "url", "row", F.col("chunk_no").cast("long").alias("chunk_no"),
                    (F.col("chunk_no") == F.col("n") - 1).alias("last"),
                    F.substring("p", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per payload from its chunk rows, which follow each other in a task."""
    h, size = hashlib.sha1(), 0
    for b in batches:
        out = []
        for page, tag, url, last, data in zip(*(b[c] for c in ("page_id", "tag", "url", "last", "data"))):
            x = data.as_buffer()
            h.update(x)
            size += x.size
            if last.as_py():
                first = int.from_bytes(h.digest()[:8], "big", signed=True)
                out.append((page.as_py(), tag.as_py(), url.as_py(), size, digest_text(h), first))
                h, size = hashlib.sha1(), 0
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["page_id", "tag", "url", "payload_bytes", "payload_digest", "d0"])


def decide(chunks: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, tag, url, payload_bytes, payload_digest, record_type, refers_to."""
    rows = stored(chunks.select("page_id", "tag", "url", "last", "data").mapInArrow(
        _digests, "page_id long, tag long, url string, payload_bytes long, payload_digest string, d0 long"), "payloads") \
        .groupBy("page_id", "tag", "payload_bytes", "payload_digest", "d0").agg(F.min("url").alias("url"))
    first = rows.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy("d0", "payload_digest") \
        .agg(F.max("page_id").alias("response"))
    # joined on the complement: through an exchange of its own, which can be split
    key = F.bitwise_not("d0").alias("d0")
    j = rows.select("page_id", "tag", "url", "payload_bytes", "payload_digest", key).join(
        first.select(key, "payload_digest", "response"), ["d0", "payload_digest"], "left")
    other = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id")) \
        & (F.col("payload_bytes") >= min_revisit_bytes)
    return j.select("page_id", "tag", "url", "payload_bytes", "payload_digest",
                    F.when(other, "revisit").otherwise("response").alias("record_type"),
                    F.when(other, F.col("response")).alias("refers_to"))


def _record_id(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _head(row: dict) -> bytes:
    """WARC and HTTP header of a record."""
    revisit = row["record_type"] == "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    uri = "".join(c for c in row["url"] if c not in "\r\n")
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", _record_id(row["page_id"])),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", "sha1:" + row["payload_digest"]),
              ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _record_id(row["refers_to"]))]
    fields.append(("Content-Length", str(len(http) + (0 if revisit else row["payload_bytes"]))))
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


class _Writer:
    """Streams records into gzip members; notes segments of whole records."""

    def __init__(self, base: str):
        self.fs, self.base = fs.FileSystem.from_uri(base)
        self.out = None
        self.segments: list[tuple[str, int, int]] = []

    def begin(self, head: bytes) -> None:
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out, self.at, self.segment = self.fs.open_output_stream(f"{self.base}/{self.name}", compression=None), 0, 0
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.put(self.member.compress(head))

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def chunk(self, data) -> None:
        self.put(self.member.compress(data))

    def end(self) -> None:
        self.put(self.member.compress(END) + self.member.flush())
        if self.at - self.segment >= SEGMENT:
            self.cut()
        if self.at >= FILE_BYTES:
            self.close()

    def cut(self) -> None:
        if self.at > self.segment:
            self.segments.append((self.name, self.segment, self.at))
            self.segment = self.at

    def close(self) -> None:
        if self.out is not None:
            self.cut()
            self.out.close()
            self.out = None


def _write(batches: Iterator[pa.RecordBatch], base: str) -> Iterator[pa.RecordBatch]:
    """Rows ordered by page_id, tag, row, chunk_no. Row -1 is the header of all records of its
    page_id and tag; each chunk 0 begins one."""
    w = _Writer(base)
    header, begun = None, False
    for b in batches:
        data = b["data"]
        head = b.drop_columns(["data"]).to_pylist()
        for i, row in enumerate(head):
            if row["row"] < 0:
                header = row
                continue
            if row["chunk_no"] == 0:
                if begun:
                    w.end()
                w.begin(_head(header))
                begun = True
            if header["record_type"] != "revisit":
                w.chunk(data[i].as_buffer())
    if begun:
        w.end()
    w.close()
    if w.segments:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*w.segments)], names=["name", "start", "end"])


def write_archives(pages: DataFrame, base: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` below ``base``; the manifest (name, start, end)."""
    spark = pages.sparkSession
    small_batches(spark, 200)
    target, path = fs.FileSystem.from_uri(base)
    target.create_dir(path, recursive=True)
    chunks = payload_chunks(pages)
    heads = decide(chunks, min_revisit_bytes)
    none = lambda t: F.lit(None).cast(t)
    no = F.lit(-1).cast("long")
    rows = heads.select("page_id", "tag", no.alias("row"), no.alias("chunk_no"), "record_type",
                        "payload_bytes", "payload_digest", "refers_to", "url", none("binary").alias("data")) \
        .union(chunks.select("page_id", "tag", "row", "chunk_no", none("string"), none("long"), none("string"),
                             none("long"), none("string"), "data"))
    # by page and payload, so rows without a page_id are spread by their payloads
    dealt = rows.repartition("page_id", "tag").sortWithinPartitions("page_id", "tag", "row", "chunk_no")
    return stored(dealt.mapInArrow(partial(_write, base=base), "name string, start long, end long"), "manifest")


class _Reader:
    """Decompressed bytes of a segment, a piece at a time."""

    def __init__(self, source, start: int, end: int):
        self.source, self.left = source, end - start
        source.seek(start)
        self.member, self.raw, self.buffer = zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Get the next piece into the buffer; False at the segment's end."""
        while True:
            if self.member.eof:
                self.raw, self.member = self.member.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(min(CHUNK, self.left))
                self.left -= len(self.raw)
                if not self.raw:
                    return False
            got = self.member.decompress(self.raw, CHUNK)
            self.raw = b"" if self.member.eof else self.member.unconsumed_tail
            if got:
                self.buffer += got
                return True

    def head(self) -> bytes | None:
        """Up to and without the next empty line."""
        while (at := self.buffer.find(END)) < 0:
            if not self.more():
                return None
        out, self.buffer = self.buffer[:at], self.buffer[at + len(END):]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.more():
                raise EOFError("archive ends within a record")
            out, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(out)
            yield out


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in
            (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def _page(record_id: str) -> int | None:
    number = record_id.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _records(r: _Reader, keep_data: bool) -> Iterator[tuple]:
    """Chunk rows of all records of a segment."""
    while (head := r.head()) is not None:
        f = _fields(head)
        http = r.head()
        length = int(f["content-length"]) - len(http) - len(END)
        page, kind = _page(f["warc-record-id"]), f["warc-type"]
        target = _page(f["warc-refers-to"]) if kind == "revisit" else None
        declared = f["warc-payload-digest"].partition(":")[2]
        if kind == "revisit":
            yield page, kind, target, 0, True, int(_fields(http)["content-length"]), declared, None, None
        else:
            h, size, no = hashlib.sha1(), 0, 0
            pieces = r.pieces(length)
            while True:
                data = next(pieces, b"")
                h.update(data)
                size += len(data)
                last = size == length
                if last or keep_data:
                    digest = digest_text(h)
                    yield (page, kind, target, no, last, size, digest, digest == declared if last else None,
                           data if keep_data else None)
                no += 1
                if last:
                    break
        for _ in r.pieces(len(END)):
            pass


def _read(batches: Iterator[pa.RecordBatch], base: str, keep_data: bool) -> Iterator[pa.RecordBatch]:
    target, path = fs.FileSystem.from_uri(base)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [x.split()[0] for x in CHUNK_ROWS.split(", ")]
    for b in batches:
        for s in b.to_pylist():
            with target.open_input_file(f"{path}/{s['name']}") as source:
                rows: list[tuple] = []
                for row in _records(_Reader(source, s["start"], s["end"]), keep_data):
                    rows.append(row)
                    if len(rows) == 100:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_archives(manifest: DataFrame, base: str, keep_data: bool = True) -> DataFrame:
    """The chunked record table: rows of CHUNK_ROWS. payload_bytes and payload_digest are
    those of the payload up to and with the chunk (of the full payload for revisits). Without
    ``keep_data`` only each record's last row comes, without its bytes."""
    spread = manifest.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(partial(_read, base=base, keep_data=keep_data), CHUNK_ROWS)


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write all pages, read the archives back: one row per record."""
    base = checkpoint_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    manifest = write_archives(pages, base, min_revisit_bytes)
    return read_archives(manifest, base, keep_data=False).filter("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")
