"""WARC archives: write, normalise, read back.

``write_archives`` writes pages as WARC/1.1 records into archives that are one
gzip stream each (the monolithic form some crawlers leave). ``normalise``
inflates each archive once, as a stream, and rewrites every record as a gzip
member of its own, with a sidecar index (offset, length, type, record id per
line) beside it. ``read_records`` then reads single records by their offsets.

Payloads of at least ``LEAST_BYTES`` that occur more than once are stored once:
the record with the smallest page id is the response, the others are revisits
that name its digest and id.

Files go through ``pyarrow.fs`` to the shared folder. A task writes under a
name of its own attempt and moves the file when it is whole; the manifest that
Spark commits names only the files of attempts that succeeded, so a lost
executor leaves at most an orphan that nobody reads.

Defined cases: null html is an empty payload; a null page id never has the
smallest id, so its record is a response unless an equal payload has an id; rows
that repeat an id and payload are each a response if theirs is the smallest id;
null urls have no target header, and control characters in urls are escaped;
an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stored

LEAST_BYTES = 100
#: Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 32 << 20
LEVEL = 4
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")    # the URL name space of RFC 4122
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with payload, digest, record type and the id a revisit refers to.
    Only digests that occur twice are joined back; Spark broadcasts them when
    they are small in bytes and splits hot ones otherwise."""
    rows = (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                         F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
            .withColumn("digest", F.sha2("payload", 256)))
    first = stored(rows.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("digest")
                   .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 and first_id is not null")
                   .select(F.col("digest").alias("d"), "first_id"))
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (rows.join(first, F.col("digest") == F.col("d"), "left")
            .select("page_id", "url", "payload", "digest",
                    F.when(again, "revisit").otherwise("response").alias("record_type"),
                    F.when(again, F.col("first_id")).alias("refers_to")))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str,
           refers_to: int | None) -> bytes:
    """One WARC record. The payload follows an HTTP header; a revisit has the
    header alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}",
                 f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


class _Output:
    """A file that appears under its name only when closed whole."""

    def __init__(self, folder: str, suffix: str):
        from pyarrow import fs
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.path = f"{root}/{self.name}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.path + ".open", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.path + ".open", self.path)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                   level: int = LEVEL) -> DataFrame:
    """The manifest (name, records) of monolithic gzip archives in ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = gz = None
        raw = n = 0
        for batch in batches:
            for i in range(batch.num_rows):
                r = [batch[c][i].as_py() for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to")]
                if out is None:
                    out, gz, raw, n = _Output(folder, ".warc.gz"), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                data = record(*r)
                out.write(gz.compress(data))
                raw, n = raw + len(data), n + 1
                if raw >= archive_bytes:
                    out.write(gz.flush())
                    out.close()
                    yield _manifest(out.name, n)
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield _manifest(out.name, n)

    return stored(records.mapInArrow(run, "name string, records long"))


def _manifest(name: str, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["name", "records"])


class _Inflated:
    """The bytes of a gzip file (of one member or more) as a stream. Input is
    inflated ``CHUNK`` bytes of output at a time, so a highly compressed payload
    takes no more memory than another; consumed bytes are cut off once a chunk,
    so the work grows with the file and not with its records."""

    def __init__(self, source):
        self.source, self.inflate = source, zlib.decompressobj(31)
        self.buffer, self.at, self.pending = bytearray(), 0, b""
        self.largest = 0

    def _more(self) -> bool:
        """Inflate up to CHUNK more bytes; False at the end of the file."""
        while True:
            if self.inflate.eof:
                self.pending = self.inflate.unused_data or self.source.read(CHUNK)
                if not self.pending:
                    return False
                self.inflate = zlib.decompressobj(31)
            elif not self.pending:
                self.pending = self.source.read(CHUNK)
                if not self.pending:
                    if self.at < len(self.buffer) or not self.inflate.eof:
                        raise ValueError("archive ends inside a gzip member")
                    return False
            got = self.inflate.decompress(self.pending, CHUNK)
            self.pending = b"" if self.inflate.eof else self.inflate.unconsumed_tail
            if got:
                if self.at:
                    del self.buffer[:self.at]
                    self.at = 0
                self.buffer += got
                self.largest = max(self.largest, len(self.buffer))
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0                                    # bytes behind ``at`` that hold no mark
        while (i := self.buffer.find(mark, self.at + seen)) < 0:
            seen = max(0, len(self.buffer) - self.at - len(mark) + 1)
            if not self._more():
                if self.at < len(self.buffer):
                    raise ValueError("archive ends inside a record")
                return None
        i += len(mark)
        out = bytes(self.buffer[self.at:i])
        self.at = i
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if self.at == len(self.buffer) and not self._more():
                raise ValueError("archive ends inside a record")
            out = bytes(self.buffer[self.at:self.at + min(n, CHUNK)])
            self.at += len(out)
            n -= len(out)
            yield out


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(x.split(": ", 1) for x in lines[1:] if x)


INDEX = "name string, offset long, length long, type string, record_id string"


def normalise(spark: SparkSession, manifest: DataFrame, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrites each archive of the manifest with a gzip member per record and
    a sidecar index file; returns the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(source)
        for batch in batches:
            for name in batch["name"].to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    stream, out = _Inflated(f), _Output(target, ".warc.gz")
                    lines = []
                    while (head := stream.until(b"\r\n\r\n")) is not None:
                        h, start = headers(head), out.size
                        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                        out.write(gz.compress(head))
                        for data in stream.exactly(int(h["Content-Length"]) + 4):
                            out.write(gz.compress(data))
                        out.write(gz.flush())
                        lines.append((out.name, start, out.size - start, h["WARC-Type"], h["WARC-Record-ID"]))
                    out.close()
                side = _Output(target, ".idx")
                side.name, side_path = f"{out.name}.idx", f"{out.path}.idx"
                side.write("".join(f"{o} {n} {t} {r}\n" for _, o, n, t, r in lines).encode())
                side.out.close()
                side.fs.move(side.path + ".open", side_path)
                cols = list(zip(*lines)) or [[]] * 5
                types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["name", "offset", "length", "type", "record_id"])

    return stored(_spread(spark, manifest).mapInArrow(run, INDEX))


def _spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """An archive per task while there are few, several per task beyond."""
    n = manifest.count()
    return manifest.repartition(max(1, min(n, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Records by their offsets: (page_id, payload_bytes, payload_digest,
    record_type, refers_to[, payload]). Response digests are computed from the
    bytes read, and must agree with their header."""
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * with_payload)
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        name = f = None
        for batch in batches:
            rows, held = [], 0
            for n, offset, length in zip(*(batch[c].to_pylist() for c in ("name", "offset", "length"))):
                if n != name:
                    name, f = n, store.open_input_file(f"{root}/{n}")
                f.seek(offset)
                data = zlib.decompress(f.read(length), 31)
                cut = data.index(b"\r\n\r\n") + 4
                h = headers(data[:cut])
                block = data[cut:cut + int(h["Content-Length"])]
                payload = block[block.index(b"\r\n\r\n") + 4:]
                digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                size = int(h["X-Payload-Length"])
                if h["WARC-Type"] == "response":
                    size, own = len(payload), hashlib.sha256(payload).hexdigest()
                    if own != digest:
                        raise ValueError(f"{n} at {offset}: the payload does not match its digest")
                rows.append((int(h["X-Page-ID"]) if "X-Page-ID" in h else None, size, digest, h["WARC-Type"],
                             int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None, payload))
                held += len(payload) * with_payload
                if held > CHUNK * 16:
                    yield _records(rows, types, with_payload)
                    rows, held = [], 0
            yield _records(rows, types, with_payload)

    return index.mapInArrow(run, schema)


def _records(rows: list, types: tuple, with_payload: bool) -> pa.RecordBatch:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][:5 + with_payload]
    cols = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t, _ in zip(cols, types, names)], names=names)


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                       folder: str | None = None) -> DataFrame:
    """Pages to monolithic archives, normalised, read back by offset."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    manifest = write_archives(planned(pages, page_id, url, html), f"{folder}/monolithic")
    index = normalise(spark, manifest, f"{folder}/monolithic", f"{folder}/records")
    return read_records(index, f"{folder}/records")
