"""Web archives written and read as chunks.

``write_archive`` writes one record for each page: a *response* with the page as payload, or, where an
earlier record has the same payload, a short *revisit* that names it. ``read_archive`` turns archive
files into a table of chunks: record, chunk number, bytes, and the payload's length and SHA-256 so far. A
payload of any size passes through both in pieces of ``CHUNK`` bytes; no record is held whole by
the code here (a page that comes from a table is one cell of a row already).

Which records are responses is found on narrow rows (id, length, digest); the smallest id of each digest
is pre-aggregated in the tasks, so a payload that a third of the pages share costs one row per task.
Pages are then joined by id, which no group of copies makes hot. Files appear complete or not at all; the
manifest names only those of tasks that succeeded.

Defined results: a null page is an empty payload; a null URL is left out of the record; payloads under
``SHARED`` bytes and rows without an id are responses; of equal payloads those with the smallest id are
responses, so repeated rows of that id are as well; an empty table gives no file and no row. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import as_uri, open_folder, prepare, settled, written_file

SHARED = 100  # bytes from which equal payloads are stored once
CHUNK = 1 << 20
FILE_BYTES = 1 << 28  # of compressed records, after which a task begins another file
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"
# Fixed value: the profile of a revisit by payload digest, from the WARC 1.1 specification.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_records long"
CHUNKS = ("record_id string, page_id long, url string, record_type string, refers_to long, chunk long, data binary, "
          "payload_bytes long, payload_digest string, last boolean, valid boolean")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def head(page: dict) -> tuple[bytes, bytes]:
    """Record header and HTTP header of a page's record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['bytes']}\r\n\r\n").encode()
    revisit = page["record_type"] == "revisit"
    fields = [("WARC-Type", page["record_type"]), ("WARC-Record-ID", record_id(page["page_id"], page["digest"])), ("WARC-Date", DATE)]
    if page["url"] is not None:
        fields.append(("WARC-Target-URI", target := quote(page["url"], safe="%/:?#[]@!$&'()*+,;=~")))
        if target != page["url"]:  # no URI as it stands; readers of the chunk table get it back as it was
            fields.append(("X-Page-Url", quote(page["url"], safe="")))
    fields.append(("WARC-Payload-Digest", f"sha256:{page['digest']}"))
    if page["page_id"] is not None:
        fields.append(("X-Page-Id", page["page_id"]))
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(page["refers_to"], page["digest"])),
                   ("X-Refers-To-Page-Id", page["refers_to"])]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", len(http) + (0 if revisit else page["bytes"]))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode(), http


def write_record(out, page: dict, payload: memoryview) -> int:
    """One gzip member; returns its length."""
    packer, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
    parts = [*head(page), *(payload[at:at + CHUNK] for at in range(0, len(payload), CHUNK)), b"\r\n\r\n"]
    for part in parts:
        found = packer.compress(part)
        out.write(found)
        size += len(found)
    found = packer.flush()
    out.write(found)
    return size + len(found)


def verdicts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``digest``, ``record_type`` and ``refers_to``, once for each id and digest."""
    narrow = pages.select("page_id", "bytes", "digest").distinct()
    shared = narrow.where((F.col("bytes") >= SHARED) & F.col("page_id").isNotNull())
    first = shared.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    judged = narrow.join(first.where("n > 1").select("digest", "first"), "digest", "left")
    again = F.col("page_id").isNotNull() & F.col("first").isNotNull() & (F.col("page_id") != F.col("first"))
    return judged.select("page_id", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
                         F.when(again, F.col("first")).alias("refers_to"))


def write_archive(pages: DataFrame, folder: str, key="page_id", url="url", html="html") -> DataFrame:
    """Writes the files and returns their manifest, one row each."""
    prepare(pages.sparkSession)
    uri = as_uri(folder)
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("bytes"), F.sha2("payload", 256).alias("digest"))
    judged = verdicts(rows).withColumnsRenamed({"page_id": "v_id", "digest": "v_digest"})
    # Ids and digests together name a row of `verdicts`; a null id equals a null id.
    joined = rows.join(judged, F.col("page_id").eqNullSafe(F.col("v_id")) & (F.col("digest") == F.col("v_digest")))
    body = F.when(F.col("record_type") == "response", F.col("payload"))
    joined = joined.select("page_id", "url", "bytes", "digest", "record_type", "refers_to", body.alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"pages-{TaskContext.get().partitionId():06d}"
        batch, at, done = next(batches, None), 0, []
        while batch is not None:
            if at == batch.num_rows:
                batch, at = next(batches, None), 0
                continue
            size = n = 0
            with written_file(uri, f"{name}-{len(done):04d}.warc.gz") as (out, path):
                while batch is not None and size < FILE_BYTES:
                    payloads = batch.column("payload")
                    for at, page in enumerate(batch.drop_columns(["payload"]).slice(at).to_pylist(), at):
                        cell = payloads[at].as_buffer()
                        size += write_record(out, page, memoryview(cell) if cell is not None else memoryview(b""))
                        n += 1
                        if size >= FILE_BYTES:
                            break
                    at += 1
                    if at == batch.num_rows:
                        batch, at = next(batches, None), 0
            done.append((path, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["file", "n_records"])

    return settled(joined.mapInArrow(write, MANIFEST), "archive-manifest")


class Unpacked:
    """The decompressed bytes of a file of gzip members, read a piece at a time."""

    def __init__(self, stream):
        self.stream, self.unpack, self.packed, self.held = stream, None, b"", bytearray()

    def more(self) -> bool:
        """Adds at most about CHUNK bytes to ``held``; False at the end of the file."""
        while True:
            if not self.packed:
                self.packed = self.stream.read(1 << 16)
                if not self.packed:
                    if self.unpack is not None:
                        raise EOFError("the archive ends inside a record")
                    return False
            if self.unpack is None:
                self.unpack = zlib.decompressobj(31)
            found = self.unpack.decompress(self.packed, CHUNK)
            self.packed = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.packed, self.unpack = self.unpack.unused_data, None
            if found:
                self.held += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        begin = 0
        while (at := self.held.find(mark, begin)) < 0:
            begin = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise EOFError("the archive ends inside a header")
                return None
        found = bytes(self.held[:at])
        del self.held[:at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        """1 to ``n`` bytes."""
        if not self.held and not self.more():
            raise EOFError("the archive ends inside a record")
        found = bytes(self.held[:n])
        del self.held[:n]
        return found


def fields(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])}


def chunks(stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """The rows of ``CHUNKS`` of an archive file; an empty payload and a revisit are one row without data."""
    source = Unpacked(stream)
    while (block := source.until(b"\r\n\r\n")) is not None:
        about = fields(block)
        http = source.until(b"\r\n\r\n")
        left = int(about["content-length"]) - len(http) - 4
        number = lambda name: int(about[name]) if name in about else None
        address = unquote(about["x-page-url"]) if "x-page-url" in about else about.get("warc-target-uri")
        known = (about["warc-record-id"], number("x-page-id"), address, about["warc-type"], number("x-refers-to-page-id"))
        stated = about["warc-payload-digest"].removeprefix("sha256:")
        if about["warc-type"] == "revisit":
            yield (*known, 0, None, int(fields(http)["content-length"]), stated, True, True)
        else:
            digest, size, place = hashlib.sha256(), 0, 0
            while left or not place:
                data = b""
                while left and len(data) < chunk:
                    part = source.take(min(left, chunk - len(data)))
                    data += part
                    left -= len(part)
                digest.update(data)
                size += len(data)
                so_far = digest.hexdigest()
                yield (*known, place, data, size, so_far, not left, bool(left) or so_far == stated)
                place += 1
        for end in (b"\r\n", b"\r\n"):
            if source.until(end) != b"":
                raise ValueError("a record is longer than its header says")


def read_archive(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of the manifest's files; a file is one task's work. Without data, only each record's last row."""
    uri, spark = as_uri(folder), manifest.sparkSession
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(uri)
        for batch in batches:
            for path in batch.column("file").to_pylist():
                with fs.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for row in chunks(stream, chunk):
                        if with_data or row[-2]:
                            rows.append(row if with_data else (*row[:6], None, *row[7:]))
                            size += len(rows[-1][6] or b"") + 200
                        if size > 4 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = manifest.select("file").collect()  # one short row for each file of up to FILE_BYTES
    if not files:
        return spark.createDataFrame([], CHUNKS)
    dealt = spark.createDataFrame(spark.sparkContext.parallelize(files, len(files)), "file string")
    return dealt.mapInArrow(read, CHUNKS)
