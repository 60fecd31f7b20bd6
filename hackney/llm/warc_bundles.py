"""WARC records in seekable Zstandard bundles.

Every page becomes one WARC/1.1 record; of records with equal payloads the one
with the smallest id is the response, the others revisit it (payloads below
``min_bytes`` are always responses).  Bundles hold groups of records in
independent frames, an index from record identifier to frame, offset and
length, and a seek table (see `seekable`).  Decompressing a whole bundle gives
a plain WARC file.

Pages are joined to their payload's response id by digest; a payload that a
third of all pages share makes a skewed join, whose page side Spark splits.

Edge cases: a null payload is the empty payload; of pages without an id none
is preferred over one with an id; rows that share the smallest id of a payload
are all responses; url may be null (no target header); an empty table gives no
bundle; columns other than the three named ones are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import open_in, open_out, shared_path, shuffle_partitions, stored, texts
from hackney.llm.seekable import CorruptFile, SeekableReader, SeekableWriter, read_records

BUNDLE_BYTES = 1 << 26         # raw bytes at which a bundle is closed
# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"    # the pages table has no fetch time


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    name = identifier.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def format_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or (``refers_to`` given) a revisit with the
    HTTP header only; the header's Content-Length is the full payload's."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Date", RECORD_DATE), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.insert(2, ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        head[-1:-1] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:] if ": " in line)


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, stored payload), with lengths and, for a
    response, the payload digest checked."""
    if not raw.startswith(VERSION + b"\r\n"):
        raise CorruptFile("not a WARC record")
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = parse_headers(head)
    n = int(warc["Content-Length"])
    if len(rest) != n + 4 or not rest.endswith(b"\r\n\r\n"):
        raise CorruptFile("record length does not match its header")
    http_head, _, payload = rest[:n].partition(b"\r\n\r\n")
    http = parse_headers(http_head)
    if warc["WARC-Type"] == "response" and f"sha1:{sha1_base32(payload)}" != warc["WARC-Payload-Digest"]:
        raise CorruptFile("payload does not match its digest")
    return warc, http, payload


class Bundle:
    def __init__(self, uri: str, frame_bytes: int):
        self.uri = uri
        self.out = SeekableWriter(open_out(uri), frame_bytes)
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, page_id: int | None, record: bytes) -> None:
        self.index.append((record_id(page_id), *self.out.write(record), len(record)))

    def close(self) -> int:
        return self.out.close(json.dumps(self.index).encode())


def open_bundle(uri: str) -> tuple[SeekableReader, list[tuple[str, int, int, int]]]:
    source = open_in(uri)
    reader = SeekableReader(source, source.size())
    return reader, json.loads(reader.index())


def read_record(uri: str, page_id: int | None) -> list[bytes]:
    """The raw records of one page of a bundle, by their frames alone."""
    reader, index = open_bundle(uri)
    found: list[bytes] = []
    read_records(reader, [tuple(x[1:]) for x in index if x[0] == record_id(page_id)], lambda _, raw: found.append(raw))
    return found


def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
         min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to`` (null for a response) for each row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    first = rows.select("page_id", "digest").groupBy("digest").agg(F.min("page_id").alias("first"))
    revisit = (F.octet_length("payload") >= min_bytes) & ~F.col("first").eqNullSafe(F.col("page_id"))
    return (rows.join(first, "digest")
            .select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to")))


def write(pages: DataFrame, root: str | None = None, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_bytes: int = 0, bundle_bytes: int = BUNDLE_BYTES,
          frame_bytes: int = 1 << 18) -> DataFrame:
    """Write the bundles below ``root``; the manifest: ``path, n_records, n_bytes``."""
    spark = pages.sparkSession
    root = root or shared_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done: list[tuple[str, int, int]] = []
        bundle: Bundle | None = None

        def close() -> None:
            done.append((bundle.uri, len(bundle.index), bundle.close()))

        for batch in batches:
            ids, urls, payloads, refers = batch.columns
            for page_id, url, payload, ref in zip(ids.to_pylist(), urls.to_pylist(), texts(payloads), refers.to_pylist(),
                                                  strict=True):
                if bundle is None:
                    bundle = Bundle(f"{name}-{len(done):04d}.warc.zst", frame_bytes)
                bundle.add(page_id, format_record(page_id, url, payload.encode(), ref))
                if bundle.out.bytes_in >= bundle_bytes:
                    close()
                    bundle = None
        if bundle is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)],
                ["path", "n_records", "n_bytes"])

    rows = plan(pages, id_col, url_col, payload_col, min_bytes)
    return stored(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Parse every record of the manifest's bundles: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                reader, index = open_bundle(uri)
                rows: list[tuple] = []

                def take(_: int, raw: bytes, rows=rows) -> None:
                    warc, http, _ = parse_record(raw)
                    ref = warc.get("WARC-Refers-To")
                    rows.append((page_of(warc["WARC-Record-ID"]), int(http["Content-Length"]),
                                 warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"],
                                 None if ref is None else page_of(ref)))

                read_records(reader, [tuple(x[1:]) for x in index], take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    n = shuffle_partitions(manifest.sparkSession)
    return (manifest.select("path").repartition(n, "path")
            .mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))
