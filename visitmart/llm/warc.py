"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding some whole WARC records, and ends with the seek
table of the seekable format (a skippable frame with each frame's compressed and plain size), so that any
standard tool reads it from the start and a reader that seeks decompresses one frame. An index maps each record
identifier to its frame and its place within the frame's plain bytes.

Bundles are rows of a Parquet table (``bundle``, ``content``, ``records``), written by Spark's committer: any
store will do, and what a lost task had written never shows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import join_spread, materialize

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLES = "bundle string, content binary, records array<struct<record_id: string, frame: int, offset: int, length: int>>"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    name = identifier[len("<urn:page:") : -1]
    return None if name == "none" else int(name)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the length of the payload that it leaves out."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _line(url) if url else record_id(page_id)[1:-1]),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[3:3] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that begins at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:stop].decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    headers = dict(x.split(": ", 1) for x in lines)
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, data[begin:end], end + 4


class BundleWriter:
    """Collects records into frames, and frames into one bundle."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.size = 0
        self.records: list[tuple[str, int, int, int]] = []

    def add(self, identifier: str, data: bytes) -> None:
        self.records.append((identifier, len(self.frames), self.filled, len(data)))
        self.open.append(data)
        self.filled += len(data)
        if self.filled >= self.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.frames.append(packed)
            self.sizes.append((len(packed), self.filled))
            self.size += len(packed)
            self.open, self.filled = [], 0

    def bundle(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the bundle's footer."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end")
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", bundle[len(bundle) - 9 - 8 * n : len(bundle) - 9]):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(bundle: bytes, frame: int) -> bytes:
    at, packed, plain = seek_table(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + packed], max_output_size=plain)


def archive(
    pages: DataFrame, min_revisit_bytes: int = 0, frame_bytes: int = 1 << 18, bundle_bytes: int = 8 << 20,
    level: int = 3, date: str = "1970-01-01T00:00:00Z", max_broadcast: int = 500_000,
) -> DataFrame:
    """The bundles of ``pages`` (page_id, url, html), in the schema ``BUNDLES``, not yet written.

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes, that with the smallest page_id is a
    response and the others revisit it; rows that share that id are responses. Null html is an empty payload; a
    null page_id is never the smallest unless there is no other, and then all its records are responses. Ids are whole
    numbers; rows that share one have equal record ids, as nothing else tells them apart.
    """
    # a payload's key is its digest; only digests are shuffled to find those that several pages have
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = keyed.withColumn("key", F.unhex(F.sha1(F.col("html").cast("binary"))))
    copies = keyed.groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    copies = materialize(copies, "copies")
    if copies.count() <= max_broadcast:
        rows = keyed.join(F.broadcast(copies), "key", "left")
    else:
        rows = join_spread(keyed, copies, ["key"], "page_id", "left", keys=keyed.select("key", "page_id"))
    rows = rows.select("page_id", "url", "html", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, out = TaskContext.get().partitionId(), 0, BundleWriter(frame_bytes, level)
        entry = pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])

        def flush() -> pa.RecordBatch:
            nonlocal n, out
            places = [[dict(zip(entry.names, r, strict=True)) for r in out.records]]
            row = [pa.array([f"{task:06d}-{n:06d}.warc.zst"]), pa.array([out.bundle()], pa.binary()), pa.array(places, pa.list_(entry))]
            n, out = n + 1, BundleWriter(frame_bytes, level)
            return pa.RecordBatch.from_arrays(row, ["bundle", "content", "records"])

        for batch in batches:
            for page, url, html, smallest in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first")], strict=True):
                payload = html.encode("utf-8")
                revisit = smallest is not None and page != smallest and len(payload) >= min_revisit_bytes
                out.add(record_id(page), record(page, url, payload, smallest, revisit, date))
                if out.size >= bundle_bytes:
                    yield flush()
        if out.records:
            yield flush()

    return rows.mapInArrow(write, BUNDLES)


def digests(bundles: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record, read from the archives.
    Each response's payload is held against its digest, and each record against its place in the index."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, records in zip(batch.column("content").to_pylist(), batch.column("records").to_pylist(), strict=True):
                out, now, plain = [], -1, b""
                for r in records:
                    if r["frame"] != now:
                        now, plain = r["frame"], read_frame(content, r["frame"])
                    headers, block, end = parse(plain, r["offset"])
                    if headers["WARC-Record-ID"] != r["record_id"] or end != r["offset"] + r["length"]:
                        raise ValueError(f"the index misses record {r['record_id']}")
                    head, payload = block.split(b"\r\n\r\n", 1)
                    size = int(head.rsplit(b"Content-Length: ", 1)[1])
                    sha = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload) != size or digest(payload) != sha):
                        raise ValueError(f"damaged payload in record {r['record_id']}")
                    refers = page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None
                    out.append((page_of(r["record_id"]), size, sha, kind, refers))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names)

    return bundles.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def fetch(bundles: DataFrame, page_ids: list[int]) -> DataFrame:
    """(page_id, payload): the stored payloads of some responses; of each bundle that holds one, only the frames
    that hold one are decompressed. A revisit has no payload of its own: fetch the page that it refers to."""
    wanted = [record_id(p) for p in page_ids]
    hits = bundles.withColumn("records", F.filter("records", lambda r: r["record_id"].isin(wanted))).where(F.size("records") > 0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, records in zip(batch.column("content").to_pylist(), batch.column("records").to_pylist(), strict=True):
                pages, payloads = [], []
                for r in records:
                    headers, block, _ = parse(read_frame(content, r["frame"]), r["offset"])
                    if headers["WARC-Type"] == "response":
                        pages.append(page_of(r["record_id"]))
                        payloads.append(block.split(b"\r\n\r\n", 1)[1])
                yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(payloads, pa.binary())], ["page_id", "payload"])

    return hits.mapInArrow(read, "page_id long, payload binary")


def archive_digests(pages: DataFrame, **settings) -> DataFrame:
    """Writes the archives of ``pages`` into the shared folder, reads them back and returns :func:`digests`.
    One row for each row of ``pages``, repeated ones too; an empty table gives an empty result; columns other
    than page_id, url and html are not read."""
    return digests(materialize(archive(pages, **settings), "warc"))


DIGESTS_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS smallest FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           ((instr('0123456789abcdef', substr(s, 1 + CAST(5 * i // 4 AS INTEGER), 1)) - 1) * 16
             + greatest(instr('0123456789abcdef', substr(s, 2 + CAST(5 * i // 4 AS INTEGER), 1)) - 1, 0))
           >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31 AS INTEGER), 1) for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id <> smallest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> smallest THEN smallest END AS refers_to
FROM f
"""
