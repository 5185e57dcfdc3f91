"""WARC archives in seekable Zstandard bundles.

Records of a bundle are grouped into independent Zstandard frames; a skippable frame at the end holds
the seek table (the public seekable format), and an index maps each record, by its page id, to its frame
and its offset within the frame. Bundles are written as rows (bundle_id, content, index), so that Spark's
commit protocol makes a repeated task harmless on any store; export_bundle() gives the bytes as a file.

Of records with equal payloads of at least `min_bytes`, that with the largest id is the response and
the others are revisits that refer to it.

Cases: a null payload is empty; a null url is an empty target; a null id is written as no id, never
becomes the response of a group with other ids and is read back as null; rows repeated under the
largest id are all responses; an empty table gives no bundle; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, salted_left_join, slices

MIN_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"  # of records whose time of capture is not known
FRAME_BYTES = 256 << 10  # of records before compression
BUNDLE_BYTES = 8 << 20  # of compressed frames
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the Zstandard seekable format
BUNDLE_SCHEMA = "bundle_id string, content binary, index array<struct<record:long, page_id:long, frame:int, offset:int, length:int>>"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def with_refers(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for responses."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha1(html).alias("digest"), F.octet_length(html).alias("len"))
    groups = rows.filter(F.col("len") >= min_bytes).groupBy("digest", "len").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    groups = materialize(groups, "warc-groups")
    joined = salted_left_join(rows, groups, ["digest", "len"], F.xxhash64("page_id"))
    return joined.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to"))


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if refers_to is not None else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class BundleWriter:
    """Collects records into frames and closes them with a seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3) -> None:
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[dict] = []
        self.open, self.open_bytes, self.packed = [], 0, 0

    def add(self, record: bytes, page_id: int | None = None) -> None:
        if self.open and self.open_bytes + len(record) > self.frame_bytes:
            self._close_frame()
        self.index.append({"record": len(self.index), "page_id": page_id, "frame": len(self.frames), "offset": self.open_bytes, "length": len(record)})
        self.open.append(record)
        self.open_bytes += len(record)

    def _close_frame(self) -> None:
        frame = self.packer.compress(b"".join(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), self.open_bytes))
        self.packed += len(frame)
        self.open, self.open_bytes = [], 0

    def finish(self) -> tuple[bytes, list[dict]]:
        if self.open:
            self._close_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table, self.index


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, out = len(content) - 9 - n * width, []
    start = 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", content, at + i * width)
        out.append((start, packed, plain))
        start += packed
    return out


def read_record(content: bytes, frame: int, offset: int, length: int) -> bytes:
    """One record by its place, reading its frame only."""
    start, packed, plain = seek_table(content)[frame]
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=max(plain, 1))[offset : offset + length]


def parse_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        size, found = len(body), hashlib.sha1(body).hexdigest()
        if found != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To", "")), "payload": body}


def write_bundles(pages: DataFrame, min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """The written table of bundles. date: the time of capture, as WARC-Date has it."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        writer = BundleWriter(frame_bytes)

        def done() -> pa.RecordBatch:
            content, index = writer.finish()
            return pa.RecordBatch.from_pylist([{"bundle_id": f"{task:06d}-{made:06d}", "content": content, "index": index}], schema=pa.schema([("bundle_id", pa.string()), ("content", pa.binary()), ("index", pa.list_(pa.struct([("record", pa.int64()), ("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])))]))

        for batch in slices(batches, "html", 4 << 20):
            for row in batch.to_pylist():
                writer.add(record_bytes(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"], date), row["page_id"])
                if writer.packed >= bundle_bytes:
                    yield done()
                    made += 1
                    writer = BundleWriter(frame_bytes)
        if writer.index:
            yield done()

    return materialize(with_refers(pages, min_bytes).mapInArrow(pack, BUNDLE_SCHEMA), "warc")


def read_bundles(bundles: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of every bundle, found by the index and read frame by frame."""
    wanted = RECORD_SCHEMA if payload else RECORD_SCHEMA.removesuffix(", payload binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        schema = pa.schema(kinds if payload else kinds[:-1])
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                content, places = batch.column("content")[i].as_py(), batch.column("index")[i].as_py()
                by_frame: dict[int, list[dict]] = {}
                for place in places:
                    by_frame.setdefault(place["frame"], []).append(place)
                for frame, (start, packed, plain) in enumerate(seek_table(content)):
                    data = unpack.decompress(content[start : start + packed], max_output_size=max(plain, 1))
                    rows = [parse_record(data[p["offset"] : p["offset"] + p["length"]]) for p in by_frame.get(frame, [])]
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return bundles.select("bundle_id", "content", "index").mapInArrow(read, wanted)


def find_records(bundles: DataFrame, page_id: int) -> list[dict]:
    """The records of one page (several if its rows repeat). The indexes tell where they are; only their frames are decompressed."""
    place = bundles.select("bundle_id", F.explode("index").alias("place")).filter(F.col("place.page_id") == page_id).select("bundle_id", "place.*")
    out = []
    for bundle_id, places in itertools.groupby(sorted(place.collect(), key=lambda p: (p.bundle_id, p.record)), key=lambda p: p.bundle_id):
        content = export_bundle(bundles, bundle_id)
        out += [parse_record(read_record(content, p.frame, p.offset, p.length)) for p in places]
    return out


def export_bundle(bundles: DataFrame, bundle_id: str) -> bytes:
    """The bytes of one .warc.zst file."""
    return bytes(bundles.filter(F.col("bundle_id") == bundle_id).select("content").first()[0])


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_bundles(write_bundles(pages), payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q
"""
