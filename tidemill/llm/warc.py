"""WARC archives as seekable Zstandard bundles.

Each page is one record. Of the records with equal payloads one (that of the largest id) is a
``response``, the others refer to it (``revisit``). A bundle is one file: records in order, in
independent frames of about ``FRAME_BYTES`` (a record is never split), and a footer in a skippable
frame with each frame's sizes (the seekable format), so that any frame can be found and
decompressed alone. ``index`` maps record identifiers to frame-relative offsets.

Files are written by Spark's own writer: a bundle is a row, and each row a file. So they are
committed with their task, whatever executors are lost, on any file system Spark knows. Equal
payloads are found on their digests; only groups of several take part in the join, and a group of
any size is one row of it.

Defined cases: null html is an empty payload; pages that repeat an id with the same payload are all
responses if the id is the largest; a null id is the smallest of all; a null url is left out and what a
header can't hold is percent-encoded; an empty table gives no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import settled
from tidemill.session import scratch_path

# Fixed values of the formats.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
END = "\r\n"

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"  # when pages carry no date
_ID = re.compile(r"<urn:page:(-?\d+|none)>")


# --- one record, one bundle ------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _quoted(url: str) -> str:
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, *, revisit: bool = False, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP header only."""
    http = END.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=UTF-8", f"Content-Length: {len(payload)}", "", "")).encode()
    block = http if revisit else http + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_quoted(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return END.join(lines).encode() + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    """What a record says. ``payload`` is null for a revisit."""

    id: str
    type: str
    uri: str | None
    digest: str
    payload_bytes: int
    refers_to: str | None
    payload: bytes | None
    offset: int
    length: int


def _fields(lines: Sequence[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records_in(frame: bytes) -> Iterator[Record]:
    """The records of a decompressed frame. What a payload says of itself must hold."""
    at = 0
    while at < len(frame):
        head_end = frame.index(b"\r\n\r\n", at)
        first, *lines = frame[at:head_end].decode().split(END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = _fields(lines)
        start, size = head_end + 4, int(fields["content-length"])
        block = frame[start:start + size]
        http_end = block.index(b"\r\n\r\n")
        http = _fields(block[:http_end].decode().split(END)[1:])
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        payload = block[http_end + 4:] if kind == "response" else None
        if payload is not None and (digest_of(payload) != digest or len(payload) != int(http["content-length"])):
            raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
        end = start + size + 4
        yield Record(fields["warc-record-id"], kind, fields.get("warc-target-uri"), digest, int(http["content-length"]),
                     fields.get("warc-refers-to"), payload, at, end - at)
        at = end


def seek_table(sizes: Sequence[tuple[int, int]]) -> bytes:
    """The footer: (compressed, decompressed) size of each frame."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the footer alone."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    table = bundle[-9 - count * entry:-9]
    out, at = [], 0
    for i in range(count):
        packed, size = struct.unpack_from("<II", table, i * entry)
        out.append((at, packed, size))
        at += packed
    return out


def unpacked(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    offset, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(bundle[offset:offset + packed], max_output_size=size)


def bundles(records: Iterable[bytes], frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> Iterator[bytes]:
    """Packs records into bundles; each ends at the first record that fills it."""
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
    frames: list[bytes] = []
    sizes: list[tuple[int, int]] = []
    waiting: list[bytes] = []
    filled = whole = 0
    for r in records:
        waiting.append(r)
        filled += len(r)
        whole += len(r)
        if filled >= frame_bytes:
            frames.append(packer.compress(b"".join(waiting)))
            sizes.append((len(frames[-1]), filled))
            waiting, filled = [], 0
        if whole >= bundle_bytes:
            if waiting:
                frames.append(packer.compress(b"".join(waiting)))
                sizes.append((len(frames[-1]), filled))
            yield b"".join(frames) + seek_table(sizes)
            frames, sizes, waiting, filled, whole = [], [], [], 0, 0
    if waiting:
        frames.append(packer.compress(b"".join(waiting)))
        sizes.append((len(frames[-1]), filled))
    if frames:
        yield b"".join(frames) + seek_table(sizes)


# --- tables ----------------------------------------------------------------------------------


def with_references(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, revisit, refers_to for each of ``pages`` (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumn("_digest", F.unhex(F.sha1("payload")))
    groups = own.filter(F.octet_length("payload") >= least).groupBy(F.col("_digest").alias("_same")).agg(
        F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1 and _last is not null").drop("_n")
    joined = own.join(groups, F.col("_digest") == F.col("_same"), "left")
    # a payload has no group if it is alone, too short, or only rows without an id have it
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return joined.select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("_last")).alias("refers_to"))


def write(pages: DataFrame, path: str, *, least: int = 0, date: str = DATE,
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Writes the bundles of ``pages`` under ``path``. Payloads of fewer than ``least`` bytes are always
    responses."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    yield record(page_id, url, payload, refers_to, revisit=revisit, date=date)

        for bundle in bundles(made(), frame_bytes, bundle_bytes):
            yield pa.RecordBatch.from_pydict({"bundle": pa.array([bundle], pa.binary())})

    packed = with_references(pages, least).mapInArrow(pack, "bundle binary")
    # The text writer puts the bytes of a row and those of a separator in a file: the separator here
    # is the last byte of every bundle, which the footer's number fixes.
    last = bytes([SEEKABLE >> 24]).decode("latin-1")
    value = F.expr("cast(substr(bundle, 1, length(bundle) - 1) as string)").alias("value")
    packed.select(value).write.option("lineSep", last).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)


def _bundles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


_READ = ("path string, frame int, frame_offset long, frame_bytes long, offset long, length long, page_id long, record_id string, "
         "record_type string, uri string, payload_digest string, payload_bytes long, refers_to long, payload binary")


def _number(identifier: str | None) -> int | None:
    found = _ID.fullmatch(identifier or "")
    return int(found[1]) if found and found[1] != "none" else None


def read(spark: SparkSession, path: str | list[str], *, payloads: bool = True) -> DataFrame:
    """Every record of the bundles under ``path`` with its place: the file, the frame in it, and the
    record's offset and length in the frame. Digests are checked on the way."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, bundle in zip(batch.column(0), batch.column(1)):
                content = bundle.as_py()
                for i, frame in enumerate(frames_of(content)):
                    rows = [(name.as_py(), i, frame[0], frame[1], r.offset, r.length, _number(r.id), r.id, r.type, r.uri, r.digest,
                             r.payload_bytes, _number(r.refers_to), r.payload if payloads else None)
                            for r in records_in(unpacked(content, frame))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    names = [c.split()[0] for c in _READ.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in _READ.split(", ")]
    return _bundles(spark, path).mapInArrow(unpack, _READ)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Record identifiers and where each is: file, frame, and offset in the frame."""
    return settled(read(spark, path, payloads=False).select(
        "record_id", "record_type", "path", "frame", "frame_offset", "frame_bytes", "offset", "length", "refers_to"))


def fetch(places: DataFrame, ids: Sequence[int]) -> DataFrame:
    """page_id and payload of some records: only the files and frames that hold them are read, for a
    revisit those of its response. ``places`` is an ``index``; the request bounds what is collected."""
    spark = places.sparkSession
    asked = places.filter(F.col("record_id").isin([record_id(i) for i in ids])).select("record_id", "refers_to").distinct().collect()
    source = {r.record_id: r.record_id if r.refers_to is None else record_id(r.refers_to) for r in asked}
    held = places.filter((F.col("record_type") == "response") & F.col("record_id").isin(list(set(source.values())))).collect()
    at = {}
    for r in sorted(held, key=lambda r: (r.path, r.frame, r.offset)):
        at.setdefault(r.record_id, r)
    wanted: dict[str, list] = {}
    for r in at.values():
        wanted.setdefault(r.path, []).append((r.frame, r.offset, r.length, r.record_id))
    if not wanted:
        return spark.createDataFrame([], "page_id long, payload binary")
    users: dict[str, list[int | None]] = {}
    for own, of in source.items():
        users.setdefault(of, []).append(_number(own))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, bundle in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = bundle.as_py()
                table = frames_of(content)
                for number, offset, length, identifier in sorted(wanted.get(name, [])):
                    (found,) = records_in(unpacked(content, table[number])[offset:offset + length])
                    own = users[identifier]
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([found.payload] * len(own), pa.binary())], names=["page_id", "payload"])

    return _bundles(spark, sorted(wanted)).mapInArrow(pick, "page_id long, payload binary")


def archived(pages: DataFrame, *, least: int = 0) -> DataFrame:
    """Writes ``pages`` to bundles in the shared folder and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, least=least)
    return read(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle(least: int = 0) -> str:
    """What the archives hold in the SQL of an embedded database; base32 by its 32 letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    # 20 bytes are four groups of 40 bits, each eight letters
    groups = " || ".join(
        f"substr('{letters}', ((('0x' || substr(h, {10 * g + 1}, 10))::BIGINT >> {35 - 5 * i}) & 31)::INT + 1, 1)"
        for g in range(4) for i in range(8))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h AS same, max(page_id) AS last FROM p WHERE octet_length(encode(html)) >= {least} GROUP BY h),
j AS (SELECT *, last IS NOT NULL AND page_id IS DISTINCT FROM last AS revisit FROM p LEFT JOIN g ON h = same)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {groups} AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN last END AS refers_to FROM j"""
