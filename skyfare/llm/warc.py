"""Pages as WARC records in seekable Zstandard bundles, and back.

A bundle is a file of independent Zstandard frames. Whole records are put into a frame until it is full, so a
record is read by decompressing its frame alone. A footer (a skippable frame, in the seekable format of
Zstandard) lists the compressed and the plain size and a checksum of every frame. The archive's index maps
each record's identifier to its bundle, its frame and its offset within that frame.

Of pages with equal payloads one is stored as a response; the others are revisits that refer to it and carry
no payload. Which one is decided on small rows (digest, identifier, place), so a payload is never shuffled:
the responses are picked out of the pages by bit maps of their places, the revisits need no payload at all.

Tasks write bundles straight to the archive's folder under names of their own. A bundle counts only when the
table of bundles lists it, which Spark commits when the task has succeeded; what a lost or repeated task
leaves behind is never read.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, functions as F

from skyfare.llm.common import located, rows_at, whole_text
from skyfare.scratch import hold, scratch_path

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3

# Fixed values of the seekable Zstandard format.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
# Fixed values of WARC 1.1.
_VERSION, _END = b"WARC/1.1", b"\r\n\r\n"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_BUNDLES = "bundle string, bytes bigint, ids array<string>, frames array<int>, offsets array<bigint>"
_READ = "record_id string, record_type string, page_id bigint, url string, refers_id string, payload_bytes bigint, payload_digest string"


def filesystem(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it. A path without a scheme is a shared local one."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return arrow_fs.FileSystem.from_uri(folder)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


# --- records -------------------------------------------------------------------------------------


def _header_value(text: str) -> bytes:
    """A header value holds no line breaks or other controls; they are percent-encoded, as in an address."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text).encode()


def record(headers: Sequence[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [name.encode() + b": " + _header_value(value) for name, value in headers if value is not None]
    return b"\r\n".join([_VERSION, *lines, b"Content-Length: %d" % len(block)]) + _END + block + _END


def _common(kind: str, row: dict, moment: str) -> list[tuple[str, str | None]]:
    page = None if row["page_id"] is None else str(row["page_id"])
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", moment),
        ("WARC-Target-URI", row["url"]),
        ("WARC-Page-ID", page),
    ]


def response_record(row: dict, moment: str) -> bytes:
    payload = row["payload"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload)
    headers = [
        *_common("response", row, moment),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return record(headers, http + _END + payload)


def revisit_record(row: dict, moment: str) -> bytes:
    headers = [
        *_common("revisit", row, moment),
        ("WARC-Profile", _SAME_PAYLOAD),
        ("WARC-Refers-To", f"<{row['refers_id']}>"),
        ("WARC-Refers-To-Target-URI", row["refers_url"]),
        ("WARC-Refers-To-Date", moment),
    ]
    return record(headers, b"")


def parse_record(frame: bytes, offset: int) -> tuple[dict[str, str], bytes]:
    """The headers and the block of the record at `offset` of a plain frame."""
    end = frame.find(_END, offset)
    if end < 0 or not frame.startswith(_VERSION, offset):
        raise ValueError(f"no record at {offset}")
    lines = frame[offset:end].split(b"\r\n")[1:]
    headers = {name.decode(): value.decode() for name, _, value in (line.partition(b": ") for line in lines)}
    start = end + len(_END)
    stop = start + int(headers["Content-Length"])
    if frame[stop : stop + len(_END)] != _END:
        raise ValueError(f"the record at {offset} is cut off")
    return headers, frame[start:stop]


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The payload of a response, checked against its digest."""
    payload = block.partition(_END)[2]
    if headers["WARC-Payload-Digest"] != f"sha1:{payload_digest(payload)}":
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not the one that was stored")
    return payload


# --- bundles -------------------------------------------------------------------------------------


class BundleWriter:
    """Writes records into frames of one file; the frame a record begins and ends in is given back with its offset."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.open_frame, self.frames, self.written = bytearray(), [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        at = len(self.frames), len(self.open_frame)
        self.open_frame += data
        if len(self.open_frame) >= self.frame_bytes:
            self.end_frame()
        return at

    def end_frame(self) -> None:
        if self.open_frame:
            plain = bytes(self.open_frame)
            packed = self.packer.compress(plain)
            self.out.write(packed)
            self.written += len(packed)
            self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.open_frame = bytearray()

    def close(self) -> int:
        """Ends the file with its seek table; gives its size."""
        self.end_frame()
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), _CHECKSUMS, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()
        return self.written + 8 + len(table)


class BundleReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEKABLE:
            raise ValueError("the file does not end with a seek table")
        width = 12 if flags & _CHECKSUMS else 8
        table = self._at(size - 9 - count * width, count * width)
        self.frames, start = [], 0
        for i in range(count):
            packed, plain, *check = struct.unpack_from("<III" if width == 12 else "<II", table, i * width)
            self.frames.append((start, packed, plain, check[0] if check else None))
            start += packed

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def frame(self, number: int) -> bytes:
        start, packed, plain, check = self.frames[number]
        data = zstandard.ZstdDecompressor().decompress(self._at(start, packed), max_output_size=plain)
        if len(data) != plain or check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} is damaged")
        return data


def _write_bundles(folder: str, make: Callable[[dict, str], bytes], moment: str, frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        writer, name, index = None, "", []

        def begin() -> None:
            nonlocal writer, name, index
            name, index = f"{uuid.uuid4().hex}.warc.zst", []
            writer = BundleWriter(system.open_output_stream(f"{path}/{name}", compression=None), frame_bytes)
            about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", moment), ("WARC-Filename", name)]
            writer.add(record([*about, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            writer.end_frame()

        def end() -> pa.RecordBatch:
            nonlocal writer
            size, writer = writer.close(), None
            ids, frames, offsets = zip(*index, strict=True)
            row = {"bundle": name, "bytes": size, "ids": list(ids), "frames": list(frames), "offsets": list(offsets)}
            kinds = pa.schema([("bundle", pa.string()), ("bytes", pa.int64()), ("ids", pa.list_(pa.string())), ("frames", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64()))])
            return pa.RecordBatch.from_pylist([row], schema=kinds)

        for batch in batches:
            for start in range(0, batch.num_rows, 64):  # payloads of a few rows at a time
                for row in batch.slice(start, 64).to_pylist():
                    if writer is None:
                        begin()
                    index.append((row["record_id"], *writer.add(make(row, moment))))
                    if writer.written >= bundle_bytes:
                        yield end()
        if writer is not None:
            yield end()

    return run


def _read_bundles(folder: str):
    """Every record that a bundle's index lists, frame by frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        fields = [f.split()[0] for f in _READ.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{path}/{row['bundle']}") as source:
                    reader, now, plain, out = BundleReader(source), -1, b"", []
                    for wanted, number, offset in zip(row["ids"], row["frames"], row["offsets"], strict=True):
                        if number != now:
                            if out:
                                yield _columns(out, fields)
                            now, plain, out = number, reader.frame(number), []
                        headers, block = parse_record(plain, offset)
                        if headers["WARC-Record-ID"] != f"<{wanted}>":
                            raise ValueError(f"{row['bundle']}: {wanted} is not where the index has it")
                        page = headers.get("WARC-Page-ID")
                        about = (wanted, headers["WARC-Type"], None if page is None else int(page), headers.get("WARC-Target-URI"))
                        if headers["WARC-Type"] == "response":
                            payload = payload_of(headers, block)
                            out.append((*about, None, len(payload), payload_digest(payload)))
                        else:
                            out.append((*about, headers["WARC-Refers-To"][1:-1], None, None))
                    if out:
                        yield _columns(out, fields)

    return run


def _columns(rows: list[tuple], fields: list[str]) -> pa.RecordBatch:
    whole = {"page_id", "payload_bytes"}
    arrays = [pa.array(c, pa.int64() if f in whole else pa.string()) for f, c in zip(fields, zip(*rows, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, fields)


# --- archives ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Archive:
    """A folder of bundles, and the table of them: bundle, bytes, and the ids, frames and offsets of its records."""

    folder: str
    bundles: DataFrame

    def index(self) -> DataFrame:
        """(record_id, bundle, frame, offset), one row per record."""
        entry = F.explode(F.arrays_zip("ids", "frames", "offsets")).alias("e")
        return self.bundles.select("bundle", entry).select(
            F.col("e.ids").alias("record_id"), "bundle", F.col("e.frames").alias("frame"), F.col("e.offsets").alias("offset")
        )


def _record_id(place: Column) -> Column:
    """urn:uuid of a row, from its place: the same whenever it is worked out again."""
    h = F.sha2(F.concat(place["file"], F.lit("#"), place["row"].cast("string")).cast("binary"), 256)
    part = lambda start, length: F.substring(h, start, length)
    return F.concat(
        F.lit("urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(13, 3), F.lit("-8"), part(16, 3), F.lit("-"), part(19, 12)
    )


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    moment: dt.datetime | None = None,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> Archive:
    """One record per row of `pages` (page_id, url, html), payload the html in UTF-8; null counts as empty.

    Of the rows whose payloads, of at least `least_bytes` bytes, are equal (by SHA-256), the one with the
    smallest page_id is a response and the others revisit it; of rows that repeat that page_id it is the first
    by place, and a row without a page_id only if the group has no other. Smaller payloads are all responses.
    A payload of any length is one record in one frame. Control characters of a url are percent-encoded; a
    null url or page_id has no header. An empty table gives no bundles; other columns are not looked at.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    stamp = (moment or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    pages, place = located(pages)
    html = whole_text(pages, "html").cast("binary")
    page_id, url = pages["page_id"].cast("bigint").alias("page_id"), pages["url"].cast("string").alias("url")

    size = F.octet_length(html)
    small = hold(
        pages.select(F.when(size >= least_bytes, F.unhex(F.sha2(html, 256))).alias("digest"), page_id, url, place.alias("place")), "payloads"
    ).df
    whole = small.where("digest IS NOT NULL")
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "place", "url")
    groups = hold(whole.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")), "payload-groups").df
    responses = groups.select("first.place.*").unionByName(small.where("digest IS NULL").select("place.*"))
    copies = groups.where("n > 1").select("digest", "first")
    revisits = (
        whole.join(copies, "digest")
        .where(F.col("place") != F.col("first.place"))
        .select(
            _record_id(F.col("place")).alias("record_id"),
            "page_id",
            "url",
            _record_id(F.col("first.place")).alias("refers_id"),
            F.col("first.url").alias("refers_url"),
        )
    )
    stored = rows_at(pages.select(pages["html"], pages["url"], pages["page_id"], place.alias("_at")), F.col("_at"), responses)
    full = stored.select(
        _record_id(F.col("_at")).alias("record_id"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        whole_text(stored, "html").cast("binary").alias("payload"),
    )
    table = scratch_path(spark, "warc-bundles")
    for rows, make in ((full, response_record), (revisits, revisit_record)):
        write = _write_bundles(folder, make, stamp, frame_bytes, bundle_bytes)
        rows.mapInArrow(write, _BUNDLES).write.mode("append").parquet(table)
    return Archive(folder, spark.read.schema(_BUNDLES).parquet(table))


def read_archive(archive: Archive) -> DataFrame:
    """Every record as it is stored: record_id, record_type, page_id, url, refers_id, payload_bytes, payload_digest.

    Bundles are dealt out over tasks; a task holds one frame at a time. Payloads are checked against their
    digests, frames against their checksums, and records against the index. A revisit has no payload of its own.
    """
    spark = archive.bundles.sparkSession
    bundles = archive.bundles.count()
    dealt = archive.bundles.repartition(max(1, min(bundles, 100 * spark.sparkContext.defaultParallelism)))
    return dealt.mapInArrow(_read_bundles(archive.folder), _READ)


def fetch_records(archive: Archive, ids: DataFrame) -> DataFrame:
    """(record_id, page_id, payload) of the records that `ids` (record_id) names; only their frames are read.

    Ids that the archive lacks give no row, repeated ones one. A revisit has a null payload.
    """
    wanted = archive.index().join(ids.select("record_id").distinct(), "record_id")
    grouped = wanted.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("offset", "record_id"))).alias("records"))
    folder = archive.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{path}/{row['bundle']}") as source:
                    plain = BundleReader(source).frame(row["frame"])
                out = []
                for r in row["records"]:
                    headers, block = parse_record(plain, r["offset"])
                    page = headers.get("WARC-Page-ID")
                    response = headers["WARC-Type"] == "response"
                    out.append((r["record_id"], None if page is None else int(page), payload_of(headers, block) if response else None))
                kinds = (pa.string(), pa.int64(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["record_id", "page_id", "payload"])

    return grouped.mapInArrow(run, "record_id string, page_id bigint, payload binary")


def archived_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to per row of `pages`, as read back from its archive.

    The size and the digest of a revisit are those of the payload of the response that it refers to. Cases as
    `write_archive` has them; an empty table gives an empty result.
    """
    records = hold(read_archive(write_archive(pages, folder, least_bytes)), "warc-records").df
    responses = records.where("record_type = 'response'")
    told = responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    target = responses.select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "refers_id")
    return told.unionByName(revisits.join(target, "refers_id").select(*told.columns))
