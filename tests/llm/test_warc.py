from __future__ import annotations

import base64
import hashlib
import io
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest
import zstandard

from skyfare.llm.queries import ORACLE_SQL, QUERIES
from skyfare.llm.warc import (
    BundleReader,
    BundleWriter,
    archived_pages,
    fetch_records,
    filesystem,
    parse_record,
    read_archive,
    record,
    write_archive,
)
from skyfare.scratch import scratch_path
from tests.compare import differences
from tests.llm.conftest import SF_DIR

SCHEMA = "page_id bigint, url string, html string, digest string, place string, _at string, file string, row string, record_id string, n string, first string"
ODD = [
    (1, "http://a/", None), (2, None, ""), (3, "http://b/\r\nWARC-Type: response", "<p>é🙂</p>"), (4, "http://c/", "WARC/1.1\r\n\r\n\r\n"),
    (5, "http://c/", "same"), (5, "http://d/", "same"), (None, "http://e/", "same"), (9, "http://f/", "same"), (None, None, None),
    (None, "x", "alone"), (None, "y", "alone"), (20, "http://long/", "long " * 400_000), (21, "http://long/", "long " * 400_000), (7, "u\x00\x7f", "\x00\r\n"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    """Which of rows that repeat a page_id is the response makes no difference to the result."""
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    first = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        first[text] = min(known, default=None)
    seen = set()
    for i, _, html in rows:
        text = html or ""
        size = len(text.encode())
        response = size < least or (i == first[text] and text not in seen)
        if response and size >= least:
            seen.add(text)
        yield i, size, digest(html), "response" if response else "revisit", None if response else first[text]


def outcome(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, *["clash"] * 8) for r in ODD], SCHEMA).repartition(3)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_DIR}/pages.parquet'")
    assert differences(QUERIES["op13_warc"](spark, SF_DIR), con, ORACLE_SQL["op13_warc"]) is None


def test_copies_against_sql(spark):
    """The given pages are all different; here they repeat."""
    path = f"{scratch_path(spark, 'copied')}"
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    copies = pages.selectExpr("page_id + 1000 * (1 + page_id % 3) AS page_id", "url", "html").where("page_id % 5 < 3")
    many = spark.range(200).selectExpr("5000 + id AS page_id", "'u' AS url", "'one payload of many' AS html")
    pages.unionByName(copies).unionByName(many).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    assert differences(archived_pages(spark.read.parquet(path)), con, ORACLE_SQL["op13_warc"]) is None


@pytest.mark.parametrize("least", [0, 5, 1 << 40])
def test_odd_rows(odd, least):
    assert outcome(archived_pages(odd, least)) == sorted(brute(ODD, least), key=repr)


def test_empty(odd):
    empty = archived_pages(odd.limit(0))
    assert empty.collect() == []
    assert empty.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_bundles_and_seeking(spark, odd):
    """Small frames and bundles: every payload comes back, by whole reads and by single ids."""
    archive = write_archive(odd, frame_bytes=200, bundle_bytes=400)
    assert archive.bundles.count() > 3
    index = archive.index().collect()
    assert len(index) == len({r.record_id for r in index}) == len(ODD)
    records = read_archive(archive).collect()
    assert {r.record_id for r in records} == {r.record_id for r in index}
    wanted = [r.record_id for r in records if r.page_id in (3, 4, 7, 20)] + ["urn:uuid:none"]
    ids = spark.createDataFrame([(i,) for i in wanted * 2], "record_id string")
    got = {r.page_id: bytes(r.payload) for r in fetch_records(archive, ids).collect()}
    assert got == {i: html.encode() for i, _, html in ODD if i in (3, 4, 7, 20)}


def test_bundles_are_plain_files(spark, odd):
    """Any Zstandard reader reads a bundle, and any WARC reader finds record after record in it."""
    archive = write_archive(odd, frame_bytes=1000)
    system, folder = filesystem(archive.folder)
    found = 0
    for row in archive.bundles.collect():
        data = system.open_input_file(f"{folder}/{row.bundle}").read()
        assert len(data) == row.bytes
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        at = 0
        while at < len(plain):
            headers, block = parse_record(plain, at)
            at = plain.index(b"\r\n\r\n", at) + 4 + len(block) + 4
            found += headers["WARC-Type"] != "warcinfo"
    assert found == len(ODD)


def test_what_a_lost_task_left_is_not_read(spark, odd):
    archive = write_archive(odd)
    system, folder = filesystem(archive.folder)
    with system.open_output_stream(f"{folder}/left-behind.warc.zst") as out:
        out.write(b"half a bundle")
    assert read_archive(archive).count() == len(ODD)


def test_damage_is_noticed():
    class Kept(io.BytesIO):
        def close(self):
            pass

    out = Kept()
    writer = BundleWriter(out, frame_bytes=50)
    where = [writer.add(record([("WARC-Type", "response"), ("N", str(i))], b"x" * 30 * i)) for i in range(6)]
    size = writer.close()
    data = out.getvalue()
    assert size == len(data)
    reader = BundleReader(pa.BufferReader(data))
    for i, (frame, offset) in enumerate(where):
        headers, block = parse_record(reader.frame(frame), offset)
        assert headers["N"] == str(i) and block == b"x" * 30 * i
    with pytest.raises(ValueError):
        BundleReader(pa.BufferReader(data[:-1]))
    with pytest.raises(ValueError):
        parse_record(reader.frame(0), 1)
    broken = bytearray(data)
    broken[-9 - 12 * len(reader.frames) + 8] ^= 1  # the first checksum
    with pytest.raises(ValueError):
        BundleReader(pa.BufferReader(bytes(broken))).frame(0)
