from __future__ import annotations

import os
from collections import defaultdict
from hashlib import sha256
from pathlib import Path

from pyspark.sql import functions as F

from skyfare.llm.exact_dedup import copy_groups, drop_copies, exact_duplicates, run_stream
from skyfare.scratch import scratch_path
from tests.llm.conftest import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    for i, t in rows:
        norm = (t or "").translate(LOWER)
        ids = [x for x in groups[norm] if x is not None]
        yield i, max(ids, default=None), len(groups[norm]), sha256(norm.encode()).hexdigest()


def outcome(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())


def test_documents(docs, texts):
    found = exact_duplicates(docs)
    assert outcome(found) == sorted(brute(texts))
    assert found.filter("kept <> (doc_id = keep_id)").count() == 0


def test_odd_rows(odd):
    found = exact_duplicates(odd)
    assert sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()))) == sorted(
        map(repr, brute(ODD_TEXTS))
    )
    groups = len({(t or "").translate(LOWER) for _, t in ODD_TEXTS})
    assert found.filter("kept").count() == groups
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == groups
    assert kept.filter("digest <> 'clash'").count() == 0


def test_empty(none):
    assert exact_duplicates(none).count() == 0
    assert drop_copies(none).count() == 0


def test_a_weak_digest_is_found_out(docs, texts):
    """Many different texts share each digest; the comparison of bytes parts them."""
    weak = copy_groups(docs, lambda t: F.unhex(F.hex(F.pmod(F.crc32(t), F.lit(5)))))
    got = sorted((r.doc_id, r.keep, r.n) for r in weak.select("doc_id", F.col("stays.doc_id").alias("keep"), "n").collect())
    assert got == sorted(x[:3] for x in brute(texts))


def test_state_goes_on_between_runs(spark):
    feed, state = scratch_path(spark, "feed"), scratch_path(spark, "state")
    schema = "digest binary, doc_id bigint, place struct<file:string,row:bigint>"
    def add(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(feed)
        frame = spark.createDataFrame([], schema)
        return {bytes(r.digest): (r.stays.doc_id, r.n) for r in run_stream(spark, feed, frame.schema, state).collect()}

    assert add((b"a", 1, ("f", 0)), (b"b", 2, ("f", 1))) == {b"a": (1, 1), b"b": (2, 1)}
    assert add((b"a", 5, ("g", 0))) == {b"a": (5, 2)}
    assert add((b"b", 1, ("h", 0)), (b"c", 3, ("h", 1))) == {b"b": (2, 2), b"c": (3, 1)}


def test_no_store_stays_open(spark, docs):
    """Once the stream has ended, no partition's state takes files, threads or memory any more."""
    exact_duplicates(docs).count()
    files = Path(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/fd")
    links = [os.readlink(f) for f in files.iterdir() if f.is_symlink()]
    assert links and not [x for x in links if "StateStoreId(" in x]
