from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skyfare.llm import sharding
from skyfare.llm.sharding import Splitters, shard_rows
from tests.llm.conftest import ODD_TEXTS


def check(rows, shards=8):
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    return sizes


def test_documents(docs, texts):
    rows = shard_rows(docs).collect()
    sizes = check(rows)
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts}
    longest = max(r.size for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * longest


def test_hot_group_is_parted_and_small_groups_stay(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one text that a third of all rows share").otherwise(
            F.concat(F.lit("text number "), (F.col("id") % 9000).cast("string"), F.lit(" with some more words"))
        ).alias("text"),
    )
    rows = shard_rows(docs).collect()
    sizes = check(rows)
    assert max(sizes.values()) <= 1.02 * min(sizes.values())
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) == 1


def test_repeated_rows_fill_shards_too(spark):
    same = spark.range(800).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    sizes = check(shard_rows(same).collect())
    assert set(sizes.values()) == {100}


def test_odd_rows(odd, none):
    rows = shard_rows(odd).collect()
    check(rows)
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ODD_TEXTS]
    assert sorted(map(repr, ((r.doc_id, r["size"], r.text_crc32) for r in rows))) == sorted(map(repr, want))
    assert shard_rows(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7])
def test_ranges_against_plain_comparison(n):
    import numpy as np

    rng = np.random.default_rng(n)
    keys = [tuple(map(int, k)) for k in rng.integers(-3, 4, (200, 3))]
    splitters = Splitters.of(keys[:n])
    got = splitters.ranges(*np.array(keys, np.int64).T)
    assert got.tolist() == [sum(c <= k for c in set(keys[:n])) for k in keys]


def test_no_range_holds_many_copies(spark, monkeypatch):
    """Groups of copies that stay in one shard lie in many ranges, so no task sorts such a group whole."""
    seen = []
    plain = sharding._splitters

    def splitters(*given):
        found = plain(*given)
        seen.extend(found[1])
        return found

    monkeypatch.setattr(sharding, "_splitters", splitters)
    docs = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 200 == 0, "a text with two hundred copies").otherwise(F.concat(F.lit("text number "), F.col("id"))).alias("text"),
    )
    rows = shard_rows(docs).collect()
    sizes = check(rows)
    assert max(sizes.values()) <= 1.02 * min(sizes.values())
    copies = [r for r in rows if r.doc_id % 200 == 0]
    assert len({r.shard for r in copies}) == 1
    assert sum(r.bytes for r in seen) == sum(sizes.values())
    assert max(r.bytes for r in seen) <= 2 * sum(sizes.values()) / sharding.LEAST_RANGES
