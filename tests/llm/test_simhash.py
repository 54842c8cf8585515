from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyfare.llm.components import components
from skyfare.llm.simhash import fingerprint_links, keep_one_each, near_components, simhash_components, spanning_links, text_fingerprint
from tests.llm.conftest import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Forest:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def brute(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    forest, distinct = Forest(), sorted({p for _, p in prints})
    for k, p in enumerate(distinct):
        for q in distinct[k:]:
            if (p ^ q).bit_count() <= 3:
                forest.join(p, q)
    least = {}
    for i, p in prints:
        if i is not None:
            root = forest.find(p)
            least[root] = min(i, least.get(root, i))
    return sorted(((i, f"{p:016x}", least.get(forest.find(p))) for i, p in prints), key=repr)


def outcome(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_documents(docs, texts):
    assert outcome(simhash_components(docs)) == brute(texts)


def test_odd_rows(odd):
    assert outcome(simhash_components(odd)) == brute(ODD_TEXTS)
    kept = keep_one_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").distinct().collect() if r.doc_id is not None) == sorted({c for _, _, c in brute(ODD_TEXTS) if c is not None})


def test_empty(none):
    assert simhash_components(none).count() == 0
    assert keep_one_each(none).count() == 0


def test_fingerprint_matches_spark_hash(spark):
    row = spark.sql("SELECT xxhash64('one two three') AS h").first()
    assert text_fingerprint("One  TWO\tthree") == row.h % (1 << 64)


@pytest.mark.parametrize("bucket", [1, 3, 4096])
def test_crowded_keys_lose_no_link(spark, bucket):
    """Near-copies around a few centres; small buckets send them through the second index."""
    rng = random.Random(bucket)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            flips = rng.sample(range(64), rng.randint(0, 5))
            prints.add(centre ^ sum(1 << b for b in flips))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    links = fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), bucket).collect()
    forest, expected = Forest(), Forest()
    for r in links:
        assert ((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 3
        forest.join(r.a, r.b)
    for a in signed:
        for b in signed:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3:
                expected.join(a, b)
    partition = lambda f: {frozenset(x for x in signed if f.find(x) == r) for r in map(f.find, signed)}
    assert partition(forest) == partition(expected)


def test_spanning_links_are_few():
    prints = np.array([0, 1, 2, 3, 7, 1 << 40, (1 << 40) | 1], np.uint64)
    a, b = spanning_links(prints, 3)
    forest, expected = Forest(), Forest()
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        forest.join(x, y)
    for x in prints.tolist():
        for y in prints.tolist():
            if (x ^ y).bit_count() <= 3:
                expected.join(x, y)
    parts = lambda f: {frozenset(x for x in prints.tolist() if f.find(x) == r) for r in map(f.find, prints.tolist())}
    assert parts(forest) == parts(expected)
    assert len(a) == len(prints) - len(parts(expected))  # no link too many
    assert (np.bitwise_count(a ^ b) <= 3).all()


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + hub + [(5, 5)], "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert {found[1000 + i] for i in range(200)} == {1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_of_copies_become_one_row(docs):
    found = near_components(docs.filter("doc_id < 30").withColumn("text", F.lit("one and the same text here")))
    assert {r.component_id for r in found.collect()} == {0}


def test_one_row_of_each_component_stays(spark):
    """Rows that share a doc_id, or have none, with equal and with other texts."""
    a, b, c = ("one text of a few words here", "another one about quite different things", "a third that is like neither of them")
    rows = [(1, a), (1, b), (2, b), (3, c), (3, c), (None, c), (None, "x y z"), (None, "x y z")]
    kept = keep_one_each(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted(((r.text, r.doc_id) for r in kept), key=repr) == sorted([(a, 1), (b, 1), (c, 3), ("x y z", None)], key=repr)
