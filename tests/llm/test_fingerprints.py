from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from skyfare.llm import fingerprints as fp
from tests.llm.conftest import ODD_TEXTS


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts):
    for k, t in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        yield t[: len(t) - len(t) // 4] + after[: len(t) // 4], after


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_documents(docs, texts, monkeypatch, bucket_rows):
    monkeypatch.setattr(fp, "BUCKET_ROWS", bucket_rows)
    rows = fp.document_fingerprints(docs).orderBy("doc_id").collect()
    plain = [t for _, t in texts]
    errors = []
    for r, t, (e, after) in zip(rows, plain, edited(plain), strict=True):
        assert r.n_chars == len(t)
        assert r.edited_sha256 == sha256(e.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        errors += [abs(r.near_edited - jaccard(t, e)), abs(r.near_next - jaccard(t, after))]
    assert max(errors) < 0.2
    assert sum(errors) / len(errors) < 0.03
    prints = {}
    for r, t in zip(rows, plain, strict=True):
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint


def test_odd_rows(odd, none):
    rows = fp.document_fingerprints(odd).collect()
    assert len(rows) == len(ODD_TEXTS)
    by_length = sorted((r.n_chars, r.doc_id or -1) for r in rows)
    assert by_length == sorted((len(t or ""), i or -1) for i, t in ODD_TEXTS)
    same = {r.fingerprint for r in rows if r.doc_id in (6, 7)}
    assert len(same) == 1
    assert {r.fingerprint for r in rows if r.doc_id in (1, 2, 3)} == {""}
    assert fp.document_fingerprints(none).count() == 0


def test_single_document_is_its_own_next(spark):
    r = fp.document_fingerprints(spark.createDataFrame([(3, "abcdefgh")], "doc_id bigint, text string")).first()
    assert r.edited_sha256 == sha256(b"abcdefab").hexdigest()
    assert r.near_next == 1.0


def test_likeness_of_short_texts(spark):
    """Texts of one shingle agree by chance in few bins only."""
    rows = [(i, f"word{i}") for i in range(200)]
    df = fp.with_fingerprint(spark.createDataFrame(rows, "i int, t string"), "t", "fp")
    pairs = df.alias("a").join(df.alias("b"), F.expr("a.i + 1 = b.i")).select(fp.likeness(F.col("a.fp"), F.col("b.fp")).alias("x"))
    assert pairs.agg(F.max("x")).first()[0] < 0.15
    assert df.select(fp.likeness(F.col("fp"), F.col("fp")).alias("x")).distinct().collect()[0].x == 1.0


def test_no_python_in_the_plan(docs):
    plan = fp.document_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("hot", ["NULL", "17"])
def test_an_id_of_very_many_rows_is_parted(spark, monkeypatch, hot):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 10)
    docs = spark.range(400).selectExpr(
        f"IF(id % 3 = 0, {hot}, id) AS doc_id", "concat_ws(' ', 'text', id, 'of some words', id * id, id + 7) AS text"
    )
    tie = F.xxhash64("text")
    key = F.coalesce("doc_id", F.lit(fp._LEAST_ID))
    placed = docs.select(fp._id_buckets(docs, key, tie).alias("bucket"), key.alias("key"), tie.alias("tie"), "text")
    ordered = sorted(placed.collect(), key=lambda r: (r.key, r.tie))
    buckets = [r.bucket for r in ordered]
    assert buckets == sorted(buckets)
    assert max(buckets.count(b) for b in set(buckets)) <= 40
    texts = [r.text for r in ordered]
    want = sorted(sha256(e.encode()).hexdigest() for e, _ in edited(texts))
    assert sorted(r.edited_sha256 for r in fp.document_fingerprints(docs).collect()) == want


def test_buckets_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_BYTES", 1000)
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('word ', 20) AS text")
    buckets = [r.bucket for r in docs.select(fp._id_buckets(docs, docs["doc_id"], F.xxhash64("text")).alias("bucket")).collect()]
    assert len(set(buckets)) == 10 and max(map(buckets.count, set(buckets))) <= 20
