from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfare.llm import quality as q
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_held_out_accuracy(spark):
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    found = q.quality_scores(spark.read.parquet(f"{at}/documents.parquet"), labels)
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95
    loss = -np.mean([np.log(r.score if r.quality else 1 - r.score) for r in rows])
    assert loss < 0.15


def test_held_out_rows_and_form(docs, labels):
    rows = q.quality_scores(docs, labels).collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)


def test_held_out_labels_are_not_learned(docs, labels):
    """Turning the held-out labels round changes no score."""
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r.doc_id: r.score for r in q.quality_scores(docs, x).collect()} for x in (labels, turned)]
    assert scores[0].keys() == scores[1].keys()
    assert max(abs(scores[0][i] - scores[1][i]) for i in scores[0]) < 1e-9


def test_odd_rows(odd, labels):
    rows = q.quality_scores(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 for r in rows)
    kept = q.keep_good(odd, labels)
    assert kept.columns == odd.columns


def test_empty_tables(none, docs, labels):
    assert q.quality_scores(none, labels).count() == 0
    unlabelled = q.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}


def test_context_sums_against_a_plain_loop():
    places, signs = q.index_vectors()
    texts = ["the cat saw the cat", "", "one", "a a a b"]
    counts, sums = q.add_contexts(texts, places, signs)
    want_counts, want = np.zeros(q.ROWS), np.zeros((q.ROWS, q.DIMS))
    for t in texts:
        rows = q.token_rows(t)
        for i, r in enumerate(rows):
            want_counts[r] += 1
            for j in range(max(0, i - q.WINDOW), min(len(rows), i + q.WINDOW + 1)):
                if j != i:
                    want[r, places[rows[j]]] += signs[rows[j]]
    assert np.array_equal(counts, want_counts)
    assert np.array_equal(sums.reshape(q.ROWS, q.DIMS), want)


def test_corpus_vectors_cover_all_documents(docs, texts):
    counts, vectors = q.corpus_vectors(docs)
    want, sums = q.add_contexts([t for _, t in texts], *q.index_vectors())
    assert np.array_equal(counts, want)
    sums = sums.reshape(q.ROWS, q.DIMS)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    assert np.allclose(vectors, sums / np.where(length > 0, length, 1))


def plain_vector(text, counts, contexts):
    """The vector of a text, word by word."""
    places, signs = q.index_vectors()
    total, context, own, weights, again = counts.sum(), np.zeros(q.DIMS), np.zeros(q.DIMS), 0.0, 0
    rows = q.token_rows(text).tolist()
    for r in rows:
        w = 1e-3 / (1e-3 + counts[r] / total)
        context += w * contexts[r]
        for place, sign in zip(places[r], signs[r], strict=True):
            own[place] += w * sign
        weights += w
        again += r == 0
    return np.append(np.append(context, own) / weights, again / len(rows)) if rows else np.zeros(2 * q.DIMS + 1)


def test_scores_against_a_plain_loop(docs, texts, labels):
    """Pooling, both layers and the temperature, text by text and number by number."""
    counts, contexts = q.corpus_vectors(docs)
    _, network = q.fit(docs, labels)
    found = {r.doc_id: r.score for r in q.quality_scores(docs, labels).collect()}
    for i, text in texts[:60]:
        x = plain_vector(text, counts, contexts)
        logit = network.b2
        for unit in range(len(network.b1)):
            inside = network.b1[unit] + sum((x[d] - network.mean[d]) / network.spread[d] * network.w1[d, unit] for d in range(len(x)))
            logit += np.tanh(inside) * network.w2[unit]
        want = 1 / (1 + np.exp(-logit / network.temperature))
        assert abs(found[i] - want) < 1e-4


def test_temperature_lowers_the_loss_of_what_the_fit_did_not_see():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2 * q.DIMS + 1))
    y = (x[:, 0] + rng.normal(scale=1.5, size=400) > 0).astype(float)
    network = q.fit_network(x, y)
    aside = np.random.default_rng(11).permutation(400) < 80
    losses = {t: q._log_loss(1 / (1 + np.exp(-network.logits(x[aside]) / t)), y[aside]) for t in (0.5, 1.0, 2.0, network.temperature)}
    assert network.temperature > 1 and losses[network.temperature] == min(losses.values())


def test_ids_that_repeat_are_learned_from_once(docs, labels):
    """However often a labelled id repeats, the network is fitted on one row of it."""
    many = docs.unionByName(docs).unionByName(docs)
    (_, once), (_, thrice) = q.fit(docs, labels), q.fit(many, labels)
    assert np.allclose(once.w1, thrice.w1, atol=0.2) and np.allclose(once.mean, thrice.mean, atol=1e-3)
