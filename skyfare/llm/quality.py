"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Words and runs of signs are tokens. A token is hashed to one of `ROWS` rows; each row has a sparse
random index vector with a few entries of +1 and -1. The context vector of a row is the sum of the
index vectors of its neighbours within `WINDOW` places, over all documents: each task adds up its own
counts, slots of tasks are added on the executors, and one matrix of fixed size (ROWS x DIMS) remains.
A document is the mean of its tokens' context vectors (frequent rows weigh less) beside the mean of
their index vectors. A network with one hidden layer is fitted on the vectors of a bounded sample of
labelled documents, and its temperature on a part of that sample that the fit does not see.

Labels come only from rows whose crc32(doc_id) mod 4 is not 2. Nothing but the text enters a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from skyfare.llm.common import bounded_sample, held, whole_text

ROWS, DIMS, ENTRIES, WINDOW = 8192, 64, 4, 2
LABELLED = 6000
SLOTS = (4096, 64, 1)  # tasks' sums are added in three steps, so that no step adds many at once
THRESHOLD = 0.7
_PARTS = 16
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_AGAIN = 0  # the row of a token that repeats the one before it


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the entries of each row's index vector, both ROWS x ENTRIES."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((ROWS, DIMS)), axis=1)[:, :ENTRIES]
    return places, rng.choice([-1.0, 1.0], (ROWS, ENTRIES))


def token_rows(text: str) -> np.ndarray:
    tokens = _TOKEN.findall(text)
    crc = zlib.crc32
    hashed = np.fromiter((crc(t.encode("utf-8", "surrogatepass")) for t in tokens), np.int64, len(tokens))
    rows = 1 + hashed % (ROWS - 1)
    if len(rows) > 1:
        rows[1:][hashed[1:] == hashed[:-1]] = _AGAIN
    return rows


def add_contexts(texts: list[str], places: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the rows, and the sums of their neighbours' index vectors."""
    counts, sums = np.zeros(ROWS), np.zeros(ROWS * DIMS)
    for start in range(0, len(texts), 256):
        each = [token_rows(t) for t in texts[start : start + 256]]
        # two places that hold nothing part the documents
        rows = np.concatenate([x for r in each for x in (r, np.full(WINDOW, -1, np.int64))])
        counts += np.bincount(rows[rows >= 0], minlength=ROWS)
        for gap in range(1, WINDOW + 1):
            a, b = rows[:-gap], rows[gap:]
            both = (a >= 0) & (b >= 0)
            a, b = a[both], b[both]
            for e in range(ENTRIES):
                sums += np.bincount(a * DIMS + places[b, e], signs[b, e], ROWS * DIMS)
                sums += np.bincount(b * DIMS + places[a, e], signs[a, e], ROWS * DIMS)
    return counts, sums


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes: most of a small task's sums are zero, and tasks may be many."""
    return zlib.compress(numbers.astype("<f8").tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), "<f8")


def _task_sums(places: np.ndarray, signs: np.ndarray):
    """A task's counts and sums, cut into parts so that the parts can be added apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, sums, first, seen = np.zeros(ROWS), np.zeros(ROWS * DIMS), 0, False
        for batch in batches:
            c, s = add_contexts(batch["text"].tolist(), places, signs)
            counts, sums = counts + c, sums + s
            if not seen and len(batch):
                seen, first = True, zlib.crc32(batch["text"].iloc[0].encode("utf-8", "surrogatepass"))
        if seen:
            both = np.column_stack([counts, sums.reshape(ROWS, DIMS)])
            parts = np.split(both, _PARTS)
            yield pd.DataFrame(
                {"part": range(_PARTS), "slot": first % SLOTS[0], "sums": [_packed(p) for p in parts]}
            )

    return run


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(_unpacked(x) for x in group["sums"])
    return group.head(1).assign(sums=[_packed(total)])


def corpus_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(counts, context vectors of unit length) of all rows, over all of `docs` (text)."""
    places, signs = index_vectors()
    each = docs.select(whole_text(docs).alias("text")).mapInPandas(
        _task_sums(places, signs), "part int, slot int, sums binary"
    )
    for slots in SLOTS:
        dealt = each.withColumn("slot", F.col("slot") % slots)
        each = dealt.groupBy("part", "slot").applyInPandas(_added, "part int, slot int, sums binary")
    parts = {r.part: _unpacked(r.sums) for r in each.collect()}  # ROWS x (DIMS + 1) numbers
    if not parts:
        return np.zeros(ROWS), np.zeros((ROWS, DIMS))
    both = np.concatenate([parts[p] for p in range(_PARTS)]).reshape(ROWS, DIMS + 1)
    vectors = both[:, 1:]
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return both[:, 0], vectors / np.where(length > 0, length, 1)


@dataclass(frozen=True)
class Pooling:
    """Turns a text into a vector of 2 * DIMS + 1 numbers."""

    table: np.ndarray
    weights: np.ndarray

    @classmethod
    def over(cls, counts: np.ndarray, contexts: np.ndarray) -> Pooling:
        places, signs = index_vectors()
        own = np.zeros((ROWS, DIMS))
        np.put_along_axis(own, places, signs, axis=1)
        share = counts / max(counts.sum(), 1)
        return cls(np.column_stack([contexts, own]).astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32))

    def pooled(self, text: str) -> np.ndarray:
        rows = token_rows(text)
        if not len(rows):
            return np.zeros(2 * DIMS + 1)
        found = np.bincount(rows, minlength=ROWS)
        kinds = np.flatnonzero(found)
        w = found[kinds] * self.weights[kinds]
        return np.append(w @ self.table[kinds] / w.sum(), found[_AGAIN] / len(rows))

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self.pooled(t) for t in texts]).reshape(len(texts), 2 * DIMS + 1)


@dataclass(frozen=True)
class Network:
    """Two layers: tanh, then one logit, divided by a temperature."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _log_loss(p: np.ndarray, y: np.ndarray) -> float:
    return float(-np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 400, seed: int = 11) -> Network:
    """Fits on four fifths of the rows and takes the temperature that suits the fifth best.

    Both labels weigh the same in the fit. Without rows of both labels every score is the share of
    label 1 (one half if there is no row at all).
    """
    if len(np.unique(y)) < 2:
        share = np.clip((y.sum() + 1) / (len(y) + 2), 0.01, 0.99) if len(y) else 0.5
        d = 2 * DIMS + 1
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    aside = rng.permutation(len(y)) < len(y) // 5 if len(y) >= 50 else np.zeros(len(y), bool)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    fx, fy = (x[~aside] - mean) / spread, y[~aside]
    weight = np.where(fy > 0, 0.5 / max(fy.mean(), 1e-9), 0.5 / max(1 - fy.mean(), 1e-9)) / len(fy)
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.2, hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        h = np.tanh(fx @ p[0] + p[1])
        d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - fy) * weight
        dh = np.outer(d, p[2]) * (1 - h * h)
        grads = [fx.T @ dh + 1e-4 * p[0], dh.sum(axis=0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
        for a, g, s, q in zip(p, grads, m, v, strict=True):
            s += 0.1 * (g - s)
            q += 0.001 * (g * g - q)
            a -= 0.02 * (s / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    plain = Network(mean, spread, p[0], p[1], p[2], float(p[3][0]))
    if not aside.any():
        return plain
    logits = plain.logits(x[aside])
    fits = {t: _log_loss(1 / (1 + np.exp(-np.clip(logits / t, -40, 40))), y[aside]) for t in np.geomspace(0.25, 8, 41)}
    best = min(fits, key=fits.get)
    return Network(mean, spread, p[0], p[1], p[2], float(p[3][0]), float(best))


def _remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def _labelled(labels: DataFrame, most: int) -> DataFrame:
    """At most `most` labelled ids that may be learned from; ids with clashing labels are left out."""
    usable = (
        labels.select(labels["doc_id"].alias("id"), labels["quality"].alias("y"))
        .filter("y IS NOT NULL AND id IS NOT NULL")
        .filter(_remainder(F.col("id")) != 2)
        .groupBy("id")
        .agg(F.min("y").alias("y"), F.max("y").alias("y2"))
        .filter("y = y2")
        .select("id", "y")
    )
    return bounded_sample(held(usable, "labels"), "id", most)


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> tuple[Pooling, Network]:
    """Word vectors over all of `docs`; the network on at most `most` labelled documents, one of each doc_id."""
    pooling = Pooling.over(*corpus_vectors(docs))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = pooling.matrix(b["text"].tolist()).astype("<f8")
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "x": [r.tobytes() for r in x]})

    sample = held(_labelled(labels, most), "labelled")  # at most `most` rows of two numbers
    rows = (
        docs.select(docs["doc_id"].alias("id"), whole_text(docs).alias("text"))
        .join(F.broadcast(sample), "id")
        .mapInPandas(vectors, "id bigint, y int, x binary")
        .groupBy("id")
        .agg(F.min(F.struct("y", "x")).alias("one"))  # one text of an id that repeats: `most` rows at most
        .select("id", "one.*")
        .collect()
    )
    rows.sort(key=lambda r: r.id)
    x = np.array([np.frombuffer(r.x, "<f8") for r in rows]).reshape(len(rows), 2 * DIMS + 1)
    return pooling, fit_network(x, np.array([r.y for r in rows], float))


def score(docs: DataFrame, pooling: Pooling, network: Network) -> Column:
    """The score of each whole text; null and empty texts get the score of an empty vector."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(network.scores(pooling.matrix(texts.tolist())))

    return scores(whole_text(docs))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    held_out marks ids with crc32 remainder 2 (a null id is not held out, but has no label either). Null and
    empty texts have the score of an empty vector; texts of any length are scored whole, and equal texts alike.
    Rows that repeat are each returned; ids with clashing labels are not learned from. An empty table gives an
    empty result; other columns are not looked at.
    """
    scored = docs.select(
        docs["doc_id"],
        F.coalesce(_remainder(docs["doc_id"]) == 2, F.lit(False)).alias("held_out"),
        score(docs, *fit(docs, labels)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score of at least `threshold`, with all their columns, whatever their names.

    Scores are those of `quality_scores`; a row is judged by its text alone, so equal texts stay or go together.
    """
    return docs.filter(score(docs, *fit(docs, labels)) >= threshold)
