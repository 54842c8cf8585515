"""Shards of near-equal size by sampled splitters.

Rows are ordered by (hash of the text, doc_id). A size-weighted sample of keys gives quantiles, which
cut the order into many ranges of like size; ranges that turn out overfull are sampled again and
subdivided, between texts where it holds several, else between the copies of its one text. Each range is
sorted on its own, and the exact sizes of the ranges before it place its rows in the whole order and so in a
shard. Copies of a text go where the first of them goes; only where they are a large part of a shard are
they parted.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from skyfare.llm.common import held, whole_text
from skyfare.scratch import hold

SHARDS = 8
LEAST_RANGES, MOST_RANGES, RANGE_ROWS = 512, 1 << 16, 50_000
PER_RANGE = 8  # sampled keys
ONE_TEXT = 16  # copies of one text are parted if they are more than this part of a shard
_KEY = ["h", "id", "uid"]
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1
_ROUNDS = 20


@dataclass(frozen=True)
class Splitters:
    """Sorted cuts (h, id, uid); a row's range is the number of cuts at or below its key."""

    h: np.ndarray
    rest: np.ndarray  # id and uid, two columns

    @classmethod
    def of(cls, cuts: list[tuple[int, int, int]]) -> Splitters:
        a = np.array(sorted(set(cuts)), np.int64).reshape(-1, 3)
        return cls(a[:, 0].copy(), a[:, 1:].copy())

    def cuts(self) -> list[tuple[int, int, int]]:
        return [(int(h), int(a), int(b)) for h, (a, b) in zip(self.h, self.rest, strict=True)]

    def ranges(self, h: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.h, h, "left"), np.searchsorted(self.h, h, "right")
        found = low.copy()
        for i in np.flatnonzero(high > low):  # rows of a text that some cut names
            found[i] = low[i] + self._below(int(low[i]), int(high[i]), int(ids[i]), int(uids[i]))
        return found

    def _below(self, low: int, high: int, doc: int, uid: int) -> int:
        a, b = 0, high - low
        while a < b:
            mid = (a + b) // 2
            if tuple(self.rest[low + mid]) <= (doc, uid):
                a = mid + 1
            else:
                b = mid
        return a


def _with_range(rows: DataFrame, splitters: Splitters) -> DataFrame:
    @F.pandas_udf("bigint")
    def of_key(h: pd.Series, ids: pd.Series, uids: pd.Series) -> pd.Series:
        return pd.Series(splitters.ranges(h.to_numpy(), ids.to_numpy(), uids.to_numpy()))

    return rows.withColumn("range", of_key(*_KEY))


def _sampled(rows: DataFrame, per_byte: float, seed: int) -> list[tuple[int, int, int]]:
    """Keys drawn with a chance in proportion to the row's size, decided by a hash of the key."""
    u = F.pmod(F.xxhash64(*_KEY, F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    return [tuple(r) for r in rows.filter(u < F.col("size") * per_byte).select(*_KEY).collect()]


def _quantiles(keys: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int]]:
    keys = sorted(keys)
    return [keys[len(keys) * k // n] for k in range(1, n) if len(keys)]


def _range_sizes(rows: DataFrame, splitters: Splitters) -> list[T.Row]:
    return (
        _with_range(rows, splitters)
        .groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("h").alias("low"), F.max("h").alias("high"))
        .orderBy("range")
        .collect()
    )  # a row per range


def _splitters(rows: DataFrame, n_rows: int, total: int) -> tuple[Splitters, list[T.Row]]:
    n = min(MOST_RANGES, max(LEAST_RANGES, n_rows // RANGE_ROWS))
    sample = _sampled(rows, PER_RANGE * n / total, 0)
    splitters = Splitters.of([(h, _FIRST, _FIRST) for h, _, _ in _quantiles(sample, n)])
    most = 2 * total / n
    sizes = _range_sizes(rows, splitters)
    for seed in range(1, _ROUNDS):
        overfull = {r.range: r for r in sizes if r.n > 1 and r.bytes > most}
        if not overfull:
            break
        inside = held(_with_range(rows, splitters).filter(F.col("range").isin(list(overfull))), "overfull")
        cuts = splitters.cuts()
        keys: dict[int, list] = {k: [] for k in overfull}
        drawn = _sampled(inside, PER_RANGE * n / total, seed)
        at = splitters.ranges(*(np.array([k[i] for k in drawn], np.int64) for i in range(3)))
        for key, r in zip(drawn, at.tolist(), strict=True):
            keys[r].append(key)
        before = len(splitters.h)
        for k, r in overfull.items():
            parts = max(2, int(np.ceil(r.bytes / most)) * 2)
            new = _quantiles(keys[k], parts)
            if r.low == r.high:  # between the copies of the one text
                cuts += new
                continue
            # before and behind texts, so that one with many copies comes to have ranges of its own
            cuts += [(h, _FIRST, _FIRST) for h in {*(h for h, _, _ in new), r.high} if h > r.low]
            cuts += [(h, _LAST, _LAST) for h in {h for h, _, _ in new} if h < r.high]
        splitters = Splitters.of(cuts)
        if len(splitters.h) == before:
            continue
        sizes = _range_sizes(rows, splitters)
    return splitters, sizes


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 bytes of the text (null: none) plus 1. A shard begins at the row with which the
    bytes before it reach its share of all bytes; copies of a text stay together, unless they are more
    than a 16th of a shard. Null ids come first among copies, rows that repeat an id are kept apart.
    """
    text = whole_text(docs)
    table = hold(
        docs.select(
            docs["doc_id"],
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_FIRST)).alias("id"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "sizes",
    )
    rows = table.df
    total = rows.agg(F.sum("size").alias("s")).first().s or 1
    splitters, sizes = _splitters(rows, table.rows, total)
    before, n, starts = 0, 0, []
    of_text: Counter = Counter()  # bytes of texts that have ranges of their own, which begin with the text
    first: dict[int, int] = {}
    for r in sizes:
        if r.low == r.high:
            of_text[r.low] += r.bytes
            first.setdefault(r.low, before)
        starts.append((r, before, n))
        before, n = before + r.bytes, n + r.n
    parted = {h for h, size in of_text.items() if size > total / (shards * ONE_TEXT)}
    places = docs.sparkSession.createDataFrame(
        [
            (r.range, b, k, r.low == r.high and r.low in parted, first[r.low] if r.low == r.high else None)
            for r, b, k in starts
        ],
        "range bigint, bytes_before bigint, rows_before bigint, parted boolean, from_text bigint",
    )  # a row per range, at most a few times MOST_RANGES
    in_range = Window.partitionBy("range").orderBy(*_KEY)
    ahead = in_range.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        _with_range(rows, splitters)
        .withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
        .withColumn("nth", F.row_number().over(in_range))
        .withColumn("text_ahead", F.min("ahead").over(Window.partitionBy("range", "h")))
        .join(F.broadcast(places), "range")
        .withColumn(
            "from",
            F.when(F.col("parted"), F.col("bytes_before") + F.col("ahead")).otherwise(
                F.coalesce("from_text", F.col("bytes_before") + F.col("text_ahead"))
            ),
        )
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.expr(f"int(from * {shards} DIV {total}L)"), F.lit(shards - 1)).alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("nth"),
        )
    )
    placed = held(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("nth").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("nth") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
