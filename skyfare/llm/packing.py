"""Packing documents into sequences of a fixed number of tokens by a grouping genetic algorithm.

A document longer than a sequence is cut into full pieces and a rest. Full pieces are sequences of
their own; all others are dealt by a hash into blocks of about `BLOCK` pieces. On each of a block's
islands a population of packings evolves: a child takes over whole well-filled bins of one parent,
the bins of the other parent that repeat one of their pieces are opened, and the pieces displaced by
this go where they fit best. After each epoch the best packing of every island moves on to the next
island. A table row holds one island, so islands evolve apart and an epoch is one pass over the table,
written to the shared folder. Then the bins of all blocks that are not well filled are opened, and
their pieces are dealt into new blocks and packed again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from skyfare.llm.common import held, whole_text
from skyfare.llm.word_tokens import WordTokens
from skyfare.scratch import hold

CAPACITY = 2048
END = 0
BLOCK = 2000


@dataclass(frozen=True)
class Settings:
    capacity: int = CAPACITY
    block: int = BLOCK
    islands: int = 2
    population: int = 5
    epochs: int = 2
    children: int = 10
    full: float = 0.995
    rounds: int = 2


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32): the pieces of every row of `docs` (doc_id, text).

    A document is the ids of its text (null: empty) and one id 0 at the end, so it has a piece at
    least. `uid` tells rows apart that repeat a doc_id.
    """

    @F.pandas_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens, end, step = WordTokens(tokenizer_path), END.to_bytes(4, "little"), 4 * capacity
        for texts in batches:
            found = []
            for ids in tokens.ids(texts.tolist()):
                ids += end
                pieces = (ids[at : at + step] for at in range(0, len(ids), step))
                found.append([(n, n * capacity, len(p) // 4, zlib.crc32(p)) for n, p in enumerate(pieces)])
            yield pd.Series(found)

    cut = cut.asNondeterministic()  # or the plan would cut twice, once to see whether there are pieces
    cut_rows = docs.select(docs["doc_id"], cut(whole_text(docs)).alias("pieces")).select("doc_id", F.inline("pieces"))
    return cut_rows.withColumn("uid", F.monotonically_increasing_id())


# --- one packing: an array with each piece's bin ---------------------------------------------------


def best_fit(order: np.ndarray, lengths: np.ndarray, free: list[int], capacity: int) -> np.ndarray:
    """The bin of each piece of `order`, taken in this order: the fullest bin that has room, or a new one.

    `free` has the room of the bins that there are; new ones get the numbers after them.
    """
    room = sorted((f, b) for b, f in enumerate(free) if f)
    bins, n = np.empty(len(order), np.int64), len(free)
    for k, size in enumerate(lengths[order].tolist()):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, n
            n += 1
        bins[k] = b
        if left > size:
            insort(room, (left - size, b))
    return bins


def _renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then bins that are as unequally filled as can be."""
    fills = np.bincount(bins, lengths)
    return float(-len(fills) + np.mean((fills / capacity) ** 2) / 2)


def _placed(bins: np.ndarray, displaced: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """`bins` with the displaced pieces placed anew, largest first."""
    child = np.full(len(bins), -1, np.int64)
    child[~displaced] = _renumbered(bins[~displaced])
    free = (capacity - np.bincount(child[~displaced], lengths[~displaced])).astype(np.int64).tolist()
    out = np.flatnonzero(displaced)
    out = out[np.argsort(-lengths[out], kind="stable")]
    child[out] = best_fit(out, lengths, free, capacity)
    return child


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of `a` in `b`; bins of `b` that repeat their pieces are opened."""
    fills = np.bincount(a, lengths)
    good = fills >= np.quantile(fills, 0.5)
    given = good & (rng.random(len(fills)) < rng.uniform(0.2, 0.6))
    injected = given[a]
    opened = np.zeros(b.max() + 1, bool)
    opened[b[injected]] = True
    mixed = np.where(injected, a + len(opened), b)
    return _placed(mixed, opened[b] & ~injected, lengths, capacity)


def mutated(a: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """The emptiest bins and a few others are opened."""
    fills = np.bincount(a, lengths)
    opened = rng.random(len(fills)) < 2 / len(fills)
    opened[np.argsort(fills)[: 1 + rng.integers(3)]] = True
    return _placed(a, opened[a], lengths, capacity)


def first_packings(lengths: np.ndarray, s: Settings, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit of the pieces, largest first, the order blurred a little for all but the first."""
    found = []
    for k in range(s.population):
        keys = lengths * (1 + 0.15 * k * rng.random(len(lengths)) / s.population)
        order = np.argsort(-keys, kind="stable")
        bins = np.empty(len(lengths), np.int64)
        bins[order] = best_fit(order, lengths, [], s.capacity)
        found.append(bins)
    return found


def evolved(population: list[np.ndarray], lengths: np.ndarray, s: Settings, rng: np.random.Generator) -> list[np.ndarray]:
    """The best packings after one epoch, best first."""
    least = -(-int(lengths.sum()) // s.capacity)
    ranked = sorted(((fitness(p, lengths, s.capacity), p) for p in population), key=lambda x: -x[0])
    for _ in range(s.children):
        if ranked[0][1].max() + 1 <= least:
            break  # no packing has fewer bins
        i, j = sorted(rng.integers(0, len(ranked), 2))
        child = crossover(ranked[i][1], ranked[j][1], lengths, s.capacity, rng)
        child = mutated(child, lengths, s.capacity, rng)
        ranked = sorted([*ranked, (fitness(child, lengths, s.capacity), child)], key=lambda x: -x[0])[: s.population]
    return [p for _, p in ranked]


# --- islands as table rows ---------------------------------------------------------------------------

_ISLANDS = "block bigint, island int, uids array<bigint>, lengths array<int>, packings array<array<int>>, score double"


def _epoch(s: Settings, number: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                lengths = np.asarray(row.lengths, np.int64)
                rng = np.random.default_rng([row.block, row.island, number])
                packings = [np.asarray(p, np.int64) for p in row.packings]
                packings = evolved(packings or first_packings(lengths, s, rng), lengths, s, rng)
                score = fitness(packings[0], lengths, s.capacity)
                out.append((row.block, row.island, row.uids, row.lengths, [p.astype(np.int32) for p in packings], score))
            yield pd.DataFrame(out, columns=["block", "island", "uids", "lengths", "packings", "score"])

    return run


def _migrated(state: DataFrame, islands: int) -> DataFrame:
    """Every island's best packing joins the packings of the next island of its block."""
    elite = state.select(
        "block", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("packings")[0].alias("guest")
    )
    return state.join(elite, ["block", "island"]).select(
        "block", "island", "uids", "lengths", F.array_append("packings", F.col("guest")).alias("packings"), "score"
    )


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per piece of the best packing: its bin, its place there, and how full the bin is."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            bins, lengths = np.asarray(row.best, np.int64), np.asarray(row.lengths, np.int64)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(lengths[order])
            fills = np.bincount(bins, lengths).astype(np.int64)
            yield pd.DataFrame(
                {
                    "uid": np.asarray(row.uids, np.int64)[order],
                    "block": row.block,
                    "bin": bins[order],
                    "offset": ends - lengths[order] - (np.cumsum(fills) - fills)[bins[order]],
                    "fill": fills[bins[order]],
                }
            )


def _packed_once(pieces: DataFrame, rows: int, s: Settings, number: int) -> DataFrame:
    """(uid, length, round, block, bin, offset, fill) for `pieces` (uid, length)."""
    blocks = max(1, round(rows / s.block))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(blocks)))
    state = (
        dealt.groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("length").cast("int").alias("length"), "uid"))).alias("p"))
        .select(
            "block",
            F.explode(F.sequence(F.lit(0), F.lit(s.islands - 1))).alias("island"),
            F.col("p.uid").alias("uids"),
            F.col("p.length").alias("lengths"),
            F.expr("CAST(array() AS array<array<int>>)").alias("packings"),
            F.lit(0.0).alias("score"),
        )
        .repartition("block", "island")
    )
    for epoch in range(s.epochs):
        if epoch:
            state = _migrated(state, s.islands).repartition("block", "island")
        state = held(state.mapInPandas(_epoch(s, epoch), _ISLANDS), "islands")
    best = state.groupBy("block").agg(
        F.max_by(F.struct("uids", "lengths", F.col("packings")[0].alias("best")), F.struct("score", -F.col("island"))).alias("b")
    )
    spread = best.select("block", "b.*").mapInPandas(
        _spread, "uid bigint, block bigint, bin bigint, offset bigint, fill bigint"
    )
    return spread.withColumn("round", F.lit(number))


def packed(pieces: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(uid, sequence_id, offset) for every row of `pieces` (uid, length)."""
    # full pieces have the negative numbers, all other sequences those from 2**56
    alone = pieces.filter(F.col("length") >= s.capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    parts, rest = [alone], hold(pieces.filter(F.col("length") < s.capacity).select("uid", "length"), "rest")
    for number in range(1, s.rounds + 1):
        if rest.rows == 0:
            break
        found = held(_packed_once(rest.df, rest.rows, s, number), "packed")
        last = number == s.rounds
        done = found if last else found.filter(F.col("fill") >= s.full * s.capacity)
        # a number for each (round, block, bin): a block has fewer than 2**20 bins
        numbered = F.col("round") * F.lit(1 << 56) + F.shiftleft("block", 20) + F.col("bin")
        parts.append(done.select("uid", numbered.alias("sequence_id"), "offset"))
        if not last:
            again = found.filter(F.col("fill") < s.full * s.capacity).select("uid")
            rest = hold(rest.df.join(again, "uid", "left_semi"), "rest")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def packed_documents(docs: DataFrame, tokenizer_path: str, s: Settings = Settings()) -> DataFrame:
    """One row per piece of every row of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty and is one piece, the closing id alone. Texts of any length are cut, none is
    shortened. Rows that repeat, also their ids, are packed each. An empty table gives an empty result; other
    columns are not looked at.
    """
    pieces = held(token_pieces(docs, tokenizer_path, s.capacity), "pieces")
    return pieces.join(packed(pieces, s), "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
