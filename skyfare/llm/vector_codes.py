"""Vectors as short codes: each vector is cut into parts, and a part is stored as the nearest entry of its codebook.

Everything is whole numbers, so results do not depend on the order of rows, tasks or additions. The nearest
entry is found in a GNAT (geometric near-neighbour access tree) over the entries: a node has a few split
points, hangs every other entry on the nearest of them, and stores for each split point the range of its
distances to each group. A query that has met one split point leaves out every group whose range is farther
from the query's distance than the best entry so far. Distances are rounded down where a group would be left
out for being too far and up otherwise, and only strictly farther groups go; so no entry that ties with the
best is ever lost, and ties are settled on the exact squared distances, to the lower index.

The codebooks are fitted in rounds over all vectors: each task hands on sums per entry, never vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from skyfare.llm.common import held
from skyfare.operators.lookup import lookup_join
from skyfare.scratch import hold

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4
_BOUND = 1 << 62
_ROWS_AT_ONCE = 1 << 22  # components of vectors that a task works on at a time

_isqrt = np.frompyfunc(math.isqrt, 1, 1)


def _root_down(squares: np.ndarray) -> np.ndarray:
    """Square roots rounded down to whole numbers, exactly."""
    if squares.dtype == object:
        return _isqrt(squares)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def _root_up(squares: np.ndarray) -> np.ndarray:
    down = _root_down(squares)
    return down + (down * down < squares)


def _squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = points - point
    return (apart * apart).sum(axis=1)


@dataclass
class _Node:
    splits: list[int]
    nearest: np.ndarray  # [i, j]: at least so far is split point i from anything in group j
    farthest: np.ndarray
    below: list[_Node | None]


class Gnat:
    """Nearest rows of `entries`, a matrix of whole numbers, by Euclidean distance; ties to the lower index.

    Entries may repeat. `met` counts the distances worked out, for comparison with trying every entry.
    """

    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries, self.degree, self.met = entries, degree, 0
        self.root = self._node(list(range(len(entries))))

    def _node(self, ids: list[int]) -> _Node:
        splits = ids[:1]
        closest = _squared(self.entries[ids], self.entries[ids[0]])
        while len(splits) < min(self.degree, len(ids)):
            closest[[ids.index(s) for s in splits]] = -1
            far = int(np.argmax(closest))
            splits.append(ids[far])
            closest = np.minimum(closest, _squared(self.entries[ids], self.entries[ids[far]]))
        rest = [i for i in ids if i not in splits]
        groups: list[list[int]] = [[] for _ in splits]
        if rest:
            to_splits = np.stack([_squared(self.entries[rest], self.entries[s]) for s in splits])
            for i, j in zip(rest, np.argmin(to_splits, axis=0), strict=True):
                groups[j].append(i)
        spans = [[_squared(self.entries[[s, *g]], self.entries[p]) for s, g in zip(splits, groups, strict=True)] for p in splits]
        return _Node(
            splits,
            np.stack([_root_down(np.array([d.min() for d in row], self.entries.dtype)) for row in spans]),
            np.stack([_root_up(np.array([d.max() for d in row], self.entries.dtype)) for row in spans]),
            [self._node(g) if g else None for g in groups],
        )

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of `points` the index of its nearest entry, and the squared distance."""
        best = _squared(points, self.entries[self.root.splits[0]])
        found = np.full(len(points), self.root.splits[0], np.int64)
        self._visit(self.root, points, np.arange(len(points)), best, found)
        return found, best

    def _visit(self, node: _Node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        open_ = np.ones((len(rows), len(node.splits)), bool)
        seen: list[tuple[np.ndarray, int, np.ndarray, np.ndarray]] = []

        def leave_out(at: np.ndarray, i: int, low: np.ndarray, high: np.ndarray) -> None:
            """Closes the groups that cannot hold anything as near as the best so far."""
            radius = _root_up(best[rows[at]])[:, None]
            beyond = low[:, None] - node.farthest[i] > radius
            within = node.nearest[i] - high[:, None] > radius
            open_[at] &= ~(beyond | within).astype(bool)

        for i, split in enumerate(node.splits):
            at = np.flatnonzero(open_[:, i])
            if not len(at):
                continue
            squares = _squared(points[rows[at]], self.entries[split])
            self.met += len(at)
            here, index = best[rows[at]], found[rows[at]]
            better = (squares < here).astype(bool) | ((squares == here).astype(bool) & (split < index))
            best[rows[at[better]]] = squares[better]
            found[rows[at[better]]] = split
            seen.append((at, i, _root_down(squares), _root_up(squares)))
            leave_out(*seen[-1])
        for j, child in enumerate(node.below):
            if child is None:
                continue
            for one in seen:  # with the best found since
                leave_out(*one)
            at = np.flatnonzero(open_[:, j])
            if len(at):
                self._visit(child, points, rows[at], best, found)


def _floors(batch: pa.RecordBatch, scale: int) -> pa.RecordBatch:
    lists = batch.column("embedding")
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(there, lengths, 0)
    row_of = np.repeat(np.arange(len(lists)), lengths)
    fine = there & (np.bincount(row_of[~np.isfinite(flat)], minlength=len(lists)) == 0)
    kept = flat[fine[row_of]]
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(kept * scale), -float(_BOUND), float(_BOUND)).astype(np.int64)
    offsets = np.r_[0, np.cumsum(lengths[fine])].astype(np.int32)
    arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole))
    some = pa.array(fine)
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id").filter(some), batch.column("label").filter(some), arrays], ["vec_id", "label", "v"]
    )


def whole_vectors(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows of `df` (vec_id, embedding, label) whose embedding is whole: floor(scale * x).

    Rows whose vector is null or holds a null or a component that is not finite are left out. Floors
    beyond 2**62 either way count as that bound.
    """
    rows = df.select(
        df["vec_id"].cast("bigint").alias("vec_id"), df["label"].alias("label"), df["embedding"].cast("array<double>").alias("embedding")
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("v", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(lambda batches: (_floors(b, scale) for b in batches), schema)


@dataclass(frozen=True)
class Shape:
    """How vectors are cut: `parts` of `width` components; `exact`, if squares may pass a 64-bit number."""

    parts: int
    width: int
    exact: bool

    def matrices(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Slices of the rows with their vectors as a matrix, shorter vectors filled with zeros."""
        step = max(1, _ROWS_AT_ONCE // max(1, self.parts * self.width))
        for start in range(0, batch.num_rows, step):
            piece = batch.slice(start, step)
            lists = piece.column("v")
            lengths = np.diff(lists.offsets.to_numpy())
            matrix = np.zeros((piece.num_rows, self.parts * self.width), np.int64)
            matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
            yield piece, matrix.astype(object) if self.exact else matrix

    def cut(self, matrix: np.ndarray, part: int) -> np.ndarray:
        return matrix[:, part * self.width : (part + 1) * self.width]


Books = Sequence[np.ndarray]  # per part: entries x width


def _first_books(whole: DataFrame, shape: Shape, entries: int) -> list[np.ndarray]:
    """The vectors of the `entries` smallest ids; of rows that repeat an id the lesser vectors first, no id last."""
    ids = [r.vec_id for r in whole.where("vec_id IS NOT NULL").select("vec_id").orderBy("vec_id").limit(entries).collect()]
    near = whole.where(F.col("vec_id") <= ids[-1]) if len(ids) == entries else whole
    rows = near.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    matrix = np.zeros((len(rows), shape.parts * shape.width), object if shape.exact else np.int64)
    for i, r in enumerate(rows):
        matrix[i, : len(r.v)] = r.v
    return [shape.cut(matrix, p) for p in range(shape.parts)]


def _entry_sums(shape: Shape, books: Books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        sums = [np.zeros(b.shape, b.dtype) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for _, matrix in shape.matrices(batch):
                for p, tree in enumerate(trees):
                    points = shape.cut(matrix, p)
                    found, _ = tree.nearest(points)
                    np.add.at(sums[p], found, points)
                    counts[p] += np.bincount(found, minlength=len(tree.entries))
        used = [(p, e) for p, n in enumerate(counts) for e in np.flatnonzero(n)]
        cells = [((p * len(books[p]) + int(e)) * shape.width + i, int(counts[p][e]), int(sums[p][e][i])) for p, e in used for i in range(shape.width)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _, _ in cells], pa.int64()),
                pa.array([n for _, n, _ in cells], pa.int64()),
                pa.array([Decimal(s) for _, _, s in cells], pa.decimal128(38, 0)),
            ],
            ["cell", "n", "total"],
        )

    return run


def refit(whole: DataFrame, shape: Shape, books: Books) -> list[np.ndarray]:
    """One round: every part goes to its nearest entry, every used entry to the floor of its parts' mean.

    The driver gets one number per component of the codebooks, however many vectors there are.
    """
    sums = whole.mapInArrow(_entry_sums(shape, books), "cell bigint, n bigint, total decimal(38,0)")
    cells = sums.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")).collect()
    moved = [b.copy() for b in books]
    for r in cells:
        entry, position = divmod(r.cell, shape.width)
        part, entry = divmod(entry, len(books[0]))
        moved[part][entry, position] = int(r.total) // r.n
    return moved


def fitted_books(whole: DataFrame, shape: Shape, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks after `rounds` rounds; a round that moves nothing is the last, as all others would repeat it."""
    books = _first_books(whole, shape, entries)
    for _ in range(rounds):
        before, books = books, refit(whole, shape, books)
        if all((a == b).all() for a, b in zip(before, books, strict=True)):
            break
    return books


def _encode(shape: Shape, books: Books, label: pa.DataType | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            for piece, matrix in shape.matrices(batch):
                near = [tree.nearest(shape.cut(matrix, p)) for p, tree in enumerate(trees)]
                codes = np.stack([found for found, _ in near], axis=1)
                errors = sum((squares.astype(object) for _, squares in near), np.zeros(len(codes), object))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("vec_id"),
                        piece.column("label"),
                        pa.array(["".join(f"{c:02x}" for c in row) for row in codes.tolist()], pa.string()),
                        pa.array([int(e) if e < 1 << 63 else None for e in errors], pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def books_digest(books: Books) -> str:
    """SHA-256 of all entries' components by part, entry and position, as decimal text with commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def decoded(codes: Sequence[str], books: Books) -> np.ndarray:
    """The vectors that codes stand for, in the same whole numbers."""
    return np.array([[x for p, b in enumerate(books) for x in b[int(code[2 * p : 2 * p + 2], 16)]] for code in codes])


def vector_codes(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every row of `df` (vec_id, embedding, label) with a whole vector.

    `code` has two hex digits for each part, `error` is the squared distance between the vector and what its
    code stands for, `label_error` the sum over all rows of the same label (rows without a label together).
    Rows whose vector is null or holds a null or non-finite component are dropped. Vectors of different
    lengths, or of one that `parts` does not divide, count as filled up with zeros; an empty vector is all
    zeros. Of equally near entries the one with the lower index is taken. Rows may repeat, also their ids:
    each is returned. Without a vec_id a row comes last where the first codebook is chosen. With fewer rows
    than entries the codebooks are as small. Components of any size are worked out exactly; an error that a
    long cannot hold is null. An empty table gives an empty result; other columns are not looked at.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    spark = df.sparkSession
    whole = held(whole_vectors(df, scale), "vectors")
    longest, low, high = whole.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    width = max(1, math.ceil((longest or 0) / parts))
    most = max(abs(low or 0), abs(high or 0))
    shape = Shape(parts, width, (2 * most + 2) ** 2 * width >= 1 << 61)
    result = T.StructType([*whole.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if longest is None:
        none = spark.createDataFrame([], result)
        return none.select("vec_id", "code", "error", F.lit(None).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = fitted_books(whole, shape, entries, rounds)
    coded = hold(whole.mapInArrow(_encode(shape, books), result), "codes").df
    of_label = hold(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    unlabelled = of_label.df.where("label IS NULL").first()
    joined = lookup_join(coded, of_label, {"label": "label"}, salt_by=["vec_id"])
    without = F.lit(unlabelled.label_error if unlabelled else None).cast("bigint")
    return joined.select(
        "vec_id",
        "code",
        "error",
        F.when(F.col("label").isNull(), without).otherwise(F.col("label_error")).alias("label_error"),
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
