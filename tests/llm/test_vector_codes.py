from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from skyfare.llm.queries import ORACLE_SQL, QUERIES
from skyfare.llm.vector_codes import Gnat, _root_down, _root_up, books_digest, decoded, vector_codes
from tests.compare import differences
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, error string, v string, n string"


def brute(rows, parts=8, entries=16, rounds=6):
    """The contract in plain Python: (vec_id, code, error, label_error) per kept row, and the digest."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = max(1, math.ceil(max(len(v) for _, v, _ in kept) / parts))
    kept = [(i, v + [0] * (parts * width - len(v)), lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(part, p):
        return min((square(part, e), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, v, _ in kept:
                part = v[p * width : (p + 1) * width]
                members[nearest(part, p)[1]].append(part)
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else b for m, b in zip(members, books[p], strict=True)]
    out = []
    for i, v, lab in kept:
        near = [nearest(v[p * width : (p + 1) * width], p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near), lab))
    of_label = {}
    for _, _, e, lab in out:
        of_label[lab] = of_label.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, of_label[lab]) for i, c, e, lab in out), key=repr), digest


def outcome(df):
    rows = df.collect()
    digests = {r.codebooks_sha256 for r in rows}
    assert len(digests) <= 1
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows), key=repr), next(iter(digests), None)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    assert differences(QUERIES["op11_vector_codes"](spark, SF_DIR), con, ORACLE_SQL["op11_vector_codes"]) is None


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert outcome(QUERIES["op11_vector_codes"](spark, SF_DIR)) == brute(rows)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def test_odd_rows(spark):
    """Nulls, other lengths, no length, repeated ids and rows, ties, and columns with names used inside."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 16) / 4096], [None, 1, 2][i % 3]) for i in range(60)]
    rows += [(5, rows[5][1], 1), (5, rows[9][1], 1), (None, rows[3][1], 2), (None, None, 2), (100, None, 1), (101, [], 1)]
    rows += [(102, [1.0, None, 2.0], 1), (103, [float("nan")], 2), (104, [float("inf"), 1.0], 2), (-7, [0.25, -0.25, 0.1], None)]
    assert outcome(vector_codes(frame(spark, rows))) == brute(rows)


def test_fewer_rows_than_entries_and_none(spark):
    rows = [(2, [0.5] * 8, 1), (1, [0.25] * 8, 1)]
    assert outcome(vector_codes(frame(spark, rows))) == brute(rows)
    assert vector_codes(frame(spark, rows).limit(0)).collect() == []
    assert vector_codes(frame(spark, [(1, None, 1)])).collect() == []
    assert vector_codes(frame(spark, rows).limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_huge_components(spark):
    """Squares beyond a 64-bit number are still exact; an error beyond a long is null."""
    rows = [(i, [(-1.0) ** i * 1e5 * i, 3e5 + i, 2.0**32 * (i % 3), 0.5 * i], i % 2) for i in range(40)]
    got, digest = outcome(vector_codes(frame(spark, rows), parts=2, entries=4))
    want, expected = brute(rows, parts=2, entries=4)
    cut = lambda e: e if e < 1 << 63 else None
    assert digest == expected
    assert [g[:3] for g in got] == [(i, c, cut(e)) for i, c, e, _ in want]
    assert len(vector_codes(frame(spark, [(1, [1e308, -1e308], 1), (2, [1.0, 2.0], 1)]), parts=2).collect()) == 2


@pytest.mark.parametrize("entries,spread", [(1, 5), (3, 2), (16, 3), (16, 4000), (200, 50), (256, 4000)])
def test_tree_finds_what_trying_all_finds(entries, spread):
    rng = np.random.default_rng(entries)
    books = rng.integers(-spread, spread + 1, (entries, 4))
    points = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (500, 4)), books])
    for kind in (np.int64, object):
        tree = Gnat(books.astype(kind))
        found, squares = tree.nearest(points.astype(kind))
        every = ((points[:, None, :] - books[None]) ** 2).sum(axis=2)
        assert (found == every.argmin(axis=1)).all()  # argmin gives the lower index
        assert (squares == every.min(axis=1)).all()
        assert tree.met <= entries * len(points)
        if entries >= 200 and spread == 4000:
            assert tree.met < entries * len(points) / 2


def test_roots_are_exact():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, (1 << 31) ** 2 - 1, (1 << 30) ** 2, (1 << 30) ** 2 + 1], np.int64)
    for kind in (np.int64, object):
        assert _root_down(squares.astype(kind)).tolist() == [math.isqrt(x) for x in squares.tolist()]
        assert _root_up(squares.astype(kind)).tolist() == [math.isqrt(x - 1) + 1 if x else 0 for x in squares.tolist()]


def test_codes_decode_to_their_entries():
    books = [np.array([[1, 2], [3, 4]]), np.array([[5, 6], [7, -8]])]
    assert decoded(["0001", "0100"], books).tolist() == [[1, 2, 7, -8], [3, 4, 5, 6]]
    assert books_digest(books) == hashlib.sha256(b"1,2,3,4,5,6,7,-8").hexdigest()
