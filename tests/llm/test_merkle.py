from __future__ import annotations

import zlib
from hashlib import sha256
from itertools import groupby

import duckdb
import pytest

from skyfare.llm.merkle import Block, address, build_manifest, digest, fold, places, proofs, split_steps, verified_documents
from skyfare.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import differences
from tests.llm.conftest import SF_DIR

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, pos string, node string, n string, block string, item string, at string"


def h(*inputs):
    return sha256("".join(inputs).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """All levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def way(levels, i):
    for level in levels[:-1]:
        run = level[i - i % 2 : i - i % 2 + 2]
        yield run, i % 2
        i //= 2


def brute(rows):
    """The contract in plain Python, rows as (doc_id, text, lang, source, n_chars)."""
    by_lang = lambda r: (r[2] is not None, (r[2] or "").encode())
    rows = sorted(rows, key=lambda r: (by_lang(r), r[0] is not None, r[0] or 0, leaf(*r)))
    trees = [list(g) for _, g in groupby(rows, by_lang)]
    climbed = [climb([leaf(*r) for r in tree]) for tree in trees]
    top = climb([levels[-1][0] for levels in climbed])
    root = top[-1][0] if trees else None
    for t, tree in enumerate(trees):
        for i, (doc_id, text, lang, source, n_chars) in enumerate(tree):
            steps = [*way(climbed[t], i), *way(top, t)]
            tampered = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            value = leaf(doc_id, text, lang, source, n_chars + 1 if tampered else n_chars)
            for run, at in steps:
                value = h(*run[:at], value, *run[at + 1 :])
            proof = h(*(x for run, at in steps for j, x in enumerate(run) if j != at))
            yield doc_id, climbed[t][0][i], climbed[t][-1][0], root, proof, value, value == root


def outcome(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 7) for r in rows], SCHEMA).repartition(3)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert differences(QUERIES["op12_merkle"](spark, SF_DIR), con, ORACLE_SQL["op12_merkle"]) is None


def test_query_against_plain_python(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = outcome(QUERIES["op12_merkle"](spark, SF_DIR))
    assert got == sorted(brute(rows), key=repr)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("height", [1, 2, 8])
def test_odd_rows(spark, height):
    """Nulls in every column, empty and long texts, repeated ids and rows, trees of one leaf to many blocks."""
    rows = [(i, f"text {i}", "en", "web", i) for i in range(37)] + [(i, "é🙂" * i, "de", None, None) for i in range(9)]
    rows += [(5, "other", "en", "web", 5), (5, "other", "en", "web", 5), (5, None, "en", None, 2**63 - 1), (None, "", "en", "web", 0)]
    rows += [(None, None, None, None, None), (7, "", None, "", 1), (-20, "x" * 300_000, "", "web", 1), (1, "a", "zz", "web", 1), (2, "b", "éa", "web", 1)]
    got = outcome(verified_documents(frame(spark, rows), height))
    assert got == sorted(brute(rows), key=repr)


def test_one_row_and_none(spark):
    assert outcome(verified_documents(frame(spark, [(1, "a", "en", "web", 1)]))) == list(brute([(1, "a", "en", "web", 1)]))
    empty = verified_documents(frame(spark, [(1, "a", "en", "web", 1)]).limit(0))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_many_languages_and_many_equal_rows(spark):
    rows = [(i, "t", f"l{i}", "web", 1) for i in range(50)] + [(3, "same", "en", "web", 4)] * 40
    assert outcome(verified_documents(frame(spark, rows), 2)) == sorted(brute(rows), key=repr)


def test_proofs_hold_for_their_document_only(spark, docs):
    manifest = build_manifest(docs, 3)
    for r in proofs(manifest).collect():
        assert len(r.siblings) % 64 == 0
        assert (r.folded_root == manifest.root) == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)


def test_layout():
    """Every node has a place of its own, and each subtree cut at half height lies in one stretch."""
    for levels in range(1, 10):
        where = [list(map(int, p)) for p in places(levels)]
        assert sorted(x for row in where for x in row) == list(range(2**levels - 1))
        assert where[0] == [0]
        top = levels // 2
        if top:
            assert sorted(x for row in where[:top] for x in row) == list(range(2**top - 1))
            for s in range(2**top):
                inside = [where[d][i] for d in range(top, levels) for i in range(s << (d - top), (s + 1) << (d - top))]
                assert sorted(inside) == list(range(min(inside), min(inside) + 2 ** (levels - top) - 1))
    assert [address(4, d, 0) for d in range(4)] == [0, 1, 3, 4]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 16])
def test_block(size):
    digests = [digest(str(i)) for i in range(size)]
    block = Block.of("".join(digests), 4)
    for i, d in enumerate(digests):
        assert block.leaf(i) == d
        assert fold(d, block.steps(i)) == block.node(0, 0)
        assert split_steps("".join(block.steps(i))) == block.steps(i)
        assert fold(digest("x"), block.steps(i)) != block.node(0, 0)
