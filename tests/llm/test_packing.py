from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyfare.llm import packing as p
from skyfare.llm.word_tokens import WordTokens
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def expected_pieces(tokenizer, rows, capacity):
    for i, t in rows:
        ids = whole_ids(tokenizer, t)
        for n, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at : at + capacity]
            yield i, n, at, len(cut), zlib.crc32(cut.tobytes())


def check(rows, tokenizer, texts, capacity):
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(expected_pieces(tokenizer, texts, capacity), key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_documents(docs, texts, tokenizer):
    rows = p.packed_documents(docs, PATH).collect()
    n = check(rows, tokenizer, texts, p.CAPACITY)
    least = -(-sum(r.length for r in rows) // p.CAPACITY)
    assert n <= least + 2


def test_many_blocks_and_islands(docs, texts, tokenizer):
    s = p.Settings(capacity=512, block=40, islands=3, population=4, epochs=3, children=4, rounds=3)
    rows = p.packed_documents(docs, PATH, s).collect()
    check(rows, tokenizer, texts, 512)


def test_odd_rows(odd, none, tokenizer):
    rows = p.packed_documents(odd, PATH).collect()
    check(rows, tokenizer, ODD_TEXTS, p.CAPACITY)
    assert p.packed_documents(none, PATH).count() == 0


def test_ids_are_the_tokenizers(tokenizer, texts):
    tokens = WordTokens(PATH, most_words=50)
    odd = ["", "a\x1cb c", "Don't STOP'S x<|endoftext|>y <|EndOfText|>", "ΣΑΣ ΟΔΟΣ.", "İstanbul KÅ ﬁ", "é x ́y",
           "²³½ 12a_b__c", "a b\x85c\xa0d᠎e​f", "日本語 🙂🙂 a🙂b", "﻿ x", "a\x00b", "<|", "ŉ Ǆ ß ẞ", "''s 's'S l'été"]
    every = odd + [t for _, t in texts[:60]]
    for i in range(0, len(every), 7):
        some = every[i : i + 7]
        want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert list(tokens.ids(some)) == want


def packing_is_sound(bins, lengths, capacity):
    fills = np.bincount(bins, lengths)
    return (fills <= capacity).all() and (fills > 0).all()


def test_operators_keep_every_piece_once():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 300)
    s = p.Settings(capacity=100)
    first = p.first_packings(lengths, s, rng)
    assert all(packing_is_sound(x, lengths, 100) for x in first)
    child = p.crossover(first[0], first[1], lengths, 100, rng)
    assert packing_is_sound(child, lengths, 100) and len(child) == 300
    assert packing_is_sound(p.mutated(child, lengths, 100, rng), lengths, 100)
    best = p.evolved(first, lengths, s, rng)[0]
    assert best.max() <= min(x.max() for x in first)


def test_evolution_finds_what_best_fit_misses():
    """Triples that fill a bin exactly: largest-first best fit needs more bins than the optimum."""
    rng = np.random.default_rng(5)
    parts = [(a := int(rng.integers(26, 48)), b := int(rng.integers(26, 74 - a)), 100 - a - b) for _ in range(40)]
    lengths = np.array([x for t in parts for x in t])
    s = p.Settings(capacity=100, population=8, children=150)
    first = p.first_packings(lengths, s, rng)
    best = p.evolved(first, lengths, s, rng)[0]
    assert p.fitness(best, lengths, 100) >= max(p.fitness(x, lengths, 100) for x in first)
    assert packing_is_sound(best, lengths, 100)


def test_full_pieces_share_no_number(spark):
    """Rows of tasks 8 and 16 beside the first bins of rounds 1 and 2, and rows of task 2048 beside those of task 0."""
    full = [task << 33 | row for task in (0, 8, 16, 2048, 2056) for row in range(3)]
    rows = [(u, 100) for u in full] + [((1 << 33) + i, 30 + i % 25) for i in range(300)]
    s = p.Settings(capacity=100, block=40, children=2, full=1.0)
    found = p.packed(spark.createDataFrame(rows, "uid bigint, length bigint"), s).collect()
    lengths, fills = dict(rows), defaultdict(int)
    assert sorted(r.uid for r in found) == sorted(lengths)
    for r in found:
        fills[r.sequence_id] += lengths[r.uid]
    assert max(fills.values()) <= 100
