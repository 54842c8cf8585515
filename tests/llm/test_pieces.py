from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from skyfare.llm.pieces import SPACE, PieceModel, encode_documents
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The library's own unigram encoder over the same pieces.

    The library adds scores up in 32 bits, so the pieces that the model all but forbids get a score
    that is low, but not so low that the others vanish beside it.
    """
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = tmp_path_factory.mktemp("pieces") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path), sentencepiece.SentencePieceProcessor(model_file=str(path))


def samples(texts):
    rng = random.Random(3)
    letters = "abcthe  \n\t▁é漢🙂x,.'\"(){}=01"
    yield from (t[:k] for _, t in texts for k in (0, 1, 30, 80))
    yield from ("".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(2000))


def test_ids_are_the_librarys(unigram, texts):
    path, library = unigram
    model = PieceModel(path)
    for t in samples(texts):
        ids = model.encode(t).tolist()
        assert ids == library.encode(t)
        assert model.decode(ids) == library.decode(ids)


def all_paths(model, text):
    """The best sum of scores over every way to cut the text."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            _, score = model._pieces.get(text[start:end], (0, None))
            if score is None and end - start == 1:
                score = model._unknown_score
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_scores_are_the_greatest(texts):
    model = PieceModel(PATH)
    scores = {i: s for i, s in model._pieces.values()}
    for t in [t[:60] for _, t in texts[:60]] + ["xé漢字 ab\n12", "((( ..."]:
        text = SPACE + t.replace(" ", SPACE)
        unknown = sum(c not in model._singles for c in text)
        ids = model.viterbi(text)
        got = sum(scores[i] for i in ids if i in scores) + unknown * model._unknown_score
        assert got == all_paths(model, text)


def test_units_change_nothing(texts):
    model = PieceModel(PATH)
    for t in (t[:200] for _, t in texts):
        assert model.encode(t).tolist() == (model.viterbi(SPACE + t.replace(" ", SPACE)) if t else [])


def test_documents(docs, texts):
    rows = encode_documents(docs, PATH).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: sha256(t.encode()).hexdigest() for i, t in texts}
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in rows)


def test_odd_rows(odd, none):
    rows = encode_documents(odd, PATH).collect()
    assert len(rows) == len(ODD_TEXTS)
    for r in rows:
        assert (r.n_ids == 0) == (r.doc_id in (1, 2) or r.doc_id is None and r.n_ids == 0)
        assert r.round_trip == (r.doc_id != 9)  # it holds the sign for a space
    assert encode_documents(none, PATH).count() == 0
    assert encode_documents(odd.filter(F.col("doc_id") == 5), PATH).first().round_trip
