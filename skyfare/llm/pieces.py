"""SentencePiece encoding and decoding: a single-pass Viterbi driven by an Aho-Corasick automaton.

The automaton over all pieces reads a text once. At each position it gives every piece that ends
there, longest first (its output links), and each of them relaxes the best score of that position.
Characters that no piece covers are written as byte pieces. The model's scores are read as those of a
unigram model: the encoding has the greatest sum of scores, of equal sums the one whose last piece is
longest.

No piece of a usual vocabulary goes on after a space, or holds certain signs beside a letter.
There a text falls into units whose best encodings are independent, and each task keeps those of the
units it has met. The vocabulary decides: where a piece crosses such a place it is no boundary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from skyfare.llm.common import whole_text

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MOST_UNITS = 400_000
AT_ONCE = 1 << 20
_UNKNOWN = " ⁇ "


class PieceModel:
    """A SentencePiece model file without a normalizer, read once per Python worker."""

    _loaded: dict[str, PieceModel] = {}

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = {}
        self._octets: list[bytes] = []
        self._byte_ids = [0] * 256
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                octet = int(piece[3:5], 16)
                self._byte_ids[octet] = i
                self._octets.append(bytes([octet]))
            elif model.is_unknown(i):
                self._octets.append(_UNKNOWN.encode())
            elif model.is_control(i) or model.is_unused(i):
                self._octets.append(b"")
            else:
                normal[piece] = (i, model.get_score(i))
                self._octets.append(piece.encode())
        self._unknown_score = min((s for _, s in normal.values()), default=0.0) - UNKNOWN_PENALTY
        self._pieces = normal
        self._singles = frozenset(p for p in normal if len(p) == 1)
        self._automaton = ahocorasick.Automaton()
        for piece, (i, score) in normal.items():
            self._automaton.add_word(piece, (len(piece), score, i))
        if normal:
            self._automaton.make_automaton()
        self._known: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> PieceModel:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @cached_property
    def _units(self) -> re.Pattern:
        """Finds the units of a text; the whole text if a piece goes on after a space.

        `alone`: characters that no piece holds beside others. `signs`: those that no piece holds beside
        a letter; a run of letters or of signs is a unit unless another sign follows, which may join them.
        """
        pieces = [p for p in self._pieces if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            return re.compile(".+", re.S)
        ascii_ = [chr(c) for c in range(128)]
        shared = {c for p in pieces for c in p}
        alone = [c for c in ascii_ if c not in shared]
        marks = {c for c in ascii_ if not c.isalnum() and c in shared}
        beside = {frozenset(x) for p in pieces for x in zip(p, p[1:], strict=False) if SPACE not in x}
        with_letter = {c for pair in beside for c in pair & marks if len(pair) > 1 and not pair <= marks}
        signs, joining = marks - with_letter, marks & with_letter

        def among(characters, negated: bool = False) -> str:
            inside = "".join(map(re.escape, sorted(characters)))
            return f"[{'^' if negated else ''}{inside}]" if inside else "(?!)"

        letters = among({SPACE, *alone, *marks}, negated=True)
        rest = among({SPACE, *alone}, negated=True)
        unless = f"(?!{among(joining)})"
        return re.compile(
            f"{among(alone)}|{SPACE}*{letters}++{unless}|{SPACE}*{among(signs)}++{unless}|{SPACE}*{rest}++|{SPACE}++"
        )

    def viterbi(self, text: str) -> list[int]:
        """The ids of the best encoding of a text in which spaces are written as in the pieces."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        start, chosen = [0] * (n + 1), [-1] * (n + 1)
        if self._singles.issuperset(text):
            for last, (length, score, i) in self._automaton.iter(text):
                at = last + 1 - length
                s = best[at] + score
                if s > best[last + 1]:
                    best[last + 1], start[last + 1], chosen[last + 1] = s, at, i
        else:
            self._relax_with_unknown(text, best, start, chosen)
        ids: list[int] = []
        at = n
        while at:
            if chosen[at] >= 0:
                ids.append(chosen[at])
            else:
                ids.extend(self._byte_ids[b] for b in reversed(text[start[at] : at].encode("utf-8", "surrogatepass")))
            at = start[at]
        ids.reverse()
        return ids

    def _relax_with_unknown(self, text: str, best: list[float], start: list[int], chosen: list[int]) -> None:
        """The same where some characters are no pieces of their own: such a one may stand for itself."""
        settled = 0
        matches = self._automaton.iter(text) if self._pieces else iter(())
        for last, found in chain(matches, [(len(text), None)]):
            for at in range(settled + 1, last + 1):  # no piece ends at these any more
                s = best[at - 1] + self._unknown_score
                if text[at - 1] not in self._singles and s > best[at]:
                    best[at], start[at], chosen[at] = s, at - 1, -1
            settled = max(settled, last)
            if found is not None:
                length, score, i = found
                s = best[last + 1 - length] + score
                if s > best[last + 1]:
                    best[last + 1], start[last + 1], chosen[last + 1] = s, last + 1 - length, i

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; a space is put before it, as the model's pieces expect."""
        return np.frombuffer(self.octets(text), np.intc)

    def octets(self, text: str) -> bytes:
        """The ids of a text as native 32-bit numbers."""
        if not text:
            return b""
        units = self._units.findall(SPACE + text.replace(" ", SPACE))
        known = self._known
        if len(known) > MOST_UNITS:
            known.clear()
        for u in units:
            if u not in known:
                known[u] = array("i", self.viterbi(u)).tobytes()
        return b"".join(map(known.__getitem__, units))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces as UTF-8, the pieces' spaces as spaces, without the first one."""
        octets = b"".join(map(self._octets.__getitem__, ids))
        return octets.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


def encoded(text: Column, model_path: str) -> Column:
    """Ids of a text column, as array<int>."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = PieceModel.load(model_path)
        for texts in batches:
            yield pd.Series([model.encode(t) for t in texts], dtype=object)

    return ids(text)


def decoded(ids: Column, model_path: str) -> Column:
    """Text of an array<int> column."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = PieceModel.load(model_path)
        for each in batches:
            yield pd.Series([model.decode(x.tolist()) for x in each], dtype=object)

    return texts(ids)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded text, so that ids and texts of few rows are held at once."""
    sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + AT_ONCE, "right")))
        yield batch.slice(start, end - start)
        start = end


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, ids, n_ids, decoded_sha256, round_trip.

    Null text counts as empty and has no ids. round_trip tells whether decoding gives the text again;
    a text that holds the pieces' own sign for a space does not come back. Texts of any length are encoded
    whole; of ways to encode a text that score alike one is taken by a fixed rule. Rows that repeat, also their
    ids, are each returned. An empty table gives an empty result; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.load(model_path)
        for batch in batches:
            for part in _slices(batch):
                texts = part["text"].to_pylist()
                octets = [model.octets(t) for t in texts]
                back = [model.decode(np.frombuffer(o, np.intc).tolist()) for o in octets]
                sizes = np.array([len(o) // 4 for o in octets], np.int64)
                values = pa.array(np.frombuffer(b"".join(octets), np.intc))
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)
                digests = [sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back]
                same = [b == t for b, t in zip(back, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], ids, pa.array(sizes), pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "ids", "n_ids", "decoded_sha256", "round_trip"],
                )

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>, n_ids bigint, decoded_sha256 string, round_trip boolean"
    )
