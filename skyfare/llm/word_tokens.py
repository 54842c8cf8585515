"""Token ids of the public word-end BPE, with a cache of words.

The tokenizer splits a text into runs of letters, single digits and runs of signs before it merges,
so the ids of a text are the ids of its runs one after the other. Runs repeat, so each task keeps the
ids of those it has met. Runs are found here only in texts whose characters lie below U+0180, where
they are the tokenizer's own; any other text is cut at white space or given whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np

_LETTERS = "a-zªµºß-öø-ſ"
_DIGITS = "0-9²³¹¼-¾"
_SPACE = "\t-\r \x85\xa0"
_RUN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACE}{_LETTERS}{_DIGITS}]+")
_BEYOND = re.compile("[^\x00-ſ]")
_NO_CUT = re.compile("[\x1c-\x1f]")
_SPECIAL = "<|"  # how the tokenizer's own markers begin; they are found before anything is split
_TOGETHER = 512
_AT_ONCE = 1 << 20


class WordTokens:
    """`ids(texts)` gives each text's ids, one after the other, as little-endian unsigned 32-bit octets."""

    def __init__(self, path: str, most_words: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # the same merges for runs that are lower-cased and cut already
        self._bare = Tokenizer.from_file(path)
        self._bare.normalizer = normalizers.Sequence([])
        octets = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), octets])
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self._ends[i] = piece.endswith("</w>")
        self._known: dict[str, bytes] = {}
        self._most = most_words

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, runs: list[str]) -> None:
        """Encodes many runs as one text and parts the ids at word ends."""
        for start in range(0, len(runs), _TOGETHER):
            some = runs[start : start + _TOGETHER]
            ids = self._bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            octets = array("I", ids).tobytes()
            ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist() if ids else []
            if len(ends) == len(some) and ends[-1] == len(octets):
                self._known.update(zip(some, (octets[i:j] for i, j in zip([0, *ends], ends, strict=False)), strict=True))
            else:
                self._known.update(zip(some, self._encode(some), strict=True))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """A few texts at a time, so that their runs are not all held at once."""
        start, size = 0, 0
        for end, t in enumerate(texts, 1):
            size += len(t)
            if size >= _AT_ONCE or end == len(texts):
                yield from self._ids_of(texts[start:end])
                start, size = end, 0

    def _ids_of(self, texts: list[str]) -> list[bytes]:
        runs: list[list[str]] = []
        plain: list[list[str]] = []
        for t in texts:
            if _SPECIAL not in t and (t.isascii() or not _BEYOND.search(t)):
                runs.append(_RUN.findall(t.lower()))
                plain.append([])
            else:
                runs.append([])
                plain.append([t] if _SPECIAL in t or _NO_CUT.search(t) else t.split())
        if len(self._known) > self._most:
            self._known.clear()
        known = self._known.__contains__
        self._learn(list(dict.fromkeys(filterfalse(known, chain.from_iterable(runs)))))
        words = list(dict.fromkeys(filterfalse(known, chain.from_iterable(plain))))
        self._known.update(zip(words, self._encode(words), strict=True))
        get = self._known.__getitem__
        return [b"".join(map(get, r or p)) for r, p in zip(runs, plain, strict=True)]
