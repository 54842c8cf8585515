"""Licence scans: phrases, and places where most of a licence template stands.

Base labels come from phrases whose words stand consecutively. The method's own labels come from an
exact set-similarity join of documents with templates, then of places: a template is found where
`SPAN` times as many words in a row as it has hold, in its order, at least `CONTAINED` of its words and
all that name the licence (`NAMES`), and none of `MODIFIERS` that it lacks stands among them. Lines and
their lengths do not matter. Words are ordered by how often they occur in all documents, rarest first.
To contain enough of a template a document must share a word of the template's prefix (its
|T| - need + 1 rarest words), and have enough left of both after the first shared word; then windows
start at each of the template's words, and those with enough of its words are verified.
The templates are a fixed small table, so the join needs no shuffle: each task holds their index.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from skyfare.llm.common import whole_text

CONTAINED = 0.8
SPAN = 2
SHORT_LINE, SHORT_LINES = 120, 4

# Base phrases and labels
PHRASES = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}

# Sentences by which public licences are granted or named
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

# Words that a place must hold if its template does, and words that make it another licence
NAMES = frozenset(b"mit apache gnu mozilla cc nc creative commons attribution unencumbered".split())
MODIFIERS = frozenset(b"nc nd sa noncommercial noderivatives noderivs sharealike".split())

_WORD_OCTETS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_OCTETS).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]  # distinct, rarest first
    need: int  # of them
    ordered: tuple[bytes, ...]  # all, as they stand

    def best_share(self, words: list[bytes], contained: float) -> float:
        """The greatest share of the template that stands at one place of `words`; 0 if no place has enough."""
        bits: dict[bytes, int] = {}
        for i, w in enumerate(self.ordered):
            bits[w] = bits.get(w, 0) | 1 << i
        named, foreign = NAMES.intersection(bits), MODIFIERS.difference(bits)
        n, span = len(self.ordered), SPAN * len(self.ordered)
        enough = max(1, ceil(contained * n - 1e-9))
        at = [i for i, w in enumerate(words) if w in bits]
        inside: Counter = Counter()
        best, end, shown = 0, 0, ()
        for k, start in enumerate(at):
            while end < len(at) and at[end] < start + span:
                inside[words[at[end]]] += 1
                end += 1
            # only more words than the best has are of interest, and each window but once
            if best < n and end - k >= max(enough, best + 1) and len(inside) >= self.need and all(w in inside for w in named):
                window = words[start : start + span]
                if window != shown:
                    shown = window
                    best = max(best, self._common(window, bits, foreign, max(enough, best + 1)))
            inside[words[start]] -= 1
            if not inside[words[start]]:
                del inside[words[start]]
        return best / n

    def _common(self, window: list[bytes], bits: Mapping[bytes, int], foreign: frozenset[bytes], least: int) -> int:
        """How many words of the template stand in the window in its order, all its names among them; 0 if under `least`.

        The place ends before a word that makes the licence another one.
        """
        n = len(self.ordered)
        whole = rows = (1 << n) - 1
        place = []
        for w in window:
            if w in foreign:
                break
            match = bits.get(w)
            if match:
                place.append(w)
                rows = ((rows + (rows & match)) | (rows & ~match)) & whole
        if n - rows.bit_count() < least:
            return 0
        worth = [n + 2 if w in NAMES else 1 for w in self.ordered]  # a name is worth more than all else
        row = [0] * (n + 1)
        for w in place:
            before = row
            row = [0]
            for i, t in enumerate(self.ordered):
                row.append(before[i] + worth[i] if t == w else max(before[i + 1], row[i]))
        names = sum(t in NAMES for t in self.ordered)
        common = row[-1] - names * (n + 1)
        return common if common >= least else 0


class TemplateIndex:
    """The templates' prefixes under a global order of words."""

    def __init__(self, templates: list[tuple[str, str]], counts: Mapping[bytes, int], contained: float):
        vocabulary = {w for _, text in templates for w in words_of(text)}
        ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ordered)}
        self.templates, self.prefixes = [], {}
        for label, text in templates:
            words = tuple(sorted(set(words_of(text)), key=self.rank.__getitem__))
            need = max(1, ceil(contained * len(words) - 1e-9))
            for at, w in enumerate(words[: len(words) - need + 1]):
                self.prefixes.setdefault(w, []).append((len(self.templates), at))
            self.templates.append(Template(label, words, need, tuple(words_of(text))))
        self.contained = contained
        self.prefix_words = frozenset(self.prefixes)

    def matches(self, block: list[bytes]) -> Iterator[tuple[str, float]]:
        """(label, containment) of every template that the block contains enough of, in any order."""
        for template, shared in self.candidates(block):
            yield template.label, shared / len(template.words)

    def candidates(self, block: list[bytes]) -> Iterator[tuple[Template, int]]:
        """Every template of which the block has enough words, and how many."""
        distinct = set(block)
        known = sorted(distinct & self.rank.keys(), key=self.rank.__getitem__)
        tried = set()
        for j, w in enumerate(known):
            for t, i in self.prefixes.get(w, ()):
                template = self.templates[t]
                if t in tried or len(known) < template.need:
                    continue
                tried.add(t)  # w is the first word that both share
                if 1 + min(len(template.words) - i - 1, len(known) - j - 1) < template.need:
                    continue
                shared = len(distinct.intersection(template.words))
                if shared >= template.need:
                    yield template, shared


def blocks_of(text: str) -> Iterator[list[bytes]]:
    """Each line that has words, and each run of two to four short lines. The scan does not use them; tests compare with them."""
    lines = [(len(line) <= SHORT_LINE, words_of(line)) for line in text.splitlines()]
    lines = [x for x in lines if x[1]]
    for i, (short, words) in enumerate(lines):
        yield words
        joined = list(words)
        for more_short, more in lines[i + 1 : i + SHORT_LINES] if short else ():
            if not more_short:
                break
            joined = joined + more
            yield joined


def base_places(words: list[bytes], phrases: Mapping[tuple[str, ...], str]) -> list[tuple[int, str]]:
    """(start, label) of every place where a phrase's words stand."""
    found = []
    for phrase, label in phrases.items():
        want = [p.encode() for p in phrase]
        at = -1
        try:
            while True:
                at = words.index(want[-1], at + 1)
                start = at - len(want) + 1
                if start >= 0 and words[start : at + 1] == want:
                    found.append((start, label))
        except ValueError:
            pass
    return found


def scan_text(text: str, index: TemplateIndex, phrases: Mapping[tuple[str, ...], str]) -> tuple:
    words = words_of(text)
    base = base_places(words, phrases)
    found: dict[str, float] = {}
    if not index.prefix_words.isdisjoint(words):
        for template, _ in index.candidates(words):
            share = template.best_share(words, index.contained)
            if share:
                found[template.label] = max(found.get(template.label, 0.0), share)
    base_labels = {label for _, label in base}
    starts = [s for s, _ in base]
    return (
        len(words),
        len(base),
        min(starts) if starts else None,
        max(starts) if starts else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | found.keys())),
        1.0 if base else max(found.values(), default=0.0),
    )


def word_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each word of a small vocabulary occurs in all of `docs`."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(filter(vocabulary.__contains__, words_of(text)))
        yield pd.DataFrame({"word": list(found), "n": list(found.values())})

    each = docs.select(whole_text(docs).alias("text")).mapInPandas(count, "word binary, n bigint")
    return {bytes(r.word): r.n for r in each.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # template words only


_FOUND = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[tuple[str, ...], str] = PHRASES,
    contained: float = CONTAINED,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null text counts as empty: no words, no labels, score 0. The score is 1 where a base phrase stands,
    else the largest share of a template that stands at one place, if it is enough for a label. Whole texts
    of any length are searched; labels are sorted and each stands once. Rows that repeat are each returned.
    An empty table gives an empty result; other columns are not looked at.
    """
    vocabulary = frozenset(w for _, text in templates for w in words_of(text))
    index = TemplateIndex(templates, word_counts(docs, vocabulary), contained)

    @F.pandas_udf(_FOUND)
    def scan(texts: pd.Series) -> pd.DataFrame:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        found = pd.DataFrame([scan_text(t, index, phrases) for t in texts], columns=names)
        return found.astype({"first_word": "Int64", "last_word": "Int64"})

    found = docs.select(docs["doc_id"], scan(whole_text(docs)).alias("found"))
    return found.select("doc_id", "found.*")
