from __future__ import annotations

import re

import pytest

from skyfare.llm import licenses as li
from tests.llm.conftest import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in li.PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == phrase]
    starts = [i for i, _ in places]
    labels, best = {label for _, label in places}, 0.0
    for block in li.blocks_of(text or ""):
        for label, template in li.TEMPLATES:
            want = {w for w in WORD.findall(template.translate(LOWER))}
            share = len(want & {w.decode() for w in block}) / len(want)
            if share >= li.CONTAINED - 1e-9:
                labels.add(label)
                best = max(best, share)
    base = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(labels)), 1.0 if places else best


def outcome(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score


def test_documents(docs, texts):
    rows = li.scan_licenses(docs).collect()
    assert {r.doc_id: outcome(r) for r in rows} == {i: brute(t) for i, t in texts}


def test_odd_rows(odd, none):
    rows = li.scan_licenses(odd).collect()
    assert sorted(map(repr, ((r.doc_id, *outcome(r)) for r in rows))) == sorted(repr((i, *brute(t))) for i, t in ODD_TEXTS)
    assert li.scan_licenses(none).count() == 0


@pytest.mark.parametrize("contained", [0.5, 0.8, 1.0])
def test_join_finds_every_match(contained):
    import random

    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(30)]
    templates = [(f"l{i}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(15)]
    counts = {w.encode(): rng.randint(0, 9) for w in vocabulary}
    index = li.TemplateIndex(templates, counts, contained)
    for _ in range(500):
        block = [w.encode() for w in rng.choices(vocabulary + ["other", "word"], k=rng.randint(0, 15))]
        got = set(index.matches(block))
        want = set()
        for label, text in templates:
            t = set(li.words_of(text))
            if len(t & set(block)) >= contained * len(t) - 1e-9:
                want.add((label, len(t & set(block)) / len(t)))
        assert got == want


def test_long_numbers_keep_their_ids(spark):
    rows = [((1 << 62) + 1, "mit license"), (None, "Apache License")]
    found = li.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.base_labels for r in found} == {(1 << 62) + 1: "mit", None: "apache"}


def test_wrapped_notice():
    text = "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files,\nto deal in the Software without restriction"
    index = li.TemplateIndex(li.TEMPLATES, {}, li.CONTAINED)
    assert li.scan_text(text, index, li.PHRASES)[5] == "mit"


INDEX = li.TemplateIndex(li.TEMPLATES, {}, li.CONTAINED)


def labels_of(text):
    return li.scan_text(text, INDEX, {})[5]


def lcs(a, b):
    """The names and the words of the longest common subsequence that has most names."""
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next_row(row, x, b)
    return divmod(row[-1], 1000)


def _next_row(row, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(row[j] + (1001 if x in li.NAMES else 1) if x == y else max(row[j + 1], new[j]))
    return new


def brute_places(words):
    """Every window of every template, by the definition; without lines."""
    found = {}
    for label, text in li.TEMPLATES:
        want = li.words_of(text)
        for start in range(len(words)):
            for end in range(start + 1, min(len(words), start + li.SPAN * len(want)) + 1):
                place = words[start:end]
                if (li.MODIFIERS - set(want)) & set(place):
                    continue
                names, shared = lcs(want, place)
                share = shared / len(want)
                if names == sum(w in li.NAMES for w in want) and share >= li.CONTAINED - 1e-9:
                    found[label] = max(found.get(label, 0.0), share)
    return found


@pytest.mark.parametrize("width", [1, 12, 30, 150, 10_000])
@pytest.mark.parametrize("mark", ["", " * "])
@pytest.mark.parametrize("template", li.TEMPLATES, ids=str)
def test_wrapped_at_any_width(template, mark, width):
    import textwrap

    text = "Some words stand before it. " + template[1] + ". And some others stand after it, on long lines and short ones."
    assert template[0] in labels_of("\n".join(mark + x for x in textwrap.wrap(text, width, break_long_words=False))).split(",")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Released under the Apache License", ""),
        ("By MIT people. Released under the Apache License", ""),
        ("Released under the MIT License", "mit"),
        ("Released under the terms of the MIT licence", "mit"),
        ("Licensed under CC BY 4.0", ""),
        ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
        ("Licensed under CC BY-NC-SA 4.0", ""),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ""),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
        ("MIT released a study, and the city under review took the license away", ""),
        ("license the under MIT released", ""),
        (f"The film was released {'as all know ' * 200} under {'as all know ' * 200} the MIT {'as ' * 200} license", ""),
    ],
)
def test_near_misses(text, want):
    assert labels_of(text) == want


def test_places_against_brute_force():
    import random

    rng = random.Random(6)
    for _ in range(60):
        words = rng.choices([b"the", b"of", b"other", b"nc", b"mit"], k=6)
        label, text = rng.choice([t for t in li.TEMPLATES if len(t[1]) < 90])
        for w in li.words_of(text):
            if rng.random() > 0.12:
                words.append(w)
            if rng.random() < 0.3:
                words.append(rng.choice([b"other", b"the", b"sa", b"under", b"license"]))
        words += rng.choices([b"the", b"license", b"nc", b"other"], k=4)
        _, _, _, _, _, labels, score = li.scan_text(" ".join(w.decode() for w in words), INDEX, {})
        want = brute_places(words)
        assert labels == ",".join(sorted(want)) and score == max(want.values(), default=0.0)
