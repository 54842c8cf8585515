from __future__ import annotations

import random
import re

import pytest

from skyfare.llm.line_dedup import dedup_lines, line_report, removed_lines
from tests.llm.conftest import ODD_TEXTS

SPACE = " \t\x0b\f\r"


def brute(rows):
    """(doc_id, line) of each line with an earlier line that has at least 4/5 of their words in common."""
    gone, lines, holders = set(), [], {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        for k, line in enumerate((t or "").split("\n")):
            words = frozenset(re.split(f"[{SPACE}]+", line.strip(SPACE).lower())) - {""}
            if not words:
                continue
            shared = {}
            for w in words:
                for j in holders.get(w, ()):
                    shared[j] = shared.get(j, 0) + 1
            if any(5 * n >= 4 * (len(words) + len(lines[j]) - n) for j, n in shared.items()):
                gone.add((i, k))
            for w in words:
                holders.setdefault(w, []).append(len(lines))
            lines.append(words)
    return gone


def outcome(df):
    return {(r.doc_id, k) for r in df.collect() for k in r.removed}


def test_documents(docs, texts):
    found = line_report(docs)
    assert outcome(found) == brute(texts)
    assert {r.doc_id: r.n_lines for r in found.collect()} == {i: len(t.split("\n")) for i, t in texts}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_and_common_words(spark, seed):
    """Few words, so that prefixes share much, and families of lines around a common one."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = [words[int(59 * rng.random() ** 3)] for _ in range(rng.randint(1, 14))]
            lines.append(" ".join(line))
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(words)
                lines.append("  ".join(line).upper())
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert outcome(line_report(docs)) == brute(rows)


def test_odd_rows(odd, none):
    report = line_report(odd)
    assert report.count() == odd.count()
    # rows that repeat both doc_id and text count as one document
    assert outcome(report) == brute(list(dict.fromkeys(ODD_TEXTS)))
    cleaned = dedup_lines(odd)
    assert cleaned.columns == odd.columns
    assert cleaned.count() == odd.count()
    assert line_report(none).count() == 0
    assert dedup_lines(none).count() == 0
    assert removed_lines(none).count() == 0


def test_text_of_the_lines_that_stay(spark):
    rows = [(1, "one two three four\n\nfive six"), (2, "x\nONE two  three four\nfive six seven"), (3, None)]
    cleaned = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text for r in cleaned} == {1: "one two three four\n\nfive six", 2: "x\nfive six seven", 3: ""}


def test_documents_without_id_are_told_apart(spark):
    rows = [(None, f"first line of {i} here\nsecond line of {i // 2} there") for i in range(40)]
    found = line_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(len(r.removed) for r in found) == 20
    assert all(r.n_lines == 2 and r.removed in ([], [1]) for r in found)


def test_digests_cover_the_words(spark):
    """128 bits over the words of a set, whatever their order and letter case."""
    from skyfare.llm import line_dedup as ld

    docs = spark.createDataFrame([(1, "b a\nA  b\na\nab\nb a c")], "doc_id bigint, text string")
    lines = ld.lines_of(docs)
    sets = ld._sets(ld._with_tokens(ld._with_words(lines), ld.word_classes(lines)))
    digests = {r.line: bytes(r.digest) for r in sets.select("first.line", "digest").collect()}
    assert all(len(d) == 16 for d in digests.values())
    # lines 0 and 1 have one set and so one digest; the first of them stands for it
    assert sorted(digests) == [0, 2, 3, 4] and len(set(digests.values())) == 4


@pytest.mark.parametrize(("hot", "near"), [(2, 1), (3, 2), (8, 1), (1 << 20, 1), (2, 32)])
def test_hot_words_are_divided_without_loss(spark, monkeypatch, hot, near):
    """Families of lines around common ones, in few words: nearly every prefix word is hot."""
    from skyfare.llm import line_dedup as ld

    monkeypatch.setattr(ld, "HOT", hot)
    monkeypatch.setattr(ld, "NEAR", near)
    rng = random.Random(hot * 100 + near)
    words = [f"w{i}" for i in range(40)]
    families = [rng.sample(words, rng.randint(4, 16)) for _ in range(12)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(1, 3)):
            line = list(rng.choice(families))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert outcome(line_report(docs)) == brute(rows)


def test_a_line_is_no_match_of_itself_and_small_sets_match(spark):
    """Sets of few words, the same with repeats, and lines with as few words of an earlier one as can match it."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    lines = [" ".join(rng.sample(words, n)) for n in range(1, 60) for _ in range(4)]
    near = []
    for line in lines:
        some = line.split()
        kept = some[: len(some) - len(some) // 5]  # as few of its words as can be alike enough
        near += [" ".join(rng.sample(kept, len(kept))), " ".join(some + some[:2])]
    rows = [(i, "\n".join((lines + near)[i::40])) for i in range(40)]
    assert outcome(line_report(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)


def test_a_document_is_hashed_once_and_not_per_line(spark):
    """The digest of a text is taken below the split into lines."""
    from skyfare.llm import line_dedup as ld

    docs = spark.createDataFrame([(1, "a b\nc d")], "doc_id bigint, text string")
    plan = ld.lines_of(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("sha2")
