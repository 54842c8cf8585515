from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"
CLASHING = ", fp string, key string, word string, digest string, place string, score string, _text string, uid string, row string, block string, h string, id string, size string, n string, line string, doc string, keep_id string, component_id string, text_sha256 string, html string, label string"

LONG = "word and another one " * 30_000
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t\n "),
    (4, "one"),
    (5, LONG),
    (6, "the same text of several words that is found twice here"),
    (7, "the same text of several words that is found twice here"),
    (7, "the same text of several words that is found twice here"),
    (8, "THE same text of several words that is found twice HERE"),
    (None, "a row without an id"),
    (None, None),
    (9, "é 漢字 🙂 ▁ <|endoftext|> \x1c ́x"),
    (10, "x" * 50_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns with names that operators use inside."""
    names = [c.split()[0] for c in CLASHING[2:].split(", ")]
    rows = [(i, t, *["clash"] * len(names)) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string" + CLASHING).repartition(3)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
