"""Every registered query against its SQL counterpart on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from workloads.oracle import oracle_sql
from workloads.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert differences(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_stream_report_whatever_the_splits(spark, con):
    """Splits that hold no row group leave no file without rows among the trip files."""
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        df = entry.queries()["stream_report"](spark, SF_DIR)
        assert differences(df, con, entry.oracle_sql()["stream_report"]) is None
    finally:
        for key in small:
            spark.conf.unset(key)
