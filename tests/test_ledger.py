"""Ledgers of loads: listing and reporting without the table of rows, loads that break off, files that fail."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from skyfare.plans import ingest, ingest_trips, ingest_weather
from skyfare.plans.ledger import Ledger
from skyfare.sinks import materialize
from skyfare.streaming import stream_trips, stream_weather


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def one_file(spark, folder, file_name, values):
    df = spark.createDataFrame([(v,) for v in values], "VendorID bigint").coalesce(1)
    df.write.option("mapreduce.output.basename", file_name).mode("append").parquet(str(folder))


@pytest.fixture
def folder(spark, tmp_path):
    path = tmp_path / "trips"
    one_file(spark, path, "a", [1, 2])
    one_file(spark, path, "b c", [3])
    return path


def test_the_table_is_not_read_to_list_or_report(spark, name, folder, tmp_path):
    where = tmp_path / "rows"
    report = ingest_trips(spark, str(folder), name, table_path=str(where), detailed=True)
    ledger = Ledger(spark, name)
    assert sorted((r.rows, r.outcome, r.reason) for r in report.collect()) == [(1, "loaded", None), (2, "loaded", None)]
    for df in (report, ledger.loaded(), ledger.failed(), ledger.latest()):
        assert str(where) not in plan(df)
    assert rows(ingest_trips(spark, str(folder), name)) == []
    one_file(spark, folder, "d", [4])
    assert [r.rows for r in ingest_trips(spark, str(folder), name).collect()] == [1]
    assert spark.table(name).count() == 4


@pytest.mark.parametrize("point", ["append", "end"])
def test_a_load_that_breaks_off_loses_and_repeats_nothing(spark, name, folder, monkeypatch, point):
    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if point == "append":  # before the rows are stored
            m.setattr(ingest, "append", lost)
        else:  # after that, and before the outcome is
            m.setattr(Ledger, "end", lost)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_trips(spark, str(folder), name)
    ingest_trips(spark, str(folder), name)
    assert rows(spark.table(name).select("VendorID")) == [(1,), (2,), (3,)]
    assert sorted(r.rows for r in Ledger(spark, name).loaded().collect()) == [1, 2]


def test_a_table_loaded_without_a_ledger_is_taken_in(spark, name, folder):
    listed = sorted(p.name for p in folder.glob("*.parquet"))
    materialize(spark.createDataFrame([(9, listed[0])], "VendorID bigint, source_file string"), name)
    ingest_trips(spark, str(folder), name)
    assert rows(spark.table(name).select("VendorID")) == [(3,), (9,)]
    spark.sql(f"DROP TABLE {name}")
    ingest_trips(spark, str(folder), name)  # what the dropped table had is loaded again
    assert spark.table(name).count() == 3


def test_a_stream_tries_failed_files_again(spark, name, folder, tmp_path):
    bad = folder / "z.parquet"
    bad.write_bytes(b"not a parquet file")
    (folder / "gone.parquet").write_bytes(b"neither")
    checkpoint = str(tmp_path / "checkpoint")
    first = {r.source_file[0]: r for r in stream_trips(spark, str(folder), name, checkpoint).collect()}
    assert {k: r.outcome for k, r in first.items()} == {"a": "loaded", "b": "loaded", "z": "failed", "g": "failed"}
    assert first["z"].reason and first["z"].rows == 0
    assert [r.outcome for r in stream_trips(spark, str(folder), name, checkpoint).collect()] == ["failed", "failed"]
    one_file(spark, tmp_path / "good", "g", [7])
    bad.write_bytes(next((tmp_path / "good").glob("*.parquet")).read_bytes())
    (folder / ".z.parquet.crc").unlink(missing_ok=True)
    (folder / "gone.parquet").unlink()
    third = stream_trips(spark, str(folder), name, checkpoint)
    assert [(r.source_file, r.rows, r.outcome) for r in third.collect()] == [("z.parquet", 1, "loaded")]
    assert stream_trips(spark, str(folder), name, checkpoint).isEmpty()
    assert rows(spark.table(name).select("VendorID")) == [(1,), (2,), (3,), (7,)]


def test_weather_text_is_read_once(spark, name, tmp_path, monkeypatch):
    header = "station,valid,tmpf\n"
    folder = tmp_path / "weather"
    folder.mkdir()
    (folder / "JFK_20240101_20240131.csv").write_text("note\nanother, one\n" + header + "JFK,2024-01-01 00:51,41.0\nJFK,2024-01-01 01:51,42.0\n")
    (folder / "LGA 1_20240101_20240131.csv").write_text("LGA,2024-01-01 00:51,41.0\n")
    scans = []
    real = ingest.weather_lines
    monkeypatch.setattr(ingest, "weather_lines", lambda *args: (scans.append(args), real(*args))[1])
    held = []
    parse = ingest.parse_weather_lines
    monkeypatch.setattr(ingest, "parse_weather_lines", lambda *args: (held.append(plan(args[0])), parse(*args))[1])
    report = stream_weather(spark, str(folder), [], name, str(tmp_path / "checkpoint"), mark=None)
    assert sorted((r.source_file[:3], r.rows, r.outcome, r.reason) for r in report.collect()) == [
        ("JFK", 2, "loaded", None), ("LGA", 0, "failed", "no header line"),
    ]
    assert len(scans) == 1 and "FileScan text" not in held[0] and "FileScan parquet" in held[0]
    (folder / "LGA 1_20240101_20240131.csv").write_text(header + "LGA,2024-01-01 00:51,41.0\n")
    again = ingest_weather(spark, str(folder), [], name, mark=None, detailed=True)
    assert [(r.source_file[:3], r.rows, r.outcome) for r in again.collect()] == [("LGA", 1, "loaded")]
    assert spark.table(name).agg(F.count("tmpf")).first()[0] == 3
