from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from skyfare.plans import ingest, ingest_trips, ingest_weather
from skyfare.sources import (
    file_stats,
    list_files,
    loaded_files,
    new_files,
    prune_files,
    read_columns,
    read_trips,
    read_weather,
)
from skyfare.streaming import stream_trips, stream_weather

NOW = dt.datetime(2024, 2, 1, 3, tzinfo=dt.timezone.utc)
STATIONS = [{"id": "JFK", "name": "Kennedy", "zone": "queens"}]
PREAMBLE = "".join(f"#DEBUG: line {i}\n" for i in range(5))
FIELDS = "station,valid,lon,lat,tmpf,dwpf,p01i,vsby,sknt,gust,skyc1,wxcodes\n"


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture
def weather_dir(tmp_path):
    folder = tmp_path / "weather"
    (folder / "2024" / "01").mkdir(parents=True)
    month = folder / "2024" / "01"
    (month / "JFK_20240101_20240131.csv").write_text(
        PREAMBLE + FIELDS
        + "JFK,2024-01-01 00:51,-73.76,40.64,41.0,30.0,T,10.00,8.00,M,CLR,M\n"
        + "JFK,bad time,-73.76,40.64,M,30.0,0.02,,nan,null,OVC,RA\n"
    )
    # other columns in another order, quoted header, station not listed, \r\n ends
    (month / "LGA_20240101_20240131.csv").write_text(
        (PREAMBLE + '"valid","station",tmpf,wxcodes\n2024-01-02 01:00,LGA,33.5,"RA,SN"\n').replace("\n", "\r\n")
    )
    (month / "EWR_20240101_20240131.csv").write_text(PREAMBLE + FIELDS)  # no rows
    (month / "NYC 2_20240201_20240229.csv").write_text(
        PREAMBLE + FIELDS + "NYC,2024-02-01 00:00,0,0,50,M,M,M,M,M,M,M\n"
    )
    (month / "notes.txt").write_text("not weather\n")
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_read_weather_binds_fields_by_name(spark, weather_dir):
    df = read_weather(spark, weather_dir)
    got = {r.source_file: r for r in df.where("valid <> 'bad time'").collect()}
    assert len(got) == 3
    lga = got["LGA_20240101_20240131.csv"]
    assert (lga.station, lga.tmpf, lga.wxcodes, lga.gust) == ("LGA", "33.5", "RA,SN", None)
    assert got["NYC 2_20240201_20240229.csv"].file_station == "NYC 2"
    assert df.count() == 4


def test_ingest_weather_once_per_file(spark, name, weather_dir):
    report = ingest_weather(spark, weather_dir, STATIONS, name, NOW)
    assert rows(report) == [
        ("EWR_20240101_20240131.csv", 0), ("JFK_20240101_20240131.csv", 2),
        ("LGA_20240101_20240131.csv", 1), ("NYC 2_20240201_20240229.csv", 1),
    ]
    table = spark.table(name)
    first = table.where("station = 'JFK' AND valid IS NOT NULL").first()
    assert (first.tmpf, first.p01i, first.gust, first.station_name) == (41.0, None, None, "Kennedy")
    assert (first.file_date, first.valid_date) == (dt.date(2024, 2, 1), dt.date(2024, 1, 1))
    assert table.where("station = 'LGA'").first().station_zone == "Unknown"
    assert table.where("valid IS NULL").first().p01i == 0.02
    again = ingest_weather(spark, weather_dir, STATIONS, name, NOW)
    assert rows(again) == [("EWR_20240101_20240131.csv", 0)]
    assert spark.table(name).count() == 4


def test_ingest_weather_between_days(spark, name, weather_dir):
    report = ingest_weather(spark, weather_dir, STATIONS, name, NOW, start="2024-02-01")
    assert rows(report) == [("NYC 2_20240201_20240229.csv", 1)]


def test_stream_weather_takes_only_new_files(spark, name, weather_dir, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    stream_weather(spark, weather_dir, STATIONS, name, checkpoint, NOW)
    assert spark.table(name).count() == 4
    (tmp_path / "weather" / "JFK_20240201_20240229.csv").write_text(
        PREAMBLE + FIELDS + "JFK,2024-02-03 00:51,0,0,41.0,30.0,M,10.00,8.00,M,CLR,M\n"
    )
    stream_weather(spark, weather_dir, STATIONS, name, checkpoint, NOW)
    assert spark.table(name).count() == 5
    # a lost checkpoint replays every file; the table's own ledger keeps them out
    stream_weather(spark, weather_dir, STATIONS, name, str(tmp_path / "another"), NOW)
    assert spark.table(name).count() == 5


def one_file(df, path, file_name):
    df.coalesce(1).write.option("mapreduce.output.basename", file_name).mode("append").parquet(path)


@pytest.fixture
def trip_dir(spark, tmp_path):
    path = str(tmp_path / "trips")
    one_file(spark.sql("SELECT 1L AS VendorID, 1.0D AS passenger_count, id AS PULocationID FROM range(3)"), path, "a_2023")
    one_file(spark.sql("SELECT 2 AS VendorID, 2L AS passenger_count, id AS PULocationID FROM range(2)"), path, "b_2024")
    one_file(spark.sql("SELECT 3L AS VendorID, 0.5D AS fare_amount, id AS PULocationID FROM range(4)"), path, "c_2025")
    (tmp_path / "trips" / "d_bad.parquet").write_bytes(b"PAR1 this is not a parquet file PAR1")
    return path


def test_ingest_trips_isolates_bad_files_and_mixed_types(spark, name, trip_dir):
    report = ingest_trips(spark, trip_dir, name)
    counts = {r.source_file[:1]: r.rows for r in report.collect()}
    assert counts == {"a": 3, "b": 2, "c": 4, "d": 0}
    table = spark.table(name)
    assert table.schema["passenger_count"].dataType.simpleString() == "double"
    got = rows(table.groupBy("VendorID", "passenger_count", "fare_amount").count())
    assert got == sorted([(1, 1.0, None, 3), (2, 2.0, None, 2), (3, None, 0.5, 4)], key=repr)
    again = ingest_trips(spark, trip_dir, name)
    assert [(r.source_file, r.rows) for r in again.collect()] == [("d_bad.parquet", 0)]
    assert spark.table(name).count() == 9


def test_ingest_trips_leaves_out_a_file_damaged_in_the_middle(spark, name, tmp_path):
    """Its footer is fine, so rows before the damage could be read; none of them may be kept."""
    path = tmp_path / "trips"
    one_file(spark.sql("SELECT id AS VendorID FROM range(10)"), str(path), "good")
    many = spark.sql("SELECT hash(id) AS VendorID FROM range(100000)").coalesce(1)
    small_pages = {"mapreduce.output.basename": "hurt", "parquet.page.size": "4096"}
    many.write.options(**small_pages).mode("append").parquet(str(path))
    (hurt,) = path.glob("hurt*")
    data = bytearray(hurt.read_bytes())
    third = len(data) // 3
    data[third : 2 * third] = b"\xff" * third
    hurt.write_bytes(data)
    for crc in path.glob(".*.crc"):
        crc.unlink()
    report = ingest_trips(spark, str(path), name)
    assert {r.source_file[:4]: r.rows for r in report.collect()} == {"good": 10, "hurt": 0}
    assert spark.table(name).count() == 10


def test_ingest_trips_in_small_loads(spark, name, trip_dir, monkeypatch):
    monkeypatch.setattr(ingest, "FILES_PER_LOAD", 1)
    ingest_trips(spark, trip_dir, name)
    assert spark.table(name).count() == 9


def test_ingest_trips_of_an_empty_folder(spark, name, tmp_path):
    (tmp_path / "none").mkdir()
    assert ingest_trips(spark, str(tmp_path / "none"), name).count() == 0


def test_an_error_that_is_not_about_a_file_is_raised(spark, name, trip_dir):
    with pytest.raises(Exception, match="no_such_column"):
        ingest_trips(spark, trip_dir, name, [{"name": "no_such_column"}])


def test_ingest_trips_with_fields(spark, name, tmp_path):
    path = str(tmp_path / "trips")
    one_file(spark.sql("SELECT 2L AS VendorID, 2.0D AS fare_amount"), path, "a")
    fields = [{"name": "VendorID"}, {"name": "cents", "transformation": "CAST(fare_amount * 100 AS BIGINT)"}]
    ingest_trips(spark, path, name, fields)
    table = spark.table(name)
    assert table.columns == ["VendorID", "cents", "source_file"]
    assert (table.first().VendorID, table.first().cents) == (2, 200)


def test_stream_trips(spark, name, tmp_path):
    path, checkpoint = str(tmp_path / "trips"), str(tmp_path / "checkpoint")
    for i in range(2):
        one_file(spark.sql(f"SELECT {i}L AS VendorID, 1.5D AS fare_amount"), path, f"f{i}")
        stream_trips(spark, path, name, checkpoint)
        stream_trips(spark, path, name, checkpoint)
        assert spark.table(name).count() == i + 1


def test_ledger(spark, name):
    assert loaded_files(spark, name).isEmpty()
    spark.sql("SELECT * FROM VALUES ('a'), ('a'), (NULL), ('b') t(source_file)").write.saveAsTable(name)
    assert rows(loaded_files(spark, name)) == [("a",), ("b",)]
    listed = spark.createDataFrame([("a",), ("c",)], "source_file string")
    assert rows(new_files(listed, loaded_files(spark, name))) == [("c",)]
    assert rows(file_stats(spark.table(name).where("source_file IS NOT NULL"))) == [("a", 2), ("b", 1)]


def test_listing_and_pruning(spark, weather_dir):
    listed = list_files(spark, weather_dir, "*.csv")
    assert listed.count() == 4
    names = [("JFK_20230101_20230131.csv",), ("JFK_20230201_x.csv",), ("JFK_20230301_x.csv",), ("readme.csv",)]
    files = spark.createDataFrame(names, "source_file string")
    got = [r[0] for r in prune_files(files, "2023-02-01", dt.date(2023, 2, 28)).collect()]
    assert sorted(got) == ["JFK_20230201_x.csv", "readme.csv"]
    assert prune_files(files).count() == 4
    assert prune_files(files, end="2023-01-01").count() == 2


def test_read_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c").write.parquet(path)
    assert read_columns(spark, path, ["c", "nope", "a"]).columns == ["c", "a"]
    assert read_columns(spark, path, ["nope"]).columns == ["a", "b", "c"]
    assert read_columns(spark, path).columns == ["a", "b", "c"]
    text = read_columns(spark, path, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:int>" in text


def test_read_trips_names_the_file(spark, tmp_path):
    path = str(tmp_path / "t")
    one_file(spark.sql("SELECT 1 AS a"), path, "x")
    one_file(spark.sql("SELECT 2 AS a, 3 AS b"), path, "y")
    df = read_trips(spark, path)
    assert df.columns == ["a", "b", "source_file"]
    assert rows(df.select(F.substring("source_file", 1, 1), "b")) == [("x", None), ("y", 3)]
