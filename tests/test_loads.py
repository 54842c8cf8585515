"""Loads that must not lose data, checks that must not hide each other, joins fit for a large lookup."""

from __future__ import annotations

import datetime as dt
import json
import shutil
import threading
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from skyfare.operators import lookup, quality
from skyfare.operators.lookup import lookup_join, salts_for
from skyfare.plans import Check, ChecksFailed, enforce_checks, ingest, ingest_trips, run_checks
from skyfare.scratch import hold, measure
from skyfare.sinks import append, append_evolving, materialize, replace_partitions, tables, upsert
from skyfare.sinks.tables import wider, widened
from skyfare.streaming import stream_trips


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_file(df, path, file_name):
    df.coalesce(1).write.option("mapreduce.output.basename", file_name).mode("append").parquet(str(path))


def test_wider_types():
    long, double, text = T.LongType(), T.DoubleType(), T.StringType()
    assert wider(T.IntegerType(), long) == long
    assert wider(long, double) == double == wider(T.FloatType(), T.IntegerType())
    assert wider(T.DecimalType(10, 2), long) == T.DecimalType(22, 2)
    assert wider(text, long) == text
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    with pytest.raises(TypeError):
        wider(T.ArrayType(long), long)
    merged = widened(T.StructType().add("A", "long").add("b", "string"), T.StructType().add("c", "date").add("a", "double"))
    assert merged.simpleString() == "struct<A:double,b:string,c:date>"


def test_append_raises_rather_than_drops_or_narrows(spark, name):
    materialize(spark.sql("SELECT 1L AS a"), name)
    with pytest.raises(ValueError, match="no column extra"):
        append(spark.sql("SELECT 2L AS a, 3 AS extra"), name)
    with pytest.raises(ValueError, match="needs double"):
        append(spark.sql("SELECT 1.75D AS a"), name)
    append(spark.sql("SELECT 2 AS A"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]


def test_append_evolving_widens_a_partitioned_table(spark, name, tmp_path):
    materialize(spark.sql("SELECT 1L AS a, 'x' AS p"), name, partition_by=["p"], path=str(tmp_path / "t"))
    append_evolving(spark.sql("SELECT 1.75D AS A, 'y' AS P, 7 AS more"), name)
    assert rows(spark.table(name).select("a", "p", "more")) == [(1.0, "x", None), (1.75, "y", 7)]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p"]
    where = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location"][0]
    assert spark.read.parquet(where).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == [where.split("/")[-1]]  # the former files are gone


def test_whole_numbers_beyond_a_double_become_text(spark, name):
    far = 2**53 + 1
    materialize(spark.sql(f"SELECT {far}L AS a, 7L AS b, 1.5D AS c, 2.5D AS d"), name)
    append_evolving(spark.sql(f"SELECT 0.5D AS a, 0.5D AS b, {far}L AS c, 3L AS d"), name)
    assert spark.table(name).schema.simpleString() == "struct<a:string,b:double,c:string,d:double>"
    assert rows(spark.table(name)) == [("0.5", 0.5, str(far), 3.0), (str(far), 7.0, "1.5", 2.5)]
    other = f"{name}_b"
    materialize(spark.sql("SELECT 1.5D AS c"), other)
    with pytest.raises(ValueError, match="beyond 2"):
        append(spark.sql(f"SELECT {far}L AS c"), other)
    assert wider(T.DecimalType(18, 2), T.DoubleType()) == T.StringType()
    assert wider(T.DecimalType(10, 2), T.DoubleType()) == T.DoubleType()
    assert wider(T.DecimalType(38, 0), T.DecimalType(10, 9)) == T.StringType()


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("broken", ["materialize", "RENAME TO former", "RENAME TO name", "drop"])
def test_a_replacement_that_breaks_off(spark, name, tmp_path, monkeypatch, broken, external):
    """The old table is whole until the new one is, and what breaks off later is finished by the next use."""
    path = str(tmp_path / "t") if external else None
    materialize(spark.sql("SELECT 1 AS a, 'x' AS p"), name, partition_by=["p"], path=path)
    new = spark.sql("SELECT 1.5D AS a, 'y' AS p")

    class Lost(Exception):
        pass

    def lost(*_, **__):
        raise Lost

    real_sql = spark.sql

    def sql(text, *args):
        if broken.startswith("RENAME") and text.endswith(broken.replace("former", f"{name}__former").replace("name", name)):
            raise Lost
        return real_sql(text, *args)

    with monkeypatch.context() as m:
        if broken == "materialize":
            m.setattr(tables, "materialize", lost)
        elif broken == "drop":
            real_drop = tables.drop_table
            m.setattr(tables, "drop_table", lambda s, t: lost() if t.endswith("__former") else real_drop(s, t))
        else:
            m.setattr(spark, "sql", sql)
        with pytest.raises(Lost):
            append_evolving(new, name)
    if broken in ("materialize", "RENAME TO former"):
        assert rows(spark.table(name)) == [(1, "x")]
    append_evolving(new, name)
    assert rows(spark.table(name)) == [(1.0, "x"), (1.5, "y")]
    assert not spark.catalog.tableExists(f"{name}__next") and not spark.catalog.tableExists(f"{name}__former")


def test_partitions_are_replaced_and_removed(spark, name):
    df = spark.sql("SELECT * FROM VALUES (1, date'2024-01-01'), (2, date'2024-01-02'), (3, null), (4, date'2024-01-04') AS t(a, d)")
    materialize(df, name, partition_by=["d"])
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, dt.date(2024, 1, 9)]
    replace_partitions(spark.table(name).where("a = 2").withColumn("a", F.col("a") * 10), name, "d", days)
    assert rows(spark.table(name).select("a")) == [(20,), (4,)]
    replace_partitions(spark.table(name).where("false"), name, "d", [dt.date(2024, 1, 4)])
    assert rows(spark.table(name).select("a")) == [(20,)]


@pytest.fixture
def fee_dir(spark, tmp_path):
    path = tmp_path / "trips"
    one_file(spark.sql("SELECT 1L AS VendorID, 2L AS airport_fee"), path, "a")
    one_file(spark.sql("SELECT 1.5D AS VendorID, 1.75D AS Airport_fee"), path, "b")
    one_file(spark.sql("SELECT 3L AS vendorid, 'free' AS note"), path, "c")
    return path


@pytest.mark.parametrize("per_load", [1, 2, 4096])
def test_the_size_of_a_load_decides_nothing(spark, name, fee_dir, monkeypatch, per_load):
    monkeypatch.setattr(ingest, "FILES_PER_LOAD", per_load)
    ingest_trips(spark, str(fee_dir), name)
    table = spark.table(name)
    assert table.schema.simpleString() == "struct<VendorID:double,Airport_fee:double,source_file:string,note:string>"
    assert rows(table.select("VendorID", "Airport_fee", "note")) == [(1.0, 2.0, None), (1.5, 1.75, None), (3.0, None, "free")]


def test_a_stream_keeps_what_an_ingest_keeps(spark, name, fee_dir, tmp_path):
    stream_trips(spark, str(fee_dir), name, str(tmp_path / "checkpoint"), files_per_batch=1)
    assert rows(spark.table(name).select("VendorID", "Airport_fee", "note")) == [
        (1.0, 2.0, None), (1.5, 1.75, None), (3.0, None, "free"),
    ]


def test_files_of_two_types_load_in_one_append(spark, name, tmp_path, monkeypatch):
    path = tmp_path / "trips"
    for i in range(16):
        value = "1.5D" if i % 2 else "1L"
        one_file(spark.sql(f"SELECT {value} AS passenger_count"), path, f"f{i:02}")
    appends = []
    monkeypatch.setattr(ingest, "append", lambda df, table: (appends.append(table), append(df, table)))
    ingest_trips(spark, str(path), name)
    assert len(appends) == 1
    assert spark.table(name).agg(F.sum("passenger_count")).first()[0] == 20.0


def test_jobs_for_schemas_do_not_grow_with_files(spark, tmp_path):
    kinds = ["1L AS a, 'x' AS b", "1.5D AS A", "2L AS a, 3 AS c", "'t' AS a"]
    sources = []
    for i, kind in enumerate(kinds):
        one_file(spark.sql(f"SELECT {kind}"), tmp_path / "kinds", f"k{i}")
        sources.append(next((tmp_path / "kinds").glob(f"k{i}*.parquet")))
    jobs = []
    for n in (8, 400):
        folder = tmp_path / f"of-{n}"
        folder.mkdir()
        paths = [str(folder / f"f {i:03}.parquet") for i in range(n)]
        for i, path in enumerate(paths):
            shutil.copy(sources[i % len(kinds)], path)
        (folder / "z.parquet").write_bytes(b"not a parquet file")
        before = spark._jsc.sc().dagScheduler().numTotalJobs()
        groups, failures = ingest.file_schemas(spark, [*paths, str(folder / "z.parquet")])
        jobs.append(spark._jsc.sc().dagScheduler().numTotalJobs() - before)
        kept = sorted((sorted(f["name"] for f in json.loads(s)["fields"]), len(files)) for s, files in groups.items())
        assert kept == [(["A"], n // 4), (["a"], n // 4), (["a", "b", "c"], n // 2)]
        assert sorted(p for files in groups.values() for p in files) == paths
        assert [path for path, _ in failures] == [str(folder / "z.parquet")]
    assert max(jobs) <= len(kinds) + 4  # all at once, each footer, the bad file, the listing of many paths


def test_report_tells_failed_from_empty(spark, name, fee_dir):
    one_file(spark.sql("SELECT 1L AS VendorID WHERE false"), fee_dir, "e")
    (fee_dir / "z_bad.parquet").write_bytes(b"not a parquet file")
    report = {r.source_file[:1]: r for r in ingest_trips(spark, str(fee_dir), name, detailed=True).collect()}
    assert {k: r.outcome for k, r in report.items()} == {
        "a": "loaded", "b": "loaded", "c": "loaded", "e": "empty", "z": "failed",
    }
    assert report["z"].reason and report["a"].reason is None


def test_an_error_of_the_users_expression_is_raised(spark, name, fee_dir):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest_trips(spark, str(fee_dir), name, [{"name": "x", "transformation": "CAST('no' AS INT)"}])


def test_checks_on_one_column_do_not_hide_each_other(spark, name):
    models = {"m": spark.range(5).select(F.col("id").alias("a"))}
    fails, holds = (Check("expression_is_true", "m", "a", (e,)) for e in ("a < 3", "a >= 0"))
    with pytest.raises(ChecksFailed) as raised:
        enforce_checks(models, [fails, holds], name)
    assert raised.value.failed == [("expression_is_true__m__a__1", 2)]
    assert spark.table(f"{name}_expression_is_true__m__a__1").count() == 2
    values = [Check("accepted_values", "m", "a", (0, 1)), Check("accepted_values", "m", "a", (0, 1, 2, 3, 4))]
    with pytest.raises(ChecksFailed) as raised:
        enforce_checks(models, values)
    assert raised.value.failed == [("accepted_values__m__a__1", 3)]
    with pytest.raises(ValueError, match="twice"):
        enforce_checks(models, [fails, fails])
    assert run_checks(models, []).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffled_lookup_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(100).selectExpr("id % 3 AS k", "id AS v", "id AS unused", "map('x', id) AS m").write.parquet(path)
    side = spark.range(3).selectExpr("id AS k", "'n' || id AS name")
    facts = spark.read.parquet(path)
    slim = lookup_join(facts, side, {"k": "k"}, max_bytes=0, salt_by=["v"]).select("v", "name")
    assert "unused" not in plan(slim)
    with_map = lookup_join(facts, side, {"k": "k"}, max_bytes=0)
    assert rows(with_map.selectExpr("v", "m['x']", "name")) == rows(
        lookup_join(facts, side, {"k": "k"}).selectExpr("v", "m['x']", "name")
    )


def test_salts_follow_the_skew(spark):
    even = spark.range(8000).selectExpr("id % 1000 AS k")
    hot = spark.range(8000).selectExpr("IF(id % 2 = 0, 7, id) AS k")
    assert salts_for(even, ["k"]) == 1
    assert salts_for(hot, ["k"]) == 5  # half of all rows over 8 partitions, rounded up
    assert salts_for(even.limit(0), ["k"]) == 1


def test_nested_columns_have_their_size(spark):
    df = spark.sql("SELECT 1 AS k, array(repeat('x', 100000)) AS a, map('m', repeat('y', 50000)) AS m")
    assert measure(df).size > 150_000
    assert hold(df).size > 150_000


def test_relationships_do_not_shuffle_rows_by_value(spark):
    child = spark.range(1000).selectExpr("IF(id % 2 = 0, 5, id) AS k", "id AS v")
    parent = spark.range(0, 1000, 2).selectExpr("id + 1 AS k")
    failing = quality.relationships(child, "k", parent, "k")
    assert failing.count() == 0 + child.where("k = 5").where("false").count() + child.join(parent, "k", "left_anti").count()
    assert "SortMergeJoin" not in plan(failing)
    assert lookup.BROADCAST_BYTES > 0


def test_overwrites_of_two_threads_do_not_meet(spark):
    """Full rebuilds of one table beside upserts of another: the upsert must keep the days it does not touch."""
    kept, rebuilt = (f"t_{uuid.uuid4().hex}" for _ in range(2))
    days = spark.range(6).selectExpr("id AS k", "date_add(date'2024-01-01', int(id)) AS d", "'old' AS v")
    materialize(days, kept, partition_by=["d"])
    errors = []

    def run(work):
        def repeat():
            try:
                for i in range(4):
                    work(i)
            except Exception as e:  # noqa: BLE001
                errors.append(e)

        return threading.Thread(target=repeat)

    def put(i):
        upsert(days.where(f"k = {i}").withColumn("v", F.lit("new")), kept, ["k"], "d")

    threads = [run(put), run(lambda _: materialize(days, rebuilt, partition_by=["d"]))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert rows(spark.table(kept).select("k", "v")) == [(i, "new" if i < 4 else "old") for i in range(6)]
    assert spark.table(rebuilt).count() == 6


def test_weather_preamble_and_files_without_header(spark, name, tmp_path):
    from skyfare.plans import ingest_weather
    from skyfare.sources import read_weather

    header = "station,valid,tmpf\n"
    (tmp_path / "JFK_20240101_20240131.csv").write_text("d1\nd2,x\n#d3\nd4\nd5\n" + header + "JFK,2024-01-01 00:51,41.0\n")
    (tmp_path / "LGA_20240101_20240131.csv").write_text("LGA,2024-01-01 00:51,41.0\n")
    (tmp_path / "EWR_20240101_20240131.csv").write_text(header)
    assert rows(read_weather(spark, str(tmp_path), mark=None).select("station", "tmpf")) == [("JFK", "41.0")]
    report = ingest_weather(spark, str(tmp_path), [], name, mark=None, detailed=True)
    assert {r.source_file[:3]: (r.rows, r.outcome, r.reason) for r in report.collect()} == {
        "JFK": (1, "loaded", None), "LGA": (0, "failed", "no header line"), "EWR": (0, "empty", None),
    }


def test_facts_join_the_trips_twice_and_increments_prune(spark):
    from workloads import queries as q

    sf = "/root/testdata/sf0.001"
    fact = q._fact(spark, sf)
    text = plan(fact)
    assert text.count("BroadcastHashJoin") + text.count("SortMergeJoin") == 2
    mapping, hourly = q._lookups(spark, sf)
    long_way = q.op.trips_with_weather(q._validated(spark, sf, (mapping, hourly)), mapping, hourly)
    assert fact.columns == long_way.columns
    assert rows(fact) == rows(long_way)


def test_validated_trips_are_read_by_date(spark, tmp_path):
    import datetime as dt

    from skyfare.plans import Sources, TableStore, build_models
    from skyfare.sinks import incremental
    from workloads import fixtures as fx

    sf = "/root/testdata/sf0.001"
    store = TableStore(f"t_{uuid.uuid4().hex}_", str(tmp_path))
    sources = Sources(fx.trips_a(spark, sf), fx.weather_a(spark, sf), fx.taxi_zone(spark, sf))
    models = build_models(spark, sources, fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    validated = spark.table(store.name("int_yellow_trips_validated"))
    above = plan(validated.where(F.col("pickup_date") > dt.date(2024, 1, 20)))
    assert "PartitionFilters: [isnotnull(pickup_date" in above
    mark = plan(incremental(validated, store.name("fct_taxi_trips_with_weather"), "pickup_date"))
    assert "PartitionFilters: [isnotnull(pickup_date" in mark
    before = rows(models["fct_taxi_trips_with_weather"])
    again = build_models(spark, sources, fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    assert rows(again["fct_taxi_trips_with_weather"]) == before
