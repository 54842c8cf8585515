from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from skyfare.plans import Check, ChecksFailed, Sources, TableStore, build_models, enforce_checks, model_checks, run_checks
from skyfare.sinks import append, append_evolving, as_view, ensure_table, incremental, materialize, upsert
from workloads import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"
D = dt.date


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def days(spark, *pairs):
    return spark.createDataFrame([(k, v, d) for k, v, d in pairs], "k int, v string, d date")


def test_incremental_takes_rows_above_the_mark(spark, name):
    first = days(spark, (1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2)))
    assert rows(incremental(first, name, "d")) == rows(first)
    materialize(first, name, partition_by=["d"])
    more = days(spark, (3, "late", D(2024, 1, 2)), (4, "new", D(2024, 1, 3)), (5, "null", None))
    assert [r.k for r in incremental(more, name, "d").collect()] == [4]
    assert incremental(more, name, "d", full_refresh=True).count() == 3


def test_incremental_treats_an_empty_table_as_absent(spark, name):
    batch = days(spark, (1, "a", D(2024, 1, 1)), (2, "b", None))
    ensure_table(spark, name, batch.schema, ["d"])
    assert incremental(batch, name, "d").count() == 2


def test_upsert(spark, name):
    old = days(
        spark, (1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 1)), (3, "c", D(2024, 1, 2)),
        (None, "null key", D(2024, 1, 1)), (9, "no day", None), (4, "far", D(2023, 1, 1)),
    )
    materialize(old, name, partition_by=["d"])
    batch = days(
        spark, (2, "B", D(2024, 1, 1)), (2, "B2", D(2024, 1, 1)), (5, "e", D(2024, 1, 3)),
        (None, "null too", D(2024, 1, 1)), (8, "no day either", None),
    )
    want = rows(old.where("k IS NULL OR k <> 2").unionByName(batch))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    upsert(batch, name, ["k"], "d")
    assert rows(spark.table(name)) == want
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    again = batch.where("k IS NOT NULL")
    upsert(again, name, ["k"], "d")
    assert rows(spark.table(name)) == want


def test_upsert_reads_only_the_days_of_the_batch(spark, name):
    from skyfare.sinks.tables import _sharing_partitions

    old = days(spark, *[(i, "x", D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(20)])
    table = materialize(old, name, partition_by=["d"])
    shared = _sharing_partitions(table, days(spark, (1, "y", D(2024, 1, 5)), (2, "y", D(2024, 1, 7))), "d")
    assert rows(shared.select("k")) == [(4,), (6,)]
    text = shared._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in text and "dynamicpruning" in text


def test_rebuild_leaves_no_old_partition(spark, name, tmp_path):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        for df in (days(spark, (1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2))), days(spark, (3, "c", D(2024, 1, 3)))):
            table = materialize(df, name, partition_by=["d"], path=str(tmp_path / "t"))
    finally:
        spark.conf.set(setting, before)
    assert rows(table) == [(3, "c", D(2024, 1, 3))]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_append_matches_names_and_casts(spark, name):
    ensure_table(spark, name, T.StructType().add("a", "long").add("b", "string"))
    append(spark.sql("SELECT 'x' AS b, 1 AS a"), name)
    append(spark.sql("SELECT 2 AS a"), name)
    assert rows(spark.table(name)) == [(1, "x"), (2, None)]


def test_append_evolving_adds_columns(spark, name):
    materialize(spark.sql("SELECT 1L AS a, date'2024-01-01' AS d"), name, partition_by=["d"])
    append_evolving(spark.sql("SELECT date'2024-01-02' AS d, 'new' AS extra, 2L AS a"), name)
    assert rows(spark.table(name).select("a", "d", "extra")) == [
        (1, D(2024, 1, 1), None), (2, D(2024, 1, 2), "new"),
    ]


def test_hot_partition_is_split_and_clustered(spark, name, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        df = spark.sql("SELECT IF(id % 3 = 0, id % 50, 7) AS d, id AS v, hash(id) AS h FROM range(60000)")
        table = materialize(df, name, partition_by=["d"], cluster_by=["v"], path=str(tmp_path / "t"))
    finally:
        spark.conf.set(size, before)
    assert table.count() == 60000
    files = table.groupBy("d").agg(F.count_distinct("_metadata.file_name").alias("n"))
    assert files.where("d = 7").first().n > 1
    # days that share the hot one's hash partition are split with it, the others are not
    assert files.where("d <> 7 AND n <= 2").count() > 25


def test_view(spark, name):
    assert as_view(spark.range(3), name).count() == 3


def build(spark, store=None, **kw):
    sources = Sources(fx.trips_a(spark, SF_DIR), fx.weather_a(spark, SF_DIR), fx.taxi_zone(spark, SF_DIR))
    return build_models(spark, sources, fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store, **kw)


def rounded(df):
    return rows(df.select(*[F.round(f.name, 6) if f.dataType == T.DoubleType() else f.name for f in df.schema]))


def test_models_lazy_stored_and_rebuilt_are_the_same(spark, name, tmp_path):
    lazy = build(spark)
    store = TableStore(f"{name}_", str(tmp_path))
    stored = build(spark, store)
    assert list(lazy) == list(stored) and len(lazy) == 12
    want = {m: rounded(df) for m, df in lazy.items()}
    for model, df in stored.items():
        assert rounded(df.select(lazy[model].columns)) == want[model], model
    for full_refresh in (False, True):
        rebuilt = build(spark, store, full_refresh=full_refresh)
        for model in lazy:
            assert rounded(rebuilt[model].select(lazy[model].columns)) == want[model], model


def test_two_step_fact_equals_one_build(spark, name, tmp_path):
    whole = build(spark)["fct_taxi_trips_with_weather"]
    store = TableStore(f"{name}_", str(tmp_path))
    trips = fx.trips_a(spark, SF_DIR)
    for part in (trips.where("tpep_pickup_datetime < '2024-01-15'"), trips):
        sources = Sources(part, fx.weather_a(spark, SF_DIR), fx.taxi_zone(spark, SF_DIR))
        models = build_models(spark, sources, fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    fact = models["fct_taxi_trips_with_weather"].select(whole.columns)
    assert rounded(fact) == rounded(whole)


def test_model_checks_are_all_declared():
    kinds = {}
    for check in model_checks():
        kinds[check.kind] = kinds.get(check.kind, 0) + 1
    assert kinds == {
        "not_null": 74, "unique": 5, "accepted_values": 3, "relationships": 5,
        "unique_combination": 2, "expression_is_true": 19,
    }


def test_checks_count_failing_rows(spark):
    parent = spark.sql("SELECT id AS p FROM range(5)")
    child = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (9, 'a'), (9, 'z'), (NULL, NULL) t(c, s)")
    models = {"child": child, "parent": parent}
    checks = [
        Check("not_null", "child", "c"),
        Check("unique", "child", "c"),
        Check("accepted_values", "child", "s", ("a", "b")),
        Check("relationships", "child", "c", ("parent", "p")),
        Check("unique_combination", "child", "c_and_s", ("c", "s")),
        Check("expression_is_true", "child", "c", ("c < 5",)),
    ]
    got = {r.check: r.failures for r in run_checks(models, checks).collect()}
    assert got == {
        "not_null": 1, "unique": 2, "accepted_values": 1, "relationships": 2,
        "unique_combination": 0, "expression_is_true": 2,
    }


def test_row_checks_of_a_table_share_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id AS a, id AS b FROM range(10)").write.parquet(path)
    df = spark.read.parquet(path)
    checks = [Check("not_null", "m", c) for c in ("a", "b")]
    checks += [Check("expression_is_true", "m", c, (f"{c} > 3",)) for c in ("a", "b")]
    summary = run_checks({"m": df}, checks)
    assert summary._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(r.failures for r in summary.collect()) == [0, 0, 4, 4]


def test_enforced_checks_store_failing_rows_and_raise(spark, name):
    models = {"m": spark.sql("SELECT id AS a FROM range(5)")}
    bad = Check("expression_is_true", "m", "a", ("a < 3",))
    with pytest.raises(ChecksFailed) as caught:
        enforce_checks(models, [bad, Check("not_null", "m", "a")], store_prefix=name)
    assert caught.value.failed == [(bad.name, 2)]
    assert rows(spark.table(f"{name}_{bad.name}")) == [(3,), (4,)]
    fine = enforce_checks(models, [Check("not_null", "m", "a")], store_prefix=name)
    assert [r.failures for r in fine.collect()] == [0]
