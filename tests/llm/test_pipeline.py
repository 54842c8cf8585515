from __future__ import annotations

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from skyfare.llm.common import located, rows_at
from skyfare.llm.queries import ORACLE_SQL, QUERIES
from skyfare.operators.lookup import BROADCAST_SETTING
from tests.compare import differences
from tests.llm.conftest import SF_DIR
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute as near_brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_queries_with_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    for name, sql in ORACLE_SQL.items():
        assert differences(QUERIES[name](spark, SF_DIR), con, sql) is None


def test_stages_against_plain_python(spark, docs):
    """Each stage on what the one before it kept, and the whole run."""
    columns = docs.columns
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in now.collect()}
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}"
        stage(spark, now, SF_DIR).write.mode("overwrite").parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == columns
        kept = {r.doc_id for r in now.select("doc_id").collect()}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
            right = [(i in kept) == bool(labels[i]) for i in before if i in labels]
            assert sum(right) >= 0.97 * len(right)
        elif name == "exact_dedup":
            last = {}
            for i in sorted(before):
                last[before[i].translate(LOWER)] = i
            assert kept == set(last.values())
        else:
            assert kept == {c for _, _, c in near_brute(before.items())}
    texts = [(r.doc_id, r.text) for r in now.collect()]
    whole = corpus_pipeline.run(spark, SF_DIR)
    rows = whole.collect()
    check(rows, Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), texts, 2048)


def test_rows_at_places(spark, docs):
    """Bit maps over several files and stretches find the same rows as a plain test of the ids."""
    path = f"{spark.conf.get('spark.checkpoint.dir')}/places"
    spark.range(0, 300_000, 1, 3).selectExpr("id", "id % 7 AS bits", "'x' AS stretch").write.parquet(path)
    df, place = located(spark.read.parquet(path))
    some = df.select("id", place.alias("place")).where("id % 13 = 5 OR id BETWEEN 140000 AND 175000").select("place.*")
    for limit in (str(1 << 28), "0"):  # broadcast, and shuffled
        spark.conf.set(BROADCAST_SETTING, limit)
        found = rows_at(df, place, some)
        assert found.columns == df.columns
        want = [i for i in range(300_000) if i % 13 == 5 or 140_000 <= i <= 175_000]
        assert sorted(r.id for r in found.collect()) == want
    spark.conf.unset(BROADCAST_SETTING)


def test_texts_are_not_shuffled(spark, docs):
    """What leaves the two stages that drop copies is a scan and a join with broadcast bit maps."""
    for stage in (corpus_pipeline.exact_dedup, corpus_pipeline.simhash_dedup):
        plan = stage(spark, docs, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        shuffled = [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]
        assert not any("text" in x for x in shuffled) and "BroadcastHashJoin" in plan


def test_stages_on_odd_rows(spark, odd, none):
    for df in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF_DIR)
            if name != "packing":
                assert out.columns == df.columns
            assert out.count() <= max(df.count(), 200)


def test_sets_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
