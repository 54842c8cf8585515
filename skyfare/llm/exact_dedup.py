"""Exact duplicates by a stream with keyed state.

The stream reads small rows (digest, identifier, place), never texts. Its state is keyed by digest,
has no watermark and so never expires, and lies in RocksDB on the executors' disks with its changes
in the shared folder: for each digest the largest identifier seen, the place of that row, and the
count. Each task reduces its rows to one per digest before the shuffle, so a digest that a third of
all rows share reaches the state as one row per task.

A digest seen more than once is a hit. The texts of hits are read again and compared byte by byte: a
group in which the least and the greatest text differ is no group of copies, and is dealt with by the
texts themselves instead of the digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyfare.llm.common import ascii_lower, located, rows_at, whole_text
from skyfare.operators.lookup import lookup_join
from skyfare.scratch import hold, scratch_path

_STORE = "spark.sql.streaming.stateStore"
#: State on disk. A store is closed when its task has committed, so an executor holds as many open as it runs tasks,
#: however many partitions there are, and none once the stream has ended; open ones share one bounded memory.
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "64",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "8",
    f"{_STORE}.rocksdb.maxWriteBufferNumber": "2",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.allowFAllocate": "false",  # many small stores: no room taken in advance
    f"{_STORE}.unloadOnCommit": "true",
}
HITS_BROADCAST_BYTES = 16 << 20
_STATE = "digest binary, stays struct<doc_id:bigint,file:string,row:bigint>, n bigint"


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def keyed_state(feed: DataFrame) -> DataFrame:
    """Of a stream of (digest, doc_id, place): per digest the row that stays and the count so far."""
    candidate = F.struct("doc_id", "place.file", "place.row")
    return feed.groupBy("digest").agg(F.max(candidate).alias("stays"), F.count(F.lit(1)).alias("n"))


def run_stream(spark: SparkSession, feed_path: str, schema, state_path: str | None = None) -> DataFrame:
    """Runs the stream over all rows of `feed_path` not yet seen; gives the state that they changed.

    `state_path` keeps the state between calls: a later call with more files in `feed_path` goes on
    where the last one ended. Without it the state is new.
    """
    out = scratch_path(spark, "dedup-state")
    spark.createDataFrame([], f"{_STATE}, batch bigint").write.parquet(out)

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/run={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        feed = spark.readStream.schema(schema).parquet(feed_path)
        query = (
            keyed_state(feed)
            .writeStream.outputMode("update")
            .option("checkpointLocation", state_path or scratch_path(spark, "dedup-checkpoint"))
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changed = spark.read.schema(f"{_STATE}, batch bigint").option("recursiveFileLookup", "true").parquet(out)
    last = changed.groupBy("digest").agg(F.max_by(F.struct("stays", "n"), "batch").alias("s"))
    return last.select("digest", "s.stays", "s.n")


def copy_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """(doc_id, place, digest, stays, n) for every row of `docs` (doc_id, text).

    Texts are equal when identical after lower-casing A-Z; null counts as empty. `stays` is the row
    with the largest doc_id (null is the smallest); of rows that repeat a doc_id the one last in
    file order stays, so exactly one row of a group does. `digest` may be any deterministic function:
    if different texts share its value, the comparison of bytes finds that and parts them.
    """
    spark = docs.sparkSession
    docs, place = located(docs)
    norm = ascii_lower(whole_text(docs))
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), norm.alias("norm"), place.alias("place"))
    path = scratch_path(spark, "dedup-feed")
    small = rows.select("doc_id", digest(F.col("norm")).alias("digest"), "place")
    small.write.parquet(path)
    feed = spark.read.schema(small.schema).parquet(path)
    state = hold(run_stream(spark, path, small.schema), "dedup-groups").df

    hits = hold(state.filter("n > 1").select("digest"), "hits")
    texts = rows.select("norm", "place.row", digest(F.col("norm")).alias("digest"))
    seen = lookup_join(texts, hits, {"digest": "digest"}, how="inner", max_bytes=HITS_BROADCAST_BYTES)
    bytes_ = seen.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    parted = hold(bytes_.filter("low <> high").select("digest"), "parted")
    plain = feed.join(state, "digest")
    if parted.rows == 0:
        return plain
    by_text = (
        rows.withColumn("digest", digest(F.col("norm")))
        .join(parted.df, "digest", "left_semi")
        .groupBy("digest", "norm")
        .agg(F.max(F.struct("doc_id", "place.file", "place.row")).alias("stays"), F.count(F.lit(1)).alias("n"))
    )
    again = (
        rows.withColumn("digest", digest(F.col("norm")))
        .join(by_text, ["digest", "norm"])
        .select("digest", "doc_id", "place", "stays", "n")
    )
    return plain.join(parted.df, "digest", "left_anti").unionByName(again)


def _is_kept() -> Column:
    return F.struct("doc_id", "place.file", "place.row").eqNullSafe(F.col("stays"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all empty texts are copies of each other. The row with the largest doc_id
    stays; of rows that repeat it the last one in file order, and a row without a doc_id only if its group has
    no other. Texts of any length are compared whole. An empty table gives an empty result; other columns are
    not looked at.
    """
    return copy_groups(docs).select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        _is_kept().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns, by the rule of `copy_groups`.

    The texts are not shuffled. An empty table gives an empty one; columns of any name are kept as they are.
    """
    docs, place = located(docs)
    return rows_at(docs, place, copy_groups(docs).filter(_is_kept()).select("place.*"))
