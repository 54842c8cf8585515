"""SimHash near-duplicates: fingerprints, deletion-variant index, links and components.

Two 64-bit fingerprints that differ in at most three bits are cut into two halves of 32 bits; one
half then differs in at most one bit. Each half is indexed whole and with each of its bits deleted
(33 variants), so that such a pair meets under an equal key, and every meeting is verified on all 64
bits. Only distinct fingerprints are indexed, so copies of a text cost nothing here.

Links are not written out as pairs of a group: within one key a breadth-first walk emits a spanning
forest of the links, which keeps the components and stays linear in the key's members. A key with
more than `bucket` members is not gathered; its members are indexed again by the variants of the
other half's 16-bit quarters. Such a key fixes at least 46 of the 64 bits, which bounds its members
by 2**18.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from skyfare.llm.common import held, located, rows_at, whole_text
from skyfare.llm.components import components
from skyfare.scratch import hold

NEAR_BITS = 3
BUCKET = 4096
_CHUNK = 1 << 16
_LINKS = "a bigint, b bigint, crowded bigint"


def text_fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 values. No word: 0."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    ones, n, chunk = np.zeros(64, np.int64), 0, []
    for shingle in shingles:
        chunk.append(digest(shingle, seed))
        if len(chunk) == _CHUNK:
            ones += _bit_counts(chunk)
            n += len(chunk)
            chunk = []
    if chunk:
        ones += _bit_counts(chunk)
        n += len(chunk)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _bit_counts(digests: list[int]) -> np.ndarray:
    octets = np.array(digests, np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: Column) -> Column:
    """The 64-bit fingerprint of a text column, as a signed bigint."""

    @F.pandas_udf("bigint")
    def of_texts(texts: pd.Series) -> pd.Series:
        prints = np.fromiter((text_fingerprint(t) for t in texts), np.uint64, len(texts))
        return pd.Series(prints.view(np.int64))

    return of_texts(text)


def _half_variants(prints: DataFrame) -> DataFrame:
    """(key, fp): each half whole (place 32) and with one bit deleted (places 0 to 31)."""
    return (
        prints.select("fp", F.explode(F.expr("sequence(0L, 65L)")).alias("v"))
        .selectExpr("fp", "v", "v % 33 AS place", "shiftrightunsigned(fp, int(32 * (v DIV 33))) & 4294967295L AS half")
        .selectExpr(
            "shiftleft(v, 32) | (half & ~(CASE WHEN place = 32 THEN 0L ELSE shiftleft(1L, int(place)) END)) AS key",
            "fp",
        )
    )


def _quarter_variants(crowded: DataFrame) -> DataFrame:
    """The same for the two quarters of the other half, within each crowded key."""
    return (
        crowded.select("key", "fp", F.explode(F.expr("sequence(0L, 33L)")).alias("v"))
        .selectExpr(
            "key", "fp", "v", "v % 17 AS place",
            "shiftrightunsigned(fp, int(32 * (1 - shiftright(key, 32) DIV 33) + 16 * (v DIV 17))) & 65535L AS quarter",
        )
        .selectExpr(
            "shiftleft(key, 22) | shiftleft(v, 16)"
            " | (quarter & ~(CASE WHEN place = 16 THEN 0L ELSE shiftleft(1L, int(place)) END)) AS key",
            "fp",
        )
    )


def spanning_links(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between distinct fingerprints, as two arrays."""
    left, right = [], []
    open_ = prints.copy()
    while len(open_):
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            x = queue.pop()
            near = np.bitwise_count(open_ ^ x) <= bits
            if near.any():
                found = open_[near]
                open_ = open_[~near]
                left.append(np.full(len(found), x))
                right.append(found)
                queue.extend(found)
    if not left:
        return prints[:0], prints[:0]
    return np.concatenate(left), np.concatenate(right)


def _link_sorted(bits: int, bucket: int | None):
    """Walks rows sorted by key; gives the links of each key, or the members of a crowded one."""

    def rows(a, b, crowded) -> pd.DataFrame:
        return pd.DataFrame({"a": a, "b": b, "crowded": crowded}).astype("Int64")

    def of_run(prints: np.ndarray) -> pd.DataFrame:
        a, b = spanning_links(np.unique(prints).view(np.uint64), bits)
        return rows(a.view(np.int64), b.view(np.int64), None)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, kept, crowded = None, [], False

        def close() -> Iterator[pd.DataFrame]:
            if not crowded and sum(map(len, kept)) > 1:
                yield of_run(np.concatenate(kept))

        for batch in batches:
            keys, prints = batch["key"].to_numpy(), batch["fp"].to_numpy()
            if not len(keys):
                continue
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            inner = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
            for s, e in zip(starts[inner], ends[inner], strict=True):
                if keys[s] != key:
                    yield from close()
                    key, kept, crowded = keys[s], [], False
                kept.append(prints[s:e])
                if bucket is not None and (crowded or sum(map(len, kept)) > bucket):
                    crowded = True
                    yield rows(np.concatenate(kept), None, key)
                    kept = []
        yield from close()

    return walk


def _links_of(variants: DataFrame, bits: int, bucket: int | None) -> DataFrame:
    return (
        variants.repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(_link_sorted(bits, bucket), _LINKS)
    )


def fingerprint_links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `prints` (fp) within three bits."""
    found = held(_links_of(_half_variants(prints.select("fp").distinct()), NEAR_BITS, bucket), "simhash")
    links = found.filter("crowded IS NULL").select("a", "b")
    crowded = found.filter("crowded IS NOT NULL").selectExpr("crowded AS key", "a AS fp")
    if crowded.limit(1).count():
        links = links.unionByName(_links_of(_quarter_variants(crowded), NEAR_BITS, None).select("a", "b"))
    return links


def near_components(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs` (doc_id, text).

    Null text counts as empty; texts without a word have fingerprint 0 and link like any other.
    component_id is the smallest doc_id reachable over links; null doc_ids are never the smallest
    unless the component has no other. Rows that share a doc_id are all returned. An empty table
    gives an empty result, and other columns of `docs` are not looked at.
    """
    prints = hold(docs.select(docs["doc_id"], fingerprint(whole_text(docs)).alias("fp")), "fingerprints").df
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = held(components(fingerprint_links(prints, bucket)), "roots")
    by_root = (
        least.join(roots, F.col("fp") == F.col("node"))
        .groupBy("root")
        .agg(F.min("least").alias("joined"))
    )
    joined = roots.join(by_root, "root").select(F.col("node").alias("fp"), "joined")
    classes = least.join(joined, "fp", "left").select("fp", F.coalesce("joined", "least").alias("component_id"))
    # written first: what is joined is then a plain scan, and a fingerprint that many rows share can be split
    classes = held(classes, "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def simhash_components(docs: DataFrame) -> DataFrame:
    """The digest columns of the query: doc_id, fingerprint as 16 hex digits, component_id."""
    found = near_components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of each component stays: that of the smallest doc_id, at the first place (file, row) of those that share it.

    A null doc_id stays only where its component has no other. The texts are not shuffled. Null text counts as
    empty; an empty table gives an empty one; columns of any name are kept as they are.
    """
    docs, place = located(docs)
    ranked = F.struct(docs["doc_id"].isNull().alias("unnamed"), docs["doc_id"].alias("id"), place.alias("place"))
    prints = hold(docs.select(ranked.alias("ranked"), fingerprint(whole_text(docs)).alias("fp")), "fingerprints").df
    least = prints.groupBy("fp").agg(F.min("ranked").alias("least"))
    roots = held(components(fingerprint_links(prints)), "roots")
    first = (
        least.join(roots, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp").alias("component"))
        .agg(F.min("least").alias("least"))
    )
    return rows_at(docs, place, first.select("least.place.*"))
