"""Document fingerprints: one-permutation MinHash, densified, low-order bits packed.

Each five-word shingle is hashed once; the top eight bits of the hash are its bin, and each of the
256 bins keeps its least hash. An empty bin borrows: it tries bins in an order of its own until it
meets one that is filled, so every empty bin draws independently (optimal densification). Four
low-order bits of each bin's hash are stored, 1,024 bits in all; the hash is mixed with the number of
the bin first, so that bins which hold one and the same shingle agree by chance apart from each other.
Two bins agree by chance once in 16, and the likeness takes that out. Built-in expressions only.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyfare.llm.common import held, whole_text

BINS, BITS, WORDS, PROBES = 256, 4, 5, 8
BUCKET_ROWS, BUCKET_BYTES, MOST_BUCKETS = 5_000, 16 << 20, 65_536
_PER_LONG = 64 // BITS
_LONGS = BINS // _PER_LONG
_SPACE = " \t\n\x0b\f\r"
_LEAST_ID = -(1 << 63)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 56).cast("int")


def _probe(b: Column, j: int) -> Column:
    return F.pmod(F.xxhash64(b, F.lit(j)), F.lit(BINS)).cast("int")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with column `name`: the packed bins of column `text` as 16 longs, null for a text without a word.

    A text of fewer than five words is one shingle. Columns beginning with `_` are used on the way.
    """
    # Each step is a projection of its own, and uses what it reads more than once, so that the
    # optimizer does not evaluate a whole array anew for every element.
    kept = [c for c in df.columns]
    trimmed = F.btrim(F.col(text), F.lit(_SPACE))
    df = df.withColumn("_w", F.when(trimmed != "", F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")))
    df = df.withColumn("_h", F.when(F.size("_w") > 0, F.transform("_w", lambda x: F.xxhash64(x))))
    h = F.col("_h")
    shingles = F.when(
        F.size(h) >= WORDS,
        F.transform(
            F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*[h[i + k] for k in range(WORDS)])
        ),
    ).when(F.size(h) > 0, F.array(F.xxhash64(h)))
    df = df.withColumn("_s", F.sort_array(shingles))
    s = F.col("_s")
    df = df.withColumn(
        "_first", F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(s[F.greatest(i - 1, F.lit(0))])))
    )
    df = df.withColumn("_bins", F.transform("_first", _bin))
    first, bins = F.col("_first"), F.col("_bins")
    df = df.withColumn(
        "_raw",
        F.when(
            F.size(bins) > 0,
            F.transform(
                F.sequence(F.lit(0), F.lit(BINS - 1)),
                lambda b: F.when(F.array_contains(bins, b), first[(F.array_position(bins, b) - 1).cast("int")]),
            ),
        ),
    )
    raw = F.col("_raw")

    def borrowed(b: Column) -> Column:
        nearest = F.array_min(F.transform(bins, lambda c: F.struct(F.xxhash64(b, c, F.lit(PROBES)), c.alias("bin"))))
        return F.coalesce(*[raw[_probe(b, j)] for j in range(PROBES)], raw[nearest["bin"]])

    df = df.withColumn(
        "_low",
        F.transform(
            raw, lambda x, b: F.xxhash64(F.coalesce(x, borrowed(b)), b).bitwiseAND(F.lit((1 << BITS) - 1))
        ),
    )
    low = F.col("_low")
    longs = [
        F.aggregate(
            F.slice(low, 1 + k * _PER_LONG, _PER_LONG),
            F.lit(0).cast("bigint"),
            lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x),
        )
        for k in range(_LONGS)
    ]
    return df.withColumn(name, F.when(F.size(low) > 0, F.array(*longs))).select(*kept, name)


def as_hex(packed: Column) -> Column:
    """The packed bins as 256 hex digits, one per bin; an empty string for a text without a word."""
    digits = [F.lower(F.lpad(F.hex(packed[k]), 16, "0")) for k in range(_LONGS)]
    return F.coalesce(F.concat(*digits), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness from the packed bins: the share of bins that agree, less agreement by chance.

    Two texts without words are alike (1); one with and one without are not (0).
    """

    def differing(k: int) -> Column:
        d = a[k].bitwiseXOR(b[k])
        folded = reduce(Column.bitwiseOR, [F.shiftrightunsigned(d, j) for j in range(BITS)])
        return F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111)))

    agreeing = 1 - sum((differing(k) for k in range(1, _LONGS)), differing(0)) / F.lit(float(BINS))
    chance = 1 / 2**BITS
    estimate = F.greatest(F.lit(0.0), (agreeing - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(estimate)


def _numbers(values: list, of: str) -> Column:
    """An array of fixed numbers, as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{of}>")


def _id_buckets(docs: DataFrame, key: Column, tie: Column) -> Column:
    """The bucket of each row: a range of (key, tie) of about `BUCKET_ROWS` rows and at most about `BUCKET_BYTES`.

    Buckets are numbered in the order of (key, tie). A key that fills several ranges by itself is parted by its ties.
    """
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(whole_text(docs))).alias("b")).first()
    n = max(1, min(MOST_BUCKETS, max(total.n // BUCKET_ROWS, (total.b or 0) // BUCKET_BYTES), total.n))
    if n == 1:
        return F.lit(0)
    shares = _numbers([k / n for k in range(1, n)], "double")
    found = Counter(docs.agg(F.percentile_approx(key, shares, max(10_000, 10 * n)).alias("c")).first().c)
    cuts = sorted(found)
    # a range begins at each cut; one that begins with a key found often has as many parts for it, and one for the rest
    parts = [1] + [found[c] for c in cuts]
    starts = list(accumulate((p if p == 1 else p + 1 for p in parts), initial=0))[:-1]
    step = max(1, round(len(cuts) ** 0.5))
    at = F.greatest(F.size(F.filter(_numbers(cuts[::step], "bigint"), lambda c: c <= key)) - 1, F.lit(0)) * step
    fine = _numbers(cuts, "bigint")
    nth = at + F.size(F.filter(F.slice(fine, at + 1, F.lit(step)), lambda c: c <= key))
    own = F.get(_numbers(parts, "int"), nth)
    in_key = F.least(F.floor((tie / F.lit(2.0**64) + 0.5) * own).cast("int"), own - 1)
    within = F.when(own == 1, 0).when(F.get(fine, nth - 1) == key, in_key).otherwise(own)
    return F.get(_numbers(starts, "int"), nth) + within


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp): every row beside the next one by doc_id; after the last the first.

    Null ids come first; rows that repeat an id are taken in the order of a hash of their text. Rows
    go to buckets of neighbours in this order, one shuffle of the texts; only the first row of each bucket
    is looked up from another one.
    """
    key = F.coalesce(docs["doc_id"], F.lit(_LEAST_ID))
    bucket = _id_buckets(docs, key, F.xxhash64(whole_text(docs)))
    rows = docs.select(
        docs["doc_id"], whole_text(docs).alias("text"), bucket.cast("int").alias("bucket"), key.alias("key")
    )
    least = held(rows.groupBy("bucket").agg(F.min("key").alias("key")), "buckets")  # MOST_BUCKETS rows at most
    heads = (
        rows.join(F.broadcast(least), ["bucket", "key"])
        .groupBy("bucket")
        .agg(F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("head"))
        .select("bucket", F.col("head.text").alias("head_text"))
    )
    following = least.select(
        "bucket",
        F.coalesce(
            F.lead("bucket").over(Window.orderBy("bucket")), F.min("bucket").over(Window.partitionBy(F.lit(0)))
        ).alias("next_bucket"),
    )
    heads = held(
        with_fingerprint(heads, "head_text", "head_fp").join(
            following.select(F.col("next_bucket").alias("bucket"), F.col("bucket").alias("of_bucket")), "bucket"
        ),
        "heads",
    ).select(F.col("of_bucket").alias("bucket"), "head_text", "head_fp")
    order = Window.partitionBy("bucket").orderBy("key", F.xxhash64("text"))
    placed = with_fingerprint(rows, "text", "fp").withColumn("_next", F.lead(F.struct("text", "fp")).over(order))
    beside = placed.join(heads, "bucket")
    here = F.col("_next").isNotNull()
    return beside.select(
        "doc_id",
        "text",
        "fp",
        F.when(here, F.col("_next.text")).otherwise(F.col("head_text")).alias("next_text"),
        F.when(here, F.col("_next.fp")).otherwise(F.col("head_fp")).alias("next_fp"),
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text has the last quarter of the code points replaced by as many from the start of the
    next document's text (all of it, if shorter). Null text counts as empty. Texts of any length are taken
    whole. Rows that repeat are each returned. An empty table gives an empty result; other columns are not
    looked at.
    """
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = with_next(docs).select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    both = with_fingerprint(rows, "edited", "edited_fp")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
