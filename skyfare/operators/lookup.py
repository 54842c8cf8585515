"""Joining a large table to a lookup table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import DataFrame, functions as F, types as T

from skyfare.scratch import Held, measure

BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_SETTING = "spark.skyfare.broadcastBytes"
MOST_SALTS = 1024
_UNHASHED = (T.MapType, T.VariantType)


def salts_for(facts: DataFrame, keys: Sequence[str]) -> int:
    """How many pieces the most frequent key is cut into: its rows over those of an even partition.

    Counted per key on the key columns alone, so the scan reads no others.
    """
    counted = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    top, rows = counted.agg(F.max("n"), F.sum("n")).first()
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_SALTS, ceil((top or 0) * partitions / max(rows or 1, 1))))


def lookup_join(
    facts: DataFrame,
    lookup: Held | DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    max_bytes: int | None = None,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns of `lookup` that are not keys to `facts`; `on` maps fact key to lookup key.

    A lookup measured at no more than `max_bytes` (by default the session's
    spark.skyfare.broadcastBytes, or 256 MiB) is broadcast: the facts are not shuffled. A larger one
    is joined by shuffle on key + salt. The salt keeps a hot key, or the NULL key, off a single
    partition, in as many pieces as it is frequent, and because no later grouping is partitioned by
    it, adaptive execution stays free to split what is still too large. The salt is a hash of the
    columns `salt_by` (by default all that can be hashed), so a retried task repeats it; name a few,
    and the scan reads only what the result needs.
    """
    held = measure(lookup)
    table = held.df
    if max_bytes is None:
        max_bytes = int(facts.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
    payload = [c for c in table.columns if c not in on.values()]
    side = table.select(
        *[F.col(right).alias(left) for left, right in on.items()],
        *[F.col(c).alias(c) for c in payload],
    )
    keys = list(on)
    if held.size <= max_bytes:
        joined = facts.join(F.broadcast(side), keys, how)
    else:
        hashed = salt_by or [f.name for f in facts.schema.fields if not isinstance(f.dataType, _UNHASHED)]
        salts = salts_for(facts, keys)
        salt = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
        every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        joined = facts.withColumn("_salt", salt).join(
            side.withColumn("_salt", every_salt), [*keys, "_salt"], how
        )
    return joined.select(*facts.columns, *payload)
