"""Sharding by rendezvous hashing.

Every shard draws a number for a record's key from a hash of both, ``-ln(u) / weight``; the least draw owns the
record. A new shard only takes records whose draw it wins, so no record moves between old shards, and a
shard holds a share in proportion to its weight. Slots number a shard's records from 0 without gaps: equal
records are counted first, hash buckets are numbered on their own, and a table of bucket sizes, bounded by shards
times ``BUCKETS``, shifts them.

Defined cases: a null key counts as the empty text; a null text has no bytes and the checksum of none; repeated
records share a shard and get slots one after the other; equal draws go to the shard of the least number; a text's length does not
matter, as only its size and checksum travel; the query reads no other columns, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 16 ** 3  # three hex digits
COPIES = 4096
_BITS = 52


def draws(key: Column, weights: Sequence[float]) -> list[Column]:
    """(draw, shard) per shard; 52 bits of md5 make u, never 0 or 1."""
    out = []
    for shard, weight in enumerate(weights):
        drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, 13), 16, 10).cast("double")
        out.append(F.struct((-F.log((drawn + 0.5) / float(1 << _BITS)) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    return out


def owner(key: Column, weights: Sequence[float]) -> Column:
    return F.array_min(F.array(*draws(key, weights)))["shard"]


def sharded(records: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float]) -> DataFrame:
    """``records``, counted per distinct row, with shard, slot and grown_shard (the owner under ``grown``).

    ``grown`` lists the weights after shards were added behind the old ones.
    """
    columns = records.columns
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    placed = records.groupBy(*columns).agg(F.count("*").alias("copies")).withColumns({
        "shard": owner(text, weights),
        "grown_shard": owner(text, grown),
        "bucket": F.substring(F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).cast("binary")), 1, 3),
    })
    totals = placed.groupBy("shard", "bucket").agg(F.sum("copies").alias("held"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(totals.select("shard", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("shard", "bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, ["shard", "bucket"])
    parts = numbered.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    copy = F.explode(F.sequence(F.col("part"), F.least(F.col("part") + (COPIES - 1), F.col("copies") - 1)))
    return parts.withColumn("copy", copy).select(
        *columns, "shard", (F.col("start") + F.col("ahead") + F.col("copy")).alias("slot"), "grown_shard")
