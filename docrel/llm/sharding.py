"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key's shard follows from its hash and the number of shards alone; no ring or table is kept. When one
shard is appended, a key either stays or moves into the new shard, so only one row in ``n + 1`` moves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed

# Fixed value: the multiplier of the published generator.
STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0 to ``shards - 1``, of each unsigned 64-bit key."""
    state, at, ahead = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    going = np.arange(len(keys))
    while len(going):
        at[going] = ahead[going]
        state[going] = state[going] * STEP + np.uint64(1)
        leap = 2.0**31 / ((state[going] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[going] = ((at[going] + 1) * leap).astype(np.int64)
        going = going[ahead[going] < shards]
    return at.astype(np.int32)


def shard_of(hashed, shards: int):
    """Column: the shard of a column of non-negative longs."""

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.uint64), shards))

    return jump(hashed)


def key_hash(key):
    """Column: 60 bits of the MD5 of a key's text, as a long. A null key counts as an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def assign_shards(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, slot and grown shard of every row, as ``key, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 bytes of the text plus 1; ``slot`` numbers a shard's rows from 0 without gaps, in the
    order (top 5 bits of the key's hash, CRC-32 of the text, hash, key, size). ``grown_shard`` is the shard
    after one more is appended.

    Numbering needs no task that sees a whole shard: rows are counted in 1,024 buckets a shard, buckets get
    offsets from the running sum of those counts (at most ``1024 * shards`` rows), and each bucket is numbered
    on its own. Rows equal in key, size and checksum are interchangeable, so they travel as one row with a
    count; they are spread again, in runs of 10,000, after a rebalancing exchange. Texts are never shuffled.

    Null keys hash as empty texts and keep a null key; null and empty texts have size 1 and checksum 0; rows
    that repeat a key all go to its shard; an empty table gives no rows; other columns are ignored.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("crc"))
    counted = rows.groupBy("key", "size", "crc").agg(F.count(F.lit(1)).alias("n")).withColumn("h", key_hash(F.col("key")))
    counted = checkpointed(counted.withColumns({
        "shard": shard_of(F.col("h"), shards), "grown": shard_of(F.col("h"), shards + 1),
        "bucket": (F.shiftright("h", 55) * 32 + F.shiftright("crc", 27)).cast("int")}))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy("shard", "bucket").agg(F.sum("n").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("crc", "h", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "bucket"])
    runs = first.withColumn("run", F.explode(F.expr("sequence(0L, n - 1, 10000L)"))).hint("rebalance")
    spread = runs.withColumn("i", F.explode(F.expr("sequence(run, least(run + 9999, n - 1))")))
    return spread.select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("start") + F.col("i")).alias("slot"), F.col("grown").alias("grown_shard"))
