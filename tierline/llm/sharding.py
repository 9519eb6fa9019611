"""Sharding by jump consistent hash: a key and the shard count decide, no ring table is kept.

``jump_hash`` follows the published algorithm: a key walks over the shard
counts at which it would have moved, each step drawn by a 64-bit linear
congruential generator, and stays where the next move lies beyond the number
of shards. Going from n to n + 1 shards moves 1 / (n + 1) of the keys, all
into the new shard.

``slot`` numbers the rows of a shard without gaps. No task sees a whole
shard: rows are dealt by hash into about sqrt(rows) blocks per shard, blocks
are counted, a running sum over the counts gives each block its first slot,
and rows are numbered inside their block. Both the blocks of a shard and the
rows of a block are then in the order of sqrt(rows).

Defined results: a null key counts as key 0; a null text has no bytes (size
1) and the checksum of no bytes (0); repeated rows each get a slot; equal rows are interchangeable;
an empty table gives an empty one; columns beyond key and text are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tierline.llm.shared import cut


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to shards - 1) of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    jump = np.zeros(len(state), dtype=np.int64)
    while len(moving):
        shard[moving] = jump
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        jump = np.floor((shard[moving] + 1) * (float(1 << 31) / ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        stays = jump >= shards
        moving, jump = moving[~stays], jump[~stays]
    return shard


def key_of(column: Column, kind: T.DataType) -> Column:
    """The 64-bit key of a column: integers as they are, everything else hashed (stable over runs)."""
    if isinstance(kind, T.IntegralType):
        return F.coalesce(column.cast("long"), F.lit(0))
    return F.when(column.isNull(), F.lit(0)).otherwise(F.xxhash64(column))


def assign(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key column."""
    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64).view(np.uint64), shards), dtype="int32")
    return jump(key)


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", grow: bool = True) -> DataFrame:
    """One row per document: (id_col, size, text_crc32, law, shard, slot, grown_shard).

    ``grown_shard`` is where the row would go with one shard more (null unless ``grow``).
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    key = key_of(docs[id_col], docs.schema[id_col].dataType)
    sized = docs.select(docs[id_col].alias("id"), key.alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("crc"))
    placed = cut(sized.withColumn("shard", assign(F.col("key"), shards))
                 .withColumn("grown", assign(F.col("key"), shards + 1) if grow else F.lit(None).cast("int")), "shard-rows")
    blocks = max(1, math.isqrt(placed.count()))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key", "crc"), F.lit(blocks)))
    counted = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("key", "crc", "size")
    return (placed.join(first, ["shard", "block"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.row_number().over(inside) - 1).alias("slot"), F.col("grown").alias("grown_shard")))
