"""Sharding by jump consistent hashing.

A key and the number of shards decide the shard; there is no ring table. Growing from n to n + 1 shards moves
about 1 / (n + 1) of the keys, all of them into the new shard.

Defined results: a null text has no bytes and CRC 0; a null id hashes as key 0; repeated rows go to the same shard
and get slots of their own; of a very long text only its length and CRC leave the scan; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kenning.llm.common import columns, materialise, or_empty

#: Fixed values of the published generator (Lamping and Veach).
MULTIPLIER = np.uint64(2862933555777941757)
ROW_OVERHEAD = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. All keys step together; those that have jumped past the end drop out."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    landed = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    at = np.zeros(len(state), dtype=np.int64)
    while len(live):
        landed[live] = at
        state[live] = state[live] * MULTIPLIER + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        at = np.floor((landed[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        on = at < shards
        live, at = live[on], at[on]
    return landed


def shard_columns(shards: int):
    """A column function: key -> struct(shard, grown), the latter for one more shard."""

    @F.pandas_udf("shard int, grown int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for keys in batches:
            k = keys.to_numpy(dtype=np.int64)
            yield pd.DataFrame({"shard": jump_hash(k, shards).astype("int32"), "grown": jump_hash(k, shards + 1).astype("int32")})

    return place


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots number a shard's rows from 0 without gaps. They are dealt out by (shard, input partition): each such group
    is as small as an input partition, so that no task holds a shard; running counts of the groups give the offsets.
    The text itself never leaves the scan.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    id_col, text_col = docs.columns
    kind = dict(docs.dtypes)[id_col]
    key = F.col(id_col).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(F.col(id_col).cast("string"))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(or_empty(text_col)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(or_empty(text_col).cast("binary")).alias("text_crc32"),
        F.coalesce(key, F.lit(0).cast("long")).alias("__key"),
        F.monotonically_increasing_id().alias("__row"),
    )
    placed = materialise(slim.withColumn("__at", shard_columns(shards)("__key")).select("doc_id", "size", "text_crc32", F.col("__at.shard").alias("shard"), F.col("__at.grown").alias("grown_shard"), "__row", F.shiftright("__row", 33).alias("__part")), "shards")
    counts = placed.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("shard", "__part").orderBy("__row")
    return (
        placed.withColumn("__nth", F.row_number().over(within))
        .join(offsets, ["shard", "__part"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("__before") + F.col("__nth") - 1).cast("long").alias("slot"), "grown_shard")
    )
