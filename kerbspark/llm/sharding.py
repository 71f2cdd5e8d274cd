"""Sharding by jump consistent hashing.

A stable key and the number of shards decide a row's shard; there is no ring
table. When a shard is appended, the rows that move all move into it, and they
are the necessary 1/(n+1) of all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

_LCG = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key by the published jump algorithm, for all keys at once."""
    state = np.array(keys).astype(np.int64).view(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live, jump = np.arange(len(state)), np.zeros(len(state), np.float64)
    while len(live):
        shard[live] = jump.astype(np.int64)
        state[live] = state[live] * _LCG + np.uint64(1)
        jump = np.floor((shard[live] + 1) * (float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1)))
        live, jump = live[jump < shards], jump[jump < shards]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a long key; a null key counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf(IntegerType())
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), shards))

    return jump(F.coalesce(key, F.lit(0)))


def stable_key(df: DataFrame, keys: list[str]) -> Column:
    """One integer column is its own key; anything else is hashed to 64 bits first."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (IntegerType, LongType)):
        return F.col(keys[0]).cast("long")
    return F.xxhash64(*keys)


def assign_shards(df: DataFrame, keys: list[str], shards: int, *, grown: int | None = None, order: list[str] | None = None, slices: int = 1024) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (0, 1, ... within the shard) and, if ``grown`` is given, ``grown_shard`` under that many shards.

    Slots are numbered within ``shards`` x ``slices`` groups, spread over all
    tasks, and shifted by the counts of the groups before: no task sees a whole
    shard, and the counts broadcast are at most shards x slices rows. A row's
    slice comes from its ``order`` columns (integers; by default the keys), so
    that a key which a third of the rows share is spread as soon as they differ
    in any of them.

    Null keys count as 0. Rows alike in every order column get neighbouring
    slots in any order. Texts play no part. An empty table gives an empty
    table. Other columns pass through, whatever their names; ``shard``,
    ``slot`` and ``grown_shard`` of the input are replaced.
    """
    order = order or keys
    kept = [c for c in df.columns if c not in ("shard", "slot", "grown_shard")]
    mixed = sum((F.coalesce(F.pmod(F.col(c), F.lit(slices)), F.lit(0)) for c in order), F.lit(0))
    key = stable_key(df, keys)
    added = [shard_of(key, shards).alias("shard"), F.pmod(mixed, F.lit(slices)).cast("int").alias("slice"), *([shard_of(key, grown).alias("grown_shard")] if grown is not None else [])]
    out = df.select(F.struct(*kept).alias("row"), *added)
    sizes = out.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "slice").orderBy(*[F.col("row")[c] for c in order])
    out = out.withColumn("within", F.row_number().over(within).cast("long") - 1).join(F.broadcast(sizes), ["shard", "slice"])
    grown_too = ["grown_shard"] if grown is not None else []
    return out.select(*[F.col("row")[c].alias(c) for c in kept], "shard", *grown_too, (F.col("within") + F.col("before")).alias("slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """Write the rows of :func:`assign_shards`, a folder for each shard."""
    df.write.partitionBy("shard").parquet(path)
