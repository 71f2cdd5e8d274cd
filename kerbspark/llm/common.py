"""Helpers shared by the training-data operators.

Text conventions used everywhere in this subpackage: a null text is an empty
text; a *word* is a run of characters outside U+0020 and U+0009..U+000D; lower
case means A-Z only.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes of text that one step of a Python task handles at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where the session names none, a local one in local mode, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="spark-")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and read it back, so that lost executors do not repeat its work."""
    spark = df.sparkSession
    if spark._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def ascii_lower(col: Column | str) -> Column:
    return F.translate(col, UPPER, LOWER)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of ``batch`` in order, in pieces of about ``limit`` bytes of ``column`` (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else []
    for a, b in zip(starts, [*starts[1:], len(part)], strict=True):
        yield batch.slice(int(a), int(b - a))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in one array, and the offsets of each text's words in it."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    real = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return words.filter(real), kept[ends]


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct string, the same in every process."""
    if not len(values):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``texts``, and the offsets of each text's words."""
    words, ends = split_words(pc.ascii_lower(texts) if lower else texts)
    coded = words.dictionary_encode()
    return hash_strings(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.uint64), ends


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    n = len(hashes) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def shingle_sets(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text, end to end, and their offsets.

    A text of fewer than ``k`` words has its whole sequence as its only shingle; one without words has none.
    Shingles are told apart by 64-bit hashes.
    """
    hashes, ends = word_hashes(texts)
    runs = rolled(hashes, k) if len(hashes) >= k else np.empty(0, np.uint64)
    sets = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(runs[a : b - k + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            sets.append(rolled(hashes[a:b], b - a) if b > a else hashes[:0])
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), offsets


def bits_for(count: int, least: int = 20, most: int = 30) -> int:
    """Bits of a table in which ``count`` hashes set one bit in 256 at most; beyond 2^22 hashes the table stays at 128 MB and lets more through."""
    return min(max(least, (256 * max(count, 1) - 1).bit_length()), most)


def without(df: DataFrame, gone: DataFrame, key: str, most: int = 1 << 21) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``gone``, a table of longs.

    Up to ``most`` of these, 16 MB, go to every task, so that texts are not
    shuffled; more are joined.
    """
    gone = cut(gone.distinct())
    few = gone.count() <= most
    return df.join(F.broadcast(gone) if few else gone, key, "left_anti")


def bit_table(hashes: DataFrame, column: str, bits: int) -> bytes:
    """A table of 2^bits bits with a one at the top bits of each 64-bit hash.

    The driver receives words of 64 bits with their numbers, columns of twice
    the table's size at most, and no row for each hash.
    """
    slot = F.shiftrightunsigned(column, 64 - bits)
    got = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("ones")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[got.column("word").to_numpy()] = got.column("ones").to_numpy()
    return table.astype("<i8").tobytes()


def in_bit_table(table: bytes, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in a :func:`bit_table`; those that are in it always are."""
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return ((np.frombuffer(table, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)
