"""Token ids in files coded by a static range asymmetric numeral system.

Documents are sorted by key. A row of the file holds a segment: some millions
of ids, their documents' keys and lengths, one frequency table made from all
ids of the segment, and blocks of whole documents that the table codes
independently. In a block the ids are dealt to interleaved lanes, whose states
advance together. Checkpoints hold all lanes' states and the place in the word
stream, so that a reader may start there, and a checksum guards each block.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, slices
from .tokens import encoder, with_end

MAGIC = b"RNS1"
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
SEGMENT_IDS, BLOCK_IDS, LANES, CHECK_STEPS = 1 << 21, 1 << 18, 1024, 64
_BLOCK = struct.Struct("<IIHHII")


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^SCALE_BITS, at least 1 for each id that occurs and 0 for others."""
    total = 1 << SCALE_BITS
    used = np.flatnonzero(counts)
    if len(used) > total // 2:
        raise ValueError("too many different ids for the table's scale")
    freq = np.zeros(len(counts), np.int64)
    share = counts[used] * (total - len(used)) // counts[used].sum()
    freq[used] = share + 1
    freq[used[np.argmax(counts[used])]] += total - freq.sum()
    return freq


class Table:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One block. Id number t * lanes + i is coded at step t in lane i; a short last step is filled with the first id."""
    n = len(ids)
    lanes = int(max(1, min(LANES, n // 128)))
    steps = -(-n // lanes)
    symbols = np.concatenate([ids, np.full(steps * lanes - n, ids[0], ids.dtype)]).reshape(steps, lanes)
    freq, cum = table.freq[symbols], table.cum[symbols]
    state = np.full(lanes, LOW)
    words, out = np.zeros((steps, lanes), np.uint32), np.zeros((steps, lanes), bool)
    marks: list[np.ndarray] = []
    shift, half = np.uint64(SCALE_BITS), np.uint64(32)
    for t in range(steps - 1, -1, -1):
        f = freq[t]
        full = state >= f << np.uint64(63 - SCALE_BITS)
        out[t], words[t] = full, state.astype(np.uint32)
        state = np.where(full, state >> half, state)
        quotient = state // f
        state = (quotient << shift) + (state - quotient * f) + cum[t]
        if t and t % CHECK_STEPS == 0:
            marks.append(state.copy())
    places = np.cumsum(out.sum(axis=1))
    at = range(CHECK_STEPS, steps, CHECK_STEPS)
    checks = b"".join(struct.pack("<I", int(places[t - 1])) + m.tobytes() for t, m in zip(at, marks[::-1], strict=True))
    payload = state.tobytes() + checks + words[out].tobytes()
    head = _BLOCK.pack(n, len(payload), lanes, len(marks), int(out.sum()), zlib.crc32(ids.astype("<u4").tobytes()))
    return head + payload


def decode_block(data: bytes, at: int, table: Table, check: int = 0) -> tuple[np.ndarray, int]:
    """The ids of the block at byte ``at`` and the byte after it; from its checkpoint number ``check``, if not 0, on."""
    n, size, lanes, checks, count, crc = _BLOCK.unpack_from(data, at)
    body = at + _BLOCK.size
    steps, each = -(-n // lanes), 4 + 8 * lanes
    stream = np.frombuffer(data, "<u4", count, body + 8 * lanes + checks * each).astype(np.uint64)
    state, place, first = np.frombuffer(data, "<u8", lanes, body).astype(np.uint64), 0, 0
    if check:
        start = body + 8 * lanes + (check - 1) * each
        place, first = struct.unpack_from("<I", data, start)[0], check * CHECK_STEPS
        state = np.frombuffer(data, "<u8", lanes, start + 4).astype(np.uint64)
    out = np.empty((steps - first, lanes), np.uint32)
    mask, shift, half = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    for t in range(steps - first):
        low = state & mask
        s = table.symbol[low]
        out[t] = s
        state = table.freq[s] * (state >> shift) + low - table.cum[s]
        need = np.flatnonzero(state < LOW)
        state[need] = (state[need] << half) | stream[place : place + len(need)]
        place += len(need)
    ids = out.reshape(-1)[: n - first * lanes]
    if not check and zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block's checksum differs from its ids")
    return ids, body + size


def encode_segment(keys: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A segment: magic, number of documents and blocks, the documents, the table, the blocks."""
    freq = quantise(np.bincount(ids))
    table = Table(freq)
    ends = np.cumsum(lengths)
    edges, last = [0], 0
    for e in ends.tolist():
        if e - last >= BLOCK_IDS:
            edges.append(e)
            last = e
    if last < len(ids):
        edges.append(len(ids))
    blocks = [encode_block(ids[a:b], table) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    named = np.array([k is not None for k in keys])
    index = zlib.compress(np.packbits(named).tobytes() + np.array([k or 0 for k in keys], "<i8").tobytes() + np.array(lengths, "<u8").tobytes())
    packed = zlib.compress(freq.astype("<u4").tobytes())
    return MAGIC + struct.pack("<IIIII", len(keys), len(blocks), len(index), len(freq), len(packed)) + index + packed + b"".join(blocks)


def decode_segment(data: bytes | pa.Buffer) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, lengths and ids of a segment's documents."""
    data = memoryview(data)
    if data[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    docs, blocks, index_size, symbols, table_size = struct.unpack_from("<IIIII", data, 4)
    at = 24
    index = zlib.decompress(data[at : at + index_size])
    at += index_size
    table = Table(np.frombuffer(zlib.decompress(data[at : at + table_size]), "<u4", symbols).astype(np.int64))
    at += table_size
    bits = -(-docs // 8)
    named = np.unpackbits(np.frombuffer(index, np.uint8, bits), count=docs).astype(bool)
    keys = np.frombuffer(index, "<i8", docs, bits).tolist()
    lengths = np.frombuffer(index, "<u8", docs, bits + 8 * docs).astype(np.int64)
    parts = []
    for _ in range(blocks):
        ids, at = decode_block(data, at, table)
        parts.append(ids)
    return [k if on else None for k, on in zip(keys, named, strict=True)], lengths, np.concatenate(parts)


def write_ids(docs: DataFrame, tokenizer: str, path: str, *, key: str = "doc_id", text: str = "text", end: int = 0, partitions: int | None = None) -> None:
    """Write the ids of whole texts, ``end`` after each, in ascending order of ``key`` to Parquet rows (part, segment, n_ids, data).

    Rows are dealt by ranges of (key, hash of the text), so many rows of one key
    are spread too. A part's number and its segments' numbers are in the order
    of the keys. A task holds one segment's ids at a time.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            nonlocal number, keys, lengths, held
            ids = np.concatenate(held)
            row = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([encode_segment(keys, lengths, ids)], pa.binary())]
            number, keys, lengths, held = number + 1, [], [], []
            return pa.RecordBatch.from_arrays(row, ["part", "segment", "n_ids", "data"])

        for whole in batches:
            for batch in slices(whole, "text"):
                ids, bounds = with_end(*encode(batch.column("text")), end)
                keys += batch.column("key").to_pylist()
                lengths += np.diff(bounds).tolist()
                held.append(ids)
                if sum(map(len, held)) >= SEGMENT_IDS:
                    yield segment()
        if keys:
            yield segment()

    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    order = ["key", F.xxhash64("text")]
    dealt = named.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, "part int, segment int, n_ids long, data binary").write.parquet(path)


def read_ids(spark: SparkSession, path: str, *, key: str = "doc_id") -> DataFrame:
    """The documents of :func:`write_ids`: key, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    rows = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, data in zip(batch.column("before").to_pylist(), batch.column("data"), strict=True):
                keys, lengths, ids = decode_segment(data.as_buffer())
                ends = np.cumsum(lengths)
                raw = pa.py_buffer(ids.astype("<u4"))
                texts = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), raw])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(before + ends - lengths), pa.array(lengths), texts], ["key", "start", "n_tokens", "ids"])

    # the ids before each part and segment; then the coded rows are joined to these, and decoded last
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("one", F.lit(1))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier(Window.partitionBy("one").orderBy("part"))), F.lit(0)).alias("before_part"))
    base = rows.select("part", "segment", "n_ids").join(parts, "part")
    base = base.select("part", "segment", (F.col("before_part") + F.coalesce(F.sum("n_ids").over(earlier(Window.partitionBy("part").orderBy("segment"))), F.lit(0))).alias("before"))
    coded = rows.select("part", "segment", "data").join(base, ["part", "segment"]).select("before", "data")
    return coded.mapInArrow(run, "key long, start long, n_tokens long, ids binary").withColumnRenamed("key", key)


def scratch_path(spark: SparkSession) -> str:
    """A new folder in the shared folder."""
    return f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
