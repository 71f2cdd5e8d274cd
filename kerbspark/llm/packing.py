"""Packing of token sequences by the sum-of-squares rule.

Documents arrive one at a time and are placed at once. Of the fill levels that
leave room, a document goes to the one after which the sum over levels of the
squared number of windows at that level is least; an array with a count for
each level is all that the choice needs. Documents longer than a window are cut
into full windows first. Each Spark partition packs its own rows, so nothing is
shuffled, and a lost task is simply packed again. What a task holds is its open
windows: few, as the rule keeps levels even, and never more than the ids of the
rests of its own partition, whose size the reader's settings bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tokens import encoder, with_end

Piece = tuple[int | None, int, np.ndarray, int]


class SumOfSquares:
    """An online packer. ``place`` and ``finish`` return the windows that they complete, lists of pieces."""

    def __init__(self, size: int):
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)
        self.windows: dict[int, list[list[Piece]]] = {}

    def best_level(self, length: int) -> int:
        """The level, 0 for a new window, whose use changes the sum of squares least; of equals the fullest."""
        from_levels = self.levels[: self.size - length + 1]
        to_levels = self.levels[length:].copy()
        to_levels[-1] = 0
        change = 2 * to_levels + 1
        change[-1] = 0  # a full window is no longer counted
        change[1:] += 1 - 2 * from_levels[1:]
        change[1:][from_levels[1:] == 0] = np.iinfo(np.int64).max
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def place(self, piece: Piece) -> list[list[Piece]]:
        length = len(piece[2])
        level = self.best_level(length)
        if level:
            window = self.windows[level].pop()
            self.levels[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + length == self.size:
            return [window]
        self.levels[level + length] += 1
        self.windows.setdefault(level + length, []).append(window)
        return []

    def finish(self) -> list[list[Piece]]:
        """All open windows, the fullest filled up with pieces cut from the emptiest; one at most is not full."""
        order = [w for level in sorted(self.windows) for w in self.windows[level]]
        self.levels[:], self.windows, done = 0, {}, []
        while len(order) > 1:
            window = order.pop()
            room = self.size - sum(len(p[2]) for p in window)
            while room and order:
                key, start, ids, total = order[0].pop()
                take = min(room, len(ids))
                window.append((key, start + len(ids) - take, ids[len(ids) - take :], total))
                if take < len(ids):
                    order[0].append((key, start, ids[: len(ids) - take], total))
                if not order[0]:
                    order.pop(0)
                room -= take
            (order if room else done).append(window)
        return done + order


def pack(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", window: int = 4096, end: int = 2) -> DataFrame:
    """Pieces of ``docs``: key, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    A document's ids are its whole text's by the ``tokenizer`` file, then
    ``end``. Every id lies in one piece. A sequence holds at most ``window``
    ids; its pieces follow one another from 0, and only the last sequence of a
    partition can be short. A sequence id is the partition's number times 2^32
    plus a count from 0.

    Cases: a null or empty text has only its end id; null keys and repeated rows
    are packed as they come; an empty table gives an empty table; a text of any
    length is cut into full windows and a rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        packer = SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << 32

        def rows(done: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequence
            out: list[list] = [[] for _ in range(7)]
            for pieces in done:
                at = 0
                for k, start, ids, total in pieces:
                    for column, value in zip(out, (k, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, at), strict=True):
                        column.append(value)
                    at += len(ids)
                sequence += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for whole in batches:
            for batch in slices(whole, "text"):
                ids, bounds = with_end(*encode(batch.column("text")), end)
                done: list[list[Piece]] = []
                for k, a, b in zip(batch.column("key").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    cut = a + (b - a) // window * window
                    done += [[(k, i - a, ids[i : i + window], b - a)] for i in range(a, cut, window)]
                    if cut < b:
                        done += packer.place((k, cut - a, ids[cut:b], b - a))
                yield rows(done)
        yield rows(packer.finish())

    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    out = named.mapInArrow(run, "key long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("key", key)
