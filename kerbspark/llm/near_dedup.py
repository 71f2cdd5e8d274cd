"""Near-duplicate documents by SetSketch registers.

A document's set of five-word shingles is summarised in registers: each
shingle drops points on the registers as a Poisson process, and a register
keeps the whole number below the base-``BASE`` logarithm of its earliest point.
Registers of a union are the maxima of its parts' registers, and two sets agree
in a register with about the probability of their Jaccard similarity.

Sets that are equal form a class, of which only the smallest id goes on. Bands
of registers put classes into buckets, and each class is compared to one class
of each of its buckets, drawn by a hash, which joins nearly all of a group of
copies by few pairs. What this leaves apart is compared in blocks of bounded
size, in which rows carry their full sets, so that no pair leaves its task
before it is confirmed. A likelihood estimate from all registers drops pairs
far below the threshold; the others are verified on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_table, bits_for, cut, in_bit_table, mix64, shingle_sets, slices
from .graph import components

BANDS, ROWS = 72, 6
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.1, 10.0, 255
#: Pairs estimated lower than the threshold by this are not verified: more than four standard errors of 432 registers.
SLACK = 0.09
#: A class is compared with about this many drawn classes of a large group.
LOTS = 6
#: Shingles on either side of a block of comparisons, or those of one text if it has more.
BLOCK = 1 << 17


def set_sketch(sets: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The registers, bytes of shape (sets, m), of sets of 64-bit numbers given end to end.

    Points come in order of time at rate RATE on each register. An element is
    done once its time is beyond the latest register of its set, as it can
    lower none any more. An empty set has zeros.
    """
    count = len(offsets) - 1
    first = np.full((count, m), np.inf)
    flat = first.reshape(-1)
    doc = np.repeat(np.arange(count), np.diff(offsets))
    element, time, step = sets, np.zeros(len(sets)), 0
    while len(element):
        width = max(1, min(256, 16384 // len(element)))
        steps = (np.arange(step + 1, step + width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
        z = mix64(element[:, None] + steps)
        u = ((z >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40
        times = time[:, None] + np.cumsum(-np.log(u), axis=1)
        register = (((z & np.uint64(0xFFFFFF)) * np.uint64(m)) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(flat, (doc[:, None] * m + register).reshape(-1), times.reshape(-1))
        step, time = step + width, times[:, -1]
        live = np.flatnonzero(np.bincount(doc, minlength=count))
        bound = np.zeros(count)
        bound[live] = first[live].max(axis=1)
        on = time < bound[doc]
        element, time, doc = element[on], time[on], doc[on]
    level = np.floor(1 - np.log(first / (m * RATE)) / np.log(BASE))
    return np.where(np.isinf(first), 0, np.clip(level, 0, TOP)).astype(np.uint8)


def estimate_jaccard(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity of each pair from its registers and set sizes.

    Registers of two sets compare greater, less or equal with probabilities that
    depend on the similarity and the sizes alone; the likelihood of the three
    counts is maximised over a grid, within what the sizes allow.
    """
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    grid = np.linspace(0, 1, 101)[None, :]
    j = grid * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    score = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
    return np.take_along_axis(np.broadcast_to(j, score.shape), score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets, offsets = shingle_sets(batch.column("text"))
            starts = np.minimum(offsets[:-1], max(len(sets) - 1, 0))
            n, some = np.diff(offsets), np.diff(offsets) > 0
            total, mixed = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(sets):
                total[some] = np.add.reduceat(sets, starts[some])
                mixed[some] = np.bitwise_xor.reduceat(mix64(sets), starts[some])
            registers = set_sketch(sets, offsets)
            binary = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.arange(len(n) + 1, dtype=np.int32) * REGISTERS), pa.py_buffer(registers)])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n, pa.int64()), pa.array(total.view(np.int64)), pa.array(mixed.view(np.int64)), binary], ["doc", "n", "s1", "s2", "registers"])


def _bytes_of(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            registers = _bytes_of(batch.column("registers"), REGISTERS).reshape(-1, BANDS, ROWS).astype(np.int64)
            keys = (registers << (np.arange(ROWS, dtype=np.int64) * 8)).sum(axis=2) + (np.arange(BANDS, dtype=np.int64) << 48)
            rows = np.repeat(np.arange(batch.num_rows), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), batch.column("doc").take(pa.array(rows))], ["bucket", "doc"])


def _likely(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the pairs that may be similar enough, by sizes, equal registers and then the estimate, and their estimates."""
    at = np.flatnonzero(100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
    at = at[(ra[at] == rb[at]).sum(axis=1) >= (percent / 100 - SLACK - 0.01) * REGISTERS]
    estimate = estimate_jaccard(ra[at], rb[at], na[at].astype(float), nb[at].astype(float))
    near = estimate >= percent / 100 - SLACK
    return at[near], estimate[near]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets, offsets = shingle_sets(batch.column("text"))
            binary = [sets[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(binary, pa.binary())], ["doc", "set"])


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sorted sets have in common."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small):
        return 0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int(np.count_nonzero(large[at] == small))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(batch.column("sa"), batch.column("sb"), strict=True)
        sets = ((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in both)
        found = [(len(x) + len(y), shared(x, y)) for x, y in sets]
        inter = [i for _, i in found]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()), pa.array([t - i for t, i in found], pa.int64())], ["a", "b", "inter", "both"])


def _joined(leader: dict[int, int], x: int) -> int:
    """The leader of ``x``'s group, with shorter ways on the way there."""
    while leader.setdefault(x, x) != x:
        leader[x] = leader[leader[x]]
        x = leader[x]
    return x


def _blocks(block: pa.Table, percent: int) -> pa.Table:
    """Links that join different parts, of a left row and a right row of one block, confirmed on full sets.

    Pairs of a left row are tried from the likeliest on; one whose parts are
    joined by then needs no trial. A pair of two left rows is tried once.
    """
    doc, n, part, left = (block.column(c).to_numpy() for c in ("doc", "n", "part", "left"))
    registers = _bytes_of(block.column("registers").combine_chunks(), REGISTERS)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in block.column("set")]
    both_sides = np.isin(doc, doc[left])
    right = np.flatnonzero(~left)
    leader: dict[int, int] = {}
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(left):
        other = right[(part[right] != part[i]) & (~both_sides[right] | (doc[right] > doc[i]))]
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            near, estimate = _likely(np.broadcast_to(registers[i], (len(some), REGISTERS)), registers[some], np.full(len(some), n[i]), n[some], percent)
            for o in some[near][np.argsort(-estimate, kind="stable")]:
                a, b = _joined(leader, int(part[i])), _joined(leader, int(part[o]))
                if a != b:
                    inter = shared(sets[i], sets[o])
                    if 100 * inter >= percent * (len(sets[i]) + len(sets[o]) - inter):
                        leader[a] = b
                        links.append((int(doc[i]), int(doc[o])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that may be similar enough."""
    side = lambda x: sketches.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                ra, rb = (_bytes_of(batch.column(c), REGISTERS) for c in ("ra", "rb"))
                near, _ = _likely(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
                yield batch.select(["a", "b"]).take(pa.array(near))

    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb")
    return cut(near.mapInArrow(run, "a long, b long"))


def _sets_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, set) of the texts that ``ids`` (doc) names; a bit table of bounded size keeps most others out of the shuffle."""
    bits = bits_for(ids.count())
    named = texts.sparkSession.sparkContext.broadcast(bit_table(ids.select(F.xxhash64("doc").alias("h")), "h", bits))

    def may_be_named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = in_bit_table(named.value, bits, batch.column("h").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(on)).select(["doc", "text"])

    few = texts.select("doc", "text", F.xxhash64("doc").alias("h")).mapInArrow(may_be_named, "doc long, text string")
    return few.join(ids, "doc", "left_semi").mapInArrow(_sets, "doc long, set binary")


def _linked(near: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``near`` (a, b) whose similarity is at least ``percent`` hundredths on their full sets."""
    ids = cut(near.select(F.col("a").alias("doc")).unionByName(near.select(F.col("b").alias("doc"))).distinct())
    sets = _sets_of(ids, texts)
    full = near.join(sets.select(F.col("doc").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("doc").alias("b"), F.col("set").alias("sb")), "b")
    checked = full.select("a", "b", "sa", "sb").mapInArrow(_verify, "a long, b long, inter long, both long")
    return cut(checked.where(100 * F.col("inter") >= percent * F.col("both")).select("a", "b").distinct())


def _rest(balls: DataFrame, part: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of classes that share a bucket, but not with the class drawn for it.

    ``balls`` has the distinct pairs (hub, doc) of a class drawn for a bucket
    and a class in the bucket. A region is the part of a hub, with all that
    share a bucket with any hub in it; so two classes of one bucket are in one
    region. Those outside the part, the left side, are compared with the whole
    region, the right side. Either is dealt by hash into chunks of about BLOCK
    shingles, and a block is a chunk of each.
    """
    of = lambda df, x, name: df.join(part.select(F.col("node").alias(x), F.col("component").alias("found")), x, "left").withColumn(name, F.coalesce("found", x)).drop("found")
    members = of(balls, "hub", "region").select("region", "doc").unionByName(of(balls.select("hub").distinct(), "hub", "region").select("region", F.col("hub").alias("doc"))).distinct()
    placed = of(members, "doc", "part").join(sketches.select("doc", "n"), "doc")
    outside = F.when(F.col("part") != F.col("region"), F.col("n")).otherwise(0)
    chunks = lambda n: F.ceil(F.sum(n) / F.lit(BLOCK)).cast("int")
    apart = cut(placed.groupBy("region").agg(chunks(outside).alias("lefts"), chunks(F.col("n")).alias("rights")).where("lefts > 0"))
    mixed = cut(placed.join(apart, "region").withColumn("h", F.xxhash64("doc", "region")))
    one = lambda n: F.pmod(F.col("h"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    right = mixed.select("region", "doc", "n", "part", F.lit(False).alias("left"), F.explode(every(F.col("lefts"))).alias("i"), one(F.col("rights")).alias("j"))
    left = mixed.where(F.col("part") != F.col("region")).select("region", "doc", "n", "part", F.lit(True).alias("left"), one(F.col("lefts")).alias("i"), F.explode(every(F.col("rights"))).alias("j"))
    sets = _sets_of(cut(mixed.select("doc").distinct()), texts).join(sketches.select("doc", "registers"), "doc")
    rows = left.unionByName(right).join(sets, "doc").select("region", "i", "j", "doc", "n", "part", "left", "registers", "set")
    return cut(rows.groupBy("region", "i", "j").applyInArrow(lambda block: _blocks(block, percent), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """One row for each row of ``docs``: key, ``n_shingles``, ``class_id``, ``component_id`` and ``kept``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    shingle sets; a component is what links reach, named by its smallest key,
    and that document is kept. ``class_id`` is the smallest key with an equal
    set; equal sets are told by their size and two 64-bit sums over their
    hashes. A pair at the threshold itself is missed by all 72 bands with a
    probability of 2e-7.

    Cases: a null or empty text, or one without words, has no shingles, is
    linked with nothing and kept; a text of fewer than five words has one
    shingle, its whole sequence; rows with one key are one document, linked by
    what any of its texts is linked by; a row with a null key is linked with
    nothing, its class and component are null, and it is kept; an empty table
    gives an empty table. No bucket has a cap.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    sketched = cut(texts.mapInArrow(_sketch, "doc long, n long, s1 long, s2 long, registers binary"))
    same = ["n", "s1", "s2"]
    rows = sketched.select("doc", *same)
    with_words = (F.col("n") > 0) & F.col("doc").isNotNull()
    real = rows.where(with_words)
    # stored, so that the join below can split the rows of one text that has very many copies
    classes = cut(real.groupBy(*same).agg(F.min("doc").alias("class_id")))
    first = sketched.join(classes.withColumnRenamed("class_id", "doc"), ["doc", *same], "left_semi")
    first = cut(first.dropDuplicates(["doc", *same]).select("doc", "n", "registers"))

    banded = first.mapInArrow(_bands, "bucket long, doc long")
    # bands share few drawing lots, so that the buckets of one group draw the same few classes
    drawn = F.xxhash64(F.shiftright("bucket", 48) % LOTS, "doc")
    buckets = banded.groupBy("bucket").agg(F.min_by("doc", drawn).alias("hub"), F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    balls = cut(banded.join(buckets, "bucket").where(F.col("doc") != F.col("hub")).select("hub", "doc").distinct())
    stars = balls.select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()
    links = _linked(_estimated(stars, first, percent), texts, percent)
    part = cut(components(links))
    more = _rest(balls, part, first, texts, percent)

    member = real.join(classes, same).select("doc", "n", "class_id").unionByName(rows.where(~with_words).select("doc", "n", F.col("doc").alias("class_id")))
    twice = member.where(F.col("n") > 0).groupBy("doc").agg(F.min("class_id").alias("a"), F.max("class_id").alias("hi")).where(F.col("a") != F.col("hi"))
    shared_ids = member.where(F.col("n") > 0).join(twice, "doc").select("a", F.col("class_id").alias("b"))
    edges = part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more).unionByName(shared_ids)
    final = components(edges)
    out = member.join(final, member["class_id"] == final["node"], "left").withColumn("component_id", F.coalesce("component", "class_id"))
    # a class without words may share its key with a document that has links
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "class_id", "component_id", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"))
