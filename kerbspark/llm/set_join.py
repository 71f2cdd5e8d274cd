"""Exact join of documents by the Jaccard similarity of their shingle sets: a size-aware heavy-light join.

All sets are put in one order, light shingles before heavy ones (those of more
than ``LIGHT`` documents), each kind by hash. Of n shingles a set may lack so
few that two linked sets share one of their first p, and two of their first
p + 1. So a small set posts every subset of two of its first p + 1 shingles,
which few unlinked sets share, and a large set, for which subsets are too many,
posts its first p alone, whose inverted lists are scanned. Where posting
subsets costs less than scanning is told by the mean length of the lists.

A posted list is not turned into pairs. All its documents are compared with one
of them, its hub; links so found make parts. Documents of one list that are
still apart are compared in blocks of bounded size by parity tables, which bound
from below how many shingles two sets differ in; what they allow is confirmed on
full sets, as all links are, in the same blocks, which give one link of those
that join the same parts. Two documents whose posted shingles are heavy
share none of their light ones unless a light list has both; so those with the
same heavy shingles, a frame and words of their own, are linked or not by their
sizes alone, and are never compared by pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_table, bits_for, cut, in_bit_table, mix64, shingle_sets, slices, without
from .graph import components
from .near_dedup import _linked, _sets_of

#: A shingle of more documents is heavy. The flag only orders shingles, so a wrong one costs time, not links.
LIGHT = 32
#: Sets that a set is compared with at once.
TRIED = 64
#: What a scanned candidate costs against a posting, as whole sets are moved to confirm it; and a bound on small sets.
SCAN, LARGEST_SMALL = 8, 250
#: Postings that a task gathers before it hands them on, and that a group of keys holds about.
FLUSH, GROUP = 1 << 20, 1 << 22
#: Shingles on either side of a block of comparisons, or those of one text if it has more.
BLOCK = 1 << 21


def boundary(mean_list: float, percent: int) -> int:
    """The largest set size at which subsets of two cost no more than single postings and the scans of their lists."""
    p = 1
    while (p + 1) / 2 <= 1 + SCAN * max(mean_list - 1, 0):
        p += 1
    # a set of n has a prefix of n - ceil(percent n / 100) + 1
    return min(LARGEST_SMALL, (p - 1) * 100 // max(100 - percent, 1))


def prefix_length(n: int, percent: int) -> int:
    return n + (-n * percent) // 100 + 1


def _digest(s: np.ndarray) -> bytes:
    return hashlib.sha256(s.tobytes()).digest()[:16]


def parity(s: np.ndarray) -> bytes:
    """A bit for each slot of a table: whether an odd number of the set's shingles fall into it.

    Two tables differ in no more bits than the sets differ in shingles. A table
    has some two bits for each shingle, and folds into a narrower one.
    """
    width = 1 << min(max(8, int(2 * len(s) - 1).bit_length()), 16)
    slot = (mix64(s) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(tables: np.ndarray, width: int) -> np.ndarray:
    """Packed parity tables, one a row, as tables of ``width`` bytes."""
    return np.bitwise_xor.reduce(tables.reshape(len(tables), -1, width), axis=1)


def may_link(one: np.ndarray, n: int, tables: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets with these parity tables, all of one width, may be linked with one of ``n`` shingles; those that are always may."""
    width = min(len(one), tables.shape[1])
    apart = np.bitwise_count(folded(tables, width) ^ folded(one[None, :], width)).sum(axis=1, dtype=np.int64)
    alike = 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)
    return alike & (apart * (100 + percent) <= (sizes + n) * (100 - percent))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets, offsets = shingle_sets(batch.column("text"))
            each = [sets[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(np.diff(offsets), pa.int64()), pa.array([_digest(s) for s in each], pa.binary()), pa.array([parity(s) for s in each], pa.binary())], ["doc", "n", "digest", "parity"])


def _groups_of(total: int) -> int:
    """Bits of a key that name its group."""
    return min(max(6, (total // GROUP).bit_length()), 24)


def _grouped(keys: np.ndarray, bits: int, columns: list[np.ndarray]) -> tuple[list[int], list[list[bytes]]]:
    """The groups of sorted ``keys`` by their first ``bits``, and for each the bytes of each of ``columns``."""
    group = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(starts[1:], len(group))
    return group[starts].tolist(), [[c[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] for c in columns]


def heavy_shingles(texts: DataFrame, total: int) -> tuple[DataFrame, float]:
    """(h, the heavy shingles as longs; the mean length of the list that a light shingle of a document is in)."""
    bits = _groups_of(total)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(parts: list[np.ndarray]) -> pa.RecordBatch:
            keys = np.sort(np.concatenate(parts))
            group, (rest,) = _grouped(keys, bits, [(keys >> np.uint64(32 - bits)).astype(np.uint32)])
            return pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(rest, pa.binary())], ["g", "rest"])

        parts, size = [], 0
        for whole in batches:
            for batch in slices(whole, "text"):
                parts.append(shingle_sets(batch.column("text"))[0])
                size += len(parts[-1])
                if size >= FLUSH:
                    yield handed(parts)
                    parts, size = [], 0
        if size:
            yield handed(parts)

    def count(group: pa.Table) -> pa.Table:
        rest = np.sort(np.frombuffer(b"".join(group.column("rest").to_pylist()), np.uint32))
        start = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        times = np.diff(np.append(start, len(rest)))
        heavy = rest[start[times > LIGHT]].astype(np.uint64)
        first = np.uint64(group.column("g")[0].as_py()) << np.uint64(64 - bits)
        light = times[times <= LIGHT]
        h = (first | (heavy << np.uint64(32 - bits))).view(np.int64)
        none = [None] * len(h)
        return pa.table({"h": pa.array([*h.tolist(), None], pa.int64()), "met": pa.array([*none, int((light.astype(np.int64) ** 2).sum())], pa.int64()), "posted": pa.array([*none, int(light.sum())], pa.int64())})

    counted = cut(texts.select("text").mapInArrow(tokens, "g int, rest binary").groupBy("g").applyInArrow(count, "h long, met long, posted long"))
    met, posted = counted.agg(F.sum("met"), F.sum("posted")).first()
    return counted.where(F.col("h").isNotNull()).select("h"), (met or 0) / max(posted or 0, 1)


def _ordered(s: np.ndarray, table: bytes, bits: int) -> tuple[np.ndarray, int]:
    """A set's shingles in the join's order, and how many are light."""
    heavy = in_bit_table(table, bits, s)
    return np.concatenate([s[~heavy], s[heavy]]), int(len(s) - heavy.sum())


def keys_of(s: np.ndarray, n_light: int, small: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that an ordered set posts, and which of them are light: subsets of two if it is small, single shingles if it may meet a large set, or a set with which it has to share one only."""
    n = len(s)
    p = prefix_length(n, percent)
    keys, light = [], []
    if n <= small and n > 1:
        q = min(p + 1, n)
        i, j = np.triu_indices(q, 1)
        keys.append(mix64(mix64(s[i]) + s[j] * np.uint64(0x9E3779B97F4A7C15)))
        light.append(i < n_light)  # light shingles come first
    if 100 * n > percent * small or percent * n <= 100:
        keys.append(mix64(s[:p] + np.uint64(1)))
        light.append(np.arange(min(p, n)) < n_light)
    return (np.concatenate(keys), np.concatenate(light)) if keys else (np.zeros(0, np.uint64), np.zeros(0, bool))


def _hubs(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (hub, doc) of all lists of two or more documents; a hub is drawn by a hash of its number."""
    order = np.lexsort((mix64(docs.view(np.uint64)), keys))
    keys, docs = keys[order], docs[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    hub = np.repeat(docs[start], np.diff(np.append(start, len(docs))))
    on = hub != docs
    pairs = np.unique(np.stack([hub[on], docs[on]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def balls(texts: DataFrame, table: bytes, bits: int, small: int, total: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(hub, doc) of all posted lists, and links (a, b) between documents with the same heavy shingles."""
    groups = _groups_of(total * max(100 - percent, 1) // 100)
    spread = texts.sparkSession.sparkContext.broadcast(table)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(keys: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
            k, d = np.concatenate(keys), np.concatenate(docs)
            order = np.argsort(k, kind="stable")
            group, (k2, d2) = _grouped(k[order], groups, [k[order], d[order]])
            return pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(k2, pa.binary()), pa.array(d2, pa.binary())], ["g", "keys", "docs"])

        keys, docs, size = [], [], 0
        for whole in batches:
            for batch in slices(whole, "text"):
                sets, offsets = shingle_sets(batch.column("text"))
                for doc, a, b in zip(batch.column("doc").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    k, on = keys_of(*_ordered(sets[a:b], spread.value, bits), small, percent)
                    keys.append(k[on])
                    docs.append(np.full(int(on.sum()), doc, np.int64))
                    size += len(keys[-1])
                if size >= FLUSH:
                    yield handed(keys, docs)
                    keys, docs, size = [], [], 0
        if size:
            yield handed(keys, docs)

    def lists(group: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), np.uint64)
        docs = np.frombuffer(b"".join(group.column("docs").to_pylist()), np.int64)
        hub, doc = _hubs(keys, docs)
        return pa.table({"hub": pa.array(hub), "doc": pa.array(doc)})

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a set whose posted shingles reach the heavy ones: its heavy keys, and what its heavy shingles are."""
        for whole in batches:
            for batch in slices(whole, "text"):
                sets, offsets = shingle_sets(batch.column("text"))
                found = []
                for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    s, n_light = _ordered(sets[a:b], spread.value, bits)
                    k, on = keys_of(s, n_light, small, percent)
                    if not on.all():
                        found.append((row, k[~on], _digest(s[n_light:]), len(s) - n_light, len(s)))
                if found:
                    times = [len(f[1]) for f in found]
                    of = pa.array(np.repeat(np.arange(len(found)), times))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([f[1] for f in found]).view(np.int64)),
                            batch.column("doc").take(pa.array(np.repeat([f[0] for f in found], times))),
                            pa.array([f[2] for f in found], pa.binary()).take(of),
                            pa.array([f[3] for f in found], pa.int64()).take(of),
                            pa.array([f[4] for f in found], pa.int64()).take(of),
                        ],
                        ["key", "doc", "core", "n_core", "n"],
                    )

    light_balls = texts.mapInArrow(light, "g int, keys binary, docs binary").groupBy("g").applyInArrow(lists, "hub long, doc long")
    posted = cut(texts.mapInArrow(heavy, "key long, doc long, core binary, n_core long, n long"))
    # of the documents of one core the smallest is linked with all that the core alone is large enough for
    held = posted.select("doc", "core", "n_core", "n").distinct()
    least = held.groupBy("core").agg(F.min(F.struct("n", "doc")).alias("least"))
    framed = held.join(least, "core").where((F.col("doc") != F.col("least.doc")) & (100 * F.col("n_core") >= percent * (F.col("n") + F.col("least.n") - F.col("n_core"))))
    links = framed.select(F.col("least.doc").alias("a"), F.col("doc").alias("b"))
    hubs = posted.groupBy("key").agg(F.min_by("doc", F.xxhash64("doc")).alias("hub"), F.min("core").alias("lo"), F.max("core").alias("hi")).where("lo != hi").select("key", "hub")
    heavy_balls = posted.select("key", "doc").join(hubs, "key").where(F.col("doc") != F.col("hub")).select("hub", "doc")
    return cut(light_balls.unionByName(heavy_balls).distinct()), cut(links)


def _compared(block: pa.Table, percent: int) -> pa.Table:
    """Of one block the rows of documents that their parity tables allow to be linked with one on the other side and in another part."""
    n, part, left = (block.column(c).to_numpy() for c in ("n", "part", "left"))
    tables = [np.frombuffer(x.as_buffer(), np.uint8) for x in block.column("parity")]
    right = np.flatnonzero(~left)
    width = np.array([len(tables[i]) for i in right])
    kinds = [(right[width == w], np.stack([tables[i] for i in right[width == w]])) for w in np.unique(width)]
    met = np.zeros(len(n), bool)
    for i in np.flatnonzero(left):
        for rows, table in kinds:
            on = rows[may_link(tables[i], int(n[i]), table, n[rows], percent) & (part[rows] != part[i])]
            met[on] = True
            met[i] |= len(on) > 0
    return block.select(["region", "i", "j", "doc", "part", "left"]).filter(pa.array(met))


def _confirmed(block: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) of a left and a right row of one block, found on full sets; of those that join the same parts, one.

    So a block gives fewer links than it has rows, however alike they are.
    """
    doc, left = block.column("doc").to_numpy(), block.column("left").to_numpy()
    _, joined = np.unique(block.column("part").to_numpy(), return_inverse=True)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in block.column("set")]
    n, tables = np.array([len(s) for s in sets]), [np.frombuffer(parity(s), np.uint8) for s in sets]
    right = np.flatnonzero(~left)
    width = np.array([len(tables[i]) for i in right])
    kinds = [(right[width == w], np.stack([tables[i] for i in right[width == w]])) for w in np.unique(width)]
    found: list[tuple[int, int]] = []
    for i in np.flatnonzero(left):
        rest = np.concatenate([rows[(joined[rows] != joined[i]) & may_link(tables[i], int(n[i]), table, n[rows], percent)] for rows, table in kinds]) if kinds else right
        while len(rest := rest[joined[rest] != joined[i]]):
            # one of each part first
            first = np.unique(joined[rest], return_index=True)[1][:TRIED]
            tried, rest = rest[first], np.delete(rest, first)
            both = np.concatenate([sets[k] for k in tried])
            at = np.minimum(np.searchsorted(sets[i], both), len(sets[i]) - 1)
            inter = np.add.reduceat((sets[i][at] == both).astype(np.int64), np.append(0, np.cumsum(n[tried])[:-1]))
            for k in tried[100 * inter >= percent * (n[i] + n[tried] - inter)]:
                if joined[k] != joined[i]:
                    found.append((min(doc[i], doc[k]), max(doc[i], doc[k])))
                    joined[joined == joined[k]] = joined[i]
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def _apart(near: DataFrame, part: DataFrame, sets: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join documents of one list in different parts, but for those of a hub, which are known.

    A region is the part of a hub, with all documents of the lists of any hub
    in it. Those outside the part, the left side, are compared with the whole
    region; either side is dealt by hash into chunks of about BLOCK shingles.
    Rows carry parity tables, a thirtieth of their sets; only those that these
    allow to be linked get their sets, and meet again in their blocks.
    """
    of = lambda df, x, name: df.join(part.select(F.col("node").alias(x), F.col("component").alias("found")), x, "left").withColumn(name, F.coalesce("found", x)).drop("found")
    members = of(near, "hub", "region").select("region", "doc").unionByName(of(near.select("hub").distinct(), "hub", "region").select("region", F.col("hub").alias("doc"))).distinct()
    placed = cut(of(members, "doc", "part").join(sets.select("doc", "n"), "doc"))
    outside = F.col("part") != F.col("region")
    chunks = lambda n: F.ceil(F.sum(n) / F.lit(BLOCK)).cast("int")
    shape = placed.groupBy("region").agg(chunks(F.when(outside, F.col("n")).otherwise(0)).alias("lefts"), chunks(F.col("n")).alias("rights"), F.count_if(outside).alias("out"), F.count(F.lit(1)).alias("all"))
    # one document beside a hub alone has been compared with it
    apart = cut(shape.where("out > 0 AND all > 2").select("region", "lefts", "rights"))
    mixed = cut(placed.select("region", "doc", "part").distinct().join(apart, "region").withColumn("h", F.xxhash64("doc", "region")).join(sets.select("doc", "n", "parity"), "doc"))
    one = lambda n: F.pmod(F.col("h"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    right = mixed.select("region", "doc", "n", "parity", "part", F.lit(False).alias("left"), F.explode(every(F.col("lefts"))).alias("i"), one(F.col("rights")).alias("j"))
    left = mixed.where(outside).select("region", "doc", "n", "parity", "part", F.lit(True).alias("left"), one(F.col("lefts")).alias("i"), F.explode(every(F.col("rights"))).alias("j"))
    block = ["region", "i", "j"]
    met = cut(left.unionByName(right).groupBy(*block).applyInArrow(lambda b: _compared(b, percent), "region long, i int, j int, doc long, part long, left boolean").distinct())
    full = met.join(_sets_of(cut(met.select("doc").distinct()), texts).where(F.length("set") > 0), "doc")
    return cut(full.groupBy(*block).applyInArrow(lambda b: _confirmed(b, percent), "a long, b long").distinct())


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that sizes and parity tables allow to be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pa_, pb = (batch.column(c).to_pylist() for c in ("pa", "pb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            on = [bool(may_link(np.frombuffer(x, np.uint8), int(na[i]), np.frombuffer(y, np.uint8)[None, :], nb[i : i + 1], percent)[0]) for i, (x, y) in enumerate(zip(pa_, pb, strict=True))]
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    side = lambda x: sets.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return cut(both.where(fits).select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long").distinct())


def similar_sets(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One row for each row of ``docs``: key, ``n_shingles``, ``class_id`` and ``component_id``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets of five-word shingles. No link is lost: a component is what links
    reach, named by its smallest key. ``class_id`` is the smallest key with an
    equal set; equal sets are told by their size and 128 bits of a
    cryptographic digest of the sorted set.

    Cases: a null or empty text, or one without words, has no shingles and is
    linked with nothing; a text of fewer than five words has one shingle, its
    whole sequence; rows with one key are one document, linked by what any of
    its texts is linked by; a row with a null key is linked with nothing, and
    its class and component are null; other columns are ignored, whatever their
    names; an empty table gives an empty table. No list has a cap.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = cut(texts.mapInArrow(_described, "doc long, n long, digest binary, parity binary"))
    real = rows.select("doc", "n", "digest").where((F.col("n") > 0) & F.col("doc").isNotNull())
    # stored, so that the join below can split the rows of one text that has very many copies
    classes = cut(real.groupBy("n", "digest").agg(F.min("doc").alias("class_id")))
    first = cut(rows.where(F.col("n") > 0).join(classes.withColumnRenamed("class_id", "doc"), ["doc", "n", "digest"], "left_semi").dropDuplicates(["doc", "n", "digest"]).select("doc", "n", "parity"))
    copies = rows.select("doc").where(F.col("doc").isNotNull()).distinct().join(first.select("doc"), "doc", "left_anti")
    own = without(texts.where(F.col("doc").isNotNull()), copies, "doc").select("doc", "text")

    total = first.agg(F.sum("n")).first()[0] or 0
    heavy, mean_list = heavy_shingles(own, total)
    bits = bits_for(heavy.count())
    near, framed = balls(own, bit_table(heavy, "h", bits), bits, boundary(mean_list, percent), total, percent)
    stars = near.select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()
    links = _linked(_likely(stars, first, percent), own, percent).unionByName(framed)
    part = cut(components(links))
    more = _apart(near, part, first, own, percent)

    member = real.join(classes, ["n", "digest"]).select("doc", "n", "class_id").unionByName(rows.where((F.col("n") == 0) | F.col("doc").isNull()).select("doc", "n", F.col("doc").alias("class_id")))
    twice = member.where("n > 0").groupBy("doc").agg(F.min("class_id").alias("a"), F.max("class_id").alias("hi")).where("a != hi")
    shared_ids = member.where("n > 0").join(twice, "doc").select("a", F.col("class_id").alias("b"))
    edges = part.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more).unionByName(shared_ids)
    final = components(edges)
    out = member.join(final, member["class_id"] == final["node"], "left").withColumn("component_id", F.coalesce("component", "class_id"))
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "class_id", "component_id")
