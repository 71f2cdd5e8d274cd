"""Benchmark decontamination by size-partitioned MinHash containment search.

Whole-document signatures cannot find a short item inside a long document: its
similarity to the document is next to nothing. Containment MinHash compares
unlike sizes: the short item is sketched by its k smallest shingle hashes, and
each is looked up among all shingles of the document. Items are partitioned by
size, and a partition's k is its largest size u less the shingles that may be
missing at most: if a document holds t of an item's n shingles, any
n - ceil(t n) + 1 of them include one that it holds. So no contaminated
document escapes the search; exact containment over all shingles then decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_table, bits_for, cut, in_bit_table, rolled, shingle_sets, slices, without, word_hashes

#: Words of a shingle; an item of fewer words is one shingle of its own length.
WORDS = 5


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets, offsets = shingle_sets(batch.column("text"), WORDS)
            _, ends = word_hashes(batch.column("text"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            words = np.minimum(np.diff(ends), WORDS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(sets.view(np.int64)), pa.array(words[row])], ["id", "shingle", "words"])


def _runs(hashes: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Every run of ``k`` words within one text, as :func:`shingle_sets` hashes a text of ``k`` words, and its text."""
    if len(hashes) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    text_of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    inside = text_of[: len(hashes) - k + 1] == text_of[k - 1 :]
    return rolled(hashes, k)[inside], text_of[k - 1 :][inside]


def item_sketches(items: DataFrame, *, key: str = "item_id", text: str = "text", percent: int = 75) -> DataFrame:
    """(item_id, shingle, words, n, size_class, in_sketch) for every shingle of every item; ``words`` is the shingle's number of words.

    ``size_class`` c holds items of 2^(c-1) + 1 to 2^c shingles. ``in_sketch``
    marks the k smallest hashes, k as the largest size of the class needs it.
    Rows with one id are one item with the shingles of all of them.
    """
    named = items.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    one = named.mapInArrow(_shingles, "id long, shingle long, words int").distinct()
    size = one.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    one = one.join(size, "id").withColumn("size_class", F.ceil(F.log2("n")).cast("int"))
    largest = F.pow(F.lit(2), F.col("size_class")).cast("long")
    k = largest - F.ceil(largest * percent / F.lit(100)) + 1
    rank = F.row_number().over(Window.partitionBy("id").orderBy("shingle"))
    return one.select(F.col("id").alias("item_id"), "shingle", "words", "n", "size_class", (rank <= k).alias("in_sketch"))


def candidates(hits: DataFrame, sketches: DataFrame) -> DataFrame:
    """(id, item_id, sketch_hits) of the pairs that share a sketched shingle; ``hits`` has distinct (id, shingle, looked_up)."""
    searched = sketches.where("in_sketch").select("item_id", "shingle")
    return hits.where("looked_up").join(searched, "shingle").groupBy("id", "item_id").agg(F.count(F.lit(1)).alias("sketch_hits"))


def contaminated(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", percent: int = 75) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, sketch_hits, containment) of every document that holds ``percent`` of an item's shingles.

    Documents are read once; a shingle leaves its task only if the membership
    table of all items knows it, two bytes for each item shingle and 128 MB at
    most, so what is stored follows the leaks. Those that the table of sketches knows are looked up in the sketches;
    shared shingles are counted for the pairs so found alone. Items are never
    broadcast as a list.

    Cases: null texts are empty; items or documents without words match
    nothing; an item of fewer than five words has its whole sequence as its one
    shingle, and is found wherever a document has these words one after the
    other; rows with one id are one document with the shingles of all; null
    ids match nothing; empty tables give an empty table.
    """
    sketches = cut(item_sketches(items, key=item_key, percent=percent))
    bits = bits_for(sketches.count())
    tables = [bit_table(s, "shingle", bits) for s in (sketches, sketches.where("in_sketch"))]
    short = [r["words"] for r in sketches.where(F.col("words") < WORDS).select("words").distinct().collect()]
    spread = docs.sparkSession.sparkContext.broadcast(tables)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, sketched = spread.value
        for whole in batches:
            for batch in slices(whole, "text"):
                sets, offsets = shingle_sets(batch.column("text"), WORDS)
                on = np.flatnonzero(in_bit_table(every, bits, sets))
                found = [(sets[on], np.searchsorted(offsets, on, side="right") - 1)]
                if short:
                    hashes, ends = word_hashes(batch.column("text"))
                    for k in short:
                        runs, text_of = _runs(hashes, ends, k)
                        on = in_bit_table(every, bits, runs)
                        found.append((runs[on], text_of[on]))
                for some, row in found:
                    looked_up = in_bit_table(sketched, bits, some)
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(some.view(np.int64)), pa.array(looked_up)], ["id", "shingle", "looked_up"])

    named = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    # the same shingle may come from several rows of one document
    hits = cut(named.mapInArrow(known, "id long, shingle long, looked_up boolean").distinct())
    asked = candidates(hits, sketches).join(sketches.select("item_id", "shingle", "n"), "item_id")
    per = asked.join(hits.select("id", "shingle"), ["id", "shingle"]).groupBy("id", "item_id", "n", "sketch_hits").agg(F.count(F.lit(1)).alias("n_shared"))
    leaks = per.where(100 * F.col("n_shared") >= percent * F.col("n"))
    return leaks.select(F.col("id").alias(key), "item_id", F.col("n").alias("n_item"), "n_shared", "sketch_hits", (F.col("n_shared") / F.col("n")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that :func:`contaminated` finds; rows with a null id stay."""
    return without(docs, contaminated(docs, items, key=key, text=text).select(key), key)
