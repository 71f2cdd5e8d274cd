"""Stages that turn ``documents`` into packed training sequences; each takes and returns a DataFrame.

Cases, for every stage: a null text counts as an empty one; texts may be of any
length; rows with a null id, or with one id and other texts, are rows of their
own; columns beside those of ``documents`` are dropped, whatever their names;
an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, near_dedup, packing, quality_rules
from .common import cut, table, without

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no base rule and no fitted rule rejects.

    Null and empty texts have too few words and go; repeated rows stay or go together.
    """
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"), keep_text=True)
    return quality_rules.keep(judged).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, a 64-bit hash of id and text: the same whenever a row is read, and one for rows equal in both."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("__row", F.xxhash64(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col("text").isNull(), text))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest id, a null one last.

    Rows are linked by their texts alone: those that share an id stay apart
    unless their texts are linked, and those with a null id are linked as the
    others are. Of rows equal in id and text, one stays. Texts without words
    are linked with nothing.
    """
    rows = _keyed(docs)
    found = near_dedup.near_duplicates(rows, key="__row").select("__row", "component_id").distinct()
    ids = rows.groupBy("__row").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    found = cut(found.join(ids, "__row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    best = cut(found.groupBy("component_id").agg(first.alias("b")).select("component_id", F.col("b.__row").alias("best")))
    gone = found.join(best, "component_id").where(F.col("__row") != F.col("best")).select("__row")
    left = without(rows, gone, "__row")
    # rows equal in id and text are few, so only they are made one
    twice = cut(found.where("n > 1").select("__row"))
    again = left.join(twice, "__row", "left_semi").dropDuplicates(["__row"])
    return without(left, twice, "__row").unionByName(again).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged alone, also one with a null id. Repeated rows stay or go together."""
    return decontaminate.drop_contaminated(_keyed(docs), table(spark, sf_dir, "benchmark"), key="__row").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 4096; a text without ids has its end id, and repeated rows are packed each."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
