"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kerbspark.llm import pipeline
from kerbspark.llm.common import shared_dir

STAGES = [
    ("quality", pipeline.quality),
    ("near_dedup", pipeline.near_dedup_stage),
    ("decontamination", pipeline.decontamination),
    ("packing", pipeline.packed),
]

#: Near-duplicate components, fitted cutoffs and tokenizers are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written as Parquet and read by the next."""
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}_{name}")
        docs = spark.read.parquet(f"{base}/{number}_{name}")
    return docs
