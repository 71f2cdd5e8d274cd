"""How rows are dealt to tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as the session has shuffle partitions, also where these are small.

    Adaptive execution merges shuffle partitions up to a size in compressed
    bytes. Rows of a few keys compress so well that one task then sorts and
    groups many millions of them, and the more, the larger the input.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
