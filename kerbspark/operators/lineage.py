"""Cutting the lineage of iterative jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder.

    Where the session names none, a local one is set in local mode; on a
    cluster that is an error, as executors would not share it.
    """
    spark = df.sparkSession
    if spark._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)
