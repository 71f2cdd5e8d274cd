"""Intervals on a line of known length: buffers, clusters of overlap, boundaries, remainders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How far a bus stop's zone reaches, in feet, and in which direction by the stop's type.
BUS_STOP_FEET = 75.0
BUS_STOP_SIGNS = {"near_side": -1.0, "far_side": 1.0, "mid_block": -1.0}


def buffers(points: DataFrame, feet: float) -> DataFrame:
    """(start_fraction, end_fraction) of ``feet`` on both sides of each fraction, within the line."""
    share = F.lit(feet) / F.col("length_ft")
    return points.withColumns({"start_fraction": F.greatest(F.lit(0.0), F.col("fraction") - share), "end_fraction": F.least(F.lit(1.0), F.col("fraction") + share)})


def bus_stop_type(fraction: Column) -> Column:
    return F.when((fraction >= 0.7) & (fraction <= 1.0), "near_side").when((fraction >= 0.0) & (fraction <= 0.3), "far_side").when((fraction > 0.3) & (fraction < 0.7), "mid_block")


def bus_stop_buffers(stops: DataFrame, multipliers: Mapping[str, float] = BUS_STOP_SIGNS) -> DataFrame:
    """``stops`` with ``stop_type`` and its zone within the curb: BUS_STOP_FEET times the type's multiplier, before the stop if that is negative."""
    kind = bus_stop_type(F.col("fraction"))
    at = F.col("fraction") * F.col("length_ft")
    reach = F.lit(None).cast("double")
    for name, times in multipliers.items():
        reach = F.when(kind == name, BUS_STOP_FEET * times).otherwise(reach)
    other = F.least(F.greatest(F.lit(0.0), at + reach), F.col("length_ft"))
    return stops.withColumns({"stop_type": kind, "start_fraction": F.least(at, other) / F.col("length_ft"), "end_fraction": F.greatest(at, other) / F.col("length_ft")})


def overlap_clusters(intervals: DataFrame, key: str) -> DataFrame:
    """(key, start, end) of the stretches that two or more intervals cover; touching stretches are one.

    A sweep: edges in order, ends before starts at one place, and a running sum.
    """
    edges = intervals.select(key, F.col("start_fraction").alias("pos"), F.lit(1).alias("delta")).unionByName(intervals.select(key, F.col("end_fraction").alias("pos"), F.lit(-1).alias("delta")))
    w = Window.partitionBy(key).orderBy("pos", "delta")
    edges = edges.groupBy(key, "pos", "delta").agg(F.sum("delta").alias("by"))
    swept = edges.withColumn("cover", F.sum("by").over(w)).withColumn("next", F.lead("pos").over(w))
    deep = swept.where((F.col("cover") >= 2) & (F.col("next") > F.col("pos"))).select(key, F.col("pos").alias("start"), F.col("next").alias("end"))
    v = Window.partitionBy(key).orderBy("start")
    deep = deep.withColumn("new", (~(F.col("start") <= F.max("end").over(v.rowsBetween(Window.unboundedPreceding, -1)))).cast("int"))
    deep = deep.withColumn("no", F.sum(F.coalesce("new", F.lit(1))).over(v))
    return deep.groupBy(key, "no").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("no")


def envelopes(intervals: DataFrame, key: str) -> DataFrame:
    """(key, start, end, env_start, env_end): each cluster and the extent of the intervals that overlap it."""
    c = overlap_clusters(intervals, key)
    touching = (F.col("end_fraction") > F.col("start")) & (F.col("start_fraction") < F.col("end"))
    return c.join(intervals.select(key, "start_fraction", "end_fraction"), key).where(touching).groupBy(key, "start", "end").agg(F.min("start_fraction").alias("env_start"), F.max("end_fraction").alias("env_end"))


def boundaries(intervals: DataFrame, key: str) -> DataFrame:
    """(key, cuts): sorted fractions at which a line is cut, from 0 to 1.

    All edges of intervals, of which, envelope by envelope in order, those
    strictly inside give way to the envelope's own.
    """
    raw = intervals.groupBy(key).agg(F.array_union(F.array(F.lit(0.0), F.lit(1.0)), F.array_union(F.collect_set("start_fraction"), F.collect_set("end_fraction"))).alias("raw"))
    folds = envelopes(intervals, key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("env_start", "env_end"))).alias("envs"))
    both = raw.join(folds, key, "left")
    fold = F.aggregate(F.coalesce("envs", F.array().cast("array<struct<env_start:double,env_end:double>>")), F.col("raw"), lambda acc, e: F.array_union(F.filter(acc, lambda x: ~((x > e["env_start"]) & (x < e["env_end"]))), F.array(e["env_start"], e["env_end"])))
    return both.select(key, F.array_sort(fold).alias("cuts"))


def pieces(cuts: DataFrame, key: str) -> DataFrame:
    """(key, no, start_fraction, end_fraction): the pieces between neighbouring cuts."""
    pos = cuts.select(key, F.explode("cuts").alias("start_fraction"))
    w = Window.partitionBy(key).orderBy("start_fraction")
    out = pos.withColumn("end_fraction", F.lead("start_fraction").over(w)).where(F.col("end_fraction").isNotNull())
    return out.withColumn("no", F.row_number().over(w) - 1)


def split_at_points(points: DataFrame, key: str, point: str) -> DataFrame:
    """Pieces between points: (key, start_fraction, end_fraction, start_id, end_id); the first starts and the last ends without an id."""
    ends = points.select(key, "fraction", point).unionByName(points.select(key).distinct().select(key, F.lit(0.0).alias("fraction"), F.lit(None).cast(points.schema[point].dataType).alias(point)))
    w = Window.partitionBy(key).orderBy("fraction", F.col(point).asc_nulls_first())
    return ends.select(key, F.col("fraction").alias("start_fraction"), F.lead("fraction", 1, 1.0).over(w).alias("end_fraction"), F.col(point).alias("start_id"), F.lead(point).over(w).alias("end_id"))


def assign_points(points: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """Points on the segments of their line that hold their fraction, both ends included."""
    s = segments.withColumnRenamed(key, "__key")
    return points.join(s, (F.col(key) == F.col("__key")) & F.col("fraction").between(F.col("start_fraction"), F.col("end_fraction"))).drop("__key")


def remainder(lines: DataFrame, removed: DataFrame, key: str, *, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(key, lo, hi) of the parts of each line's [lo, hi] that no removed interval covers; of no length, none.

    Removed intervals are clipped and swept by a running maximum of their ends,
    so a gap lies between the furthest end so far and the next start.
    """
    r = removed.select(F.col(key).alias("__key"), F.col(lo).alias("rlo"), F.col(hi).alias("rhi"))
    base = lines.select(key, F.col(lo).alias("llo"), F.col(hi).alias("lhi"))
    clipped = base.join(r, (F.col(key) == F.col("__key")) & (F.col("rhi") > F.col("llo")) & (F.col("rlo") < F.col("lhi")))
    clipped = clipped.select(key, "llo", "lhi", F.greatest("rlo", "llo").alias("a"), F.least("rhi", "lhi").alias("b"))
    ends = clipped.unionByName(base.select(key, "llo", "lhi", F.col("lhi").alias("a"), F.col("lhi").alias("b")))
    w = Window.partitionBy(key, "llo", "lhi").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    gaps = ends.withColumn("from", F.coalesce(F.max("b").over(w), F.col("llo")))
    return gaps.where(F.col("a") > F.col("from")).select(key, F.col("from").alias(lo), F.col("a").alias(hi))
