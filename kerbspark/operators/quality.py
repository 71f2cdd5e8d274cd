"""Data-quality metrics, snapshots and audits. Metrics are rows (section, metric, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metrics(df: DataFrame, section: str, values: Mapping[str, Column]) -> DataFrame:
    """Aggregates of ``df`` in one pass, a row for each."""
    one = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in values])
    return one.select(F.explode(pairs).alias("m")).select(F.lit(section).alias("section"), "m.metric", "m.value")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str, section: str, metric: str) -> DataFrame:
    """How many rows of ``child`` have no parent; a null key counts as one."""
    gone = child.select(F.col(key).alias("__k")).join(parent.select(F.col(parent_key).alias("__k")), "__k", "left_anti")
    return metrics(gone, section, {metric: F.count(F.lit(1))})


def duplicates(df: DataFrame, keys: Sequence[str], section: str, metric: str) -> DataFrame:
    """How many rows there are beyond one for each key."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return metrics(per, section, {metric: F.coalesce(F.sum(F.col("n") - 1), F.lit(0))})


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, most first; nulls are "(null)"."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(null)")).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def json_number_stats(df: DataFrame, column: str, path: str, section: str) -> DataFrame:
    """Count, least, largest and mean of a number in JSON text; values of other types, also text that reads as a number, do not count."""
    # a variant keeps the type that the JSON text has
    v = F.try_variant_get(F.try_parse_json(column), path, "variant")
    v = F.when(F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(F.try_parse_json(column), path, "double"))
    return metrics(df.select(v.alias("v")), section, {"numbers": F.count("v"), "min": F.min("v"), "max": F.max("v"), "mean": F.round(F.avg("v"), 6)})


def array_stats(df: DataFrame, column: str, section: str) -> DataFrame:
    """Arrays in JSON text: how many, empty ones, values of other types, and lengths."""
    n = F.json_array_length(F.col(column))
    return metrics(df.select(F.col(column).alias("c"), n.alias("n")), section, {"arrays": F.count("n"), "empty": F.count_if(F.col("n") == 0), "not_arrays": F.count_if(F.col("n").isNull() & F.col("c").isNotNull()), "max_length": F.max("n"), "mean_length": F.round(F.avg("n"), 6)})


def activity_counts(df: DataFrame, policy: str) -> DataFrame:
    """Rules by activity over policies in JSON text."""
    rules = F.from_json(F.get_json_object(policy, "$.rules"), "array<struct<activity:string>>")
    return group_counts(df.select(F.explode(rules).alias("r")).select("r.activity"), "activity")


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(section, metric, old, new, delta) of metrics that appear, vanish or change."""
    a = old.select("section", "metric", F.col("value").alias("old"))
    b = new.select("section", "metric", F.col("value").alias("new"))
    both = a.join(b, ["section", "metric"], "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).withColumn("delta", F.col("new") - F.col("old"))


def warnings(snapshot: DataFrame, forbidden: Mapping[str, str], needed: Mapping[str, str]) -> DataFrame:
    """(warning, value): metrics that should be zero and are not, and metrics that should not be zero and are.

    Both map a metric's ``section.metric`` to what to say.
    """
    name = F.concat_ws(".", "section", "metric")
    rules = [(k, v, True) for k, v in forbidden.items()] + [(k, v, False) for k, v in needed.items()]
    table = snapshot.sparkSession.createDataFrame(rules, "name string, warning string, zero boolean")
    bad = F.when(F.col("zero"), F.col("value") > 0).otherwise(F.col("value") == 0)
    return snapshot.withColumn("name", name).join(table, "name").where(bad).select("warning", "value")


def sequence_faults(df: DataFrame, key: str, seq: str, first: int = 0) -> DataFrame:
    """(key, n, lo, hi, different) of groups whose numbers are not ``first``, ``first`` + 1, ... each once."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.count_distinct(seq).alias("different"))
    return g.where((F.col("lo") != first) | (F.col("hi") != F.col("n") - 1 + first) | (F.col("different") != F.col("n")))


def mixed_values(df: DataFrame, key: str, column: str) -> DataFrame:
    """Groups with more than one value of a column."""
    return df.groupBy(key).agg(F.count_distinct(column).alias("different")).where(F.col("different") > 1)


def cardinality(df: DataFrame, key: str) -> DataFrame:
    """(rows_per_key, keys): how many keys have one row, two, and so on."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_key")).groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("keys"))


def job_filter(df: DataFrame, key: str, job: str, job_id) -> DataFrame:
    """One row: keys with several rows over all jobs, and within one job, where there should be none."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col(job) == job_id).alias("one"))
    return per.agg(F.count_if(F.col("all") > 1).alias("repeated_over_jobs"), F.count_if(F.col("one") > 1).alias("repeated_in_job"), F.max("all").alias("most_rows"))


def moved_points(before: DataFrame, after: DataFrame, key: str, least: float = 1e-9) -> DataFrame:
    """Keys whose point lies elsewhere than before."""
    b = after.select(key, F.col("x").alias("bx"), F.col("y").alias("by"))
    return before.join(b, key).where((F.abs(F.col("x") - F.col("bx")) > least) | (F.abs(F.col("y") - F.col("by")) > least)).select(key)


def uncovered(blockfaces: DataFrame, segments: DataFrame, tiny_feet: float) -> DataFrame:
    """(blockface_id, explained): blockfaces without segments; those shorter than ``tiny_feet`` are explained."""
    bare = blockfaces.join(segments, "blockface_id", "left_anti")
    return bare.select("blockface_id", (F.col("length_ft") < tiny_feet).alias("explained"))


def run_audit(expected_ids: DataFrame, locations: DataFrame, before: DataFrame, signs: DataFrame, images: DataFrame, segments: DataFrame, blockfaces: DataFrame, readings: DataFrame, *, job_id: str, tiny_feet: float = 3.0) -> DataFrame:
    """(check, failures) of one run: ids, moved points, images, sequences, coverage, readings and lineage."""
    n = F.count(F.lit(1))
    found = locations.select("location_id")
    both = expected_ids.select("location_id").distinct().withColumn("a", F.lit(1)).join(found.distinct().withColumn("b", F.lit(1)), "location_id", "full_outer")
    checks = {
        "unmatched ids": both.where(F.col("a").isNull() | F.col("b").isNull()),
        "moved locations": moved_points(before, locations, "location_id"),
        "signs without image": signs.join(images, "sign_id", "left_anti"),
        "sequence errors": sequence_faults(segments, "blockface_id", "segment_seq"),
        "uncovered blockfaces": uncovered(blockfaces, segments, tiny_feet).where(~F.col("explained")),
        "signs without reading": signs.join(readings, "sign_id", "left_anti"),
        "rows of another job": readings.where(~F.col("job_id").eqNullSafe(F.lit(job_id))),
    }
    out = None
    for name, rows in checks.items():
        one = rows.agg(n.alias("failures")).select(F.lit(name).alias("check"), "failures")
        out = one if out is None else out.unionByName(one)
    return out


def same_content(a: DataFrame, b: DataFrame, keys: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between two tables, whatever the order within ``arrays``."""
    canon = lambda df: df.withColumns({c: F.array_sort(c) for c in arrays}).select(*keys, F.sha2(F.to_json(F.struct(*[c for c in sorted(df.columns)])), 256).alias("h"))
    x, y = canon(a), canon(b).withColumnRenamed("h", "h2")
    return x.join(y, list(keys), "full_outer").where(~F.col("h").eqNullSafe(F.col("h2"))).select(*keys)


def latest_runs(jobs: DataFrame, kind: str, created: str) -> DataFrame:
    """The newest job of each kind."""
    w = Window.partitionBy(kind).orderBy(F.desc(created), "job_id")
    return jobs.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")
