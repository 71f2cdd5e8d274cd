"""Acceptance of a run: frozen selections, reconciled exports, expected published state, snapshots and final counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import policies as P
from . import quality, spatial, tables
from .layout import spread


def freeze_selection(points: DataFrame, polygons: DataFrame, box: tuple[float, float, float, float] | None, *, key: str = "point_id", fringe: float, cell: float) -> DataFrame:
    """``points`` with ``state``: ``selected`` inside a polygon or the box, ``nearby`` within ``fringe`` of either, else ``outside``.

    ``polygons`` is an edge table (polygon_id, x0, y0, x1, y1). A point on a
    polygon's edge or on the box counts as inside. Nearby points are for review
    and never selected. Points without a place are left out.
    """
    placed = points.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    inside = spatial.in_polygons(placed, polygons, key=key, cell=cell).select(key, F.lit(0.0).alias("distance"))
    edges = polygons.select(F.concat_ws("#", "polygon_id", F.xxhash64("x0", "y0", "x1", "y1")).alias("line_id"), F.lit(0).alias("edge_no"), "x0", "y0", "x1", "y1", F.lit(0.0).alias("cum"), F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("total"))
    close = spatial.snap(placed, edges, tolerance=fringe, key=key, cell=cell).select(key, "distance")
    near = inside.unionByName(close).groupBy(key).agg(F.min("distance").alias("distance"))
    out = placed.join(near, key, "left")
    if box:
        x0, y0, x1, y1 = box
        away = F.hypot(F.greatest(F.lit(x0) - F.col("x"), F.col("x") - F.lit(x1), F.lit(0.0)), F.greatest(F.lit(y0) - F.col("y"), F.col("y") - F.lit(y1), F.lit(0.0)))
        out = out.withColumn("distance", F.least("distance", F.when(away <= fringe, away)))
    state = F.when(F.col("distance") == 0, "selected").when(F.col("distance").isNotNull(), "nearby").otherwise("outside")
    return out.withColumn("state", state).drop("distance")


def reconcile_export(parents: DataFrame, children: DataFrame, live: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """(check, failures) of an export against what a load gives.

    ``parents``: id; ``children``: id, parent_id, kind, of which the
    ``excluded`` kinds (whatever their case) are not eligible; ``live``: id,
    kind, n_attachments.
    """
    n = F.count(F.lit(1))
    barred = F.lower(F.trim(F.coalesce("kind", F.lit("")))).isin([x.lower() for x in excluded])
    eligible = children.where(~barred)
    repeated = lambda df: df.groupBy("id").agg(n.alias("n")).where((F.col("n") > 1) | F.col("id").isNull())
    sides = tables.reconcile(eligible, live, "id")
    checks = {
        "repeated parents": repeated(parents),
        "repeated children": repeated(eligible),
        "children without parent": eligible.join(parents.select(F.col("id").alias("parent_id")), "parent_id", "left_anti"),
        "missing in the load": sides.where("side = 'missing'"),
        "unexpected in the load": sides.where("side = 'unexpected'"),
        "signs without exactly one attachment": live.where("n_attachments != 1"),
        "excluded kinds in the load": live.where(barred),
    }
    return count_all(checks)


def count_all(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check, failures): how many rows each check finds."""
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
        out = one if out is None else out.unionByName(one)
    return out


def expected_state(zones: DataFrame, links: DataFrame, policies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curb_zone_id, policy_ids), the sorted policies of every zone, none as an empty list; and (curb_policy_id, description)."""
    per = links.groupBy("curb_zone_id").agg(F.array_sort(F.collect_list(F.col("curb_policy_id").cast("string"))).alias("policy_ids"))
    found = zones.select("curb_zone_id").join(per, "curb_zone_id", "left")
    return found.select("curb_zone_id", F.coalesce("policy_ids", F.array().cast("array<string>")).alias("policy_ids")), policies.select("curb_policy_id", "description")


def description_backfill(zones: DataFrame, links: DataFrame, policies: DataFrame) -> DataFrame:
    """The policies that some active zone uses, with ``missing``, whether their description is."""
    active = zones.where("end_date IS NULL").select("curb_zone_id")
    used = links.join(active, "curb_zone_id", "left_semi").select("curb_policy_id").distinct()
    return policies.join(used, "curb_policy_id", "left_semi").withColumn("missing", P.is_missing_description(F.col("description")))


def new_rows_only(policy_tables: Mapping[str, DataFrame], reuse: DataFrame) -> dict[str, DataFrame]:
    """Each of the policy tables without the rows of policies that are published already; ``reuse`` as of :func:`publish.reuse_policies`."""
    known = reuse.where("NOT is_new").select("curb_policy_id")
    return {name: df.join(known, "curb_policy_id", "left_anti") for name, df in policy_tables.items()}


def collect_snapshot(parts: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """(section, metric, value) of several tables, each read once: by section a table and its aggregates."""
    out = None
    for section, (df, values) in parts.items():
        one = quality.metrics(df, section, values)
        out = one if out is None else out.unionByName(one)
    return out


def accept(signs: DataFrame, images: DataFrame, locations: DataFrame, policies: DataFrame, *, job_id: str) -> DataFrame:
    """(section, metric, value): the final counts of a run, from one join of signs, images and locations, and checks of keys, lineage and texts.

    ``signs``: sign_id, location_id; ``images``: image_id, sign_id;
    ``locations``: location_id; ``policies``: sign_id, policy_json, stored_json,
    job_id, where both texts must be one document.
    """
    joined = spread(spread(signs, "sign_id").join(images, "sign_id", "left"), "location_id").join(locations.withColumn("found", F.lit(1)), "location_id", "left")
    # each id of each kind once, with how many rows lack something; then only counts are left
    ids = {"signs": F.col("sign_id"), "images": F.col("image_id"), "locations": F.when(F.col("found") == 1, F.col("location_id"))}
    lacks = {"signs_without_image": F.col("image_id").isNull(), "signs_without_location": F.col("found").isNull()}
    each = [F.struct(F.lit(kind).alias("kind"), *[(v if k == kind else F.lit(None)).cast(joined.select(v).schema[0].dataType).alias(k) for k, v in ids.items()], *[(v if kind == "signs" else F.lit(False)).alias(k) for k, v in lacks.items()]) for kind in ids]
    rows = joined.select(F.explode(F.array(*each)).alias("r")).select("r.*").where("kind = 'signs' OR images IS NOT NULL OR locations IS NOT NULL")
    per = spread(rows, "kind", *ids).groupBy("kind", *ids).agg(*[F.count_if(F.col(k)).alias(k) for k in lacks])
    counts = {kind: F.count_if((F.col("kind") == kind) & F.col(kind).isNotNull()) for kind in ids} | {k: F.coalesce(F.sum(k), F.lit(0)) for k in lacks}
    same = P.canonical_json(F.col("policy_json")).eqNullSafe(P.canonical_json(F.col("stored_json")))
    checked = policies.select("sign_id", F.col("job_id").eqNullSafe(F.lit(job_id)).alias("job"), same.alias("same"))
    texts = {
        "rows": F.count(F.lit(1)),
        "repeated_signs": F.count(F.lit(1)) - F.count_distinct("sign_id"),
        "wrong_job": F.count_if(~F.col("job")),
        "other_text": F.count_if(~F.col("same")),
    }
    return collect_snapshot({"signs": (per, counts), "policies": (spread(checked, "sign_id"), texts)})


def seed_subset(blockfaces: DataFrame, points: Mapping[str, DataFrame], box: tuple[float, float, float, float], margin: float) -> DataFrame:
    """(source, id): what a subset for a box holds: the ``blockfaces`` (an edge table) that meet it, and of each kind the points inside."""
    out = spatial.lines_in_envelope(blockfaces, box, margin).select(F.lit("blockfaces").alias("source"), F.col("line_id").cast("string").alias("id"))
    for name, df in points.items():
        inside = spatial.in_envelope(df, box, margin).select(F.lit(name).alias("source"), F.col("point_id").cast("string").alias("id"))
        out = out.unionByName(inside)
    return out.distinct()
