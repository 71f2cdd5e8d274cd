"""Applying a publication: new segments against the published tables, as one consistent state.

A published state is a dict of the tables of :mod:`publish`: ``curb_zones``,
``curb_zone_policies``, ``curb_policies`` and its child tables
``curb_policy_rules``, ``curb_policy_time_spans`` and ``curb_policy_rates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import publish, spatial
from .lineage import cut

CHILDREN = ("curb_policy_rules", "curb_policy_time_spans", "curb_policy_rates")
KEYS = {
    "curb_zones": ["curb_zone_id"],
    "curb_zone_policies": ["curb_zone_id", "curb_policy_id"],
    "curb_policies": ["curb_policy_id"],
    "curb_policy_rules": ["rule_id"],
    "curb_policy_time_spans": ["time_span_id"],
    "curb_policy_rates": ["rate_id"],
}


def metric(zones: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``line`` in metres of the UTM zone in which the middle of their first points lies."""
    lon = F.element_at("line", 1)["x"]
    middle = zones.select(lon.alias("lon")).unionByName(others.select(lon.alias("lon"))).agg(F.avg("lon")).first()[0]
    zone = int((middle if middle is not None else 0.0) // 6) + 31
    return tuple(df.withColumn("line", G.map_points(F.col("line"), lambda x, y: G.to_utm(x, y, zone))) for df in (zones, others))


def zone_overlaps(old: DataFrame, new: DataFrame, *, tolerance: float = 0.001) -> DataFrame:
    """(old_id, new_id, equivalent) of zones (curb_zone_id, line in metres) that share more than ten times ``tolerance`` of curb."""
    edges = lambda df: spatial.edge_table(df, "curb_zone_id", "line")
    both = spatial.linear_overlap(edges(new), edges(old), tolerance=tolerance, least=10 * tolerance)
    side = lambda df, name: df.select(F.col("curb_zone_id").alias(f"{name}_id"), F.col("line").alias(f"{name}_line"))
    pairs = both.select(F.col("a_id").alias("new_id"), F.col("b_id").alias("old_id")).join(side(old, "old"), "old_id").join(side(new, "new"), "new_id")
    same = publish.equivalent(F.col("old_line"), F.col("new_line"), spatial.hausdorff(F.col("old_line"), F.col("new_line")), tolerance)
    return pairs.select("old_id", "new_id", same.alias("equivalent"))


def merge_zones(new: DataFrame, old: DataFrame, overlaps: DataFrame, new_links: DataFrame, old_links: DataFrame, now: Column) -> dict[str, DataFrame]:
    """The state of zones and links after new zones meet the published ones.

    ``new``: curb_zone_id and the other columns of ``old`` but its dates;
    ``old``: with published_date, last_updated_date, start_date and end_date;
    ``overlaps``: old_id, new_id, equivalent, of active old zones;
    ``new_links`` and ``old_links``: curb_zone_id, curb_policy_id.

    A new zone with equivalent old ones is dropped, and each of these takes its
    policies: with the policies it has it is touched (last_updated_date), with
    others its links are replaced. An active old zone that overlaps new ones,
    but is equivalent to none, ends; every other old zone stays as it is, and
    other new zones start now. Applied again to its own result it changes
    nothing but the date of touched zones.

    Returns ``curb_zones`` and ``curb_zone_policies``, the state afterwards;
    ``links_to_delete``, the published links of ended zones, of zones whose
    links are replaced, and of zones that were not active before; and
    ``links_to_add``, to be written after that deletion; and ``changes``
    (curb_zone_id, change).
    """
    link_keys = ["curb_zone_id", "curb_policy_id"]
    old_links, new_links = (df.select(*link_keys).distinct() for df in (old_links, new_links))
    same = cut(overlaps.where("equivalent").select("old_id", "new_id").distinct())
    # the links that an old zone takes over from its equivalents
    taken = cut(same.join(new_links, F.col("new_id") == F.col("curb_zone_id")).select(F.col("old_id").alias("curb_zone_id"), "curb_policy_id").distinct())
    kept_as_is = same.select(F.col("old_id").alias("curb_zone_id")).distinct()
    # links on one side only; an equivalent zone with none of them is touched
    both = taken.withColumn("side", F.lit(1)).unionByName(old_links.join(kept_as_is, "curb_zone_id", "left_semi").withColumn("side", F.lit(2)))
    unlike = both.groupBy(*link_keys).agg(F.sum("side").alias("sides")).where("sides < 3").select("curb_zone_id").distinct().withColumn("unlike", F.lit(True))
    hit = overlaps.where(~F.col("equivalent")).select(F.col("old_id").alias("curb_zone_id")).distinct().withColumn("hit", F.lit(True))
    told = old.join(kept_as_is.withColumn("same", F.lit(True)), "curb_zone_id", "left").join(unlike, "curb_zone_id", "left").join(hit, "curb_zone_id", "left")
    active = F.col("end_date").isNull()
    change = F.when(~active, "ended").when(F.col("same") & F.col("unlike"), "relink").when(F.col("same"), "touch").when(F.col("hit"), "retire").otherwise("keep")
    told = cut(told.withColumn("change", change).drop("same", "unlike", "hit"))

    moved = told.withColumns({
        "last_updated_date": F.when(F.col("change").isin("relink", "touch", "retire"), now).otherwise(F.col("last_updated_date")),
        "end_date": F.when(F.col("change") == "retire", now).otherwise(F.col("end_date")),
    })
    # an ended zone may come back on the same curb; it is a zone of its own
    fresh = new.join(same.select(F.col("new_id").alias("curb_zone_id")).distinct(), "curb_zone_id", "left_anti")
    fresh = fresh.join(old.select("curb_zone_id", F.lit(True).alias("known")), "curb_zone_id", "left")
    fresh = cut(fresh.withColumn("old_name", F.col("curb_zone_id")).withColumn("curb_zone_id", F.when(F.col("known"), F.sha2(F.concat_ws("|", "curb_zone_id", now.cast("string")), 256)).otherwise(F.col("curb_zone_id"))).drop("known"))
    dates = {c: now for c in ("published_date", "last_updated_date", "start_date")}
    started = fresh.drop("old_name").withColumns(dates | {"end_date": F.lit(None).cast("timestamp")})
    zones = moved.drop("change").unionByName(started)

    labels = told.select("curb_zone_id", "change")
    to_delete = cut(old_links.join(labels.where(F.col("change").isin("touch", "keep")), "curb_zone_id", "left_anti"))
    relinked = taken.join(labels.where("change = 'relink'"), "curb_zone_id", "left_semi")
    first = new_links.join(fresh.select(F.col("old_name").alias("curb_zone_id"), F.col("curb_zone_id").alias("id")), "curb_zone_id").select(F.col("id").alias("curb_zone_id"), "curb_policy_id")
    to_add = cut(relinked.unionByName(first))
    return {
        "curb_zones": zones,
        "curb_zone_policies": old_links.join(to_delete, link_keys, "left_anti").unionByName(to_add),
        "links_to_delete": to_delete,
        "links_to_add": to_add,
        "changes": labels.unionByName(fresh.select("curb_zone_id", F.lit("insert").alias("change"))),
    }


def apply_publication(segments: DataFrame, published: dict[str, DataFrame] | None, now: Column, describe, *, tolerance: float = 0.001) -> dict[str, DataFrame]:
    """The published tables after ``segments`` (blockface_id, segment_seq, policy_list, line in degrees) are applied to them.

    Segments become zones and policies; a policy whose signature is published
    keeps the published id. Zones are compared with the active published ones
    and merged by :func:`merge_zones`; policies, and rows of their child tables,
    that no link of the new state uses go; missing descriptions are filled by
    ``describe`` and no other. Returns the tables of a published state, with
    ``links_to_delete``, ``links_to_add`` and ``changes``. ``published`` may be
    None or hold empty tables.
    """
    zones = cut(publish.zones_from_segments(segments))
    texts, links = publish.unique_policies(zones)
    made = publish.policy_tables(texts)
    made["curb_policies"] = made["curb_policies"].join(texts, "curb_policy_id")
    table = publish.zone_tables(zones, links, now)[0]
    if published is None:
        empty = lambda df: df.where(F.lit(False))
        published = {"curb_zones": empty(table), "curb_zone_policies": empty(links)} | {k: empty(v) for k, v in made.items()}
    reused = cut(publish.reuse_policies(made["curb_policies"], published["curb_policies"]))
    links = links.join(reused, "curb_policy_id").select("curb_zone_id", F.col("use_id").alias("curb_policy_id")).distinct()

    active = published["curb_zones"].where(F.col("end_date").isNull())
    lines = active.select("curb_zone_id", F.element_at(G.from_wkt(F.col("geometry")), 1).alias("line"))
    new_m, old_m = metric(zones.select("curb_zone_id", "line"), lines)
    overlaps = cut(zone_overlaps(cut(old_m), cut(new_m), tolerance=tolerance))
    plain = table.drop("published_date", "last_updated_date", "start_date", "end_date")
    state = merge_zones(plain, published["curb_zones"], overlaps, links, published["curb_zone_policies"], now)

    used = cut(state["curb_zone_policies"].select("curb_policy_id").distinct())
    fresh = reused.where("is_new").select("curb_policy_id")
    out = dict(state)
    for name in ("curb_policies", *CHILDREN):
        old = published[name]
        new = made[name].join(fresh, "curb_policy_id", "left_semi")
        out[name] = publish.without_orphans(old.unionByName(new, allowMissingColumns=True), used)
    out["curb_policies"] = publish.fill_descriptions(out["curb_policies"], describe)
    return out
