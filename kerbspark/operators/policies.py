"""Policies along the curb: events in curb order, propagation both ways, one list for each segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.policies import BUS_STOP, FIRE_HYDRANT, PARKING_ANYTIME, canonical_json
from .lineage import cut

AWAY, TOWARD = "AWAY", "TOWARD"


def location_policies(locations: DataFrame, signs: DataFrame, sign_policies: DataFrame, meters: DataFrame) -> DataFrame:
    """(location_id, policy_json, arrow): policies of active signs, and of meters, which begin at one location and end at another."""
    places = locations.select("asset_location_id")
    posted = places.join(signs, F.col("asset_location_id") == F.col("sign_location_id")).join(sign_policies, "sign_id", "left")
    posted = posted.select(F.col("asset_location_id").alias("location_id"), "policy_json", F.col("policy_arrow").alias("arrow"))
    ends = [("start_asset_location_id", AWAY), ("end_asset_location_id", TOWARD)]
    for column, arrow in ends:
        metered = places.join(meters, F.col("asset_location_id") == F.col(column))
        posted = posted.unionByName(metered.select(F.col("asset_location_id").alias("location_id"), "policy_json", F.lit(arrow).alias("arrow")))
    return posted.where(F.col("policy_json").isNotNull())


def blockface_faults(segments: DataFrame) -> DataFrame:
    """(blockface_id, fault) of blockfaces whose sequence has gaps or repeats, or whose one-way flag is mixed."""
    n = F.count(F.lit(1))
    bad_order = (F.min("segment_seq") != 0) | (F.max("segment_seq") != n - 1) | (F.count_distinct("segment_seq") != n)
    mixed = F.count_distinct(F.coalesce("is_left_side_oneway", F.lit(False))) > 1
    per = segments.groupBy("blockface_id").agg(bad_order.alias("bad"), mixed.alias("mixed"))
    per = per.select("blockface_id", F.explode(F.array_compact(F.array(F.when(F.col("bad"), F.lit("sequence")), F.when(F.col("mixed"), F.lit("one-way flag"))))).alias("fault"))
    return per


#: The arrows that a sign may have, besides none, and those that a meter's ends have.
ARROWS = ("both", "left", "right", AWAY, TOWARD)


def location_faults(policies: DataFrame) -> DataFrame:
    """(location_id, reason) of posted policies that no curb can be walked with: an unknown arrow, or text that is not JSON."""
    arrow = F.when(~F.col("arrow").isin(*ARROWS), F.concat(F.lit("unknown arrow: "), F.col("arrow")))
    text = F.when(F.try_parse_json(F.col("policy_json")).isNull(), F.lit("policy is not JSON"))
    return policies.select("location_id", F.explode(F.array_compact(F.array(arrow, text))).alias("reason")).distinct()


def blockface_errors(segments: DataFrame, policies: DataFrame) -> DataFrame:
    """(blockface_id, stage, reason): everything that keeps a blockface from getting its lists, each once.

    Stage ``validation`` has :func:`blockface_faults`, stage ``policies`` the
    faults of locations that the curb passes. Only faulty locations are joined.
    """
    checked = blockface_faults(segments).select("blockface_id", F.lit("validation").alias("stage"), F.col("fault").alias("reason"))
    first = F.when(F.col("segment_seq") == 0, F.col("upstream_loc_list"))
    passed = segments.select("blockface_id", F.explode(F.concat(F.coalesce(first, F.array().cast("array<string>")), F.coalesce("downstream_loc_list", F.array().cast("array<string>")))).alias("location_id"))
    bad = passed.join(location_faults(policies), "location_id").select("blockface_id", F.lit("policies").alias("stage"), "reason")
    return checked.unionByName(bad).distinct()


def event_log(segments: DataFrame, policies: DataFrame, features: DataFrame) -> DataFrame:
    """(blockface_id, pos, segment_id, policy, direction): each blockface's segments and arrows in curb order.

    ``segments``: blockface_id, segment_id, segment_seq, is_left_side_oneway,
    upstream_loc_list, downstream_loc_list. ``policies`` as of
    :func:`location_policies`, ``features``: location_id, feature_type. The
    first segment's upstream locations come first, then each segment and its
    downstream locations. A hydrant or bus stop begins and ends its zone by
    turns. Arrows left and right are read from the curb's side; both, and none,
    end one zone and begin another. An arrow that is none of these is an error;
    :func:`apply_policies` sets its blockface aside before.
    """
    flag = F.coalesce(F.col("is_left_side_oneway"), F.lit(False))
    base = segments.select("blockface_id", "segment_id", F.col("segment_seq").alias("seq"), flag.alias("left"), "upstream_loc_list", "downstream_loc_list")
    bodies = base.select("blockface_id", F.struct("seq", F.lit(1).alias("part"), F.lit(0).alias("item"), F.lit("").alias("policy"), F.lit(0).alias("half")).alias("at"), "segment_id", F.lit(None).cast("string").alias("policy"), F.lit(None).cast("string").alias("direction"))
    up = base.where(F.col("seq") == 0).select("blockface_id", "seq", "left", F.lit(0).alias("part"), F.posexplode("upstream_loc_list").alias("item", "location_id"))
    down = base.select("blockface_id", "seq", "left", F.lit(2).alias("part"), F.posexplode("downstream_loc_list").alias("item", "location_id"))
    # one row for each location and kind of zone, whatever other features are there
    zoned = features.where(F.col("feature_type").isin("fire_hydrant", "bus_stop")).select("location_id", "feature_type").distinct()
    items = up.unionByName(down).join(zoned, "location_id", "left")
    is_feature = (F.col("part") == 2) & F.col("feature_type").isin("fire_hydrant", "bus_stop")
    order = Window.partitionBy("blockface_id", "feature_type").orderBy("seq", "item")
    fixed = F.when(F.col("feature_type") == "fire_hydrant", F.lit(FIRE_HYDRANT)).otherwise(F.lit(BUS_STOP))
    toggled = items.where(is_feature).withColumn("direction", F.when(F.row_number().over(order) % 2 == 1, AWAY).otherwise(TOWARD))
    toggled = toggled.select("blockface_id", "seq", "part", "item", canonical_json(fixed).alias("policy"), F.lit(0).alias("half"), "direction")
    posted = items.where(~F.coalesce(is_feature, F.lit(False))).join(policies, "location_id")
    arrow = F.col("arrow")
    known = arrow.isNull() | arrow.isin(*ARROWS)
    arrow = F.when(~known, F.raise_error(F.concat(F.lit("unknown arrow: "), arrow))).otherwise(arrow)
    one = F.when(arrow == "left", F.when(F.col("left"), TOWARD).otherwise(AWAY)).when(arrow == "right", F.when(F.col("left"), AWAY).otherwise(TOWARD)).otherwise(arrow)
    directions = F.when(arrow.isNull() | (arrow == "both"), F.array(F.lit(TOWARD), F.lit(AWAY))).otherwise(F.array(one))
    posted = posted.select("blockface_id", "seq", "part", "item", canonical_json(F.col("policy_json")).alias("policy"), F.posexplode(directions).alias("half", "direction"))
    arrows = toggled.unionByName(posted).select("blockface_id", F.struct("seq", "part", "item", "policy", "half").alias("at"), F.lit(None).cast("string").alias("segment_id"), "policy", "direction")
    both = bodies.withColumn("segment_id", F.col("segment_id").cast("string")).unionByName(arrows)
    return both.select("blockface_id", F.row_number().over(Window.partitionBy("blockface_id").orderBy("at")).alias("pos"), "segment_id", "policy", "direction")


def propagate(events: DataFrame) -> DataFrame:
    """(blockface_id, segment_id, pos, policy) of the policies that hold on each segment.

    Walking forward, AWAY starts a policy and TOWARD ends it; walking back,
    TOWARD starts it. So between two neighbouring arrows of one policy it holds
    if the first points away or the second points toward. Each stretch is one
    row from ``lead`` over the arrows, and only holding stretches are joined to
    the segments inside them.
    """
    arrows = events.where(F.col("direction").isNotNull())
    w = Window.partitionBy("blockface_id", "policy").orderBy("pos")
    after = arrows.select("blockface_id", "policy", F.col("pos").alias("a"), F.lead("pos").over(w).alias("b"), (F.col("direction") == AWAY).alias("starts"), (F.lead("direction").over(w) == TOWARD).alias("ends"), F.lag("pos").over(w).alias("before"), (F.col("direction") == TOWARD).alias("first_ends"))
    first = after.where(F.col("before").isNull() & F.col("first_ends")).select("blockface_id", "policy", F.lit(None).cast("bigint").alias("a"), F.col("a").cast("bigint").alias("b"))
    held = after.where(F.col("starts") | F.coalesce("ends", F.lit(False))).select("blockface_id", "policy", F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
    stretches = held.unionByName(first)
    segments = events.where(F.col("segment_id").isNotNull()).select(F.col("blockface_id").alias("face"), "segment_id", "pos")
    inside = (F.col("face") == F.col("blockface_id")) & (F.col("a").isNull() | (F.col("pos") > F.col("a"))) & (F.col("b").isNull() | (F.col("pos") < F.col("b")))
    return segments.join(stretches, inside).select("blockface_id", "segment_id", "pos", "policy").distinct()


def segment_lists(segments: DataFrame, active: DataFrame, *, default: bool = False) -> DataFrame:
    """(blockface_id, segment_id, segment_seq, policy_list): each segment's policies by priority (without one last), then text.

    ``default`` adds parking at any time to every list.
    """
    rank = F.coalesce(F.get_json_object("policy", "$.priority").try_cast("int"), F.lit(2**31 - 1))
    found = active.select("segment_id", F.struct(rank.alias("rank"), "policy").alias("p")).groupBy("segment_id").agg(F.array_sort(F.collect_set("p")).alias("ps"))
    lists = F.coalesce(F.transform("ps", lambda p: p["policy"]), F.array().cast("array<string>"))
    if default:
        lists = F.concat(lists, F.array(canonical_json(F.lit(PARKING_ANYTIME))))
    named = segments.select("blockface_id", F.col("segment_id").cast("string").alias("segment_id"), "segment_seq")
    return named.join(found, "segment_id", "left").select("blockface_id", "segment_id", "segment_seq", lists.alias("policy_list"))


def apply_or_quarantine(segments: DataFrame, policies: DataFrame, features: DataFrame, *, default: bool = False) -> tuple[DataFrame, DataFrame]:
    """The policy list of every segment of the blockfaces without errors, and the :func:`blockface_errors` of the others.

    An error sets its own blockface aside and no other.
    """
    errors = cut(blockface_errors(segments, policies))
    sound = segments.join(errors.select("blockface_id").distinct(), "blockface_id", "left_anti")
    return segment_lists(sound, propagate(event_log(sound, policies, features)), default=default), errors


def apply_policies(segments: DataFrame, policies: DataFrame, features: DataFrame, *, default: bool = False) -> DataFrame:
    """The policy list of every segment of the blockfaces without errors."""
    return apply_or_quarantine(segments, policies, features, default=default)[0]
