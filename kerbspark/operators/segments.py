"""Curb segments: splits at assets, boundary locations, and merging of tiny segments."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import curbs as curb_lines
from . import intervals, spatial
from .layout import spread
from .lineage import cut

FEATURES = ("FH", "BS")


def fill_boundaries(segments: DataFrame, key: str = "blockface_id", order: str = "segment_seq", up: str = "upstream_location", down: str = "downstream_location") -> DataFrame:
    """Fill missing boundary locations from neighbours.

    The first segment has no upstream and the last no downstream location;
    others take the neighbour's. A segment with one anchor at both ends keeps
    it, and its neighbours keep theirs toward it.
    """
    w = Window.partitionBy(key).orderBy(order)
    first, last = F.lag(F.lit(1)).over(w).isNull(), F.lead(F.lit(1)).over(w).isNull()
    df = segments.withColumns({"__u": F.when(first, F.lit(None)).otherwise(F.coalesce(F.col(up), F.lag(down).over(w))), "__same": F.coalesce(F.col(up) == F.col(down), F.lit(False)), "__last": last})
    df = df.withColumns({"__d": F.when(F.col("__last"), F.lit(None)).otherwise(F.lead("__u").over(w)), "__next": F.coalesce(F.lead("__same").over(w), F.lit(False)), "__before": F.coalesce(F.lag("__same").over(w), F.lit(False))})
    d = F.when(F.col("__next") & F.col(down).isNotNull(), F.col(down)).when(F.col("__same"), F.col(down)).otherwise(F.col("__d"))
    u = F.when(F.col("__before") & F.col(up).isNotNull(), F.col(up)).when(F.col("__same"), F.col(up)).otherwise(F.col("__u"))
    return df.withColumns({up: u, down: d}).drop("__u", "__d", "__same", "__last", "__next", "__before")


def merge_groups(segments: DataFrame, threshold: float, key: str = "blockface_id", order: str = "segment_seq", length: str = "seg_length", asset: str = "upstream_asset") -> DataFrame:
    """``segments`` with ``tiny`` and ``merge_group``, numbering the groups of a blockface from 0.

    A tiny segment joins the long one before it, or the first long one if none
    is before. If the next long one begins at a hydrant or bus stop, the last
    tiny segment before it joins that one instead. A blockface of tiny segments
    is one group.
    """
    w = Window.partitionBy(key).orderBy(order)
    past, coming = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    df = segments.withColumn("tiny", F.col(length) < threshold)
    at = F.when(~F.col("tiny"), F.col(order))
    df = df.withColumns({"__p": F.last(at, ignorenulls=True).over(past), "__n": F.first(at, ignorenulls=True).over(coming), "__a": F.first(F.when(~F.col("tiny"), F.struct(asset)), ignorenulls=True).over(coming)[asset], "__long": F.lead(~F.col("tiny")).over(w)})
    forward = F.col("tiny") & F.coalesce(F.col("__long"), F.lit(False)) & F.coalesce(F.col("__a").isin(*FEATURES), F.lit(False))
    df = df.withColumn("__g", F.when(forward, F.col("__n")).otherwise(F.coalesce("__p", "__n", F.lit(-1))))
    # anchors never fall along the order, so groups are numbered in it without another sort
    new = F.lag(F.lit(1)).over(w).isNotNull() & ~F.col("__g").eqNullSafe(F.lag("__g").over(w))
    df = df.withColumn("__new", new.cast("int"))
    return df.withColumn("merge_group", F.sum("__new").over(past).cast("int")).drop("__p", "__n", "__a", "__long", "__g", "__new")


def _distinct(lists: Column) -> Column:
    values = F.array_compact(lists)
    return F.when(F.size(values) > 0, F.array_distinct(values))


def merge_tiny(segments: DataFrame, threshold: float, key: str = "blockface_id", order: str = "segment_seq", keep: Sequence[str] = ()) -> DataFrame:
    """One row for each merge group: segment_id, the new sequence, length, first and last location, location lists, and of the columns ``keep`` arrays in order.

    A group of one kind lists all its locations. A mixed one lists upstream the
    first segment's upstream and the downstream ones of leading tiny segments,
    and downstream those from the first long segment on. A group's upstream
    list begins with the downstream list of the group before. A blockface that
    is one tiny segment without locations is dropped.
    """
    alone = F.count(F.lit(1)).over(Window.partitionBy(key)) == 1
    df = merge_groups(segments, threshold, key, order)
    df = df.withColumn("__alone", alone).where(~(F.col("__alone") & F.col("tiny") & F.col("upstream_location").isNull() & F.col("downstream_location").isNull()))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("seq"), F.col("upstream_location").alias("up"), F.col("downstream_location").alias("down"), "tiny", "segment_id", *keep)))
    g = df.groupBy(key, "merge_group").agg(rows.alias("rows"), F.sum("seg_length").alias("seg_length"), (F.min("tiny") != F.max("tiny")).alias("mixed"))
    first_long = F.aggregate("rows", F.lit(None).cast("int"), lambda acc, r: F.coalesce(acc, F.when(~r["tiny"], r["seq"].cast("int"))))
    g = g.withColumn("long", first_long)
    ups = F.when(F.col("mixed"), F.concat(F.array(F.col("rows")[0]["up"]), F.transform(F.filter("rows", lambda r: r["tiny"] & (r["seq"] < F.col("long"))), lambda r: r["down"]))).otherwise(F.transform("rows", lambda r: r["up"]))
    downs = F.transform(F.when(F.col("mixed"), F.filter("rows", lambda r: r["seq"] >= F.col("long"))).otherwise(F.col("rows")), lambda r: r["down"])
    g = g.withColumns({"__ups": F.array_compact(ups), "downstream_loc_list": _distinct(downs)})
    w = Window.partitionBy(key).orderBy("merge_group")
    before = F.coalesce(F.lag("downstream_loc_list").over(w), F.array().cast("array<string>"))
    g = g.withColumn("upstream_loc_list", _distinct(F.concat(before, "__ups")))
    some = lambda c: F.array_compact(F.transform("rows", lambda r: r[c]))
    return g.select(key, F.col("rows")[0]["segment_id"].alias("segment_id"), (F.row_number().over(w) - 1).alias(order), "seg_length", F.get(some("up"), F.lit(0)).alias("upstream_location"), F.try_element_at(some("down"), F.lit(-1)).alias("downstream_location"), "upstream_loc_list", "downstream_loc_list", F.transform("rows", lambda r: r["seq"]).alias("merged"), *[F.col("rows")[c].alias(c) for c in keep])


def split_by_buffers(lines: DataFrame, points: DataFrame, feet: float, least_feet: float, *, suffix: str = "FH") -> DataFrame:
    """``lines`` (line_id, lo, hi: feet along the curb) cut at the buffers of ``points`` (line_id, at, point_id).

    Pieces shorter than ``least_feet`` are dropped and take no number. A
    piece's point is the smallest id among the points on it, ends included.
    Lines without points are one piece. Ids become ``line_id:suffix`` and a number.
    """
    on = points.join(lines, "line_id").withColumns({"length_ft": F.col("hi") - F.col("lo")})
    on = on.withColumn("fraction", (F.col("at") - F.col("lo")) / F.col("length_ft"))
    cuts = cut(intervals.boundaries(intervals.buffers(on, feet), "line_id"))
    parts = intervals.pieces(cuts, "line_id").join(lines, "line_id")
    parts = parts.where((F.col("end_fraction") - F.col("start_fraction")) * (F.col("hi") - F.col("lo")) >= least_feet)
    owners = intervals.assign_points(on.select("line_id", "fraction", "point_id"), parts.select("line_id", "no", "start_fraction", "end_fraction"), "line_id").groupBy("line_id", "no").agg(F.min("point_id").alias("point_id"))
    rest = lines.join(points.select("line_id").distinct(), "line_id", "left_anti").select("line_id", F.lit(0.0).alias("start_fraction"), F.lit(1.0).alias("end_fraction"), F.lit(0).alias("no"), *[c for c in lines.columns if c != "line_id"])
    both = parts.unionByName(rest, allowMissingColumns=True).join(owners, ["line_id", "no"], "left")
    n = F.row_number().over(Window.partitionBy("line_id").orderBy("start_fraction"))
    span = F.col("hi") - F.col("lo")
    kept = [c for c in lines.columns if c not in ("line_id", "lo", "hi")]
    return both.select(F.concat_ws(":", "line_id", F.concat(F.lit(suffix), n)).alias("line_id"), (F.col("lo") + F.col("start_fraction") * span).alias("lo"), (F.col("lo") + F.col("end_fraction") * span).alias("hi"), F.col("point_id").alias(f"{suffix.lower()}_id"), *kept)


def _swept(lines: DataFrame, points: DataFrame, suffix: str) -> DataFrame:
    """``lines`` cut at ``points``, rows of their line with ``at`` and ``point_id``.

    A line's start and its points are sorted together, and each row reaches to
    the next one; so lines are neither joined again nor told from those without points.
    """
    starts = lines.withColumns({"at": F.col("lo"), "point_id": F.lit(None).cast(points.schema["point_id"].dataType)})
    keys = [c for c in ("blockface_id", "line_id") if c in lines.columns]
    w = Window.partitionBy(*keys).orderBy("at", F.col("point_id").asc_nulls_first())
    kept = [c for c in lines.columns if c not in ("line_id", "lo", "hi")]
    s = suffix.lower()
    line_id = F.concat_ws(":", "line_id", F.concat(F.lit(suffix), F.row_number().over(w)))
    return points.unionByName(starts).select(line_id.alias("line_id"), F.col("at").alias("lo"), F.coalesce(F.lead("at").over(w), "hi").alias("hi"), F.col("point_id").alias(f"{s}_start"), F.lead("point_id").over(w).alias(f"{s}_end"), *kept)


def split_by_points(lines: DataFrame, points: DataFrame, *, suffix: str = "PS") -> DataFrame:
    """``lines`` cut at ``points``, even into pieces of no length; each piece knows the points at its ends."""
    return _swept(lines, points.select("line_id", "at", "point_id").join(lines, "line_id"), suffix)


def split_by_bus_stops(lines: DataFrame, stops: DataFrame, least_feet: float, *, suffix: str = "BS", multipliers: Mapping[str, float] = intervals.BUS_STOP_SIGNS) -> DataFrame:
    """``lines`` cut at both ends of each stop's zone; a piece knows the stop whose zone begins where it does, of several the smallest id.

    Pieces shorter than ``least_feet`` are dropped and take no number; lines
    without stops are one piece. Ends of zones are carried with their stop, so
    no fractions are compared to find it.
    """
    span = F.col("hi") - F.col("lo")
    on = stops.join(lines, "line_id").withColumn("length_ft", span).withColumn("fraction", (F.col("at") - F.col("lo")) / F.col("length_ft"))
    zones = cut(intervals.bus_stop_buffers(on, multipliers).select("line_id", "start_fraction", "end_fraction", "point_id"))
    none = F.lit(None).cast(zones.schema["point_id"].dataType).alias("point_id")
    edges = zones.select("line_id", F.col("start_fraction").alias("pos"), "point_id").unionByName(zones.select("line_id", F.col("end_fraction").alias("pos"), none))
    edges = edges.unionByName(lines.select("line_id", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("pos"), none))
    cuts = edges.groupBy("line_id", "pos").agg(F.min("point_id").alias("point_id"))
    w = Window.partitionBy("line_id").orderBy("pos")
    parts = cuts.withColumn("next", F.lead("pos").over(w)).where("next IS NOT NULL").join(lines, "line_id")
    # a line of no length has no fractions; it stays whole
    parts = parts.where(((F.col("next") - F.col("pos")) * span >= least_feet) | (F.col("pos").eqNullSafe(F.lit(0.0)) & F.col("next").eqNullSafe(F.lit(1.0))))
    kept = [c for c in lines.columns if c not in ("line_id", "lo", "hi")]
    return parts.select(F.concat_ws(":", "line_id", F.concat(F.lit(suffix), F.row_number().over(w))).alias("line_id"), (F.col("lo") + F.col("pos") * span).alias("lo"), (F.col("lo") + F.col("next") * span).alias("hi"), F.col("point_id").alias(f"{suffix.lower()}_id"), *kept)


def id_order(line_id: Column, stages: int = 4) -> Column:
    """The numbers of the last ``stages`` parts of a composite id, to sort by: ``b:BS1:FH10:PS2:PM1`` is (1, 10, 2, 1)."""
    return F.transform(F.slice(F.split(line_id, ":"), -stages, stages), lambda x: F.regexp_extract(x, "([0-9]+)$", 1).try_cast("int"))


def _placed(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """The columns of ``lines`` with at and point_id: assets (blockface_id, at, point_id) on the piece of their blockface that is nearest, of equals the first."""
    gap = F.greatest(F.col("lo") - F.col("at"), F.col("at") - F.col("hi"), F.lit(0.0))
    own = [c for c in lines.columns if c not in ("blockface_id", "line_id", "lo", "hi")]
    # merged and not broadcast, so that rows stay where their blockface is
    near = assets.select("blockface_id", "at", "point_id").join(lines.hint("merge"), "blockface_id")
    best = near.groupBy("blockface_id", "point_id", "at").agg(F.min(F.struct(gap.alias("gap"), "lo", "hi", "line_id", *own)).alias("b"))
    return best.select("blockface_id", *[F.col("b")[c].alias(c) for c in ("line_id", "lo", "hi", *own)], F.least(F.greatest("at", "b.lo"), F.col("b.hi")).alias("at"), "point_id")


def place(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """(line_id, at, point_id): assets (blockface_id, at, point_id) on the piece of their blockface that is nearest, of equals the first."""
    return _placed(lines.select("blockface_id", "line_id", "lo", "hi"), assets).select("line_id", "at", "point_id")


def _pieces(lines: DataFrame, hydrants: DataFrame | None, signs: DataFrame | None, meters: DataFrame | None, stops: DataFrame | None, buffer_feet: float, least_feet: float) -> DataFrame:
    """The pieces of curbs (blockface_id, line_id, lo, hi) after all four stages, in order, with the locations at their ends.

    A kind that is None leaves all pieces whole, so they only get their number.
    Signs and meters are dealt and sorted by blockface, as are the steps that
    follow, so pieces are written down only where another stage reads them.
    """
    made = False
    for suffix, assets in (("BS", stops), ("FH", hydrants), ("PS", signs), ("PM", meters)):
        if assets is None:
            lines = lines.withColumn("line_id", F.concat_ws(":", "line_id", F.lit(f"{suffix}1")))
            continue
        if made:
            lines = cut(lines)  # read several times by a stage
        if suffix == "BS":
            lines = split_by_bus_stops(lines, place(lines, assets), least_feet)
        elif suffix == "FH":
            lines = split_by_buffers(lines, cut(place(lines, assets)), buffer_feet, least_feet)
        else:
            lines = _swept(lines, _placed(lines, assets), suffix)
        made = True
    w = Window.partitionBy("blockface_id").orderBy(id_order(F.col("line_id")))
    seq = F.row_number().over(w) - 1
    first = lambda *names: F.coalesce(F.lit(None), *[c for c in names if c in lines.columns]).cast("string")
    asset = F.when(first("pm_start", "ps_start").isNotNull(), F.lit("S")).when(first("fh_id").isNotNull(), "FH").when(first("bs_id").isNotNull(), "BS")
    return lines.select("blockface_id", F.col("line_id").alias("segment_id"), seq.alias("segment_seq"), (F.col("hi") - F.col("lo")).alias("seg_length"), first("pm_start", "ps_start", "fh_id", "bs_id").alias("upstream_location"), first("pm_end", "ps_end", "fh_id", "bs_id").alias("downstream_location"), asset.alias("upstream_asset"), "lo", "hi")


def segment_curbs(curbs: DataFrame, hydrants: DataFrame | None, signs: DataFrame | None, meters: DataFrame | None, stops: DataFrame | None = None, *, buffer_feet: float = 10.0, least_feet: float = 0.5, tiny_feet: float = 3.0) -> DataFrame:
    """Curbs (blockface_id, lo, hi, in feet along them) cut at bus stops' zones, hydrants' buffers, signs and meters in turn; tiny pieces merged.

    Assets have (blockface_id, at, point_id), as :func:`spatial.snap` gives
    them. Without assets of a kind its stage passes pieces through; None costs
    no work. A segment's location is the first there is of its meter, sign,
    hydrant and bus stop.
    """
    lines = curbs.select("blockface_id", F.col("blockface_id").cast("string").alias("line_id"), "lo", "hi")
    table = _pieces(lines, hydrants, signs, meters, stops, buffer_feet, least_feet)
    merged = merge_tiny(fill_boundaries(table), tiny_feet, keep=("lo", "hi"))
    return merged.drop("merged").withColumns({"lo": F.array_min("lo"), "hi": F.array_max("hi")})


def segment_lines(curbs: DataFrame, hydrants: DataFrame | None, signs: DataFrame | None, meters: DataFrame | None, stops: DataFrame | None = None, *, snap_feet: float = 30.0, buffer_feet: float = 10.0, least_feet: float = 0.5, tiny_feet: float = 3.0, degrees: Callable[[Column, Column], tuple[Column, Column]] = G.to_degrees, same: Sequence[str] = (), once: bool = False) -> DataFrame:
    """Curb lines and the points near them as segments with lines: :func:`segment_curbs` from end to end.

    ``curbs``: blockface_id, line in feet, along the flow; assets: point_id, x,
    y. A point belongs to the nearest curb within ``snap_feet``, others are
    left out (:func:`spatial.unsnapped`); where curbs lie over each other, as
    on several levels, ``same`` names columns of both that must be equal. ``once``
    tells that no point_id is given twice, which spares a shuffle; of points with
    one id the nearest counts. All stages carry feet along the curb,
    so no line is cut before the last one: then each piece gets its points, and
    its length in feet on the ellipsoid, rounded to two decimals, decides
    whether it is tiny. A merged segment keeps the ends of its pieces as points.
    ``degrees`` turns the lines' coordinates into degrees. Adds ``line``, in
    feet, to the columns of :func:`segment_curbs`; ``lo`` and ``hi`` are feet
    along the curb.
    """
    edges = cut(spatial.edge_table(curbs.select(F.col("blockface_id").cast("string").alias("blockface_id"), "line", *same), "blockface_id", "line", same))
    whole = edges.groupBy("line_id").agg(F.max("total").alias("hi"))
    whole = whole.select(F.col("line_id").alias("blockface_id"), "line_id", F.lit(0.0).alias("lo"), "hi")

    def on_curb(points: DataFrame) -> DataFrame:
        snapped = spatial.snap(points.select("point_id", "x", "y", *same), edges, tolerance=snap_feet, same=same, keep=(), once=once)
        return spread(snapped.select(F.col("line_id").alias("blockface_id"), F.col("along").alias("at"), "point_id"), "blockface_id")

    placed = [None if a is None else on_curb(a) for a in (hydrants, signs, meters, stops)]
    pieces = _pieces(whole, *placed, buffer_feet, least_feet).drop("seg_length").withColumnRenamed("blockface_id", "line_id")
    table = curb_lines.piece_lines(edges.drop(*same), pieces).withColumnRenamed("line_id", "blockface_id")
    table = table.withColumn("__degrees", G.map_points(F.col("line"), degrees)).withColumn("seg_length", G.geodesic_feet(F.col("__degrees"))).drop("__degrees")
    merged = merge_tiny(fill_boundaries(table), tiny_feet, keep=("lo", "hi", "line"))
    joined = F.flatten(F.transform("line", lambda x, i: F.when(i == 0, x).otherwise(F.slice(x, 2, F.size(x)))))
    return merged.drop("merged").withColumns({"lo": F.array_min("lo"), "hi": F.array_max("hi"), "line": joined})
