"""Spatial joins by grid cells: candidates by an equi-join on cells, then exact arithmetic.

An edge table has one row for each straight piece of a line: line_id, edge_no,
x0, y0, x1, y1, cum (length before it) and total (the line's length).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .layout import spread
from .lineage import cut


def edge_table(lines: DataFrame, line_id: str, line: str, keep: Sequence[str] = ()) -> DataFrame:
    """The edges of lines given as arrays of points, with the lines' ``keep`` columns; edges of no length are left out."""
    steps = F.arrays_zip(F.slice(line, 1, F.size(line) - 1).alias("a"), F.slice(line, 2, F.size(line) - 1).alias("b"))
    length = lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])
    df = lines.where(F.size(line) >= 2).select(F.col(line_id).alias("line_id"), steps.alias("steps"), *keep).withColumn("lengths", F.transform("steps", length))
    total = F.aggregate("lengths", F.lit(0.0), lambda a, x: a + x)
    df = df.select("line_id", "lengths", total.alias("total"), F.posexplode("steps").alias("edge_no", "s"), *keep)
    cum = F.aggregate(F.slice("lengths", 1, F.col("edge_no")), F.lit(0.0), lambda a, x: a + x)
    df = df.select("line_id", "edge_no", F.col("s.a.x").alias("x0"), F.col("s.a.y").alias("y0"), F.col("s.b.x").alias("x1"), F.col("s.b.y").alias("y1"), cum.alias("cum"), "total", *keep)
    return df.where((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1")))


def cells(x0: Column, y0: Column, x1: Column, y1: Column, cell: float, reach: float = 0.0) -> Column:
    """The grid cells of the box of two points, widened by ``reach``: an array of (cx, cy)."""
    at = lambda v: F.floor(v / cell)
    xs = F.sequence(at(F.least(x0, x1) - reach), at(F.greatest(x0, x1) + reach))
    ys = F.sequence(at(F.least(y0, y1) - reach), at(F.greatest(y0, y1) + reach))
    return F.flatten(F.transform(xs, lambda cx: F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def snap(points: DataFrame, edges: DataFrame, *, tolerance: float, key: str = "point_id", cell: float | None = None, same: Sequence[str] = (), keep: Sequence[str] = ("fraction", "px", "py"), once: bool = False) -> DataFrame:
    """``points`` (key, x, y) with the nearest line within ``tolerance``: line_id, distance, along, and ``keep`` of fraction, px, py.

    A point lies in one cell, and an edge in the cells of its widened box, so
    each pair near enough meets once for each point. Of equally near lines the
    smallest id wins. Points without a line are left out; find them with
    :func:`unsnapped`. A point meets only lines with equal ``same`` columns,
    which both tables have. With ``once`` the caller tells that no key is given
    twice; then a point's lines are compared where they meet, in one of all
    shuffle partitions, and not dealt again.
    """
    size = cell or max(4 * tolerance, 1.0)
    at = {"__cx": F.floor(F.col("x") / size), "__cy": F.floor(F.col("y") / size)}
    e = edges.withColumn("c", F.explode(cells(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), size, tolerance))).select("*", F.col("c.cx").alias("__cx"), F.col("c.cy").alias("__cy")).drop("c")
    e = e.withColumnsRenamed({c: f"__{c}" for c in same})
    # a point's cell is told by its place, so it takes no room where points are dealt;
    # the cells of edges are many more than the rows that they are made from tell, so they are never broadcast
    meet = [F.col(c) == F.col(f"__{c}") for c in same] + [own == F.col(c) for c, own in at.items()]
    near = (spread(points, *same, *at.values()) if once else points).join(e.hint("merge"), meet)
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x0")) * dx + (F.col("y") - F.col("y0")) * dy) / (dx * dx + dy * dy)))
    near = near.withColumn("t", t).withColumns({"px": F.col("x0") + F.col("t") * dx, "py": F.col("y0") + F.col("t") * dy})
    near = near.withColumns({"distance": F.hypot(F.col("x") - F.col("px"), F.col("y") - F.col("py")), "along": F.col("cum") + F.col("t") * F.hypot(dx, dy)}).where(F.col("distance") <= tolerance)
    best = near.groupBy(*[f"__{c}" for c in same], *at, key) if once else near.groupBy(key)
    best = best.agg(F.min(F.struct("distance", "line_id", "along", *["total" if c == "fraction" else c for c in keep])).alias("b"))
    return best.select(key, "b.line_id", "b.distance", "b.along", *[(F.col("b.along") / F.col("b.total")).alias(c) if c == "fraction" else f"b.{c}" for c in keep])


def unsnapped(points: DataFrame, snapped: DataFrame, key: str = "point_id") -> DataFrame:
    return points.join(snapped, key, "left_anti")


def in_polygons(points: DataFrame, polygons: DataFrame, *, key: str = "point_id", cell: float) -> DataFrame:
    """(key, polygon_id) of points strictly inside polygons given as edges (polygon_id, x0, y0, x1, y1).

    A point meets the polygons whose box holds a part of its grid cell, and of
    these only the edges that its band of y touches, so the work follows the
    points near a polygon and not all in its band. Rays go right: a point is
    inside if they cross an odd number of edges; points on an edge are not.
    """
    band = lambda y: F.floor(y / cell)
    box = polygons.groupBy("polygon_id").agg(F.min(F.least("x0", "x1")).alias("bx0"), F.min(F.least("y0", "y1")).alias("by0"), F.max(F.greatest("x0", "x1")).alias("bx1"), F.max(F.greatest("y0", "y1")).alias("by1"))
    tiles = box.withColumn("c", F.explode(cells(F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1"), cell))).select("polygon_id", "bx0", "by0", "bx1", "by1", "c.cx", "c.cy")
    p = points.withColumns({"cx": F.floor(F.col("x") / cell), "cy": band(F.col("y"))})
    inside_box = F.col("x").between(F.col("bx0"), F.col("bx1")) & F.col("y").between(F.col("by0"), F.col("by1"))
    near = p.join(tiles, ["cx", "cy"]).where(inside_box).select(key, "polygon_id", "x", "y", F.col("cy").alias("band"))
    e = polygons.withColumn("band", F.explode(F.sequence(band(F.least("y0", "y1")), band(F.greatest("y0", "y1")))))
    both = near.join(e, ["polygon_id", "band"])
    cross = (F.col("x1") - F.col("x0")) * (F.col("y") - F.col("y0")) - (F.col("y1") - F.col("y0")) * (F.col("x") - F.col("x0"))
    on = (cross == 0) & F.col("x").between(F.least("x0", "x1"), F.greatest("x0", "x1")) & F.col("y").between(F.least("y0", "y1"), F.greatest("y0", "y1"))
    spans = (F.col("y0") > F.col("y")) != (F.col("y1") > F.col("y"))
    right = F.col("x") < F.col("x0") + (F.col("y") - F.col("y0")) * (F.col("x1") - F.col("x0")) / F.when(F.col("y1") != F.col("y0"), F.col("y1") - F.col("y0"))
    found = both.groupBy(key, "polygon_id").agg(F.count_if(spans & right).alias("crossings"), F.count_if(on).alias("touches"))
    return found.where((F.col("crossings") % 2 == 1) & (F.col("touches") == 0)).select(key, "polygon_id")


def bounding_box(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return points.agg(F.min(x).alias("x0"), F.min(y).alias("y0"), F.max(x).alias("x1"), F.max(y).alias("y1"))


def lines_in_envelope(edges: DataFrame, box: tuple[float, float, float, float], margin: float) -> DataFrame:
    """(line_id) of the lines (an edge table) that meet the box (x0, y0, x1, y1) widened by ``margin``, touching included.

    An edge is clipped at each side of the box: it meets the box if what is
    left begins no later than it ends.
    """
    x0, y0, x1, y1 = box[0] - margin, box[1] - margin, box[2] + margin, box[3] + margin

    def clip(a: Column, b: Column, lo: float, hi: float) -> tuple[Column, Column]:
        d = F.nullif(b - a, F.lit(0.0))
        level = F.when(a.between(lo, hi), 0.0)  # null if a level edge lies outside
        return F.when(a == b, level).otherwise(F.least((lo - a) / d, (hi - a) / d)), F.when(a == b, level + 1).otherwise(F.greatest((lo - a) / d, (hi - a) / d))

    (sx, ex), (sy, ey) = clip(F.col("x0"), F.col("x1"), x0, x1), clip(F.col("y0"), F.col("y1"), y0, y1)
    some = sx.isNotNull() & sy.isNotNull() & (F.greatest(sx, sy, F.lit(0.0)) <= F.least(ex, ey, F.lit(1.0)))
    return edges.where(some).select("line_id").distinct()


def far_distance(points: DataFrame, edges: DataFrame, *, tolerance: float, key: str = "point_id", most: float) -> DataFrame:
    """(key, distance) of points further than ``tolerance`` from every line: their distance to the nearest one, null beyond ``most``.

    Each round looks four times as far, with cells that are as much larger, at
    the points that the round before left; so rounds grow with the logarithm of
    ``most``, and few points are left for the wide ones.
    """
    left = points.join(snap(points, edges, tolerance=tolerance, key=key), key, "left_anti").select(*points.columns)
    out, reach = None, tolerance
    while reach < most:
        reach = min(4 * reach, most)
        left = cut(left)
        found = cut(snap(left, edges, tolerance=reach, key=key).select(key, "distance"))
        out = found if out is None else out.unionByName(found)
        left = left.join(found, key, "left_anti")
    rest = left.select(key, F.lit(None).cast("double").alias("distance"))
    return rest if out is None else out.unionByName(rest)


def in_envelope(df: DataFrame, box: tuple[float, float, float, float], margin: float, x: str = "x", y: str = "y") -> DataFrame:
    """Rows whose point lies in the box (x0, y0, x1, y1) widened by ``margin``, edges included."""
    x0, y0, x1, y1 = box
    return df.where(F.col(x).between(x0 - margin, x1 + margin) & F.col(y).between(y0 - margin, y1 + margin))


def into_cells(edges: DataFrame, side: str, size: tuple[Column, Column], reach: float, within: str | None = None, parts: tuple[str, str] | None = None) -> DataFrame:
    """A row for each cell (cx, cy) that an edge runs through or comes within ``reach`` of, not for all of its box.

    The edge's columns carry ``side`` in front, and ``size`` is a cell's width
    and height. ``within`` names a larger cell (cx, cy) of so many ``parts``
    across and up, out of which nothing is given.
    """
    x0, y0, x1, y1 = (F.col(side + k) for k in ("x0", "y0", "x1", "y1"))
    wide, slack = size[0], size[0] * 1e-9 + reach

    def spread(df: DataFrame, lo: Column, hi: Column, axis: str) -> DataFrame:
        i = ("cx", "cy").index(axis)
        beside = size[i] * 1e-9 + reach
        lo, hi = F.floor((lo - beside) / size[i]), F.floor((hi + beside) / size[i])
        if within is not None:
            lo, hi = F.greatest(lo, F.col(within)[axis] * F.col(parts[i])), F.least(hi, (F.col(within)[axis] + 1) * F.col(parts[i]) - 1)
        return df.withColumns({"__lo": lo, "__hi": hi}).where("__lo <= __hi").withColumn(axis, F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")

    # first the columns of the grid, then in each the rows where the edge is inside it
    df = spread(edges, F.least(x0, x1), F.greatest(x0, x1), "cx")
    dx = F.nullif(x1 - x0, F.lit(0.0))
    df = df.withColumns({"__a": (F.col("cx") * wide - slack - x0) / dx, "__b": ((F.col("cx") + 1) * wide + slack - x0) / dx})
    begin, end = F.coalesce(F.greatest(F.least("__a", "__b"), F.lit(0.0)), F.lit(0.0)), F.coalesce(F.least(F.greatest("__a", "__b"), F.lit(1.0)), F.lit(1.0))
    df = df.withColumns({"__a": y0 + begin * (y1 - y0), "__b": y0 + end * (y1 - y0)})
    return spread(df, F.least("__a", "__b"), F.greatest("__a", "__b"), "cy").drop("__a", "__b")


#: A tile of the overlap join is about this many mean edges wide, and its cells are a power of four narrower and lower, up to the second number.
TILE_EDGES, MOST_PARTS = 4, 64


def _posted(edges: DataFrame, side: str, tile: float, reach: float) -> DataFrame:
    """Edges by the tiles that they run through; columns carry ``side`` in front."""
    named = edges.select(*[F.col(k).alias(side + k) for k in ("line_id", "edge_no", "x0", "y0", "x1", "y1")])
    return into_cells(named, side, (F.lit(tile), F.lit(tile)), reach).withColumn("tile", F.struct("cx", "cy")).drop("cx", "cy")


def linear_overlap(a: DataFrame, b: DataFrame, *, tolerance: float, least: float) -> DataFrame:
    """(a_id, b_id, overlap) of lines (edge tables) that run along each other for more than ``least``.

    Edges of B within ``tolerance`` of A's line overlap it over the part of A's
    edge that they cover; a part that several edges of B cover, as when B
    doubles back, counts once. Lines that touch or cross do not overlap.

    Edges meet in grid cells whose size follows the counts: the plane is cut
    into tiles of some mean edges, and each tile into as many cells across and
    up as cost least, of postings (more in small cells) and pairs (more in
    large ones); so edges that run one way meet in cells stretched that way.
    """
    longest = lambda df: df.agg(F.sum(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0")))).alias("s"), F.count(F.lit(1)).alias("n")).first()
    found = [longest(df) for df in (a, b)]
    mean = sum(r["s"] or 0.0 for r in found) / max(sum(r["n"] for r in found), 1)
    tile = 2.0 ** math.ceil(math.log2(max(TILE_EDGES * mean, 4 * MOST_PARTS * tolerance, 1e-9)))
    ta, tb = _posted(a, "a", tile, 0.0), _posted(b, "b", tile, tolerance)

    run = lambda side, axis: F.least(F.abs(F.col(f"{side}{axis}1") - F.col(f"{side}{axis}0")), F.lit(tile))
    within = lambda df, side: df.select("tile", F.lit(side == "a").alias("is_a"), run(side, "x").alias("across"), run(side, "y").alias("up"))
    of = lambda side, c: F.sum(F.when(F.col("is_a") == F.lit(side == "a"), F.col(c)).otherwise(0.0)).alias(f"{c}_{side}")
    counts = within(ta, "a").unionByName(within(tb, "b")).groupBy("tile").agg(
        F.count_if("is_a").alias("na"), F.count_if(~F.col("is_a")).alias("nb"),
        *[of(side, c) for side in "ab" for c in ("across", "up")],
    ).where("na > 0 AND nb > 0")

    def cost(nx: int, ny: int) -> Column:
        posted = lambda side: F.col(f"n{side}") + F.col(f"across_{side}") * (nx / tile) + F.col(f"up_{side}") * (ny / tile)
        return F.struct((posted("a") + posted("b") + posted("a") * posted("b") / (nx * ny)).alias("cost"), F.lit(nx).cast("long").alias("nx"), F.lit(ny).cast("long").alias("ny"))

    powers = [1 << k for k in range(0, MOST_PARTS.bit_length(), 2)]
    sizes = counts.select("tile", F.array_min(F.array(*[cost(nx, ny) for nx in powers for ny in powers])).alias("s")).select("tile", "s.nx", "s.ny")

    def celled(df: DataFrame, side: str, reach: float) -> DataFrame:
        sized = df.join(sizes, "tile").withColumns({"wide": F.lit(tile) / F.col("nx"), "high": F.lit(tile) / F.col("ny")})
        return into_cells(sized, side, (F.col("wide"), F.col("high")), reach, "tile", ("nx", "ny")).drop("nx", "ny")

    dx, dy = F.col("ax1") - F.col("ax0"), F.col("ay1") - F.col("ay0")
    length = F.hypot(dx, dy)
    straight = celled(ta, "a", 0.0).select("tile", "cx", "cy", "wide", "high", F.col("aline_id").alias("a_id"), F.col("aedge_no").alias("a_no"), "ax0", "ay0", length.alias("length"), (dx / length).alias("ux"), (dy / length).alias("uy"))
    other = celled(tb, "b", tolerance).select("tile", "cx", "cy", F.col("bline_id").alias("b_id"), "bx0", "by0", "bx1", "by1")
    pairs = straight.join(other, ["tile", "cx", "cy"])
    # B's ends along A's edge and off it; B has to come into the band of the tolerance around it
    along = lambda k: (F.col(f"bx{k}") - F.col("ax0")) * F.col("ux") + (F.col(f"by{k}") - F.col("ay0")) * F.col("uy")
    off = lambda k: (F.col(f"bx{k}") - F.col("ax0")) * F.col("uy") - (F.col(f"by{k}") - F.col("ay0")) * F.col("ux")
    pairs = pairs.where((F.least(off(0), off(1)) <= tolerance) & (F.greatest(off(0), off(1)) >= -tolerance))

    def stretch(r: Column) -> Column:
        """The part of B's edge within the tolerance of A's line, as feet along A's edge."""
        slope = F.nullif(r["v"] - r["u"], F.lit(0.0))
        low, high = (F.lit(-tolerance) - r["u"]) / slope, (F.lit(tolerance) - r["u"]) / slope
        t0, t1 = F.coalesce(F.greatest(F.least(low, high), F.lit(0.0)), F.lit(0.0)), F.coalesce(F.least(F.greatest(low, high), F.lit(1.0)), F.lit(1.0))
        return F.struct((r["s"] + (r["e"] - r["s"]) * t0).alias("p"), (r["s"] + (r["e"] - r["s"]) * t1).alias("q"))

    # no filter moves below an explode, so each step is worked out once for a pair and not where it is used
    named = lambda df, name, value: df.withColumn(name, F.explode(F.array(value)))
    met = named(pairs, "r", F.struct(along(0).alias("s"), along(1).alias("e"), off(0).alias("u"), off(1).alias("v")))
    met = named(met, "r", stretch(F.col("r")))
    met = named(met, "m", F.struct(F.greatest(F.least("r.p", "r.q"), F.lit(0.0)).alias("from"), F.least(F.greatest("r.p", "r.q"), F.col("length")).alias("to")))
    found = met.where("m.to > m.from")
    # a pair that meets in several cells counts in the one where its stretch begins
    begins = lambda p, u, size: F.floor((F.col(p) + F.col("m.from") * F.col(u)) / F.col(size))
    found = found.where((begins("ax0", "ux", "wide") == F.col("cx")) & (begins("ay0", "uy", "high") == F.col("cy"))).select("a_id", "b_id", "a_no", "m.from", "m.to")
    # what goes beyond all earlier stretches on the same edge of A; one shuffle serves the window and the sum
    before = Window.partitionBy("a_id", "b_id", "a_no").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("from", F.coalesce(F.max("to").over(before), F.col("from")))
    parts = found.repartition("a_id", "b_id").withColumn("part", F.greatest(F.col("to") - reached, F.lit(0.0)))
    return parts.groupBy("a_id", "b_id").agg(F.sum("part").alias("overlap")).where(F.col("overlap") > least)


def hausdorff(a: Column, b: Column) -> Column:
    """The discrete Hausdorff distance of two lines: the largest distance of a vertex to the other line."""

    def to_line(p: Column, line: Column) -> Column:
        steps = F.arrays_zip(F.slice(line, 1, F.size(line) - 1).alias("a"), F.slice(line, 2, F.size(line) - 1).alias("b"))

        def one(s: Column) -> Column:
            dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
            square = dx * dx + dy * dy
            t = F.when(square == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - s["a"]["x"]) * dx + (p["y"] - s["a"]["y"]) * dy) / F.nullif(square, F.lit(0.0)))))
            return F.hypot(p["x"] - s["a"]["x"] - t * dx, p["y"] - s["a"]["y"] - t * dy)

        return F.array_min(F.transform(steps, one))

    return F.greatest(F.array_max(F.transform(a, lambda p: to_line(p, b))), F.array_max(F.transform(b, lambda p: to_line(p, a))))


def near_ends(starts: DataFrame, ends: DataFrame, distance: float, same: list[str]) -> DataFrame:
    """(a, b): line b starts within ``distance`` of where line a ends, with equal ``same`` columns; a is not b.

    ``starts`` and ``ends`` have id, x, y and the ``same`` columns.
    """
    s = starts.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), *same, F.floor(F.col("x") / distance).alias("cx"), F.floor(F.col("y") / distance).alias("cy"))
    e = ends.withColumn("c", F.explode(cells(F.col("x"), F.col("y"), F.col("x"), F.col("y"), distance, distance))).select(F.col("id").alias("a"), "x", "y", *same, "c.cx", "c.cy")
    near = e.join(s, [*same, "cx", "cy"]).where((F.col("a") != F.col("b")) & (F.hypot(F.col("x") - F.col("bx"), F.col("y") - F.col("by")) <= distance))
    return near.select("a", "b").distinct()
