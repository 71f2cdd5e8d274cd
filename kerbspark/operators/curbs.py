"""Curb lines from street centrelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import intervals, spatial
from .lineage import cut


def half_widths(roads: DataFrame) -> DataFrame:
    """``roads`` with ``left_width`` and ``right_width``: half the surface, and the shoulder if the right of way has other than surface and sidewalks."""
    wider = ~F.col("row_width").eqNullSafe(F.col("surface_wd") + F.col("left_sidewalk") + F.col("right_sidewalk")) | F.col("row_width").isNull()
    half = F.coalesce(F.col("surface_wd") / 2, F.lit(0.0))
    side = lambda c: half + F.when(wider, F.coalesce(F.col(c), F.lit(0.0))).otherwise(0.0)
    return roads.withColumns({"left_width": side("left_shoulder"), "right_width": side("right_shoulder")})


def offset_line(line: Column, width: Column) -> Column:
    """``line`` moved to its left by ``width`` (right if negative), corners mitred; corners that turn back are cut off at their point."""

    def normal(a: Column, b: Column) -> tuple[Column, Column]:
        n = F.nullif(F.hypot(b["x"] - a["x"], b["y"] - a["y"]), F.lit(0.0))
        return -(b["y"] - a["y"]) / n, (b["x"] - a["x"]) / n

    last = F.size(line) - 1

    def move(p: Column, i: Column) -> Column:
        ux, uy = normal(F.when(i > 0, F.get(line, i - 1)).otherwise(p), F.when(i > 0, p).otherwise(F.get(line, i + 1)))
        vx, vy = normal(F.when(i < last, p).otherwise(F.get(line, i - 1)), F.when(i < last, F.get(line, i + 1)).otherwise(p))
        dot = F.greatest(ux * vx + uy * vy + 1, F.lit(0.02))
        return G.point(p["x"] + (ux + vx) / dot * width, p["y"] + (uy + vy) / dot * width)

    clean = F.filter(line, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(line, i - 1)))
    return F.transform(clean, move)


def offset_both(roads: DataFrame, line: str = "line") -> DataFrame:
    """One row for each side with a width: the road's columns, ``side`` and its curb line."""
    sides = F.array(F.struct(F.lit("left").alias("side"), F.col("left_width").alias("w")), F.struct(F.lit("right").alias("side"), (-F.col("right_width")).alias("w")))
    df = roads.withColumn("__s", F.explode(sides)).where(F.col("__s.w") != 0)
    return df.withColumns({"side": F.col("__s.side"), line: offset_line(F.col(line), F.col("__s.w"))}).drop("__s")


def with_ends(curbs: DataFrame, line: str = "line", least_feet: float = 1.0) -> DataFrame:
    """Curbs longer than ``least_feet`` with their length and end points."""
    a, b = G.first_point(F.col(line)), G.last_point(F.col(line))
    return curbs.withColumns({"length_ft": G.line_length(F.col(line)), "x0": a["x"], "y0": a["y"], "x1": b["x"], "y1": b["y"]}).where(F.col("length_ft") > least_feet)


def buffer_cuts(edges: DataFrame, roads: DataFrame, widths: DataFrame, *, cell: float, shrink: float = 0.0) -> DataFrame:
    """(line_id, lo, hi): stretches of curb, in feet along it, that lie inside some road's buffer.

    A road edge's buffer is its quad, half widths less ``shrink`` to each side.
    A curb edge is clipped to the quad's four half planes.
    """
    q = roads.join(widths, "line_id").select(F.col("line_id").alias("road_id"), *[F.col(c).alias("r" + c) for c in ("x0", "y0", "x1", "y1")], (F.col("left_width") - shrink).alias("lw"), (F.col("right_width") - shrink).alias("rw"))
    reach = F.greatest("lw", "rw")
    at = lambda v: F.floor(v / cell)
    xs = F.sequence(at(F.least("rx0", "rx1") - reach), at(F.greatest("rx0", "rx1") + reach))
    ys = F.sequence(at(F.least("ry0", "ry1") - reach), at(F.greatest("ry0", "ry1") + reach))
    q = q.where((F.col("lw") > 0) | (F.col("rw") > 0)).withColumn("cx", F.explode(xs)).withColumn("cy", F.explode(ys))
    e = edges.withColumn("c", F.explode(spatial.cells(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), cell))).select("*", "c.cx", "c.cy").drop("c")
    pairs = e.join(q, ["cx", "cy"]).drop("cx", "cy").distinct()
    rx, ry = F.col("rx1") - F.col("rx0"), F.col("ry1") - F.col("ry0")
    n = F.hypot(rx, ry)
    along = lambda x, y: ((x - F.col("rx0")) * rx + (y - F.col("ry0")) * ry) / n
    off = lambda x, y: ((y - F.col("ry0")) * rx - (x - F.col("rx0")) * ry) / n
    a0, a1 = along(F.col("x0"), F.col("y0")), along(F.col("x1"), F.col("y1"))
    o0, o1 = off(F.col("x0"), F.col("y0")), off(F.col("x1"), F.col("y1"))

    def clip(f0: Column, f1: Column) -> tuple[Column, Column]:
        """Parameters of the edge between which a linear function, f0 at its start and f1 at its end, is positive."""
        root = f0 / F.nullif(f0 - f1, F.lit(0.0))
        lo = F.when((f0 < 0) & (f1 <= 0), 2.0).when(f0 < 0, root).otherwise(0.0)
        hi = F.when((f0 >= 0) & (f1 < 0), root).otherwise(1.0)
        return lo, hi

    sides = [clip(a0, a1), clip(n - a0, n - a1), clip(F.col("lw") - o0, F.col("lw") - o1), clip(F.col("rw") + o0, F.col("rw") + o1)]
    lo, hi = F.greatest(*[s[0] for s in sides]), F.least(*[s[1] for s in sides])
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return pairs.where(lo < hi).select("line_id", (F.col("cum") + lo * length).alias("lo"), (F.col("cum") + hi * length).alias("hi"))


def outside_roads(edges: DataFrame, cuts: DataFrame) -> DataFrame:
    """(line_id, lo, hi): stretches of curb outside all roads."""
    whole = edges.select("line_id", F.lit(0.0).alias("lo"), F.col("total").alias("hi")).distinct()
    return intervals.remainder(whole, cuts, "line_id")


def cut_lines(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """(line_id, lo, hi, line): the points of each part [lo, hi] of a line."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    on = parts.join(edges, "line_id").where((F.col("cum") <= F.col("hi")) & (F.col("cum") + length >= F.col("lo")))
    at = lambda m: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (m - F.col("cum")) / length))
    p = lambda t: G.point(F.col("x0") + t * (F.col("x1") - F.col("x0")), F.col("y0") + t * (F.col("y1") - F.col("y0")))
    pieces = F.array(p(at(F.col("lo"))), p(at(F.col("hi"))))
    got = on.groupBy("line_id", "lo", "hi").agg(F.transform(F.array_sort(F.collect_list(F.struct("edge_no", pieces.alias("p")))), lambda s: s["p"]).alias("ps"))
    return got.select("line_id", "lo", "hi", G.join_lines(F.col("ps")).alias("line"))


def piece_lines(edges: DataFrame, parts: DataFrame, slack: float = 1e-9) -> DataFrame:
    """``parts`` (line_id, lo, hi and columns of their own) with ``line``: each part's two ends, also if they are one place, and the vertices between them."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    end = F.col("cum") + length
    inside = (F.col("cum") < F.col("hi") - slack) & (end > F.col("lo") + slack)
    here = (F.col("hi") - F.col("lo") <= 2 * slack) & (F.col("cum") <= F.col("lo") + slack) & (end >= F.col("lo") - slack)
    # merged and not broadcast, so that parts stay where their line is
    on = parts.join(edges.hint("merge"), "line_id").where(inside | here)
    at = lambda m: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (m - F.col("cum")) / length))

    def place(m: Column) -> Column:
        t = at(m)
        last = G.point(F.col("x1"), F.col("y1"))
        return F.when(t == 1, last).otherwise(G.point(F.col("x0") + t * (F.col("x1") - F.col("x0")), F.col("y0") + t * (F.col("y1") - F.col("y0"))))

    rows = F.array_sort(F.collect_list(F.struct("edge_no", place(F.col("lo")).alias("a"), place(F.col("hi")).alias("b"))))
    got = on.groupBy(*parts.columns).agg(rows.alias("rows"))
    ends = F.when(F.col("hi") - F.col("lo") <= 2 * slack, F.slice("rows", 1, 1)).otherwise(F.col("rows"))
    return got.select(*parts.columns, F.concat(F.array(F.col("rows")[0]["a"]), F.transform(ends, lambda r: r["b"])).alias("line"))


def _look_back(steps: DataFrame, rounds: int) -> DataFrame:
    """(id, up, hops, low) after ``rounds`` doublings of how far each node looks back, or once nothing changes."""
    for _ in range(rounds):
        far = steps.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("hops").alias("h2"), F.col("low").alias("l2"))
        after = cut(steps.join(far, "up").select("id", F.col("up2").alias("up"), (F.col("hops") + F.col("h2")).alias("hops"), F.least("low", "l2").alias("low"), (F.col("up") != F.col("up2")).alias("moved")))
        steps = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    return steps


def chain(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, head, position): each node's chain, named by its first node, and its place from 0.

    ``pairs`` (a, b): b follows a. Of several successors the smallest counts,
    then of several predecessors. A ring is broken before its smallest node.
    Places are found by pointer jumping, in rounds that grow with the logarithm
    of the longest chain, each cut by a checkpoint.
    """
    one = pairs.groupBy("a").agg(F.min("b").alias("b")).groupBy("b").agg(F.min("a").alias("a"))
    rounds = max(1, nodes.count().bit_length())

    def steps(links: DataFrame) -> DataFrame:
        df = nodes.select("id").distinct().join(links.select(F.col("b").alias("id"), F.col("a").alias("p")), "id", "left")
        up = F.coalesce("p", "id")
        return cut(df.select("id", up.alias("up"), F.col("p").isNotNull().cast("long").alias("hops"), F.least("id", up).alias("low")))

    heads = lambda links: nodes.select(F.col("id").alias("up")).distinct().join(links.select(F.col("b").alias("up")), "up", "left_anti")
    looked = _look_back(steps(one), rounds)
    rings = looked.join(heads(one), "up", "left_anti")
    if not rings.isEmpty():
        one = one.join(rings.select(F.col("low").alias("b")).distinct(), "b", "left_anti")
        looked = _look_back(steps(one), rounds)
    return looked.select("id", F.col("up").alias("head"), F.col("hops").alias("position"))


def merge_chains(curbs: DataFrame, chains: DataFrame, carried: list[str], line: str = "line") -> DataFrame:
    """One row for each chain: its head's id and ``carried`` columns, and its lines joined in order."""
    rows = F.array_sort(F.collect_list(F.struct("position", F.col(line).alias("line"), *carried)))
    g = curbs.join(chains, "id").groupBy("head").agg(rows.alias("rows"))
    return g.select(F.col("head").alias("id"), G.join_lines(F.transform("rows", lambda r: r["line"])).alias(line), *[F.col("rows")[0][c].alias(c) for c in carried])


def flow(curbs: DataFrame) -> DataFrame:
    """``curbs`` with ``direction_of_flow`` and ``is_left_side_oneway``; a missing operation is 1 and a missing one-way FT."""
    op, way = F.coalesce("operation", F.lit(1)), F.coalesce("oneway", F.lit("FT"))
    direction = F.when(op.isin(1, 3) & (way == "FT"), "forward").when(op.isin(1, 3) & (way == "TF"), "reverse").when((op == 2) & (F.col("side") == "right"), "forward").when((op == 2) & (F.col("side") == "left"), "reverse")
    left = (op == 1) & (((way == "FT") & (F.col("side") == "left")) | ((way == "TF") & (F.col("side") == "right")))
    return curbs.withColumns({"direction_of_flow": direction, "is_left_side_oneway": F.coalesce(left, F.lit(False))})


def along_flow(curbs: DataFrame, line: str = "line") -> DataFrame:
    """Lines in the direction of flow."""
    back = F.col("direction_of_flow") == "reverse"
    return curbs.withColumns({line: F.when(back, F.reverse(line)).otherwise(F.col(line)), "direction_of_flow": F.when(back, "forward").otherwise(F.col("direction_of_flow"))})


def numbered(curbs: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``curbs`` with ``seq`` from 0 within a key."""
    return curbs.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def connect_parts(parts: DataFrame, key: str, *, order: str = "part", line: str = "line") -> DataFrame:
    """(key, line): the parts of each feature as one line, from the longest on, each time by the nearest free end.

    ``parts`` has one row for each part, a line as an array of points. A part is
    turned round if that brings its nearer end to the join. Of equal distances
    the earlier part wins, then the line's end before its start, then the
    part's start before its end. A feature has few parts, so its row holds them.
    """
    length = F.aggregate(F.sequence(F.lit(1), F.size(line) - 1), F.lit(0.0), lambda a, i: a + F.hypot(F.col(line)[i]["x"] - F.col(line)[i - 1]["x"], F.col(line)[i]["y"] - F.col(line)[i - 1]["y"]))
    whole = parts.where(F.size(line) >= 2).select(key, F.struct(F.col(order).alias("at"), length.alias("length"), F.col(line).alias("line")).alias("p"))
    g = whole.groupBy(key).agg(F.array_sort(F.collect_list("p")).alias("ps"))
    first = F.array_max(F.transform("ps", lambda p, i: F.struct(p["length"].alias("length"), (-i).alias("i"))))["i"]
    g = g.withColumn("first", -first)
    gap = lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"])
    end = lambda x: F.element_at(x, -1)

    def step(state: Column, _: Column) -> Column:
        now = state["line"]
        ways = lambda p: [gap(end(now), p["line"][0]), gap(end(now), end(p["line"])), gap(now[0], p["line"][0]), gap(now[0], end(p["line"]))]
        options = F.transform(state["rest"], lambda p, i: F.array_min(F.array(*[F.struct(d.alias("d"), i.alias("i"), F.lit(k).alias("way")) for k, d in enumerate(ways(p))])))
        best = F.array_min(options)
        taken = state["rest"][best["i"]]["line"]
        taken = F.when(best["way"].isin(1, 2), F.reverse(taken)).otherwise(taken)
        joined = F.when(best["way"] < 2, F.concat(now, taken)).otherwise(F.concat(taken, now))
        return F.struct(joined.alias("line"), F.filter(state["rest"], lambda p, i: i != best["i"]).alias("rest"))

    start = F.struct(F.col("ps")[F.col("first")]["line"].alias("line"), F.filter("ps", lambda p, i: i != F.col("first")).alias("rest"))
    steps = F.slice(F.sequence(F.lit(0), F.size("ps")), 2, F.size("ps") - 1)
    return g.select(key, F.aggregate(steps, start, step, lambda s: s["line"]).alias(line))


def clean_curbs(curbs: DataFrame, *, key: str = "blockface_id", line: str = "line", least: float, slack: float = 1e-6) -> DataFrame:
    """``curbs`` with one valid line of at least ``least`` for each id.

    Of rows with one id the first by line stays. Lines of fewer than two
    points, with missing or infinite ones or without length go, as do those
    shorter than ``least`` by more than ``slack``.
    """
    w = Window.partitionBy(key).orderBy(F.to_json(line))
    one = curbs.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return one.where(G.is_valid_line(F.col(line)) & (G.line_length(F.col(line)) >= least - slack))
