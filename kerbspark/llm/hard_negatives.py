"""Hard negatives by cover trees over norm-augmented candidates.

A candidate x is lifted by one more entry sqrt(M^2 - |x|^2), M the largest norm
of all, and an anchor q by a zero: then |q' - x'|^2 = M^2 + |q|^2 - 2 q.x, so
that large inner products are near neighbours. A node of a cover tree holds the
candidates within a radius r of its centre c; their inner products with q lie in
q.c - d r - r^2/2 to q.c + d r - r^2/2, d the distance of q' and c'. A search
goes best first: the node with the highest bound is opened, nodes that lie
outside every window or below what is already found are skipped, and leaves are
verified by exact integer inner products.

The upper levels are fitted on a bounded sample, ``PIVOTS`` vectors by smallest
hash; every row is indexed. Rows go to the nearest pivot, pivots follow one
another as their own cover tree visits them, and the row of cells is cut into
trees of bounded size, so that a crowded cell becomes several trees. Anchors are
cut into blocks likewise. A task searches one tree for one block of anchors;
pairs that no anchor of the block needs are left out by the trees' bounds.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Sampled vectors of the upper levels.
PIVOTS = 256
#: A tree holds about a 64th of the rows, within these bounds; a block of anchors about this many.
TREE_ROWS, BLOCK_ROWS = (2048, 1 << 16), 2048
#: Beyond this many trees no bounds are sent to all tasks, and every block meets every tree.
ROOTS = 1 << 15
#: Rows of a leaf, how fast radii shrink from level to level, and what a centre must cover to become a node.
LEAF, SHRINK, LEAST = 128, 1.3, 8
#: Leaves or nodes of one anchor that a round of a search opens.
WIDE = 4
LONG = 1 << 63


def whole(vectors: list) -> list[np.ndarray | None]:
    """floor(256 * c) as doubles, which hold them exactly; None for a null vector or one with a null, NaN or infinite entry."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        x = None if v is None or any(c is None for c in v) else np.asarray(v, np.float64)
        with np.errstate(over="ignore"):
            x = None if x is None or not np.isfinite(x).all() else np.floor(x * 256)
        out.append(x if x is not None and np.isfinite(x).all() else None)
    return out


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Binary doubles as rows of ``width``; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    for i, b in enumerate(column):
        x = np.frombuffer(b.as_buffer(), np.float64)
        out[i, : len(x)] = x
    return out


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, clipped to the range of a long: shape (len(x), len(q))."""
    if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(x.shape[1], 1) < 2.0**53:
        return (x @ q.T).astype(np.int64)
    ints = lambda a: np.array([[int(v) for v in row] for row in a], object).reshape(a.shape)
    return np.clip(ints(x) @ ints(q).T, -LONG, LONG - 1).astype(np.int64)


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(largest**2 - (x * x).sum(axis=1), 0.0))[:, None]], axis=1)


class CoverTree:
    """Nodes in one array each: centre, radius, children; a leaf has rows instead. Built level by level.

    A node's rows lie within its radius; its children's centres are its own
    centre and rows farther apart than the next level's radius. Rows that no
    centre covers in useful numbers go to leaves of the node itself. Radii are
    measured, and at most the level's.
    """

    def __init__(self, x: np.ndarray, label: np.ndarray, largest: float):
        self.x, self.label = x, label
        up = lifted(x, largest)
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.child: list[tuple[int, int]] = []  # first node and end of the children, or (-1, leaf number)
        self.leaves: list[np.ndarray] = []
        far = np.linalg.norm(up - up[0], axis=1)
        jobs = [(np.arange(len(x)), 0, float(far.max()))]
        self._node(up, jobs[0][0], up[0])
        at = 0
        while at < len(jobs):
            rows, middle, level = jobs[at]
            parts = self._parts(up, rows, middle, level)
            if parts is None:
                self.child[at] = (-1, len(self.leaves))
                self.leaves.append(rows)
            else:
                self.child[at] = (len(jobs), len(jobs) + len(parts))
                for some, centre in parts:
                    self._node(up, some, up[centre])
                    jobs.append((some, centre, level / SHRINK))
            at += 1
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.low = np.array([label[rows].min() for rows, _, _ in jobs])
        self.high = np.array([label[rows].max() for rows, _, _ in jobs])

    def _node(self, up: np.ndarray, rows: np.ndarray, centre: np.ndarray) -> None:
        self.centre.append(centre)
        self.radius.append(float(np.linalg.norm(up[rows] - centre, axis=1).max()))
        self.child.append((-1, -1))

    @staticmethod
    def _parts(up: np.ndarray, rows: np.ndarray, middle: int, level: float) -> list[tuple[np.ndarray, int]] | None:
        """(rows, centre) of the children, or None for a leaf."""
        if len(rows) <= LEAF or level <= 1e-9:
            return None if len(rows) <= LEAF else [(rows[i : i + LEAF], int(rows[i])) for i in range(0, len(rows), LEAF)]
        parts, left, centre, poor, loose = [], rows, middle, 0, []
        while len(left) and poor < 8:
            near = np.linalg.norm(up[left] - up[centre], axis=1) <= level / SHRINK
            if near.sum() >= LEAST:
                parts.append((left[near], centre))
                poor = 0
            else:
                poor += 1
                loose.append(left[near])
            left = left[~near]
            if len(left):
                centre = int(left[0])
        left = np.concatenate([*loose, left]).astype(np.int64)
        for i in range(0, len(left), LEAF):
            parts.append((left[i : i + LEAF], int(left[i])))
        if len(parts) == 1 and len(parts[0][0]) == len(rows):
            return CoverTree._parts(up, rows, middle, level / SHRINK)
        return parts


def bounds(q: np.ndarray, largest: float, centre: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner products of each pair of an anchor and a node (rows alike), with room for rounding."""
    dot = (q * centre[:, :-1]).sum(axis=1)
    reach = largest**2 + (q * q).sum(axis=1)
    d = np.sqrt(np.maximum(reach - 2 * dot, 0.0))
    slack = 1e-9 * reach + 1.0
    high = np.where(radius >= d, reach / 2, dot + d * radius - radius**2 / 2)
    return dot - d * radius - radius**2 / 2 - slack, high + slack


def _best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, vec: np.ndarray, rid: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` best entries of each anchor and slot: high scores first, then small ids."""
    order = np.lexsort((rid, vec, -score, slot, anchor))
    key = anchor[order].astype(np.int64) * (int(slot.max(initial=0)) + 1) + slot[order]
    start = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else np.zeros(0, np.int64)
    rank = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
    return order[rank < keep]


def search(tree: CoverTree, vec: np.ndarray, rid: np.ndarray, largest: float, block: dict, keep: int, same: bool) -> tuple[np.ndarray, ...]:
    """(anchor, slot, score, vec, rid) of the best ``keep`` candidates in each window of each anchor of ``block``.

    ``block`` has x, label, rid, low and high; window k of an anchor takes the
    scores from low[k] to high[k]. ``same`` asks for rows of the anchor's label
    but itself, else for rows of another label. Ids are compared as given; the
    null id has the largest number.
    """
    q, label, low, high = block["x"], block["label"], block["low"].copy(), block["high"]
    a_count, slots = low.shape
    found = tuple(np.zeros(0, np.int64) for _ in range(5))
    anchor, node = np.arange(a_count), np.zeros(a_count, np.int64)
    lo, hi = bounds(q, largest, tree.centre[node], tree.radius[node])
    floor = low.astype(np.float64)
    ceiling = high.astype(np.float64)

    def wanted(anchor: np.ndarray, node: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        at = (hi[:, None] >= floor[anchor]) & (lo[:, None] <= ceiling[anchor]) & (low <= high)[anchor]
        mine = label[anchor]
        fits = (tree.low[node] <= mine) & (mine <= tree.high[node]) if same else (tree.low[node] != mine) | (tree.high[node] != mine)
        return at.any(axis=1) & fits

    while len(anchor):
        on = wanted(anchor, node, lo, hi)
        anchor, node, lo, hi = anchor[on], node[on], lo[on], hi[on]
        if not len(anchor):
            break
        order = np.lexsort((node, -hi, anchor))
        start = np.flatnonzero(np.diff(anchor[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        opened, rest = order[rank < WIDE], order[rank >= WIDE]
        new_anchor, new_node = [anchor[rest]], [node[rest]]
        new_lo, new_hi = [lo[rest]], [hi[rest]]
        add: list[tuple[np.ndarray, ...]] = [found]
        o_anchor, o_node = anchor[opened], node[opened]
        by = np.argsort(o_node, kind="stable")
        groups = np.flatnonzero(np.diff(o_node[by], prepend=-1))
        for s, e in zip(groups, [*groups[1:], len(by)], strict=True):
            n, who = int(o_node[by[s]]), o_anchor[by[s:e]]
            first, end = tree.child[n]
            if first >= 0:
                kids = np.arange(first, end)
                pa_, pn = np.repeat(who, len(kids)), np.tile(kids, len(who))
                l2, h2 = bounds(q[pa_], largest, tree.centre[pn], tree.radius[pn])
                new_anchor.append(pa_), new_node.append(pn), new_lo.append(l2), new_hi.append(h2)
                continue
            rows = tree.leaves[end]
            score = products(tree.x[rows], q[who])
            fits = (tree.label[rows][:, None] == label[who][None, :]) == same
            if same:
                fits &= rid[rows][:, None] != block["rid"][who][None, :]
            for k in range(slots):
                r, w = np.nonzero(fits & (score >= low[who, k][None, :]) & (score <= high[who, k][None, :]))
                add.append((who[w], np.full(len(w), k), score[r, w], vec[rows[r]], rid[rows[r]]))
        if len(add) > 1:
            found = tuple(np.concatenate(x) for x in zip(*add, strict=True))
            at = _best(*found, keep)
            found = tuple(x[at] for x in found)
            full = np.zeros((a_count, slots), np.int64)
            np.add.at(full, (found[0], found[1]), 1)
            worst = np.full((a_count, slots), LONG - 1, np.int64)
            np.minimum.at(worst, (found[0], found[1]), found[2])
            low = np.where(full >= keep, np.maximum(low, worst), low)
            floor = low.astype(np.float64)
        anchor, node = np.concatenate(new_anchor), np.concatenate(new_node)
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
    return found


def _walk(points: np.ndarray) -> np.ndarray:
    """An order of ``points`` in which a cover tree visits them, so that neighbours follow one another."""
    if not len(points):
        return np.zeros(0, np.int64)
    out: list[int] = []
    todo = [(np.arange(len(points)), float(np.linalg.norm(points - points[0], axis=1).max()))]
    while todo:
        rows, level = todo.pop()
        if len(rows) <= 2 or level <= 1e-9:
            out += rows.tolist()
            continue
        parts, left = [], rows
        while len(left):
            near = np.linalg.norm(points[left] - points[left[0]], axis=1) <= level / SHRINK
            parts.append((left[near], level / SHRINK))
            left = left[~near]
        todo += parts[::-1]
    return np.array(out)


def _runs(sizes: dict[int, int], most: int) -> tuple[list[int], list[int]]:
    """For each cell 0 to PIVOTS - 1, the first and last of the runs of about ``most`` rows that its rows are dealt to."""
    first, last, before = [], [], 0
    for cell in range(PIVOTS):
        size = sizes.get(cell, 0)
        first.append(before // most)
        last.append(max(before + size - 1, before) // most)
        before += size
    return first, last


def _dealt(cell: Column, rid: Column, runs: tuple[list[int], list[int]]) -> Column:
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), cell + 1)
    return (at(runs[0]) + F.pmod(F.xxhash64(rid), at(runs[1]) - at(runs[0]) + 1)).cast("int")


def _packed(rows: DataFrame, group: str, extra: list[str]) -> DataFrame:
    """One row for each group, its rows pickled as arrays; a group is of bounded size."""

    def pack(table: pa.Table) -> pa.Table:
        data = {c: table.column(c).to_numpy() for c in ("rid", "vec", "label")}
        data |= {c: np.array(table.column(c).to_pylist(), np.int64).reshape(len(table), -1) for c in extra}
        data["x"] = [np.frombuffer(b, np.float64) for b in table.column("x").to_pylist()]
        return pa.table({group: table.column(group)[:1], "data": pa.array([pickle.dumps(data)], pa.binary())})

    return rows.groupBy(group).applyInArrow(pack, f"{group} int, data binary")


def _wide(x: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(x), width))
    for i, row in enumerate(x):
        out[i, : len(row)] = row
    return out


def _grown(trees: DataFrame, width: int, largest: float) -> DataFrame:
    """(tree, data, root): each packed group as a pickled cover tree, and what its root needs for bounds."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = pickle.loads(batch.column("data")[i].as_py())
                tree = CoverTree(_wide(data["x"], width), data["label"], largest)
                root = pickle.dumps((tree.centre[0], tree.radius[0], tree.low[0], tree.high[0]))
                yield pa.RecordBatch.from_arrays([batch.column("tree").slice(i, 1), pa.array([pickle.dumps((tree, data["vec"], data["rid"]))], pa.binary()), pa.array([root], pa.binary())], ["tree", "data", "root"])

    return trees.mapInArrow(grow, "tree int, data binary, root binary")


def _searched(blocks: DataFrame, trees: DataFrame, roots: list[tuple], pairs: str, width: int, largest: float, keep: int, same: bool) -> DataFrame:
    """(anchor, slot, score, vec, rid): what :func:`search` finds in each tree that a block needs.

    ``pairs``: "home" takes the tree of the block's own cells, "away" all others
    and "all" every one. ``roots`` has the bounds of all trees by number, or
    only None for each where there are too many to send.
    """
    spread = blocks.sparkSession.sparkContext.broadcast(roots)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = pickle.loads(batch.column("data")[i].as_py())
                q, low, high = _wide(data["x"], width), data["low"], data["high"]
                home = np.unique(data["home"])
                needed = []
                for no, root in enumerate(spread.value):
                    if pairs != "all" and (no in home) != (pairs == "home"):
                        continue
                    if root is not None:
                        lo, hi = bounds(q, largest, np.broadcast_to(root[0], (len(q), width + 1)), np.full(len(q), root[1]))
                        mine = data["label"]
                        fits = (root[2] <= mine) & (mine <= root[3]) if same else (root[2] != mine) | (root[3] != mine)
                        if not (((hi[:, None] >= low) & (lo[:, None] <= high) & (low <= high)).any(axis=1) & fits).any():
                            continue
                    needed.append(no)
                yield pa.RecordBatch.from_arrays([pa.array(needed, pa.int32()), pa.array([batch.column("block")[i].as_py()] * len(needed), pa.int32())], ["tree", "block"])

    chosen = cut(blocks.mapInArrow(choose, "tree int, block int"))
    left = chosen.join(blocks, "block").select("tree", "block", F.lit(False).alias("is_tree"), "data")
    right = chosen.join(trees, "tree").select("tree", "block", F.lit(True).alias("is_tree"), "data")

    def run(group: pa.Table) -> pa.Table:
        tree_row, block_row = (group.filter(pa.array([t == side for t in group.column("is_tree").to_pylist()])).column("data")[0].as_py() for side in (True, False))
        tree, vec, rid = pickle.loads(tree_row)
        block = pickle.loads(block_row)
        block["x"] = _wide(block["x"], width)
        a, slot, score, v, r = search(tree, vec, rid, largest, block, keep, same)
        return pa.table({"anchor": pa.array(block["rid"][a], pa.int64()), "slot": pa.array(slot, pa.int32()), "score": pa.array(score, pa.int64()), "vec": pa.array(v, pa.int64()), "rid": pa.array(r, pa.int64())})

    return left.unionByName(right).groupBy("tree", "block").applyInArrow(run, "anchor long, slot int, score long, vec long, rid long")


def _first(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(vectors: DataFrame, anchors: Column, *, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", keep: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchors`` is true.

    Entries become whole numbers floor(256 * c); a score is the inner product of
    two rows. An anchor's positives are its ``keep`` best other rows of the same
    label, and each has the ``keep`` best rows of other labels whose score is
    from 80 to 100 hundredths of the positive's. Ties go to the smaller key.
    ``anchors`` and ``label`` are expressions over ``vectors``.

    Cases: rows with a null label, a null vector, or a null, NaN or infinite
    entry take no part; of vectors of unlike lengths the shorter counts as
    ending in zeros; rows with one key are rows of their own, and so are equal
    rows; a null key comes after all others in ties and is returned as null (so is the largest long); a
    negative positive score has no negatives; scores beyond a long are clipped
    to it; without anchors, positives or negatives nothing is returned; other
    columns are ignored, whatever their names.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    named = vectors.select(F.coalesce(F.col(key).cast("long"), F.lit(LONG - 1)).alias("vec"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asks"), F.col(vector).alias("v"), F.col(key).isNull().alias("no_key"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch.column("v").to_pylist())
            kept = pa.array([v is not None for v in x], pa.bool_())
            some = batch.filter(kept).select(["vec", "label", "asks", "no_key"])
            x = [v for v in x if v is not None]
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array([v.tobytes() for v in x], pa.binary()), pa.array([len(v) for v in x], pa.int32()), pa.array([float(np.sqrt(v @ v)) for v in x], pa.float64())], ["vec", "label", "asks", "no_key", "x", "size", "norm"])

    rows = named.where(F.col("label").isNotNull() & F.col("v").isNotNull()).mapInArrow(prepare, "vec long, label long, asks boolean, no_key boolean, x binary, size int, norm double")
    # stored, so that a row keeps its number however often it is read
    rows = cut(rows.withColumn("rid", F.monotonically_increasing_id()))
    count, width, largest = rows.agg(F.count(F.lit(1)), F.max("size"), F.max("norm")).first()
    if not count or not width:
        width, largest = max(width or 0, 1), largest or 0.0
    largest *= 1 + 1e-12
    sample = rows.orderBy(F.xxhash64("x", "rid"), "rid").limit(PIVOTS).select("x").collect()
    points = lifted(_wide([np.frombuffer(r["x"], np.float64) for r in sample], width), largest)
    pivots = spark.sparkContext.broadcast(points[_walk(points)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 4096):
                batch = whole_batch.slice(at, 4096)
                up = lifted(_rows(batch.column("x"), width), largest)
                away = (p * p).sum(axis=1)[None, :] - 2 * up @ p.T
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(away.argmin(axis=1).astype(np.int32))], [*batch.schema.names, "cell"])

    names = "vec long, label long, asks boolean, no_key boolean, x binary, rid long, cell int"
    placed = cut(rows.select("vec", "label", "asks", "no_key", "x", "rid").mapInArrow(place, names))
    sizes = {r["cell"]: (r["n"], r["a"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("a")).collect()}
    most = min(max(count // 64, TREE_ROWS[0]), TREE_ROWS[1])
    tree_runs = _runs({c: n for c, (n, _) in sizes.items()}, most)
    tree_of = _dealt(F.col("cell"), F.col("rid"), tree_runs)
    block_of = _dealt(F.col("cell"), F.col("rid"), _runs({c: a for c, (_, a) in sizes.items()}, BLOCK_ROWS))

    trees = cut(_grown(_packed(placed.select("rid", "vec", "label", "x", tree_of.alias("tree")), "tree", []), width, largest))
    last = (trees.agg(F.max("tree")).first()[0] or 0) + 1 if count else 0
    if trees.count() <= ROOTS:
        roots: list = [(np.zeros(width + 1), -1e300, 1, 0)] * last  # a number without a tree is met by nothing
        for r in trees.select("tree", "root").collect():
            roots[r["tree"]] = pickle.loads(r["root"])
    else:
        roots = [None] * last

    asking = cut(placed.where("asks").select("rid", "vec", "no_key", "label", "x", tree_of.alias("home"), block_of.alias("block")))
    open_window = asking.withColumn("low", F.array(F.lit(-LONG))).withColumn("high", F.array(F.lit(LONG - 1)))
    fields = ["low", "high", "home"]
    blocks = cut(_packed(open_window, "block", fields))
    at_home = cut(_searched(blocks, trees, roots, "home", width, largest, keep, True))
    # what is found at home bounds from below what other trees must offer
    least = _first(at_home, keep).groupBy("anchor").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= keep).select(F.col("anchor").alias("rid"), "worst")
    bounded = asking.join(least, "rid", "left").withColumn("low", F.array(F.coalesce("worst", F.lit(-LONG)))).withColumn("high", F.array(F.lit(LONG - 1))).drop("worst")
    away = _searched(cut(_packed(bounded, "block", fields)), trees, roots, "away", width, largest, keep, True)
    positives = cut(_first(at_home.unionByName(away), keep).select("anchor", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec").alias("positive"), F.col("score").alias("positive_score")))

    by_anchor = positives.groupBy(F.col("anchor").alias("rid")).agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("p"))
    score = lambda i: F.get("p", F.lit(i))["positive_score"]
    # the window of p is from p - floor(p / 5) to p; a negative or missing score has one that nothing fits
    low = F.array(*(F.when(score(i) >= 0, F.expr(f"get(p, {i}).positive_score - get(p, {i}).positive_score div 5")).otherwise(F.lit(1).cast("long")) for i in range(keep)))
    high = F.array(*(F.greatest(F.coalesce(score(i), F.lit(0).cast("long")), F.lit(0).cast("long")) for i in range(keep)))
    asked = asking.join(by_anchor, "rid").withColumn("low", low).withColumn("high", high).drop("p")
    found = _searched(cut(_packed(asked, "block", fields)), trees, roots, "all", width, largest, keep, False)
    negatives = _first(found, keep).select("anchor", "slot", "rank", F.col("vec").alias("negative"), F.col("score").alias("negative_score"))
    ids = asking.select(F.col("rid").alias("anchor"), F.when(~F.col("no_key"), F.col("vec")).alias("anchor_id"))
    shown = lambda c: F.when(F.col(c) != LONG - 1, F.col(c))
    out = negatives.join(positives, ["anchor", "slot"]).join(ids, "anchor")
    out = out.select("anchor_id", shown("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), shown("negative").alias("negative_id"), "positive_score", "negative_score")
    return out.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")))
