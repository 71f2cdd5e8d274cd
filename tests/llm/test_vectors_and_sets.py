import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbspark.llm import hard_negatives, set_join, whitening
from kerbspark.llm.common import bit_table, in_bit_table

VECTORS = "vec_id long, embedding array<float>, label int"


def words(text):
    out, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            out, word = out + [word], ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return [w for w in [*out, word] if w]


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute_components(rows, percent):
    """{doc: component} over (doc, text) rows; rows of one id are one document."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    sets = [(d, s) for d, s in sets if s]
    lead = {d: d for d, _ in rows}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    by = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, (d, s) in enumerate(sets):
        count = {}
        for x in s:
            for j in by[x]:
                if j > i:
                    count[j] = count.get(j, 0) + 1
        for j, both in count.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = sorted((find(d), find(sets[j][0])))
                lead[b] = a
    return {d: find(d) for d in lead if d is not None}


def joined(spark, rows, percent=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in set_join.similar_sets(docs, percent=percent).collect()}


def edited(rng, base, share):
    return " ".join(f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in base)


@pytest.mark.parametrize("percent", [80, 60])
def test_join_finds_every_component(spark, percent):
    rng = random.Random(3)
    rows, doc = [], 0

    def add(text):
        nonlocal doc
        doc += 1
        rows.append((doc * 37 % 10007, text))

    for size in (5, 6, 8, 9, 12, 30, 60, 400):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            for share in (0, 0, 0.01, 0.02, 0.03, 0.05):
                add(edited(rng, base, share))
            for cut in range(1, 4):  # of nearly the same size, near the threshold
                add(" ".join(base[cut:]))
                add(" ".join(base[: max(1, len(base) - cut * size // 15)]))
    assert joined(spark, rows, percent) == brute_components(rows, percent)


def test_join_of_a_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, edited(rng, base, rng.choice((0.0, 0.01, 0.02, 0.03)))) for i in range(300)]
    got = joined(spark, rows)
    assert got == brute_components(rows, 80)
    assert len(set(got.values())) > 3


def test_near_copies_give_no_more_links_than_documents(spark, monkeypatch):
    """Pairs that parity tables allow, and links, grow with the square of a group; rows between steps do not."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, edited(rng, base, rng.choice((0.01, 0.02, 0.03)))) for i in range(300)] + [(5, ""), (6, edited(rng, base, 0.02))]
    found, apart = [], set_join._apart

    def watched(*args):
        out = apart(*args)
        found.append(out.count())
        return out

    monkeypatch.setattr(set_join, "_apart", watched)
    assert joined(spark, rows) == brute_components(rows, 80)
    assert 0 < found[0] < 300


def test_documents_of_one_frame_are_not_compared_by_pairs(spark, monkeypatch):
    """A common passage and words of their own: similarity below the threshold, or above it by sizes alone."""
    rng = random.Random(5)
    frame = [f"f{i}" for i in range(160)]
    own = lambda n: [f"o{rng.randrange(10**9)}" for _ in range(n)]
    rows = [(i, " ".join(frame + own(50))) for i in range(200)] + [(1000 + i, " ".join(frame + own(3 + i % 30))) for i in range(60)]
    seen = []
    apart = set_join._apart

    def watched(near, *rest):
        seen.append(near.count())
        return apart(near, *rest)

    monkeypatch.setattr(set_join, "_apart", watched)
    got = joined(spark, rows)
    assert got == brute_components(rows, 80)
    assert seen[0] == 0


def test_keys_keep_the_promise_of_the_prefix():
    """Two sets at the threshold share a key, whatever the boundary between small and large is."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        small = int(rng.integers(0, 80))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            ka, kb = (set_join.keys_of(s, len(s), small, 80)[0] for s in (a, b))
            assert len(np.intersect1d(ka, kb)), (len(a), len(b), small)


def test_join_of_odd_rows(spark, docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    odd = docs.withColumn("doc", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("class_id", F.lit(0)).withColumn("n", F.lit(2))
    got = set_join.similar_sets(odd).collect()
    assert len(got) == len(rows)
    want = brute_components(rows, 80)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])
    assert sorted((r["doc_id"] or -1, r["n_shingles"]) for r in got) == sorted((d or -1, len(shingles(t))) for d, t in rows)
    assert set_join.similar_sets(empty).collect() == []


def test_bit_table_is_packed(spark):
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 2000)
    table = bit_table(spark.createDataFrame([(int(x),) for x in h], "h long"), "h", 21)
    assert len(table) == 1 << 18
    assert in_bit_table(table, 21, h.view(np.uint64)).all()
    assert np.unpackbits(np.frombuffer(table, np.uint8)).sum() == len(set((h.view(np.uint64) >> np.uint64(43)).tolist()))


def brute_negatives(rows, keep=5):
    """rows: (vec_id, vector, label), vectors as given; anchors are ids divisible by 100."""
    good = []
    for no, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            good.append((no, i, [int(np.floor(float(c) * 256)) for c in v], label))
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for no, i, v, label in good:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m, k) for k, j, w, m in good]
        positives = sorted((s for s in scored if s[2] == label and s[3] != no), key=order)[:keep]
        others = sorted((s for s in scored if s[2] != label), key=order)
        for p in positives:
            fits = [s for s in others if 80 * p[0] <= 100 * s[0] <= 100 * p[0]][:keep]
            out += [(i, p[1], rank + 1, s[1], p[0], s[0]) for rank, s in enumerate(fits)]
    return sorted(out, key=str)


def mined(df):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect()), key=str)


@pytest.mark.parametrize("shape", ["loose", "crowded", "small"])
def test_negatives_match_brute_force(spark, shape, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", (150, 1000))
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    monkeypatch.setattr(hard_negatives, "PIVOTS", 20)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(7)
    n, d = 1200, 6
    x = rng.normal(size=(n, d)) * rng.choice([0.2, 1.0, 3.0], n)[:, None]
    if shape == "crowded":  # a third in one spot, many of them equal
        x[: n // 3] = np.round(rng.normal(size=(n // 3, d)) * 0.02 + 1, 2)
    if shape == "small":
        x = np.round(x * 2 / 256) / 2  # many ties
    rows = [(int(i), [float(c) for c in np.float32(v)], int(label)) for i, v, label in zip(rng.permutation(n), x, rng.integers(0, 4, n))]
    assert mined(spark.createDataFrame(rows, VECTORS).repartition(5)) == brute_negatives(rows)


def test_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(np.float32(c)) for c in rng.normal(size=4)], int(i) % 3) for i in range(200)]
    rows += [(100, [1.0, 0.5, 0.0, 0.0], 1), (100, [1.0, 0.5, 0.0, 0.0], 1), (None, [1.0, 0.5, 0.0, 0.0], 1), (None, [0.9, 0.5, 0.0, 0.0], 2)]
    rows += [(300, None, 1), (301, [1.0, None, 0.0, 0.0], 1), (302, [float("nan")] * 4, 1), (303, [float("inf")] * 4, 2), (400, [1.0] * 4, None)]
    assert mined(spark.createDataFrame(rows, VECTORS)) == brute_negatives(rows)
    short = rows[:50] + [(500, [1.0, 0.5], 1), (501, [], 2)]
    padded = [(i, None if v is None else v + [0.0] * (4 - len(v)), label) for i, v, label in short]
    assert mined(spark.createDataFrame(short, VECTORS)) == brute_negatives(padded)
    clash = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("?") for c in ("rid", "cell", "asks", "x", "size", "vec", "v")})
    assert mined(clash) == brute_negatives(rows)
    assert mined(spark.createDataFrame([], VECTORS)) == []
    assert mined(spark.createDataFrame(rows[:1], VECTORS)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], VECTORS)) == []


def test_scores_beyond_doubles_are_exact():
    x = np.array([[2.0**40, 1.0], [2.0**40, 0.0]])
    assert hard_negatives.products(x, np.array([[2.0**15, 1.0]]))[:, 0].tolist() == [2**55 + 1, 2**55]
    assert hard_negatives.products(x, np.array([[2.0**80, 1.0]]))[:, 0].tolist() == [2**63 - 1] * 2


def test_search_skips_most_of_a_tree_that_is_far_away():
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(40, 5)) * 4000
    x = np.floor(np.repeat(middles, 100, axis=0) + rng.normal(size=(4000, 5)) * 20)
    largest = float(np.linalg.norm(x, axis=1).max()) * 1.01
    tree = hard_negatives.CoverTree(x, np.zeros(len(x), np.int64), largest)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(x)))
    opened = []
    leaves = tree.leaves
    tree.leaves = type("Watched", (), {"__getitem__": lambda self, i: opened.append(len(leaves[i])) or leaves[i]})()
    q = np.floor(x[:1])
    block = {"x": q, "label": np.zeros(1, np.int64), "rid": np.array([-1]), "low": np.array([[-(2**62)]]), "high": np.array([[2**62]])}
    found = hard_negatives.search(tree, np.arange(4000), np.arange(4000), largest, block, 5, True)
    assert found[4].tolist() == np.lexsort((np.arange(4000), -(x @ q[0])))[:5].tolist()
    assert sum(opened) < 1500


def brute_whitening(rows, count=4):
    good = [(i, [int(np.floor(float(c) * 256)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    good = [(i, v + [0] * (width - len(v))) for i, v in good]
    u = np.array(sorted({tuple(v) for _, v in good}), float)
    n, s = len(u), u.sum(axis=0)
    c = u - s / n
    cov = c.T @ c / n
    e, axes = np.linalg.eigh(cov)
    return good, n, [int(v) for v in s], e[::-1], axes[:, ::-1]


def whitened(df):
    out = {}
    for r in whitening.whiten(df).collect():
        out.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    return out


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(10)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=7) * np.geomspace(3, 0.05, 7)]) for i in range(300)]
    rows += [(1000 + i, v) for i, v in rows[:40]] + [(2000, None), (2001, [None] * 7), (2002, [float("nan")] * 7), (2003, [float("inf")] * 7)]
    got = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("id", F.lit(2)).withColumn("n", F.lit(3)).repartition(7))
    good, n, s, e, axes = brute_whitening(rows)
    assert set(got) == {i for i, _ in good} and n == 300
    for k in range(4):
        ours = np.array([got[i][k + 1][0]["whitened"] for i, _ in good])
        want = np.array([(np.array(v) - np.array(s) / n) @ axes[:, k] / np.sqrt(e[k]) for _, v in good])
        assert min(np.abs(ours - want).max(), np.abs(ours + want).max()) < 1e-9
    for i, v in good:
        r = got[i][1][0]
        assert r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(v, s))
        assert r["explained"] == pytest.approx(e[0] / e.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<double>"
    make = lambda rows: spark.createDataFrame(rows, schema)
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, None), (2, [float("nan")])])).collect() == []
    one = whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 1 for r in one)
    flat = whitening.whiten(make([(1, [1.0, 2.0, 0.0]), (None, [3.0, 2.0, 0.0]), (None, [3.0, 2.0]), (3, [3.0, 2.0, 0.0, 0.0])])).collect()
    assert len(flat) == 16 and {r["n"] for r in flat} == {2}
    assert sorted(abs(r["whitened"]) for r in flat if r["component"] == 1) == pytest.approx([1.0] * 4)
    assert all(r["whitened"] is None for r in flat if r["component"] > 1)
    huge = whitening.whiten(make([(1, [1e15, 0.0]), (2, [0.0, 1e15]), (3, [0.0, 0.0])])).collect()
    assert all(r["deviation"] is None for r in huge if r["vec_id"] in (1, 2))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 70])
def test_qd_solver(n):
    rng = np.random.default_rng(n)
    cases = [rng.normal(size=(n, n)) * np.geomspace(1, 10.0 ** -rng.integers(0, 9), n), np.eye(n), np.zeros((n, n)), np.ones((n, n))]
    twin = np.linalg.qr(rng.normal(size=(n, n)))[0] * np.concatenate([np.full(n - n // 2, 2.0), np.full(n // 2, 1.0)])
    for a in [*cases, twin, cases[0][:, ::-1]]:
        r = np.linalg.qr(a, mode="r")
        diagonal, upper, v = whitening.bidiagonal(r)
        values = whitening.singular_values(diagonal, upper)
        want = np.linalg.svd(a, compute_uv=False)
        assert np.abs(values - want).max() <= 1e-13 * max(want[0], 1e-300) * n
        count = min(4, n)
        top, axes, total = whitening.directions(r, count)
        assert np.abs(axes.T @ axes - np.eye(count)).max() < 1e-12
        assert np.abs(a.T @ (a @ axes) - axes * top**2).max() <= 1e-12 * max(want[0], 1e-300) ** 2 * n


def test_small_singular_values_keep_their_digits():
    """A graded bidiagonal: dqds finds values twelve orders apart to full relative accuracy."""
    diagonal, upper = np.geomspace(1, 1e-12, 9), np.geomspace(1, 1e-12, 9)[1:] * 0.5
    got = whitening.singular_values(diagonal, upper)
    assert abs(np.prod(got / diagonal) - 1) < 1e-10  # the determinant


def test_triangles_fold_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "QR_ROWS", 5)
    x = np.random.default_rng(2).integers(-500, 500, size=(60, 3))
    rows = spark.createDataFrame([([int(c) for c in v],) for v in x], "x array<long>").repartition(9)
    s = [int(v) for v in x.sum(axis=0)]
    r = whitening.triangle(rows, 60, s)
    c = x - np.array(s) / 60
    assert np.allclose(r.T @ r, c.T @ c)


def test_pairs_of_sizes_are_few():
    """Subsets are posted while they cost less than scans."""
    assert set_join.boundary(1.0, 80) < set_join.boundary(2.0, 80) <= set_join.LARGEST_SMALL
    assert all(set_join.prefix_length(n, 80) == n - -(-80 * n // 100) + 1 for n in range(1, 300))
    assert len(list(combinations(range(set_join.prefix_length(set_join.LARGEST_SMALL, 80) + 1), 2))) < 1500
