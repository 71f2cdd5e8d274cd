"""Golden segmentations of one curb from 1 to 100, and properties of the interval operators."""

import pytest

from pyspark.sql import functions as F

from kerbspark.operators import assets, curbs, intervals, segments

# assets: kind and position (meters are pairs; those at one position share its location); expected: [from, to] and numbers of upstream and downstream locations
CASES = {
    0: ("S20", [(1, 20, 0, 1), (20, 100, 1, 0)]),
    1: ("S30 S60", [(1, 30, 0, 1), (30, 60, 1, 1), (60, 100, 1, 0)]),
    2: ("S60 S80", [(1, 60, 0, 1), (60, 80, 1, 1), (80, 100, 1, 0)]),
    3: ("H50 S80", [(1, 40, 0, 1), (40, 60, 1, 1), (60, 80, 1, 1), (80, 100, 1, 0)]),
    4: ("H75 S80", [(1, 65, 0, 1), (65, 80, 1, 1), (80, 85, 1, 1), (85, 100, 1, 0)]),
    5: ("M2 M100", [(1, 100, 1, 1)]),
    6: ("M2 M50 M50 M60 M60 M100", [(1, 50, 1, 1), (50, 60, 1, 1), (60, 100, 1, 1)]),
    7: ("M2 M100 S60 S80", [(1, 60, 1, 1), (60, 80, 1, 1), (80, 100, 1, 1)]),
    8: ("M2 M100 H75 S60", [(1, 60, 1, 1), (60, 65, 1, 1), (65, 85, 1, 1), (85, 100, 1, 1)]),
    9: ("S2 S75 H73 H100", [(1, 63, 1, 1), (63, 75, 1, 1), (75, 83, 1, 1), (83, 90, 1, 1), (90, 100, 1, 1)]),
    10: ("S2 S75 S73 S100", [(1, 75, 1, 2), (75, 100, 2, 1)]),
    11: ("S2 S3 S98 S99", [(1, 100, 2, 2)]),
}


def test_golden_segmentations(spark):
    faces, placed = [], {"H": [], "S": [], "M": []}
    for case, (text, _) in CASES.items():
        faces.append((f"c{case:02d}", 1.0, 100.0))
        for a in sorted(set(text.split())):
            placed[a[0]].append((f"c{case:02d}", float(a[1:]), f"{case:02d}-{a}"))
    kind = "blockface_id string, at double, point_id string"
    made = segments.segment_curbs(spark.createDataFrame(faces, "blockface_id string, lo double, hi double"), *[spark.createDataFrame(placed[k], kind) for k in "HSM"])
    got = {}
    for r in made.orderBy("blockface_id", "segment_seq").collect():
        got.setdefault(r["blockface_id"], []).append((round(r["lo"], 5), round(r["hi"], 5), len(r["upstream_loc_list"] or []), len(r["downstream_loc_list"] or [])))
    wrong = {c: (got.get(f"c{c:02d}"), want) for c, (_, want) in CASES.items() if got.get(f"c{c:02d}") != want}
    assert not wrong


#: Points of the merged lines where they are more than the ends.
VERTICES = {5: [(1, 2, 100, 100)], 11: [(1, 2, 3, 98, 99, 100)]}


def test_golden_segmentations_on_lines(spark):
    """The same cases from curb lines and points beside them: a curb for each case, far from the others."""
    faces, placed = [], {"H": [], "S": [], "M": []}
    for case, (text, _) in CASES.items():
        y = 2_900_000.0 + 1000 * case
        faces.append((f"c{case:02d}", [(750_001.0, y), (750_100.0, y)]))
        for a in sorted(set(text.split())):
            placed[a[0]].append((f"{case:02d}-{a}", 750_000.0 + float(a[1:]), y + 2))
        placed["S"].append((f"{case:02d}-far", 750_050.0, y + 31))
    kind = "point_id string, x double, y double"
    made = segments.segment_lines(spark.createDataFrame(faces, "blockface_id string, line array<struct<x:double,y:double>>"), *[spark.createDataFrame(placed[k], kind) for k in "HSM"])
    got, points = {}, {}
    for r in made.orderBy("blockface_id", "segment_seq").collect():
        xs = [p["x"] - 750_000 for p in r["line"]]
        got.setdefault(r["blockface_id"], []).append((round(xs[0], 5), round(xs[-1], 5), len(r["upstream_loc_list"] or []), len(r["downstream_loc_list"] or [])))
        points.setdefault(r["blockface_id"], []).append(tuple(round(x, 5) for x in xs))
        assert abs(r["seg_length"] - (xs[-1] - xs[0])) < 0.02
    assert not {c: (got.get(f"c{c:02d}"), want) for c, (_, want) in CASES.items() if got.get(f"c{c:02d}") != want}
    for case, want in VERTICES.items():
        assert points[f"c{case:02d}"] == want


def test_pieces_of_a_bent_line(spark):
    from kerbspark.operators import spatial

    line = spark.createDataFrame([("a", [(0.0, 0.0), (30.0, 0.0), (30.0, 40.0)])], "id string, line array<struct<x:double,y:double>>")
    parts = spark.createDataFrame([("a", lo, hi) for lo, hi in ((0.0, 10.0), (10.0, 30.0), (30.0, 30.0), (30.0, 70.0), (20.0, 50.0), (70.0, 70.0))], "line_id string, lo double, hi double")
    got = {(r["lo"], r["hi"]): [tuple(p) for p in r["line"]] for r in curbs.piece_lines(spatial.edge_table(line, "id", "line"), parts).collect()}
    assert got == {(0, 10): [(0, 0), (10, 0)], (10, 30): [(10, 0), (30, 0)], (30, 30): [(30, 0), (30, 0)], (30, 70): [(30, 0), (30, 40)], (20, 50): [(20, 0), (30, 0), (30, 20)], (70, 70): [(30, 40), (30, 40)]}


def test_curbs_without_assets_pass_through(spark):
    none = spark.createDataFrame([], "blockface_id string, at double, point_id string")
    made = segments.segment_curbs(spark.createDataFrame([("a", 0.0, 50.0)], "blockface_id string, lo double, hi double"), none, none, none).collect()
    assert [(r["lo"], r["hi"]) for r in made] == [(0.0, 50.0)]


def test_bus_stops_cut_first_and_pieces_sort_by_number(spark):
    kind = "blockface_id string, at double, point_id string"
    none = spark.createDataFrame([], kind)
    face = spark.createDataFrame([("a", 0.0, 400.0), ("b", 0.0, 1000.0)], "blockface_id string, lo double, hi double")
    # near side: the zone lies before the stop; far side: after it; the middle one is cut by a hydrant too
    stops = spark.createDataFrame([("a", 300.0, "s1"), ("a", 20.0, "s2"), ("b", 400.0, "s3")], kind)
    signs = spark.createDataFrame([("b", 10.0 * i, f"p{i:02d}") for i in range(1, 13)], kind)
    made = segments.segment_curbs(face, spark.createDataFrame([("b", 360.0, "h1")], kind), signs, none, stops).orderBy("blockface_id", "segment_seq").collect()
    assert [(r["lo"], r["hi"], r["upstream_location"], r["downstream_location"]) for r in made if r["blockface_id"] == "a"] == [(0.0, 20.0, None, "s2"), (20.0, 95.0, "s2", "s2"), (95.0, 225.0, "s2", "s1"), (225.0, 300.0, "s1", "s1"), (300.0, 400.0, "s1", None)]
    b = [(r["lo"], r["hi"], r["segment_seq"]) for r in made if r["blockface_id"] == "b"]
    assert [x[2] for x in b] == list(range(len(b))) and [x[0] for x in b] == sorted(x[0] for x in b) and b[0][0] == 0 and b[-1][1] == 1000
    assert [x[0] for x in b][12:] == [120.0, 325.0, 350.0, 370.0, 400.0]


def test_ids_sort_by_their_numbers(spark):
    ids = ["b:BS1:FH1:PS10:PM1", "b:BS1:FH1:PS2:PM2", "b:BS2:FH1:PS1:PM1", "b:BS1:FH1:PS2:PM10", "b:BS10:FH1:PS1:PM1"]
    got = spark.createDataFrame([(x,) for x in ids], "id string").orderBy(segments.id_order(F.col("id"))).collect()
    assert [r["id"] for r in got] == [ids[i] for i in (1, 3, 0, 2, 4)]


def test_assets_are_loaded_once_for_each_location(spark):
    places = spark.createDataFrame([(1, 5.0, "j"), (2, 6.0, "j"), (3, 7.0, "old"), (4, 8.0, "j"), (4, 8.0, "j")], "asset_location_id long, x double, job_id string")
    meters = spark.createDataFrame([(10, 1, 2), (11, 2, 4), (12, 3, None)], "meter_policy_id long, start_asset_location_id long, end_asset_location_id long")
    assert sorted((r["point_id"], r["x"]) for r in assets.meters(meters, places, job_id="j").collect()) == [(1, 5.0), (2, 6.0), (4, 8.0)]
    signs = spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 2, "2024-01-01"), (4, None, None)], "sign_id long, sign_location_id long, sign_removed_date string")
    assert [r["point_id"] for r in assets.active_signs(signs, places, job_id="j").collect()] == [1]
    features = spark.createDataFrame([(1, 4, "fire_hydrant"), (2, 2, "bus_stop")], "feature_id long, feature_location long, feature_type string")
    assert [r["point_id"] for r in assets.features(features, places, "fire_hydrant", job_id="j").collect()] == [4]
    with pytest.raises(ValueError):
        assets.meters(meters, places, job_id="")


def test_remainder_and_pieces_cover_the_line(spark):
    lines = spark.createDataFrame([(1, 0.0, 100.0), (2, 0.0, 10.0)], "id int, lo double, hi double")
    removed = spark.createDataFrame([(1, -5.0, 10.0), (1, 5.0, 20.0), (1, 50.0, 60.0), (1, 55.0, 58.0), (2, 0.0, 10.0)], "id int, lo double, hi double")
    assert sorted((r["id"], r["lo"], r["hi"]) for r in intervals.remainder(lines, removed, "id").collect()) == [(1, 20.0, 50.0), (1, 60.0, 100.0)]
    points = spark.createDataFrame([(1, 0.25, 1), (1, 0.75, 2), (1, 0.3, 3)], "curb int, fraction double, point_id int").selectExpr("*", "100.0D AS length_ft")
    cut = intervals.pieces(intervals.boundaries(intervals.buffers(points, 10.0), "curb"), "curb").collect()
    assert abs(sum(r["end_fraction"] - r["start_fraction"] for r in cut) - 1) < 1e-12


def test_overlapping_buffers_give_one_envelope(spark):
    b = spark.createDataFrame([(1, 0.1, 0.3), (1, 0.2, 0.4), (1, 0.6, 0.7)], "k int, start_fraction double, end_fraction double")
    assert [tuple(r) for r in intervals.envelopes(b, "k").collect()] == [(1, 0.2, 0.3, 0.1, 0.4)]
    assert intervals.boundaries(b, "k").first()["cuts"] == [0.0, 0.1, 0.4, 0.6, 0.7, 1.0]


@pytest.mark.parametrize("pairs,want", [([(1, 2), (2, 3)], {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (4, 0)}), ([(1, 2), (2, 3), (3, 1)], {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (4, 0)}), ([(1, 2), (1, 3)], {1: (1, 0), 2: (1, 1), 3: (3, 0), 4: (4, 0)})])
def test_chains(spark, pairs, want):
    nodes = spark.createDataFrame([(i,) for i in range(1, 5)], "id long")
    got = curbs.chain(spark.createDataFrame(pairs, "a long, b long"), nodes)
    assert {r["id"]: (r["head"], r["position"]) for r in got.collect()} == want


def test_curbs_over_each_other_keep_their_own_signs(spark):
    line = [(750000.0, 2950000.0), (750100.0, 2950000.0)]
    curbs = spark.createDataFrame([("a", 0, line), ("b", 1, line)], "blockface_id string, level int, line array<struct<x:double,y:double>>")
    signs = spark.createDataFrame([("s", 1, 750040.0, 2950001.0)], "point_id string, level int, x double, y double")
    made = segments.segment_lines(curbs, signs.limit(0), signs, signs.limit(0), same=["level"])
    assert sorted((r["blockface_id"], round(r["lo"]), r["upstream_location"]) for r in made.collect()) == [("a", 0, None), ("b", 0, None), ("b", 40, "s")]


def test_segments_take_little_disk(spark, tmp_path):
    """The query deals its signs a few times and stores none of them: before, shuffles and checkpoints took seven times the room."""
    import os

    from kerbspark.plans import queries

    spark.range(400).select(F.col("id").alias("p_partkey"), (F.col("id") % 50 + 1).cast("int").alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    signs = spark.range(20_000).select((F.col("id") % 400).alias("l_partkey"), (F.floor(F.col("id") / 400) + 1).cast("double").alias("l_quantity"))
    signs.write.parquet(f"{tmp_path}/lineitem.parquet")

    def used():
        return sum(os.path.getsize(os.path.join(folder, name)) for folder, _, names in os.walk(spark.sparkContext.getConf().get("spark.local.dir")) for name in names)

    before = used()
    made = queries.QUERIES["curb_segments"](spark, str(tmp_path)).agg(F.count(F.lit(1)), F.sum("points")).first()
    # signs stand two feet apart, so all pieces of a curb become one, which keeps their ends and the bend
    assert tuple(made) == (400, 400 * 52) and used() - before < 120 * 20_000


def test_kinds_that_are_absent_leave_pieces_whole(spark):
    kind = "blockface_id string, at double, point_id string"
    none = spark.createDataFrame([], kind)
    face = spark.createDataFrame([("a", 0.0, 100.0), ("b", 0.0, 50.0)], "blockface_id string, lo double, hi double")
    signs = spark.createDataFrame([("a", 40.0, "s"), ("a", 0.0, "t")], kind)
    rows = lambda *assets: sorted(tuple(r) for r in segments.segment_curbs(face, *assets).collect())
    assert rows(None, signs, None) == rows(none, signs, none, none) and len(rows(None, signs, None)) == 3
    assert rows(None, None, None) == rows(none, none, none)
    # a meter where a sign and the curb begin
    meters = spark.createDataFrame([("a", 0.0, "m")], kind)
    assert [(r["blockface_id"], r["lo"], r["hi"]) for r in segments.segment_curbs(face, None, signs, meters).orderBy("blockface_id", "lo").collect()] == [("a", 0.0, 40.0), ("a", 40.0, 100.0), ("b", 0.0, 50.0)]


def test_a_point_given_twice_counts_where_it_is_nearest(spark):
    from kerbspark.operators import spatial

    edges = spatial.edge_table(spark.createDataFrame([("a", [(0.0, 0.0), (100.0, 0.0)]), ("b", [(0.0, 1000.0), (100.0, 1000.0)])], "id string, line array<struct<x:double,y:double>>"), "id", "line")
    points = spark.createDataFrame([("p", 10.0, 9.0), ("p", 20.0, 1003.0), ("q", 30.0, 4.0)], "point_id string, x double, y double")
    assert sorted((r["point_id"], r["line_id"], r["along"]) for r in spatial.snap(points, edges, tolerance=30.0).collect()) == [("p", "b", 20.0), ("q", "a", 30.0)]
    got = spatial.snap(points.where("point_id = 'q'"), edges, tolerance=30.0, keep=(), once=True)
    assert got.columns == ["point_id", "line_id", "distance", "along"] and [tuple(r) for r in got.collect()] == [("q", "a", 4.0, 30.0)]
