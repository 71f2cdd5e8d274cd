import math
import random

import pytest
from pyspark.sql import functions as F

from kerbspark.functions import geometry as G
from kerbspark.operators import curbs, publish, spatial

LINE = "id string, line array<struct<x:double,y:double>>"


def lines(spark, rows):
    return spark.createDataFrame(rows, LINE)


def test_snap_across_cells_and_ties(spark):
    e = spatial.edge_table(lines(spark, [("a", [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0)]), ("b", [(0.0, 20.0), (90.0, 20.0)])]), "id", "line")
    points = spark.createDataFrame([(1, 50.0, 3.0), (2, 50.0, 10.0), (3, 130.0, 50.0), (4, 131.0, 50.0), (5, -10.0, 0.0)], "point_id int, x double, y double")
    got = {r["point_id"]: (r["line_id"], r["distance"], r["along"]) for r in spatial.snap(points, e, tolerance=30.0, cell=40.0).collect()}
    assert got == {1: ("a", 3.0, 50.0), 2: ("a", 10.0, 50.0), 3: ("a", 30.0, 150.0), 5: ("a", 10.0, 0.0)}
    assert [r["point_id"] for r in spatial.unsnapped(points, spatial.snap(points, e, tolerance=30.0)).collect()] == [4]


def test_points_on_edges_are_not_inside(spark):
    square = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 0.0), (1, 10.0, 0.0, 10.0, 10.0), (1, 10.0, 10.0, 0.0, 10.0), (1, 0.0, 10.0, 0.0, 0.0)], "polygon_id int, x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 11.0, 5.0), (4, 0.0, 0.0), (5, 5.0, 0.0)], "point_id int, x double, y double")
    assert [r["point_id"] for r in spatial.in_polygons(points, square, cell=4.0).collect()] == [1]


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(-71.06, 42.35), (-70.9, 41.2), (-71.5, 41.0)], "lon double, lat double")
    x, y = G.to_feet(F.col("lon"), F.col("lat"))
    df = df.withColumns({"x": x, "y": y})
    lon, lat = G.to_degrees(F.col("x"), F.col("y"))
    for r in df.withColumns({"lon2": lon, "lat2": lat}).collect():
        assert abs(r["lon"] - r["lon2"]) < 1e-11 and abs(r["lat"] - r["lat2"]) < 1e-11
    origin = df.where("lat = 41.0").first()
    assert abs(origin["x"] - 200000 / 0.3048006096012192) < 1e-6 and abs(origin["y"] - 750000 / 0.3048006096012192) < 1e-6


@pytest.mark.parametrize("code", [4326, 4269, 2249, 3395, 26919, 32619, 32618])
def test_every_system_goes_both_ways(spark, code):
    from kerbspark.functions import crs

    df = spark.createDataFrame([(-71.06, 42.35), (-70.9, 41.2), (-73.5, 41.0), (-69.0, 44.5)], "lon double, lat double")
    x, y = crs.reproject(F.col("lon"), F.col("lat"), 4326, code)
    df = df.withColumns({"x": x, "y": y})
    lon, lat = crs.reproject(F.col("x"), F.col("y"), f"EPSG:{code}", "urn:ogc:def:crs:OGC:1.3:CRS84")
    for r in df.withColumns({"lon2": lon, "lat2": lat}).collect():
        off = abs(r["lon"] - (code % 100 * 6 - 183)) if code in (26919, 32619, 32618) else None
        # the series of a UTM zone holds to a millimetre within it, and less well beyond
        near = 1e-9 if off is None else 2e-8 if off <= 3 else 2e-6
        assert abs(r["lon"] - r["lon2"]) < near and abs(r["lat"] - r["lat2"]) < near


def test_points_of_the_systems(spark):
    """Fixed values of the published projections: a central meridian has easting 500000, and the equator northing 0."""
    from kerbspark.functions import crs

    df = spark.createDataFrame([(-69.0, 0.0), (-69.0, 42.0), (-66.0, 0.0)], "lon double, lat double")
    x, y = crs.reproject(F.col("lon"), F.col("lat"), 4326, 32619)
    got = [(r["x"], r["y"]) for r in df.select(x.alias("x"), y.alias("y")).collect()]
    assert got[0] == pytest.approx((500000.0, 0.0), abs=1e-6) and got[1][0] == pytest.approx(500000.0)
    assert got[1][1] == pytest.approx(4649776.22, abs=0.01) and got[2][0] == pytest.approx(833978.56, abs=0.01)
    for bad in ("EPSG:27700", "", "no code"):
        with pytest.raises(ValueError):
            crs.system(bad)


def test_a_line_in_feet_is_read_as_degrees_and_written_in_feet(spark, tmp_path):
    from kerbspark.sources import generations, readers

    feet = '{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::2249"}},"features":[{"type":"Feature","properties":{"blockface_id":"b"},"geometry":{"type":"LineString","coordinates":[[775000.25,2950000.5],[775100,2950050]]}}]}'
    (tmp_path / "feet.geojson").write_text(feet)
    code = readers.declared_crs(spark, f"{tmp_path}/feet.geojson")
    assert code == 2249
    got = readers.lines_of(readers.geojson(spark, f"{tmp_path}/feet.geojson", crs="EPSG:2249"), ["geometry"], crs=code, to=4326).drop("geometry", "part")
    lon, lat = got.first()["line"][0]
    assert -71.1 < lon < -71.0 and 42.3 < lat < 42.4
    generations.write_geojson_lines(got, f"{tmp_path}/out", to=2249)
    back = readers.lines_of(readers.geojson_lines(spark, f"{tmp_path}/out"), ["geometry"]).first()["line"]
    assert [p for xy in back for p in xy] == pytest.approx([775000.25, 2950000.5, 775100, 2950050], abs=1e-6)
    generations.write_lines(got.withColumn("job_id", F.lit("j")), f"{tmp_path}/faces", crs=4326, to=26919)
    faces = spark.read.parquet(f"{tmp_path}/faces").withColumn("geometry", F.to_json(F.struct(F.lit("LineString").alias("type"), F.transform("line", lambda p: F.array(p["x"], p["y"])).alias("coordinates")))).drop("line")
    faces.write.parquet(f"{tmp_path}/load")
    loaded = readers.blockfaces(spark, f"{tmp_path}/load", "j", crs=26919).first()["line"]
    assert loaded[0]["x"] == pytest.approx(775000.25, abs=1e-3)
    (tmp_path / "plain.geojson").write_text('{"type":"FeatureCollection","features":[]}')
    assert readers.declared_crs(spark, f"{tmp_path}/plain.geojson", otherwise=4326) == 4326
    for call in (lambda: readers.declared_crs(spark, f"{tmp_path}/plain.geojson"), lambda: readers.blockfaces(spark, f"{tmp_path}/load", "other", crs=26919), lambda: readers.blockfaces(spark, f"{tmp_path}/load", "j", crs=None), lambda: readers.lines_of(faces, ["geometry"], to=4326)):
        with pytest.raises(ValueError):
            call()


def test_overlap_and_equivalence(spark):
    old = lines(spark, [("o", [(0.0, 0.0), (100.0, 0.0)])])
    new = lines(spark, [("same", [(0.0, 0.0005), (50.0, 0.0), (100.0, 0.0)]), ("half", [(0.0, 0.0), (50.0, 0.0)]), ("next", [(100.0, 0.0), (200.0, 0.0)]), ("cross", [(50.0, -50.0), (50.0, 50.0)]), ("beside", [(0.0, 1.0), (100.0, 1.0)])])
    got = spatial.linear_overlap(spatial.edge_table(old, "id", "line"), spatial.edge_table(new, "id", "line"), tolerance=0.001, least=0.01)
    assert {r["b_id"]: round(r["overlap"], 3) for r in got.collect()} == {"same": 100.0, "half": 50.0}
    both = old.crossJoin(new.select(F.col("id").alias("n"), F.col("line").alias("l2")))
    eq = both.select("n", publish.equivalent(F.col("line"), F.col("l2"), spatial.hausdorff(F.col("line"), F.col("l2")), 0.001).alias("eq"))
    assert {r["n"]: r["eq"] for r in eq.collect()} == {"same": True, "half": False, "next": False, "cross": False, "beside": False}


def test_a_line_that_doubles_back_overlaps_once(spark):
    old = lines(spark, [("o", [(0.0, 0.0), (100.0, 0.0)])])
    new = lines(spark, [("back", [(20.0, 0.0), (70.0, 0.0), (40.0, 0.0), (90.0, 0.0)])])
    got = spatial.linear_overlap(spatial.edge_table(old, "id", "line"), spatial.edge_table(new, "id", "line"), tolerance=0.001, least=0.01)
    assert [round(r["overlap"], 6) for r in got.collect()] == [70.0]


def test_lines_in_an_envelope(spark):
    found = [("through", [(-5.0, 5.0), (15.0, 6.0)]), ("inside", [(4.0, 4.0), (6.0, 6.0)]), ("corner", [(-2.0, 10.0), (2.0, 14.0)]), ("touch", [(11.0, -5.0), (11.0, 20.0)]), ("level", [(-9.0, 0.0), (30.0, 0.0)])]
    apart = [("past", [(12.0, 0.0), (12.0, 9.0)]), ("over", [(0.0, 12.0), (9.0, 12.0)]), ("slant", [(10.0, 14.0), (14.0, 10.0)])]
    edges = spatial.edge_table(lines(spark, found + apart), "id", "line")
    assert {r["line_id"] for r in spatial.lines_in_envelope(edges, (0.0, 0.0, 10.0, 10.0), 1.0).collect()} == {"through", "inside", "corner", "touch", "level"}


def test_distance_beyond_the_tolerance(spark):
    e = spatial.edge_table(lines(spark, [("a", [(0.0, 0.0), (100.0, 0.0)])]), "id", "line")
    points = spark.createDataFrame([(1, 50.0, 10.0), (2, 50.0, 40.0), (3, 50.0, 700.0), (4, 50.0, 2000.0)], "point_id int, x double, y double")
    got = {r["point_id"]: r["distance"] for r in spatial.far_distance(points, e, tolerance=30.0, most=1000.0).collect()}
    assert got == {2: 40.0, 3: 700.0, 4: None}


def brute_connect(parts):
    rest = [list(p) for p in parts]
    line = rest.pop(max(range(len(rest)), key=lambda i: (sum(math.dist(a, b) for a, b in zip(rest[i], rest[i][1:])), -i)))
    while rest:
        ways = [(d, i, w) for i, p in enumerate(rest) for w, d in enumerate((math.dist(line[-1], p[0]), math.dist(line[-1], p[-1]), math.dist(line[0], p[0]), math.dist(line[0], p[-1])))]
        _, i, w = min(ways)
        p = rest.pop(i)
        p = p[::-1] if w in (1, 2) else p
        line = line + p if w < 2 else p + line
    return line


def test_parts_are_connected_by_their_nearest_ends(spark):
    rng = random.Random(4)
    features = {k: [[(float(rng.randint(0, 50)), float(rng.randint(0, 50))) for _ in range(rng.randint(2, 4))] for _ in range(rng.randint(1, 5))] for k in range(30)}
    rows = [(k, n, p) for k, ps in features.items() for n, p in enumerate(ps)] + [(99, 0, [(1.0, 1.0)])]
    got = curbs.connect_parts(spark.createDataFrame(rows, "id int, part int, line array<struct<x:double,y:double>>"), "id").collect()
    assert {r["id"]: [tuple(p) for p in r["line"]] for r in got} == {k: brute_connect(ps) for k, ps in features.items()}


def test_offsets_are_parallel(spark):
    df = lines(spark, [("r", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)])])
    left, right = df.select(curbs.offset_line(F.col("line"), F.lit(2.0)), curbs.offset_line(F.col("line"), F.lit(-2.0))).first()
    assert [tuple(p) for p in left] == [(0.0, 2.0), (8.0, 2.0), (8.0, 10.0)] and [tuple(p) for p in right] == [(0.0, -2.0), (12.0, -2.0), (12.0, 10.0)]
    roads = spark.createDataFrame([(20.0, 20.0, None, None, 3.0, 1.0), (None, None, None, None, None, None), (20.0, 30.0, 5.0, 5.0, 3.0, 1.0)], "surface_wd double, row_width double, left_sidewalk double, right_sidewalk double, left_shoulder double, right_shoulder double")
    assert [(r["left_width"], r["right_width"]) for r in curbs.half_widths(roads).collect()] == [(13.0, 11.0), (0.0, 0.0), (10.0, 10.0)]


def test_curbs_inside_other_roads_are_cut(spark):
    curb = spatial.edge_table(lines(spark, [("c", [(0.0, 0.0), (100.0, 0.0)])]), "id", "line")
    road = spatial.edge_table(lines(spark, [("r", [(50.0, -50.0), (50.0, 50.0)])]), "id", "line")
    widths = spark.createDataFrame([("r", 10.0, 10.0)], "line_id string, left_width double, right_width double")
    parts = curbs.outside_roads(curb, curbs.buffer_cuts(curb, road, widths, cell=25.0))
    assert sorted((round(r["lo"], 6), round(r["hi"], 6)) for r in parts.collect()) == [(0.0, 40.0), (60.0, 100.0)]
    cut = curbs.cut_lines(curb, parts)
    assert sorted([tuple(p) for p in r["line"]] for r in cut.collect()) == [[(0.0, 0.0), (40.0, 0.0)], [(60.0, 0.0), (100.0, 0.0)]]


def test_chained_lines_join_once(spark):
    df = lines(spark, [("1", [(0.0, 0.0), (1.0, 0.0)]), ("2", [(1.0, 0.0), (2.0, 0.0)])]).withColumn("route", F.col("id"))
    chains = spark.createDataFrame([("1", "1", 0), ("2", "1", 1)], "id string, head string, position int")
    r = curbs.merge_chains(df, chains, ["route"]).first()
    assert (r["id"], r["route"], [p["x"] for p in r["line"]]) == ("1", "1", [0.0, 1.0, 2.0])


def test_geodesic_and_wkt(spark):
    df = lines(spark, [("a", [(-71.06, 42.35), (-71.061, 42.35)]), ("b", [(-71.06, 42.3), (-71.06, 42.4)])])
    (feet, text), (north, _) = df.orderBy("id").select(G.geodesic_feet(F.col("line")), G.to_wkt(F.col("line"))).collect()
    e2, a = 2 / 298.257223563 - 1 / 298.257223563**2, 6378137.0
    sine = math.sin(math.radians(42.35))
    assert abs(feet - math.radians(0.001) * a * math.cos(math.radians(42.35)) / math.sqrt(1 - e2 * sine * sine) * 3.280839895) < 0.01
    # the meridian's arc by a sum over small steps
    steps = [math.radians(42.3 + (i + 0.5) * 1e-4) for i in range(1000)]
    assert abs(north - sum(math.radians(1e-4) * a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5 for p in steps) * 3.280839895) < 0.1
    assert text == "LINESTRING (-71.06 42.35, -71.061 42.35)"


@pytest.fixture
def published(spark):
    seg = [("f", 0, ['{"rules":[{"activity":"parking"}],"priority":80}'], [(0.0, 0.0), (1.0, 0.0)]), ("f", 1, ['{"priority":80,"rules":[{"activity":"parking"}]}'], [(1.0, 0.0), (2.0, 0.0)]), ("f", 2, [], [(2.0, 0.0), (3.0, 0.0)])]
    df = spark.createDataFrame(seg, "blockface_id string, segment_seq int, policy_list array<string>, line array<struct<x:double,y:double>>")
    from kerbspark.functions.policies import canonical_json

    return df.withColumn("policy_list", F.transform("policy_list", canonical_json))


def test_publication(spark, published):
    zones = publish.zones_from_segments(published)
    assert sorted(len(r["line"]) for r in zones.collect()) == [2, 3]
    policies, links = publish.unique_policies(zones)
    tables = publish.policy_tables(policies)
    assert {k: v.count() for k, v in tables.items()} == {"curb_policies": 1, "curb_policy_rules": 1, "curb_policy_time_spans": 0, "curb_policy_rates": 0}
    assert [r["activity"] for r in publish.nested_policies(tables).first()["rules"]] == ["parking"]
    reused = publish.reuse_policies(tables["curb_policies"], tables["curb_policies"].withColumn("curb_policy_id", F.lit("old"))).first()
    assert (reused["use_id"], reused["is_new"]) == ("old", False)
    described = publish.fill_descriptions(policies.withColumn("description", F.lit(None).cast("string")), lambda text: F.lit("Parking"))
    active = zones.withColumn("end_date", F.lit(None).cast("timestamp"))
    assert publish.violations(active, described, links).isEmpty()
    with pytest.raises(Exception, match="description is missing"):
        publish.fill_descriptions(policies.withColumn("description", F.lit(" ")), lambda text: F.lit("")).collect()
    bad = publish.violations(active.withColumn("end_date", F.current_timestamp()), described.withColumn("description", F.lit("")), links.union(links))
    assert {r["rule"] for r in bad.collect()} == {"link key", "link to inactive zone", "missing description"}
    add, gone = publish.link_changes(links, links.withColumn("curb_policy_id", F.lit("other")), zones)
    assert add.count() == 1 and gone.first()["curb_policy_id"] == "other"
    again_add, again_gone = publish.link_changes(links, links, zones)
    assert again_add.isEmpty() and again_gone.isEmpty()


def _tasks(df):
    """How many tasks the last step of ``df`` has rows in."""
    return df.select(F.spark_partition_id()).distinct().count()


def test_violations_spread_links_over_tasks(spark):
    """Small shuffled partitions must not all be merged into one task, whose memory then follows the input."""
    zones = spark.range(500).select(F.col("id").alias("curb_zone_id"), F.expr("array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D))").alias("line"), F.lit(None).cast("string").alias("end_date"))
    policies = spark.range(5).select(F.col("id").alias("curb_policy_id"), F.lit("text").alias("description"))
    links = spark.range(500).select(F.col("id").alias("curb_zone_id"), (F.col("id") % 6).alias("curb_policy_id"))
    found = publish.violations(zones.union(zones), policies, links.union(links))
    assert {r["rule"]: r["count"] for r in found.groupBy("rule").count().collect()} == {"zone key": 500, "link key": 500, "link to missing policy": 2 * 83}
    assert _tasks(found.where("rule = 'link key'")) == 4
    assert _tasks(found.where("rule = 'zone key'")) == 4


def test_merge_groups_are_numbered_in_one_sort(spark):
    from kerbspark.operators import segments
    from kerbspark.plans import queries

    rows = [(b, q, length, asset) for b in range(40) for q, (length, asset) in enumerate([(5.0, None), (50.0, None), (5.0, None), (5.0, None), (60.0, "FH"), (4.0, None)])]
    df = spark.createDataFrame([*rows, (99, 0, 1.0, None), (99, 1, None, None), (99, 2, 2.0, None)], "blockface_id int, segment_seq int, seg_length double, upstream_asset string")
    merged = segments.merge_groups(df, 20.0)
    assert merged.schema["merge_group"].dataType.simpleString() == "int"
    by = lambda b: [r["merge_group"] for r in merged.where(f"blockface_id = {b}").orderBy("segment_seq").collect()]
    assert by(7) == [0, 0, 0, 1, 1, 1] and by(99) == [0, 0, 0]
    assert merged._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    assert _tasks(queries.tiny_merge_groups(spark, "/root/testdata/sf0.001")) == 4


def test_link_changes_are_spread_over_tasks(spark):
    links = spark.range(2000).select((F.col("id") % 500).alias("curb_zone_id"), (F.col("id") % 7).alias("curb_policy_id"))
    add, gone = publish.link_changes(links, links.where("curb_policy_id > 2"), spark.range(400).toDF("curb_zone_id"))
    assert add.exceptAll(links.where("curb_zone_id < 400 AND curb_policy_id < 3").distinct()).isEmpty() and add.count() == links.where("curb_zone_id < 400 AND curb_policy_id < 3").distinct().count()
    assert {r["curb_zone_id"] for r in gone.collect()} == set(range(400, 500))
    assert _tasks(add) == 4 and _tasks(gone.distinct()) == 4


def test_acceptance_counts_are_spread_over_tasks(spark):
    """Ids that are null or stand several times, and counts of a join whose ids are dealt to all tasks."""
    from kerbspark.operators import acceptance

    signs = spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, 1), (3, 9)], "sign_id int, location_id int")
    images = spark.createDataFrame([("a", 1), ("b", 1), ("c", 5)], "image_id string, sign_id int")
    places = spark.createDataFrame([(1,), (2,), (2,)], "location_id int")
    texts = spark.createDataFrame([(1, '{"a":1,"b":2}', '{"b": 2, "a": 1}', "new"), (1, '{"a":1}', '{"a":2}', None), (2, None, None, "new")], "sign_id int, policy_json string, stored_json string, job_id string")
    got = acceptance.accept(signs, images, places, texts, job_id="new")
    assert {(r["section"], r["metric"]): r["value"] for r in got.collect()} == {
        ("signs", "signs"): 3, ("signs", "images"): 2, ("signs", "locations"): 2, ("signs", "signs_without_image"): 3, ("signs", "signs_without_location"): 2,
        ("policies", "rows"): 3, ("policies", "repeated_signs"): 1, ("policies", "wrong_job"): 1, ("policies", "other_text"): 1,
    }
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 4
    none = acceptance.accept(signs.limit(0), images, places, texts.limit(0), job_id="new")
    assert {r["value"] for r in none.collect()} == {0}


def test_edges_are_not_broadcast_to_points(spark, tmp_path):
    """A small file may give many cells: the driver must not gather them."""
    spark.range(20).selectExpr("id", "array(named_struct('x', 0D, 'y', id * 100D), named_struct('x', 5000D, 'y', id * 100D)) AS line").write.parquet(f"{tmp_path}/lines")
    spark.range(50).selectExpr("id AS point_id", "id * 90D AS x", "id * 40D + 1 AS y").write.parquet(f"{tmp_path}/points")
    points = spark.read.parquet(f"{tmp_path}/points")
    edges = spatial.edge_table(spark.read.parquet(f"{tmp_path}/lines"), "id", "line")
    near = spatial.snap(points, edges, tolerance=30.0)
    assert near.count() + spatial.unsnapped(points, near).count() == 50
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()


def test_level_and_upright_edges_meet_once_and_are_worked_out_once(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        a, b, n = rng.randrange(0, 900), 10 * rng.randrange(0, 9), rng.randrange(20, 120)
        rows.append((i, 0, float(a), float(b), float(a + n), float(b)) if i % 2 else (i, 0, float(b), float(a), float(b), float(a + n)))
    e = spark.createDataFrame(rows, "line_id int, edge_no int, x0 double, y0 double, x1 double, y1 double")
    found = spatial.linear_overlap(e, e, tolerance=0.0, least=0.0)
    want = {}
    for i, _, x0, y0, x1, y1 in rows:
        for j, _, u0, v0, u1, v1 in rows:
            if i % 2 == j % 2 and (y0 == v0 if i % 2 else x0 == u0):
                both = min(x1, u1) - max(x0, u0) if i % 2 else min(y1, v1) - max(y0, v0)
                if both > 0:
                    want[i, j] = both
    assert {(r["a_id"], r["b_id"]): r["overlap"] for r in found.collect()} == want
    assert "lambdafunction" not in found._jdf.queryExecution().executedPlan().toString()
