import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kerbspark.functions import geometry as G
from kerbspark.operators import publish, quality, signs, tables
from kerbspark.sources import generations, readers


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "a_b", 3.0, "x"), (2, "ab", 5.0, None), (3, "c%d", 9.0, "y")], "id long, name string, time double, time_type string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("name,value,want", [("time_gte", 5.0, [2, 3]), ("time_max", 5.0, [1, 2]), ("time_after", 5.0, [3]), ("time_before", 5.0, [1]), ("name_contains", "_", [1]), ("name_prefix", "c%", [3]), ("name_suffix", "b", [1, 2]), ("time_type", "x", [1]), ("id", 2, [2])])
def test_filter_names(people, name, value, want):
    assert ids(tables.select_by_spec(people, {name: value})) == want


def test_unknown_filters_and_bad_projections(people):
    with pytest.raises(ValueError):
        tables.select_by_spec(people, {"nothing_gte": 1})
    with pytest.raises(ValueError):
        tables.select_by_spec(people, {"id": 1}, minimal=True)
    with pytest.raises(ValueError):
        tables.select_by_spec(people, {}, limit=2)
    assert tables.select_by_spec(people, {"time_gte": 1.0}, minimal=True, include=["id"]).columns == ["time", "id"]
    assert ids(tables.select_by_spec(people, {"time_gte": 1.0, "name": None}, limit=2, order=["id"])) == [1, 2]


def test_nulls_are_not_excluded(people):
    assert ids(tables.keep_values(people, exclude={"time_type": ["x"]})) == [2, 3]
    assert ids(tables.filter_column(people, "time_type", "drop", ["y"])) == [1, 2]
    assert ids(tables.exclude_words(people, "time_type", [" X "])) == [2, 3]
    assert ids(tables.filter_column(people, "name", "starts_with", ["C%"])) == [3]
    with pytest.raises(ValueError):
        tables.filter_column(people, "name", "other", ["a"])
    with pytest.raises(ValueError):
        tables.filter_column(people, "name", "keep", [])


def test_keyed_changes(spark, people):
    new = spark.createDataFrame([(3, "new", 1.0, "z"), (4, "four", 2.0, None)], people.schema)
    once = tables.upsert(people, new, ["id"])
    assert {(r["id"], r["name"]) for r in once.collect()} == {(1, "a_b"), (2, "ab"), (3, "new"), (4, "four")}
    assert sorted(map(tuple, tables.upsert(once, new, ["id"]).collect())) == sorted(map(tuple, once.collect()))
    with pytest.raises(Exception, match="given twice"):
        tables.upsert(people, new.union(new), ["id"]).collect()
    with pytest.raises(ValueError):
        tables.upsert(people, new.drop("time"), ["id"])
    assert ids(tables.delete(people, new.select("id"), ["id"])) == [1, 2]
    with pytest.raises(ValueError):
        tables.delete(people, new.limit(0), ["id"])
    changed = tables.modify_record(people, F.col("id") == 2, "name", "two")
    assert changed.where("name = 'two'").count() == 1
    for condition in (F.col("id") > 1, F.col("id") > 9):
        with pytest.raises(ValueError):
            tables.modify_record(people, condition, "name", "x")


def test_replacing_a_job_keeps_the_last_duplicate(spark):
    kind = "id long, job_id string, v int, n int"
    old = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 2, 0), (3, "b", 3, 0)], kind)
    new = spark.createDataFrame([(1, "a", 7, 1), (1, "a", 8, 2)], kind)
    got = tables.replace_by_job(old, new, ["id"], [F.desc("n")])
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, 8), (3, 3)]


def test_entities_are_strict(people):
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    assert tables.read_entity(people.select("name", "id"), schema).columns == ["id", "name"]
    with pytest.raises(ValueError):
        tables.read_entity(people, schema)


def test_reconciliation_and_fingerprint(spark, people):
    other = spark.createDataFrame([(2,), (3,), (9,)], "id long")
    assert {tuple(r) for r in tables.reconcile(people, other, "id").collect()} == {(1, "missing"), (9, "unexpected")}
    assert tables.fingerprint(people).first() == tables.fingerprint(people.repartition(3)).first()
    assert tables.fingerprint(people).first() != tables.fingerprint(people.where("id > 1")).first()


def test_generations(spark, people, tmp_path):
    root = str(tmp_path)
    generations.publish({"p": people}, root)
    generations.publish({"p": people.where("id = 1")}, root)
    assert ids(generations.current(spark, root, "p")) == [1] and ids(generations.current(spark, root, "p", back=1)) == [1, 2, 3]
    generations.roll_back(spark, root)
    assert ids(generations.current(spark, root, "p")) == [1, 2, 3]
    with pytest.raises(ValueError):
        generations.current(spark, f"{root}/none", "p")
    # two publishers that saw the same pointer: the second one fails, and readers keep what the first one published
    after = generations._pointers(spark, root)[0]
    generations._point(spark, root, after, generations._generation(spark, root, after))
    with pytest.raises(ValueError, match="came first"):
        generations._point(spark, root, after, "lost")
    assert ids(generations.current(spark, root, "p")) == [1, 2, 3]
    more = spark.createDataFrame([(9, "n", 1.0, "x")], people.schema)
    generations.publish_in_order({"p": generations.current(spark, root, "p")}, {"p": (people.where("id = 2"), ["id"])}, {"p": more}, root)
    assert ids(generations.current(spark, root, "p")) == [1, 3, 9]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, y"\n2,\n')
    assert [tuple(r) for r in readers.csv_strings(spark, f"{tmp_path}/a.csv").collect()] == [("1", "x, y"), ("2", None)]
    (tmp_path / "g.geojson").write_text('{"type":"FeatureCollection","crs":{"properties":{"name":"EPSG:4326"}},"features":[{"type":"Feature","properties":{"id":7},"geometry":{"type":"LineString","coordinates":[[0,1,9],[2,3,9]]}},{"type":"Feature","properties":{"id":8},"geometry":{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[2,2],[3,3]]]}}]}')
    g = readers.lines_of(readers.geojson(spark, f"{tmp_path}/g.geojson", crs="EPSG:4326"), ["geometry"])
    assert sorted((r["id"], r["part"], [tuple(p) for p in r["line"]]) for r in g.collect()) == [(7, 0, [(0.0, 1.0), (2.0, 3.0)]), (8, 0, [(0.0, 0.0), (1.0, 1.0)]), (8, 1, [(2.0, 2.0), (3.0, 3.0)])]
    with pytest.raises(ValueError):
        readers.geojson(spark, f"{tmp_path}/g.geojson", crs="EPSG:2249")
    lines = spark.createDataFrame([(1, "a", None, [(0.0, 1.0), (2.0, 3.0)]), (2, None, None, [(5.0, 5.0), (6.0, 6.5)])], "id long, name string, none string, line array<struct<x:double,y:double>>")
    generations.write_geojson_lines(lines, f"{tmp_path}/lines")
    for schema in (None, "id long, name string"):
        back = readers.lines_of(readers.geojson_lines(spark, f"{tmp_path}/lines", schema), ["geometry"])
        assert sorted((r["id"], r["name"] or "", [tuple(p) for p in r["line"]]) for r in back.collect()) == [(1, "a", [(0.0, 1.0), (2.0, 3.0)]), (2, "", [(5.0, 5.0), (6.0, 6.5)])]
    w = spark.createDataFrame([("LINESTRING (0 0, 1 2)",), ("SRID=4326;POINT(5 6)",), ("junk",), (None,)], "wkt string")
    assert [[tuple(p) for p in r["line"]] for r in readers.lines_of(w, ["geom", "wkt"], bad="drop").collect()] == [[(0.0, 0.0), (1.0, 2.0)], [(5.0, 6.0)]]
    with pytest.raises(Exception, match="malformed"):
        readers.lines_of(w, ["wkt"]).collect()
    for n, content in (("a.jpg", b"1"), ("b.JPG", b"1"), ("c.png", b"1")):
        (tmp_path / "img").mkdir(exist_ok=True)
        (tmp_path / "img" / n).write_bytes(content)
    assert readers.binary_store(spark, f"{tmp_path}/img").count() == 2
    with pytest.raises(ValueError):
        readers.job_rows(w, "auto")


def test_survey_join(spark):
    g = "{{{:08X}-0000-0000-0000-000000000000}}".format
    parents = spark.createDataFrame([(g(1), 1.0, 2.0), (g(1), 1.0, 2.0), (g(2), 3.0, 4.0)], "globalid string, x double, y double")
    kids = spark.createDataFrame([(g(1).lower(), "Parking", "1700000000000"), (g(2), " driveway ", "0"), (g(9), "Parking", "0"), ("junk", None, None), (g(2), None, "soon")], "parentglobalid string, sign_type string, CreationDate string")
    allowed = spark.createDataFrame([(g(1),), (g(2).strip("{}"),), (g(2),)], "GlobalID string")
    got = signs.survey(parents, kids, allowed, ["Driveway"], now=F.lit("2024-01-01").cast("timestamp"))
    assert sorted((r["x"], str(r["added_date"].date())) for r in got.collect()) == [(1.0, "2023-11-14"), (3.0, "2024-01-01")]
    with pytest.raises(ValueError):
        signs.survey(parents, kids, allowed.limit(1), [], now=F.current_timestamp())


def test_sign_reading_falls_back(spark):
    import pandas as pd

    def read(urls):
        return pd.DataFrame({"policy": ['{"rules":[{"activity":"No Parking"}]}' if "good" in u else "?" for u in urls], "arrow": ["none" if "1" in u else "left" for u in urls]})

    work = spark.createDataFrame([("a", "good1"), ("b", "bad"), ("c", "blurred good"), ("d", "good2")], "sign_id string, url string")
    got = {r["sign_id"]: r for r in signs.read_signs(work, [lambda u: ~u.str.contains("blurred")], read, job_id="j").collect()}
    assert '"priority":3' in got["a"]["policy_json"] and got["a"]["policy_arrow"] is None and got["d"]["policy_arrow"] == "left"
    assert all('"priority":98' in got[k]["policy_json"] for k in "bc")


def test_sign_tables(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, ["u", "v"]), (2, 0.0, 0.0, []), (3, 5.0, 0.0, ["w"])], "source_sign_id long, x double, y double, attachments array<string>").withColumns({"added_date": F.lit(None).cast("timestamp"), "sign_removed_date": F.lit(None).cast("timestamp")})
    t = signs.sign_tables(rows, job_id="j", source_id="s")
    assert {k: v.count() for k, v in t.items()} == {"asset_locations": 2, "signs": 3, "images": 3, "asset_jobs": 1, "data_sources": 1}
    assert {r["source_location_id"] for r in t["asset_locations"].collect()} == {"1, 2", "3"}


def test_snapshots_and_warnings(spark, people):
    a = quality.metrics(people, "p", {"rows": F.count(F.lit(1)), "null_types": F.count_if(F.col("time_type").isNull())})
    b = quality.metrics(people.where("id < 3"), "p", {"rows": F.count(F.lit(1)), "null_types": F.count_if(F.col("time_type").isNull())})
    assert [tuple(r) for r in quality.snapshot_diff(a, b).collect()] == [("p", "rows", 3.0, 2.0, -1.0)]
    assert [tuple(r) for r in quality.warnings(a, {"p.null_types": "types are null"}, {"p.rows": "no rows"}).collect()] == [("types are null", 1.0)]
    x = spark.createDataFrame([(1, [1, 2]), (2, [3])], "k int, v array<int>")
    y = spark.createDataFrame([(1, [2, 1]), (2, [4])], "k int, v array<int>")
    assert [r["k"] for r in quality.same_content(x, y, ["k"], ["v"]).collect()] == [2]


def test_json_numbers_are_told_by_type(spark):
    rows = ['{"k":7}', '{"k":"7"}', '{"k":2.5}', '{"k":true}', '{"k":null}', '{"k":[1]}', "{}", "no json", None, '{"k":-1e3}']
    got = quality.json_number_stats(spark.createDataFrame([(r,) for r in rows], "j string"), "j", "$.k", "s").collect()
    assert {r["metric"]: r["value"] for r in got} == {"numbers": 3.0, "min": -1000.0, "max": 7.0, "mean": round(-990.5 / 3, 6)}


def test_named_uuids_and_array_text(spark):
    import uuid

    space = uuid.uuid4()
    names = ["", "LINESTRING (0 0, 1 1)", "ä", "x" * 300]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(signs.name_uuid(str(space), F.col("n")).alias("u")).collect()
    assert [r["u"] for r in got] == [str(uuid.uuid5(space, n)) for n in names]
    lists = [["a", "b,c"], ['d"e', "f\\g"], [], None, ["x", None]]
    text = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, v array<string>").withColumn("t", signs.array_text(F.col("v"))).withColumn("back", signs.array_of_text(F.col("t")))
    rows = text.orderBy("i").collect()
    assert [r["back"] for r in rows] == lists and rows[0]["t"] == '{"a","b,c"}'
    assert spark.range(1).select(signs.array_of_text(F.lit("{one,two three,NULL}")).alias("v")).first()["v"] == ["one", "two three", None]


def test_jobs_must_be_named(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, job_id string")
    assert tables.job_tables({"t": df}, {"t": "b"})["t"].first()["id"] == 2
    for jobs in ({}, {"t": ""}, {"t": "auto"}):
        with pytest.raises(ValueError):
            tables.job_tables({"t": df}, jobs)


def test_nested_view_and_tables_hold_the_same(spark):
    docs = [
        {"name": "a", "rules": [{"activity": "parking", "max_stay": 2, "max_stay_unit": "hour", "rate": {"rate": 125, "rate_unit": "hour"}}, {"activity": "loading", "user_classes": ["truck"]}], "time_spans": [{"days_of_week": ["mon"], "time_of_day_start": "08:00", "time_of_day_end": "10:00"}]},
        {"name": "b", "rules": [{"activity": "no parking"}], "time_spans": []},
    ]
    p = spark.createDataFrame([(f"p{i}", json.dumps(d)) for i, d in enumerate(docs)], "curb_policy_id string, policy_json string")
    made = publish.policy_tables(p)
    back = publish.unnested_policies(publish.nested_policies(made))
    for name, key in (("curb_policies", None), ("curb_policy_rules", "rule_id"), ("curb_policy_time_spans", "time_span_id"), ("curb_policy_rates", "rate_id")):
        a, b = ({tuple(str(r[c]) for c in sorted(df.columns) if c not in (key, "rule_id")) for r in df.collect()} for df in (made[name], back[name]))
        assert a == b and made[name].count() == back[name].count(), name
    assert made["curb_policy_rates"].count() == 1


def test_signs_of_an_area_lie_on_a_grid_of_feet(spark):
    rows = [(1, -71.06, 42.35, "R7", "2024-01-02", None), (1, -71.0601, 42.35, "R7", "2024-01-01", None), (2, -71.0602, 42.3501, "r8", "2024-01-01", "Removed"), (3, -71.5, 42.35, "R7", "2024-01-01", None), (4, None, 42.35, "R7", "2024-01-01", None), (5, -71.06, 42.35, "S1", "2024-01-01", None)]
    df = spark.createDataFrame(rows, "k int, lon double, lat double, code string, changed string, status string")
    x, y = spark.range(1).select(*G.to_feet(F.lit(-71.06), F.lit(42.35))).first()
    corners = [(x - 500, y - 500), (x + 500, y - 500), (x + 500, y + 500), (x - 500, y + 500)]
    area = spark.createDataFrame([(1, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])], "polygon_id int, x0 double, y0 double, x1 double, y1 double")
    got = signs.preprocess_area(df, area, lon="lon", lat="lat", area_cell=250.0, key="k", modified="changed", inspected="changed", code="code", prefixes=["R"], cell=10.0).collect()
    assert {r["k"]: r["sign_removed_date"] for r in got} == {1: None, 2: "2024-01-01"}
    for r in got:
        assert r["x"] % 10 == 0 and r["y"] % 10 == 0 and abs(r["lon"] + 71.06) < 1e-3 and abs(r["lat"] - 42.35) < 1e-3
    assert [r["k"] for r in signs.active(spark.createDataFrame(got)).collect()] == [1]


def test_a_fingerprint_of_ordered_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("t"))
    of = lambda d, *order: tuple(tables.ordered_fingerprint(d, order, fan_in=10).first())
    want = of(df, "k", "id")
    assert want[0] == 1000 and of(df.repartition(9), "k", "id") == want and of(df.coalesce(1), "k", "id") == want
    assert of(df, "id", "k") != want and of(df.where("id != 500"), "k", "id") != want
    assert of(df.withColumn("t", F.coalesce("t", F.lit(""))), "k", "id") != want  # null is not empty
    assert of(df, "k") == of(df.repartition(5), "k")  # ties by the rows' text
    assert of(df.limit(0), "k") == (0, "d41d8cd98f00b204e9800998ecf8427e")


def test_required_paths(spark):
    df = spark.createDataFrame([], "a int, b struct<c:string,d:array<struct<e:int>>>, m map<string,struct<f:int>>")
    tables.require_schema(df, "a int, b struct<d:array<struct<e:int>>>, m map<string,struct<f:int>>")
    with pytest.raises(ValueError, match=r"\['a', 'b.d\[\].x', 'b.y.z', 'm\{\}.g', 'n'\]".replace("b.y.z", "b.y")):
        tables.require_schema(df, "a string, b struct<d:array<struct<e:int,x:int>>,y:struct<z:int>>, m map<string,struct<g:int>>, n int")


def test_three_slots_move_together(spark, people, tmp_path):
    root = f"{tmp_path}/slots"
    ids = lambda which: sorted(r["id"] for r in generations.slot(spark, root, which, "p").collect())
    with pytest.raises(ValueError):
        generations.roll_over(spark, root)
    generations.write_next({"p": people}, root)
    assert ids("current") == [] and ids("next") == [1, 2, 3]
    generations.roll_over(spark, root)
    assert (ids("previous"), ids("current"), ids("next")) == ([], [1, 2, 3], [])
    assert generations.slot(spark, root, "next", "p").schema == generations.slot(spark, root, "current", "p").schema
    generations.write_next({"p": people.where("id = 2")}, root)
    generations.roll_over(spark, root)
    assert (ids("previous"), ids("current"), ids("next")) == ([1, 2, 3], [2], [])
    generations.undo_roll_over(spark, root)
    assert (ids("current"), ids("next")) == ([1, 2, 3], [2])
    for wrong in (lambda: generations.undo_roll_over(spark, root), lambda: ids("previous"), lambda: generations.write_next({"q": people}, root)):
        with pytest.raises(ValueError):
            wrong()
    # a publisher that died while it wrote leaves a draft, which no reader looks at
    (tmp_path / "slots" / "slots" / "_pointers" / "_draft-1").write_text("")
    assert ids("current") == [1, 2, 3]
    with pytest.raises(ValueError, match="came first"):
        generations._point(spark, f"{root}/slots", generations._slots(spark, root)[0] - 1, "{}")


def test_a_fingerprint_of_so_many_levels(spark):
    df = spark.range(250).select("id")
    of = lambda d: d.selectExpr("id DIV 10 AS a", "id DIV 100 AS b", "to_json(struct(id)) AS t", "id").groupBy("a", "b").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda r: r["t"]), "\n")).alias("t"))
    two = lambda d: of(d).groupBy("b").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", "t"))), lambda r: r["t"]), "\n")).alias("t")).agg(F.max("t")).first()[0]
    # more rows than two levels bring to one digest, and fewer than one level does
    for some in (df, df.where("id < 7")):
        assert tables.ordered_fingerprint(some, ["id"], fan_in=10, levels=2).first()["digest"] == two(some)
    assert tuple(tables.ordered_fingerprint(df.limit(0), ["id"], levels=2).first()) == (0, None)


def test_the_digest_of_orders_tells_a_change_in_any_of_them(spark, tmp_path):
    """Over a million orders, changed in the first and in the last thousand: two levels leave two digests, of which neither may be dropped."""
    import duckdb

    from kerbspark.plans import queries

    key = F.col("id")
    orders = spark.range(0, 1_001_500, 1, 4).select((key % 7).alias("o_custkey"), key.alias("o_orderkey"), F.lit("5-LOW").alias("o_orderpriority"), F.when(key % 3 == 0, "F").otherwise("O").alias("o_orderstatus"))
    ends = {"whole": None, "first": 0, "last": 1_001_496, "few": None, "none": None}
    kept = {"few": F.col("o_orderkey") < 700, "none": F.lit(False)}
    found = {}
    for name, changed in ends.items():
        some = orders.where(kept.get(name, F.lit(True))).withColumn("o_orderpriority", F.when(F.col("o_orderkey") == F.lit(changed), "1-URGENT").otherwise(F.col("o_orderpriority")))
        some.write.parquet(f"{tmp_path}/{name}/orders.parquet")
        found[name] = tuple(queries.QUERIES["ordered_digest"](spark, f"{tmp_path}/{name}").first())
        con = duckdb.connect()
        con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/{name}/orders.parquet/*.parquet'")
        assert con.execute(queries.SQL["ordered_digest"]).fetchall() == [found[name]], name
    assert found["whole"][0] == 1_001_500 and len({found[name][1] for name in ("whole", "first", "last")}) == 3 and found["none"] == (0, None)
