"""Publications applied to published tables, from segments in degrees to one consistent state."""

import json

import pytest
from pyspark.sql import functions as F

from kerbspark.operators import publication, publish

SEGMENTS = "blockface_id string, segment_seq int, policy_list array<string>, line array<struct<x:double,y:double>>"
PARKING = json.dumps({"rules": [{"activity": "parking"}], "priority": 80})
LOADING = json.dumps({"rules": [{"activity": "loading"}], "priority": 80, "time_spans": [{"days_of_week": ["mon"]}]})
LAT = 42.35
WHOLE = [(-71.06, LAT), (-71.061, LAT)]
FIRST, SECOND, NEXT = [(-71.06, LAT), (-71.0605, LAT)], [(-71.0605, LAT), (-71.061, LAT)], [(-71.061, LAT), (-71.062, LAT)]
DRIFT = [(-71.06, LAT + 1e-12), (-71.061, LAT + 1e-12)]
TABLES = list(publication.KEYS)


@pytest.fixture
def apply(spark):
    calls = []

    def run(rows, published=None, day=1):
        def describe(text):
            calls.append(day)
            return F.concat(F.lit(f"day {day}: "), F.get_json_object(text, "$.rules[0].activity"))

        df = spark.createDataFrame(rows, SEGMENTS)
        state = publication.apply_publication(df, published, F.lit(f"2030-01-0{day} 00:00:00").cast("timestamp"), describe)
        # what a reader of the tables sees, so that later steps do not follow the whole history
        return {k: spark.createDataFrame(v.collect(), v.schema) for k, v in state.items()}

    return run


def counts(state):
    return {k: state[k].count() for k in TABLES}


def active(state):
    return state["curb_zones"].where("end_date IS NULL")


def changes(state):
    return sorted(r["change"] for r in state["changes"].collect())


def check_consistent(state):
    zones = active(state).withColumn("line", F.element_at(publication.G.from_wkt(F.col("geometry")), 1))
    assert publish.violations(state["curb_zones"].withColumn("line", F.element_at(publication.G.from_wkt(F.col("geometry")), 1)), state["curb_policies"], state["curb_zone_policies"]).isEmpty()
    assert state["curb_zone_policies"].join(zones, "curb_zone_id", "left_anti").isEmpty()
    for child in publication.CHILDREN:
        assert state[child].join(state["curb_policies"], "curb_policy_id", "left_anti").isEmpty()
    for name, keys in publication.KEYS.items():
        assert state[name].select(*keys).distinct().count() == state[name].count()


def test_nothing_published_yet(apply):
    state = apply([("f", 0, [PARKING], WHOLE)])
    assert counts(state) == {"curb_zones": 1, "curb_zone_policies": 1, "curb_policies": 1, "curb_policy_rules": 1, "curb_policy_time_spans": 0, "curb_policy_rates": 0}
    assert state["curb_policies"].first()["description"] == "day 1: parking"
    assert changes(state) == ["insert"] and state["links_to_delete"].isEmpty()
    check_consistent(state)


def test_the_same_again_changes_nothing_but_a_date(apply):
    first = apply([("f", 0, [PARKING], WHOLE)])
    again = apply([("g", 0, [PARKING], WHOLE)], first, 2)  # another blockface: the new zone's own id differs
    same = lambda t, *c: sorted(map(tuple, t.select(*c).collect()))
    for name, keys in publication.KEYS.items():
        assert same(first[name], *keys) == same(again[name], *keys)
    assert again["links_to_add"].isEmpty() and again["links_to_delete"].isEmpty() and changes(again) == ["touch"]
    assert again["curb_policies"].first()["description"] == "day 1: parking"
    row = again["curb_zones"].first()
    assert (str(row["start_date"])[:10], str(row["last_updated_date"])[:10], row["end_date"]) == ("2030-01-01", "2030-01-02", None)
    third = apply([("g", 0, [PARKING], WHOLE)], again, 3)
    assert counts(third) == counts(again) and changes(third) == ["touch"]


def test_unlinked_policies_go_and_are_not_described(apply, spark):
    first = apply([("f", 0, [PARKING], WHOLE)])
    extra = first["curb_policies"].withColumns({"curb_policy_id": F.lit("unused"), "signature": F.lit("s"), "description": F.lit(None).cast("string")})
    again = apply([("f", 0, [PARKING], WHOLE)], first | {"curb_policies": first["curb_policies"].union(extra)}, 2)
    assert [r["description"] for r in again["curb_policies"].collect()] == ["day 1: parking"]


def test_a_zone_gains_a_policy_and_keeps_its_id(apply):
    first = apply([("f", 0, [PARKING], WHOLE)])
    again = apply([("g", 0, [PARKING, LOADING], WHOLE)], first, 2)
    zone = first["curb_zones"].first()["curb_zone_id"]
    assert [r["curb_zone_id"] for r in again["curb_zones"].collect()] == [zone] and changes(again) == ["relink"]
    assert again["curb_zone_policies"].count() == 2 and again["links_to_add"].count() == 2
    assert again["links_to_delete"].collect() == first["curb_zone_policies"].collect()
    assert sorted(r["description"] for r in again["curb_policies"].collect()) == ["day 1: parking", "day 2: loading"]
    check_consistent(again)
    back = apply([("g", 0, [LOADING], WHOLE)], again, 3)
    assert counts(back)["curb_policies"] == 1 and counts(back)["curb_policy_time_spans"] == 1 and back["links_to_delete"].count() == 2


def test_a_line_that_drifts_stays(apply):
    first = apply([("f", 0, [PARKING], WHOLE)])
    again = apply([("f", 0, [PARKING], DRIFT)], first, 2)
    assert [r["curb_zone_id"] for r in active(again).collect()] == [first["curb_zones"].first()["curb_zone_id"]]
    assert again["curb_zones"].count() == 1


def test_a_split_ends_the_old_zone_and_keeps_its_neighbour(apply):
    first = apply([("f", 0, [PARKING], WHOLE), ("h", 0, [LOADING], NEXT)])
    split, kept = (first["curb_zones"].where(F.col("geometry").contains(x)).first()["curb_zone_id"] for x in ("-71.06 ", "-71.062"))
    again = apply([("f", 0, [PARKING], FIRST), ("f", 1, [LOADING], SECOND)], first, 2)
    assert changes(again) == ["insert", "insert", "keep", "retire"]
    ids = {r["curb_zone_id"] for r in active(again).collect()}
    assert len(ids) == 3 and kept in ids and split not in ids
    assert {r["curb_zone_id"] for r in again["links_to_delete"].collect()} == {split}
    ended = again["curb_zones"].where(F.col("curb_zone_id") == split).first()
    assert str(ended["end_date"]) == str(ended["last_updated_date"]) == "2030-01-02 00:00:00"
    untouched = again["curb_zones"].where(F.col("curb_zone_id") == kept).first()
    assert str(untouched["last_updated_date"]) == "2030-01-01 00:00:00"
    check_consistent(again)
    # the whole zone comes back on the same curb: a zone of its own, though its line is the one of an ended zone
    third = apply([("f", 0, [PARKING], WHOLE)], again, 3)
    assert changes(third) == ["ended", "insert", "keep", "retire", "retire"]
    check_consistent(third)


def test_equivalent_to_several(apply, spark):
    """Two old zones on one curb, and a new one on it that also runs into a third."""
    first = apply([("f", 0, [PARKING], WHOLE)])
    twin = lambda t: t.withColumn("curb_zone_id", F.lit("twin"))
    both = first | {k: first[k].unionByName(twin(first[k])) for k in ("curb_zones", "curb_zone_policies")}
    again = apply([("f", 0, [LOADING], WHOLE)], both, 2)
    assert changes(again) == ["relink", "relink"]
    policies = {r["curb_policy_id"] for r in again["curb_policies"].collect()}
    assert {tuple(r) for r in again["curb_zone_policies"].collect()} == {(z, p) for z in ("twin", first["curb_zones"].first()["curb_zone_id"]) for p in policies}
    check_consistent(again)


def test_links_of_zones_that_are_not_active_go(apply):
    first = apply([("f", 0, [PARKING], WHOLE)])
    stale = first["curb_zone_policies"].withColumn("curb_zone_id", F.lit("gone"))
    again = apply([("f", 0, [PARKING], WHOLE)], first | {"curb_zone_policies": first["curb_zone_policies"].union(stale)}, 2)
    assert [r["curb_zone_id"] for r in again["links_to_delete"].collect()] == ["gone"]
    check_consistent(again)


def test_a_missing_description_stops_the_publication(spark):
    df = spark.createDataFrame([("f", 0, [PARKING], WHOLE)], SEGMENTS)
    with pytest.raises(Exception, match="description is missing"):
        publication.apply_publication(df, None, F.current_timestamp(), lambda text: F.lit(""))["curb_policies"].collect()
