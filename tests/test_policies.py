"""Policy propagation against a walk of the curb, and priorities against the bands."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from kerbspark.functions import policies as P
from kerbspark.operators import policies

POLICIES = [json.dumps({"rules": [{"activity": a}], "priority": p}) for a, p in (("no parking", 38), ("parking", 80), ("loading", 90), ("no stopping", 37))]


def canonical(text):
    return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"))


def walked(segments, arrows):
    """The policies of each segment of one curb, by walking it both ways: an arrow away begins a policy ahead, one toward begins it behind."""
    order = [("arrow", a) for a in arrows.get((0, "up"), [])]
    for n in range(segments):
        order += [("segment", n), *[("arrow", a) for a in arrows.get((n, "down"), [])]]
    held = collections.defaultdict(set)
    for steps, begins in ((order, "AWAY"), (order[::-1], "TOWARD")):
        on = set()
        for kind, x in steps:
            if kind == "segment":
                held[x] |= on
            else:
                (on.add if x[1] == begins else on.discard)(x[0])
    return held


def test_propagation_is_a_walk_both_ways(spark):
    rng = random.Random(12)
    rows, posted, features, want = [], [], [], {}
    hydrant = canonical(P.FIRE_HYDRANT)
    for face in range(60):
        left, n = bool(face % 2), rng.randint(1, 7)
        arrows, toggles = {}, 0
        for seq in range(n):
            lists = {"up": None, "down": None}
            for side in ("up", "down") if seq == 0 else ("down",):
                places = [f"{face}/{seq}{side}{i}" for i in range(rng.choice([0, 1, 1, 2]))]
                lists[side] = places or None
                found = []
                for place in places:
                    if side == "down" and rng.random() < 0.3:
                        features.append((place, "fire_hydrant"))
                        found.append((hydrant, "TOWARD" if toggles % 2 else "AWAY"))
                        toggles += 1
                        continue
                    own = []
                    for text in rng.sample(POLICIES, rng.choice([0, 1, 2])):
                        arrow = rng.choice([None, "both", "left", "right", "AWAY", "TOWARD"])
                        posted.append((place, text, arrow))
                        ahead = {"left": "TOWARD" if left else "AWAY", "right": "AWAY" if left else "TOWARD"}.get(arrow, arrow)
                        own += [(canonical(text), d) for d in (["TOWARD", "AWAY"] if arrow in (None, "both") else [ahead])]
                    found += own
                arrows[seq, side] = found
            rows.append((f"f{face}", f"{face}#{seq}", seq, left, lists["up"], lists["down"]))
        for seq, texts in walked(n, arrows).items():
            want[f"{face}#{seq}"] = texts
    segments = spark.createDataFrame(rows, "blockface_id string, segment_id string, segment_seq int, is_left_side_oneway boolean, upstream_loc_list array<string>, downstream_loc_list array<string>")
    made = policies.apply_policies(segments, spark.createDataFrame(posted, "location_id string, policy_json string, arrow string"), spark.createDataFrame(features, "location_id string, feature_type string"))
    got = {r["segment_id"]: [canonical(p) for p in r["policy_list"]] for r in made.collect()}
    assert {k: set(v) for k, v in got.items()} == {k: want.get(k, set()) for k in got} and len(got) == len(rows)
    rank = lambda p: json.loads(p)["priority"]
    assert all([rank(p) for p in v] == sorted(rank(p) for p in v) for v in got.values()) and any(len(v) > 2 for v in got.values())


#: Policies by their letters, and what must come out of curbs that pass them. A curb is its side, what is
#: posted where (an arrow "<" is left, ">" right, "=" both), and for each segment: upstream places, downstream places,
#: letters of its policies in order. Places beginning with h are hydrants; meters post "+" where they begin and "-" where they end.
LETTERS = {"N": ("no parking", 38), "C": ("no parking", 38, "street cleaning"), "2": ("parking", 40), "P": ("no parking", 53), "M": ("parking", 83), "K": ("parking", 43)}
CURBS = {
    "0": ("right", {"c": "C<"}, [("", "c", ""), ("c", "", "C")]),
    "0 left": ("left", {"c": "C<"}, [("", "c", "C"), ("c", "", "")]),
    "1": ("right", {"a": "N<", "b": "N>"}, [("", "a", ""), ("a", "b", "N"), ("b", "", "")]),
    "1 left": ("left", {"a": "N>", "b": "N<"}, [("", "a", ""), ("a", "b", "N"), ("b", "", "")]),
    "2": ("right", {"a": "N>", "b": "2="}, [("", "a", "N2"), ("a", "b", "2"), ("b", "", "2")]),
    "2 left": ("left", {"a": "2=", "b": "N>"}, [("", "a", "2"), ("a", "b", "2"), ("b", "", "N2")]),
    "3": ("right", {"a": "2="}, [("", "h", "2"), ("h", "h", "F2"), ("h", "a", "2"), ("a", "", "2")]),
    "3 left": ("left", {"a": "2="}, [("", "a", "2"), ("a", "h", "2"), ("h", "h", "F2"), ("h", "", "2")]),
    "4": ("right", {"a": "2="}, [("", "h", "2"), ("h", "a", "F2"), ("a", "h", "F2"), ("h", "", "2")]),
    "4 left": ("left", {"a": "2="}, [("", "h", "2"), ("h", "a", "F2"), ("a", "h", "F2"), ("h", "", "2")]),
    "5": ("right", {"m": "M+", "n": "M-"}, [("m", "n", "M")]),
    "6": ("right", {"m": "M+", "n": "M- K+", "o": "K- M+", "p": "M-"}, [("m", "m n", "M"), ("n", "o", "K"), ("o p", "p", "M")]),
    "7": ("right", {"m": "M+", "a": "P<", "b": "P>"}, [("m", "m a", "M"), ("a", "b", "PM"), ("b", "", "M")]),
    "8": ("right", {"m": "M+", "a": "N>"}, [("m", "m a", "NM"), ("a", "h", "M"), ("h", "h", "FM"), ("h", "", "M")]),
}
ARROWS = {"<": "left", ">": "right", "=": "both", "+": "AWAY", "-": "TOWARD"}


def lettered(letter):
    activity, rank, *name = LETTERS[letter]
    return json.dumps({"name": name[0] if name else letter, "rules": [{"activity": activity}], "priority": rank})


def test_fixed_curbs(spark):
    rows, posted, features = [], [], []
    for case, (side, places, segments) in CURBS.items():
        at = lambda names, case=case: [f"{case}/{x}" for x in names.split()] or None
        rows += [(case, f"{case}#{n}", n, side == "left", at(up), at(down)) for n, (up, down, _) in enumerate(segments)]
        posted += [(f"{case}/{x}", lettered(p[0]), ARROWS[p[1]]) for x, text in places.items() for p in text.split()]
        features.append((f"{case}/h", "fire_hydrant"))
        features += [(f"{case}/{x}", kind) for x in places for kind in ("bench", "tree")]  # other features change nothing
    segments = spark.createDataFrame(rows, "blockface_id string, segment_id string, segment_seq int, is_left_side_oneway boolean, upstream_loc_list array<string>, downstream_loc_list array<string>")
    posted = spark.createDataFrame(posted, "location_id string, policy_json string, arrow string")
    features = spark.createDataFrame(features, "location_id string, feature_type string")
    letters = {canonical(lettered(x)): x for x in LETTERS} | {canonical(P.FIRE_HYDRANT): "F"}
    got = {r["segment_id"]: "".join(letters[canonical(p)] for p in r["policy_list"]) for r in policies.apply_policies(segments, posted, features).collect()}
    want = {f"{case}#{n}": x for case, (_, _, segments) in CURBS.items() for n, (_, _, x) in enumerate(segments)}
    assert got == want and len(CURBS) == 14
    log = policies.event_log(segments, posted, features)
    assert log.count() == log.distinct().count()


HOURS = {"days_of_week": ["mon"], "time_of_day_start": "08:00", "time_of_day_end": "18:00"}
#: Published ranks of rules and spans.
RANKS = [
    (99, [], []),
    (1, [{"activity": "no stopping"}], []),
    (2, [{"activity": "no loading"}], []),
    (3, [{"activity": "no parking"}], []),
    (10, [{"activity": "parking"}], [{"start_date": 1, "end_date": 2}]),
    (21, [{"activity": "no stopping"}], [{"start_date": 1, "end_date": 2}]),
    (33, [{"activity": "no parking"}], [HOURS | {"designated_period": ["snow emergency"]}]),
    (37, [{"activity": "no loading"}], [HOURS]),
    (40, [{"activity": "parking", "user_classes": ["resident_permit"]}], [HOURS]),
    (53, [{"activity": "no parking", "user_classes_except": ["accessible"]}], [HOURS]),
    (60, [{"activity": "loading", "user_classes": ["truck"]}], []),
    (71, [{"activity": "no stopping", "user_classes": ["truck"]}], []),
    (80, [{"activity": "parking"}], [HOURS]),
    (99, [{"activity": "parking"}], []),
    (90, [{"activity": "loading"}], []),
    (99, [{"activity": "parking"}], [{"days_of_week": P.DAYS, "time_of_day_start": "00:00", "time_of_day_end": "23:59"}]),
]


def test_fixed_ranks(spark):
    rows = [(n, json.dumps({"rules": rules, "time_spans": spans})) for n, (_, rules, spans) in enumerate(RANKS)]
    got = spark.createDataFrame(rows, "n int, j string").select("n", P.priority(P.parse(F.col("j"))).alias("p")).collect()
    assert {r["n"]: r["p"] for r in got} == {n: want for n, (want, _, _) in enumerate(RANKS)} and len(RANKS) == 16


def test_an_error_sets_aside_its_own_blockface_only(spark):
    schema = "blockface_id string, segment_id string, segment_seq int, is_left_side_oneway boolean, upstream_loc_list array<string>, downstream_loc_list array<string>"
    rows = [("good", "g0", 0, False, None, ["a"]), ("arrow", "x0", 0, False, ["bad"], ["bad", "a"]), ("text", "t0", 0, False, None, ["worse"]), ("text", "t1", 1, False, ["bad"], None), ("gap", "p0", 0, False, None, None), ("gap", "p2", 2, False, None, ["bad"])]
    posted = [("a", lettered("2"), "both"), ("bad", lettered("2"), "up"), ("bad", lettered("N"), "up"), ("worse", "{no", None), ("unused", "{no", "down")]
    lists, errors = policies.apply_or_quarantine(spark.createDataFrame(rows, schema), spark.createDataFrame(posted, "location_id string, policy_json string, arrow string"), spark.createDataFrame([], "location_id string, feature_type string"))
    assert [(r["segment_id"], len(r["policy_list"])) for r in lists.collect()] == [("g0", 1)]
    assert sorted(map(tuple, errors.collect())) == [("arrow", "policies", "unknown arrow: up"), ("gap", "policies", "unknown arrow: up"), ("gap", "validation", "sequence"), ("text", "policies", "policy is not JSON")]


def test_faulty_blockfaces_are_reported(spark):
    rows = [("a", 0, True), ("a", 2, True), ("b", 0, True), ("b", 1, False), ("c", 0, None), ("c", 1, False)]
    got = {(r[0], r[1]) for r in policies.blockface_faults(spark.createDataFrame(rows, "blockface_id string, segment_seq int, is_left_side_oneway boolean")).collect()}
    assert got == {("a", "sequence"), ("b", "one-way flag")}


ACTIVITIES = ["no stopping", "no loading", "no parking", "parking", "loading"]
LIMITS = {"none": [], "always": [{"days_of_week": P.DAYS, "time_of_day_start": "00:01", "time_of_day_end": "00:00"}], "hours": [{"days_of_week": P.DAYS, "time_of_day_start": "07:00", "time_of_day_end": "09:30"}], "days": [{"days_of_week": ["sat", "sun"]}], "season": [{"days_of_week": P.DAYS, "time_of_day_start": "00:00", "time_of_day_end": "23:59", "months": [6, 7]}], "period": [{"designated_period": ["school days"]}], "dates": [{"start_date": 5, "end_date": 9, "time_of_day_start": "07:00"}]}
CLASSES = [{}, {"user_classes": ["bus"]}, {"user_classes_except": ["bus"]}, {"purposes": ["film"]}]

#: Fixed values, the published bands: for a limit by dates, period or hours, or none, without and with user classes. Negative activities add their number.
BANDS = {("dates", False): 10, ("dates", True): 10, ("hours", False): 80, ("hours", True): 40, ("none", True): 60}
NEGATIVE_BANDS = {("dates", False): 20, ("dates", True): 20, ("period", False): 30, ("hours", False): 35, ("hours", True): 50, ("none", False): 0, ("none", True): 70}


def test_priority_follows_the_bands(spark):
    rows = []
    for n, activity in enumerate(ACTIVITIES):
        for limit, spans in LIMITS.items():
            for more in CLASSES:
                kind = "none" if limit in ("none", "always") else limit if limit in ("dates", "period") else "hours"
                users = bool(more)
                if n < 3:
                    want = NEGATIVE_BANDS[kind if (kind, users) in NEGATIVE_BANDS else "hours", users] + n + 1
                else:
                    kind = "hours" if kind == "period" else kind
                    want = BANDS.get((kind, users), 99 if activity == "parking" else 90)
                rows.append((json.dumps({"rules": [{"activity": activity} | more], "time_spans": spans}), want))
    rows.append((json.dumps({"rules": [], "time_spans": LIMITS["hours"]}), 99))
    df = spark.createDataFrame(rows, "j string, want int").withColumn("got", P.priority(P.parse(F.col("j"))))
    assert [tuple(r) for r in df.where("got != want").collect()] == [] and len(rows) == 141


@pytest.mark.parametrize("text,missing", [(None, True), ("  ", True), ("No Description Available", True), ("park here", False)])
def test_missing_descriptions(spark, text, missing):
    assert spark.createDataFrame([(text,)], "d string").select(P.is_missing_description(F.col("d"))).first()[0] is missing


def test_normal_form_and_signature(spark):
    a = {"rules": [{"activity": "Parking", "max_stay": 120, "max_stay_unit": "minute", "user_classes": ["b", "a"]}], "time_spans": [{"days_of_week": ["tue", "mon"], "months": list(range(1, 13))}], "priority": 5}
    b = {"rules": [{"activity": "parking", "max_stay": 2, "max_stay_unit": "hour", "user_classes": ["a", "b"]}], "time_spans": [{"days_of_week": ["mon", "tue"]}], "name": "x"}
    got = spark.createDataFrame([(json.dumps(a),), (json.dumps(b),)], "j string").select(P.signature(P.parse(F.col("j")))).collect()
    assert got[0] == got[1]
