"""Policy documents: schema, canonical text, normal form, priority and signature."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The fields of a policy document.
RATE = "struct<rate:int,rate_unit:string,rate_unit_period:string,increment_duration:int,increment_amount:int,start_duration:int,end_duration:int,max_fee:int>"
RULE = f"struct<activity:string,max_stay:int,max_stay_unit:string,purposes:array<string>,user_classes:array<string>,user_classes_except:array<string>,rate:{RATE}>"
SPAN = "struct<start_date:bigint,end_date:bigint,days_of_week:array<string>,days_of_month:array<int>,weeks_of_month:array<int>,months:array<int>,time_of_day_start:string,time_of_day_end:string,designated_period:array<string>,designated_period_except:boolean>"
POLICY = f"struct<name:string,priority:int,rules:array<{RULE}>,time_spans:array<{SPAN}>>"

#: Weekdays in order.
DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]

#: Policies of features and the policy where nothing is posted.
FIRE_HYDRANT = '{"rules": [{"activity": "no stopping", "purposes": ["fire_hydrant"]}], "priority": 1}'
BUS_STOP = '{"rules": [{"activity": "no stopping", "purposes": ["bus_stop"]}], "priority": 1}'
PARKING_ANYTIME = '{"rules": [{"activity": "parking"}], "priority": 93}'
UNUSABLE_PRIORITY = 98


def canonical_json(text: Column) -> Column:
    """JSON text with the keys of all objects sorted; null where the text is null."""
    return F.to_json(F.parse_json(text))


def parse(text: Column) -> Column:
    """The typed policy of a JSON text."""
    return F.from_json(text, POLICY)


def some(values: Column) -> Column:
    """True for an array with elements, false for null and empty."""
    return F.coalesce(F.size(values) > 0, F.lit(False))


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def limited(span: Column) -> Column:
    """Whether one span is less than always; the times of a whole day are fixed values."""
    week = F.coalesce(F.size(F.array_distinct(span["days_of_week"])) == 7, F.lit(False))
    start = F.coalesce(span["time_of_day_start"].isin("00:00", "00:01"), F.lit(False))
    end = F.coalesce(span["time_of_day_end"].isin("00:00", "23:59"), F.lit(False))
    year = span["months"].isNull() | (F.size(F.array_distinct(span["months"])) == 12)
    return ~(week & start & end & year & ~some(span["designated_period"]))


def priority(policy: Column) -> Column:
    """The rank of a typed policy, 1 (first) to 99, by the published decision table, whose numbers are fixed values.

    A policy is negative if an activity begins with "no ", user-specific if a
    rule names classes, exceptions or purposes, and timed if a span is less
    than always. A null policy, or one without rules, has 99.
    """
    rules = F.coalesce(policy["rules"], _none(RULE))
    spans = F.coalesce(policy["time_spans"], _none(SPAN))
    neg = F.exists(rules, lambda r: F.startswith(F.lower(r["activity"]), F.lit("no ")))
    user = F.exists(rules, lambda r: some(r["user_classes"]) | some(r["user_classes_except"]) | some(r["purposes"]))
    timed = F.exists(spans, limited)
    dated = F.exists(spans, lambda s: s["start_date"].isNotNull() & s["end_date"].isNotNull())
    special = F.exists(spans, lambda s: some(s["designated_period"]))
    has = lambda a: F.exists(rules, lambda r: F.lower(r["activity"]) == a)
    offset = F.when(has("no stopping"), 1).when(has("no loading"), 2).when(has("no parking"), 3).otherwise(0)
    table = (
        F.when(F.size(rules) == 0, 99)
        .when(neg & ~user & ~timed & ~dated, F.when(offset > 0, offset).otherwise(9))
        .when(~neg & dated, 10)
        .when(neg & dated, offset + 20)
        .when(neg & ~user & timed, F.when(special, 30).otherwise(35) + offset)
        .when(~neg & user & timed, 40)
        .when(neg & user & timed, offset + 50)
        .when(~neg & user, 60)
        .when(neg & user, offset + 70)
        .when(~neg & timed, 80)
        .otherwise(F.when(has("parking"), 99).otherwise(90))
    )
    return F.coalesce(table, F.lit(99)).cast("int")


def normalise(policy: Column) -> Column:
    """A typed policy in normal form: lists sorted, all months and empty lists null, whole hours for minutes."""
    full = lambda a: F.when(some(a), F.array_sort(F.array_distinct(a)))
    week = lambda a: F.when(some(a), F.filter(F.array(*map(F.lit, DAYS)), lambda d: F.array_contains(a, d)))
    hours = lambda r: (r["max_stay_unit"] == "minute") & (r["max_stay"] % 60 == 0) & (r["max_stay"] > 0)

    def rule(r: Column) -> Column:
        return F.struct(
            F.lower(r["activity"]).alias("activity"),
            F.when(hours(r), (r["max_stay"] / 60).cast("int")).otherwise(r["max_stay"]).alias("max_stay"),
            F.when(hours(r), F.lit("hour")).otherwise(r["max_stay_unit"]).alias("max_stay_unit"),
            full(r["purposes"]).alias("purposes"),
            full(r["user_classes"]).alias("user_classes"),
            full(r["user_classes_except"]).alias("user_classes_except"),
            r["rate"].alias("rate"),
        )

    def span(s: Column) -> Column:
        return F.struct(
            s["start_date"].alias("start_date"),
            s["end_date"].alias("end_date"),
            week(s["days_of_week"]).alias("days_of_week"),
            full(s["days_of_month"]).alias("days_of_month"),
            full(s["weeks_of_month"]).alias("weeks_of_month"),
            F.when(F.size(F.array_distinct(s["months"])) < 12, full(s["months"])).alias("months"),
            s["time_of_day_start"].alias("time_of_day_start"),
            s["time_of_day_end"].alias("time_of_day_end"),
            full(s["designated_period"]).alias("designated_period"),
            s["designated_period_except"].alias("designated_period_except"),
        )

    return F.struct(policy["name"].alias("name"), policy["priority"].alias("priority"), F.array_sort(F.transform(policy["rules"], rule)).alias("rules"), F.array_sort(F.transform(policy["time_spans"], span)).alias("time_spans"))


def times_valid(policy: Column) -> Column:
    """Whether every time of day is HH:MM."""
    ok = lambda t: t.isNull() | F.coalesce(t.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$"), F.lit(True))
    return F.forall(F.coalesce(policy["time_spans"], _none(SPAN)), lambda s: ok(s["time_of_day_start"]) & ok(s["time_of_day_end"]))


def signature(policy: Column) -> Column:
    """md5 of a typed policy's normal form, apart from name and priority."""
    n = normalise(policy)
    return F.md5(F.to_json(F.struct(n["rules"].alias("rules"), n["time_spans"].alias("time_spans"))))


def is_missing_description(value: Column) -> Column:
    """Null, blank, or one of the placeholders of older runs (fixed values)."""
    placeholders = ["", "no description available", "no policy description provided", "no policy description provided."]
    return F.coalesce(F.lower(F.trim(value)), F.lit("")).isin(placeholders)
