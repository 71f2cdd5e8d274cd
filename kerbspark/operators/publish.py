"""Publication: segments to zones, policies to tables, and what changes against what is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import policies as P
from .layout import spread


def zones_from_segments(segments: DataFrame) -> DataFrame:
    """Neighbouring segments of a blockface with one policy list as one zone, their lines joined.

    ``segments``: blockface_id, segment_seq, policy_list, line.
    """
    w = Window.partitionBy("blockface_id").orderBy("segment_seq")
    new = ~F.col("policy_list").eqNullSafe(F.lag("policy_list").over(w)) | F.lag("segment_seq").over(w).isNull()
    df = segments.withColumn("no", F.sum(new.cast("int")).over(w))
    rows = F.array_sort(F.collect_list(F.struct("segment_seq", "line")))
    g = df.groupBy("blockface_id", "no").agg(rows.alias("rows"), F.first("policy_list").alias("policy_list"))
    line = G.join_lines(F.transform("rows", lambda r: r["line"]))
    g = g.withColumn("line", line)
    return g.select(F.sha2(F.concat_ws("|", "blockface_id", G.to_wkt(F.col("line"))), 256).alias("curb_zone_id"), "blockface_id", "line", "policy_list")


def unique_policies(zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curb_policy_id, policy_json) of distinct canonical policies, and (curb_zone_id, curb_policy_id)."""
    each = zones.select("curb_zone_id", F.explode("policy_list").alias("text")).withColumn("policy_json", P.canonical_json(F.col("text")))
    each = each.withColumn("curb_policy_id", F.sha2("policy_json", 256))
    return each.select("curb_policy_id", "policy_json").distinct(), each.select("curb_zone_id", "curb_policy_id").distinct()


def zone_tables(zones: DataFrame, links: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """The table of zones, with their line as text and open from ``now`` on, and their links to policies, each once."""
    times = [now.alias(c) for c in ("published_date", "last_updated_date", "start_date")]
    table = zones.select("curb_zone_id", G.to_wkt(F.col("line")).alias("geometry"), *times, F.lit(None).cast("timestamp").alias("end_date"))
    return table, links.join(zones, "curb_zone_id", "left_semi").select("curb_zone_id", "curb_policy_id").distinct()


def policy_tables(policies: DataFrame) -> dict[str, DataFrame]:
    """The tables of policies (curb_policy_id, policy_json): policies, rules, time spans, and rates where a rule has one."""
    typed = policies.withColumn("p", P.parse(F.col("policy_json")))
    rules = typed.select("curb_policy_id", F.posexplode("p.rules").alias("n", "r")).withColumn("rule_id", F.sha2(F.concat_ws("|", F.lit("rule"), "curb_policy_id", "n"), 256))
    spans = typed.select("curb_policy_id", F.posexplode("p.time_spans").alias("n", "s")).withColumn("time_span_id", F.sha2(F.concat_ws("|", F.lit("span"), "curb_policy_id", "n"), 256))
    rates = rules.where(F.col("r.rate").isNotNull())
    return {
        "curb_policies": typed.select("curb_policy_id", "p.name", "p.priority", P.signature(F.col("p")).alias("signature"), F.lit(None).cast("string").alias("description")),
        "curb_policy_rules": rules.select("rule_id", "curb_policy_id", "r.activity", "r.max_stay", "r.max_stay_unit", "r.purposes", "r.user_classes", "r.user_classes_except"),
        "curb_policy_time_spans": spans.select("time_span_id", "curb_policy_id", "s.*"),
        "curb_policy_rates": rates.select(F.sha2(F.concat_ws("|", F.lit("rate"), "rule_id"), 256).alias("rate_id"), "curb_policy_id", "rule_id", "r.rate.*"),
    }


def nested_policies(tables: dict[str, DataFrame]) -> DataFrame:
    """Policies with arrays of their rules, each with its rate, and time spans: the view for readers."""
    rates = tables["curb_policy_rates"]
    rate = rates.select("rule_id", F.struct(*[c for c in rates.columns if c not in ("rate_id", "curb_policy_id", "rule_id")]).alias("rate"))
    rules = tables["curb_policy_rules"].join(rate, "rule_id", "left")
    gather = lambda df, key, name: df.groupBy("curb_policy_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c not in (key, "curb_policy_id")]))).alias(name))
    return tables["curb_policies"].join(gather(rules, "rule_id", "rules"), "curb_policy_id", "left").join(gather(tables["curb_policy_time_spans"], "time_span_id", "time_spans"), "curb_policy_id", "left")


def unnested_policies(view: DataFrame) -> dict[str, DataFrame]:
    """The tables of :func:`policy_tables` from the nested view, with new ids of the rows; the content is the same."""
    row = lambda what, *keys: F.sha2(F.concat_ws("|", F.lit(what), *keys), 256)
    rules = view.select("curb_policy_id", F.posexplode("rules").alias("n", "r")).withColumn("rule_id", row("rule", "curb_policy_id", "n"))
    spans = view.select("curb_policy_id", F.posexplode("time_spans").alias("n", "s")).withColumn("time_span_id", row("span", "curb_policy_id", "n"))
    plain = [f.name for f in rules.schema["r"].dataType.fields if f.name != "rate"]
    rates = rules.where("r.rate IS NOT NULL")
    return {
        "curb_policies": view.drop("rules", "time_spans"),
        "curb_policy_rules": rules.select("rule_id", "curb_policy_id", *[f"r.{c}" for c in plain]),
        "curb_policy_time_spans": spans.select("time_span_id", "curb_policy_id", "s.*"),
        "curb_policy_rates": rates.select(row("rate", "rule_id").alias("rate_id"), "curb_policy_id", "rule_id", "r.rate.*"),
    }


def reuse_policies(new: DataFrame, old: DataFrame) -> DataFrame:
    """(curb_policy_id, use_id, is_new): a new policy whose signature is published uses the published id, the smallest of several."""
    by = old.groupBy("signature").agg(F.min("curb_policy_id").alias("old_id"))
    return new.join(by, "signature", "left").select("curb_policy_id", F.coalesce("old_id", "curb_policy_id").alias("use_id"), F.col("old_id").isNull().alias("is_new"))


def zone_changes(new: DataFrame, old: DataFrame, overlaps: DataFrame, new_links: DataFrame, old_links: DataFrame) -> DataFrame:
    """(zone_id, change) of new and active old zones.

    ``overlaps``: old_id, new_id, equivalent. ``new_links`` and ``old_links``:
    zone id, curb_policy_id, with reused ids. Of a new zone with an equivalent
    old one, the old one stays: ``keep`` with the same policies, else
    ``relink``; the new one is ``drop``. An old zone that only overlaps new ones
    is ``retire``. Other new zones are ``insert``, other old ones ``keep``. An
    equivalent pair decides over other overlaps of the new zone; an old zone
    that also overlaps another is retired unless it is equivalent to some.
    """
    lists = lambda df, name: df.groupBy("curb_zone_id").agg(F.array_sort(F.collect_set("curb_policy_id")).alias(name))
    same = overlaps.where("equivalent")
    pairs = same.join(lists(new_links, "np").withColumnRenamed("curb_zone_id", "new_id"), "new_id", "left").join(lists(old_links, "op").withColumnRenamed("curb_zone_id", "old_id"), "old_id", "left")
    decided = pairs.groupBy("old_id").agg(F.max(F.col("np").eqNullSafe(F.col("op"))).alias("alike"))
    hit = overlaps.where(~F.col("equivalent")).select("old_id").distinct().withColumn("hit", F.lit(True))
    olds = old.select(F.col("curb_zone_id").alias("old_id")).join(decided, "old_id", "left").join(hit, "old_id", "left")
    change = F.when(F.col("alike"), "keep").when(F.col("alike").isNotNull(), "relink").when(F.col("hit"), "retire").otherwise("keep")
    news = new.select(F.col("curb_zone_id").alias("new_id")).join(same.select("new_id").distinct().withColumn("same", F.lit(True)), "new_id", "left")
    return olds.select(F.col("old_id").alias("zone_id"), change.alias("change")).unionByName(news.select(F.col("new_id").alias("zone_id"), F.when(F.col("same"), "drop").otherwise("insert").alias("change")))


def equivalent(old_line: Column, new_line: Column, hausdorff: Column, tolerance: float) -> Column:
    """Lines no more than ``tolerance`` apart and twice that in length."""
    return (hausdorff <= tolerance) & (F.abs(G.line_length(old_line) - G.line_length(new_line)) <= 2 * tolerance)


def link_changes(wanted: DataFrame, published: DataFrame, active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of active zones to add, and published links to delete; both (curb_zone_id, curb_policy_id)."""
    keys = ["curb_zone_id", "curb_policy_id"]
    wanted = spread(spread(wanted.select(*keys), "curb_zone_id").join(active, "curb_zone_id", "left_semi"), *keys).distinct()
    published = spread(published.select(*keys), *keys)
    return wanted.join(published, keys, "left_anti"), published.join(wanted, keys, "left_anti")


def without_orphans(policies: DataFrame, links: DataFrame) -> DataFrame:
    """Policies, or rows of their child tables, that some link uses."""
    return policies.join(links, "curb_policy_id", "left_semi")


def fill_descriptions(policies: DataFrame, describe) -> DataFrame:
    """Missing descriptions by ``describe(column of canonical text)``, a Column builder; others stay.

    A description that is still missing stops the job.
    """
    missing = P.is_missing_description(F.col("description"))
    text = F.when(missing, describe(F.col("policy_json"))).otherwise(F.col("description"))
    done = F.when(P.is_missing_description(text), F.raise_error(F.lit("a description is missing"))).otherwise(text)
    return policies.withColumn("description", done)


def violations(zones: DataFrame, policies: DataFrame, links: DataFrame) -> DataFrame:
    """(rule, key) of everything that forbids a publication; empty if it may go on.

    ``zones``: curb_zone_id, line, end_date; ``policies``: curb_policy_id,
    description; ``links``: retained and new.
    """
    keys = ["curb_zone_id", "curb_policy_id"]
    n = F.count(F.lit(1))

    def twice(df: DataFrame, cols: list[str], rule: str) -> DataFrame:
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in cols])
        bad = (n > 1) | F.max(F.col(cols[0]).isNull())
        return df.groupBy(*cols).agg(bad.alias("bad")).where("bad").select(F.lit(rule).alias("rule"), key.alias("key"))

    active, by_zone = zones.where(F.col("end_date").isNull()), spread(links, "curb_zone_id")
    empty = zones.agg(n.alias("n")).where(F.col("n") == 0).select(F.lit("no zones").alias("rule"), F.lit("").alias("key"))
    parts = [
        twice(spread(zones, "curb_zone_id"), ["curb_zone_id"], "zone key"),
        twice(policies, ["curb_policy_id"], "policy key"),
        twice(by_zone, keys, "link key"),
        empty,
        zones.where(~G.is_valid_line(F.col("line"))).select(F.lit("invalid line"), F.col("curb_zone_id")),
        by_zone.join(active, "curb_zone_id", "left_anti").select(F.lit("link to inactive zone"), F.col("curb_zone_id")),
        spread(links, "curb_policy_id").join(policies, "curb_policy_id", "left_anti").select(F.lit("link to missing policy"), F.col("curb_policy_id")),
        policies.where(P.is_missing_description(F.col("description"))).select(F.lit("missing description"), F.col("curb_policy_id")),
    ]
    text = lambda df: df.toDF("rule", "key").select("rule", F.col("key").cast("string").alias("key"))
    out = text(parts[0])
    for p in parts[1:]:
        out = out.union(text(p))
    return out


def published_state(links: DataFrame) -> DataFrame:
    """(curb_zone_id, policy_ids): each zone's sorted policies."""
    return links.groupBy("curb_zone_id").agg(F.array_sort(F.collect_set("curb_policy_id")).alias("policy_ids"))
