"""URL filter rules by a sort-merge range join.

A host is written with its labels reversed and a dot after each
(``www.example.com`` -> ``com.example.www.``), so a rule's host and all its
subdomains are the keys of one interval: those that begin with its key. A
rule's host and path in one key make an interval of paths in the same way.
Intervals of prefixes are nested or apart. Keys of rules and urls are sorted
together, and a sweep keeps the stack of active nested rules: a key that comes
next takes off the top what it does not begin with. Urls first meet the hosts of
rules, then the paths of those hosts. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: Rules that one fold handles at a time.
BLOCK = 1024
#: Stands between the host and the path of a key; no host holds it that a rule could match.
MARK = "\x00"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _popped(stack: Column, key: Column) -> Column:
    """What is left of a stack of keys, shortest first, at ``key``: those it begins with."""
    return F.filter(stack, lambda x: F.startswith(key, x["key"]))


def nested_stacks(intervals: DataFrame, partitions: int) -> DataFrame:
    """(key, stack): for each of the distinct keys of ``intervals`` (key, value), the intervals around it and itself, outermost first.

    Keys are dealt by ranges into blocks of at most BLOCK. In a block a fold
    over the sorted keys pops and pushes. A block begins with what the blocks
    before it leave, which a fold over one row for each block finds.
    """
    dealt = cut(intervals.repartitionByRange(partitions, "key").withColumn("part", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    blocks = dealt.withColumn("block", F.floor(place / BLOCK)).groupBy("part", "block").agg(F.array_sort(F.collect_list(F.struct("key", "value"))).alias("keys"))
    item = blocks.schema["keys"].dataType.elementType.simpleString()
    none = F.array().cast(f"array<{item}>")

    def push(stack: Column, x: Column) -> Column:
        return F.concat(_popped(stack, x["key"]), F.array(x))

    def step(acc: Column, x: Column) -> Column:
        now = push(acc["stack"], x)
        return F.struct(now.alias("stack"), F.concat(acc["all"], F.array(now)).alias("all"))

    start = F.struct(none.alias("stack"), F.array().cast(f"array<array<{item}>>").alias("all"))
    local = cut(blocks.select("part", "block", F.aggregate("keys", start, step, lambda acc: acc["all"]).alias("stacks")))
    last = F.struct("part", "block", F.element_at("stacks", -1).alias("stack"))
    # a block's own stack goes on top of what its last key leaves of the stack before it
    over = lambda stack, own: F.concat(_popped(stack, F.element_at(own, -1)["key"]), own)
    before = F.struct(none.alias("stack"), F.array().cast(f"array<struct<part:int,block:bigint,stack:array<{item}>>>").alias("all"))
    carry = lambda acc, x: F.struct(over(acc["stack"], x["stack"]).alias("stack"), F.concat(acc["all"], F.array(F.struct(x["part"].alias("part"), x["block"].alias("block"), acc["stack"].alias("stack")))).alias("all"))
    ends = local.agg(F.array_sort(F.collect_list(last)).alias("ends")).select(F.explode(F.aggregate("ends", before, carry, lambda acc: acc["all"])).alias("c"))
    carried = ends.select("c.part", "c.block", F.col("c.stack").alias("carried"))
    found = local.join(carried, ["part", "block"]).select("carried", F.explode("stacks").alias("own"))
    return found.select(F.element_at("own", -1)["key"].alias("key"), over(F.col("carried"), F.col("own")).alias("stack"))


def sweep(points: DataFrame, intervals: DataFrame, partitions: int) -> DataFrame:
    """``points`` (key, point) with ``active``: the intervals (key, value) that hold the point's key, outermost first.

    The sort key ends with a hash of the point, so the points of one key are
    dealt over as many range partitions as they need. A partition takes the
    stack that it starts with from the last interval of the partitions before
    it; for that, one row for each partition is gathered, as long as intervals
    are deeply nested.
    """
    stacks = nested_stacks(intervals, partitions).select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("spread"), "stack")
    order = ["key", "kind", "spread"]
    both = points.select("key", F.lit(1).alias("kind"), F.xxhash64("point").alias("spread"), "point").unionByName(stacks, allowMissingColumns=True)
    dealt = cut(both.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()))
    last = dealt.where(F.col("kind") == 0).groupBy("part").agg(F.max_by("stack", "key").alias("last"))
    parts = dealt.groupBy("part").agg(F.lit(1).alias("one")).join(last, "part", "left")
    before = Window.partitionBy("one").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(F.col("part").alias("of"), F.last("last", ignorenulls=True).over(before).alias("carried"))
    swept = dealt.join(F.broadcast(carried), F.col("part") == F.col("of"))
    past = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    stack = F.coalesce(F.last("stack", ignorenulls=True).over(past), F.col("carried"))
    swept = swept.withColumn("stack", stack).where(F.col("kind") == 1)
    return swept.select("key", "point", F.coalesce(_popped(F.col("stack"), F.col("key")), F.array().cast(dealt.schema["stack"].dataType)).alias("active"))


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow", partitions: int | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the longest rule that fits, else null) and ``verdict``.

    ``rules`` has (host, path, verdict). A rule fits its host and all
    subdomains, if the url's path starts with the rule's path; of the rules
    that fit, the longest wins, then the one with the longer host, then the
    lower verdict. Urls that no rule fits get ``default``.

    The first sweep gives a url the hosts of rules that it lies under, at most
    one for each of its labels; the second gives each of these the rules whose
    path it begins with, of which the last is the longest.

    Cases: a null url or one without ``://`` has an empty host and path and
    gets the default; no rules or no pages are fine; repeated rows stay; input
    columns named ``host``, ``path``, ``rule`` or ``verdict`` are replaced, and
    others may have any name; urls may be of any length.
    """
    n = partitions or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    page = F.struct(*kept) if kept else F.struct(F.lit(1).alias("one"))
    point = F.struct(F.monotonically_increasing_id().alias("rid"), page.alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rules = rules.select(ascii_lower("host").alias("host"), "path", "verdict").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    rules = cut(rules.withColumn("hkey", host_key(F.col("host"))))
    hosts = rules.select(F.col("hkey").alias("key"), F.lit(1).alias("value")).distinct()
    points = pages.select(point.alias("point")).select(host_key(F.col("point.host")).alias("key"), "point")
    # kept, as its rows are numbered and read twice
    under = cut(sweep(points, hosts, n).select("point", F.transform("active", lambda x: x["key"]).alias("hkeys")))

    key = lambda host, path: F.concat(host, F.lit(MARK), path)
    paths = rules.select(key(F.col("hkey"), F.col("path")).alias("key"), F.struct(F.char_length(F.concat("host", "path")).alias("length"), F.char_length("host").alias("host_length"), "host", "path", "verdict").alias("value"))
    probes = under.select(F.explode("hkeys").alias("hkey"), "point").select(key(F.col("hkey"), F.col("point.path")).alias("key"), F.struct("point.rid").alias("point"))
    met = sweep(probes, paths, n).where(F.size("active") > 0).select("point.rid", F.element_at("active", -1)["value"].alias("hit"))
    best = met.groupBy("rid").agg(F.max("hit").alias("hit"))
    out = under.select("point.*").join(best, "rid", "left")
    return out.select(*[F.col("page")[c].alias(c) for c in kept], "host", "path", F.concat("hit.host", "hit.path").alias("rule"), F.coalesce(F.col("hit.verdict"), F.lit(default)).alias("verdict"))
