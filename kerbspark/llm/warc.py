"""Not-modified revisits resolved to the responses they stand for.

A revisit record says that a page had not changed. Its content is that of the
latest earlier full response with the same canonical url; the join is as-of.
A revisit is only taken at its word if a validator (etag, payload digest or
last-modified) agrees with the response. Headers that a 304 response may
update replace those stored with the full response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower

#: Header fields that a 304 response may update in a stored one.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without fragment, default port and closing dots of the host; an empty path is ``/``.

    A null url stays null; one without ``://`` loses its fragment only.
    """
    bare = F.regexp_replace(url, "(?s)#.*$", "")
    scheme = ascii_lower(F.regexp_extract(bare, "(?s)^(.*?)://", 1))
    host = ascii_lower(F.regexp_extract(bare, "(?s)^.*?://([^/?]*)", 1))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    host = F.regexp_replace(host, "\\.+$", "")
    rest = F.regexp_extract(bare, "(?s)^.*?://[^/?]*(.*)$", 1)
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.contains(bare, F.lit("://")), F.concat(scheme, F.lit("://"), host, rest)).otherwise(bare)


def merge_headers(stored: Column, fresh: Column) -> Column:
    """``stored`` with the permitted fields of ``fresh`` in place of its own; names in lower case, sorted.

    Of fields given twice in one record the last counts; null headers are none.
    """
    none = F.create_map().cast("map<string,string>")

    def last(m: Column) -> Column:
        return F.map_entries(F.coalesce(m, none))

    low = lambda m: F.transform(last(m), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    new = F.filter(low(fresh), lambda e: e["key"].isin(PERMITTED))
    names = F.transform(new, lambda e: e["key"])
    old = F.filter(low(stored), lambda e: ~F.array_contains(names, e["key"]))
    return F.array_sort(F.array_distinct(F.concat(old, new)))


def resolve_revisits(records: DataFrame, *, bucket_seconds: int = 86_400) -> DataFrame:
    """Every row of ``records`` with the response that it stands for.

    ``records``: record_id, kind (``response`` or ``revisit``), url, ts, etag,
    digest, last_modified and headers (a map); more columns pass through. Added:
    ``canonical_url``; ``source_id``, the record_id of the latest response with
    that url before the revisit (at one time, lower ids are earlier);
    ``status``: ``response``, ``resolved``, ``mismatch`` (a validator that both
    have differs, or they share none) or ``no_response``; ``merged_headers``:
    sorted (key, value) pairs, of a resolved revisit the merged ones, otherwise
    the record's own.

    Time is cut into buckets, so the rows of one hot url are swept in as many
    tasks as it has buckets; a bucket gets the last response of the buckets
    before it from a table with one row for each url and bucket.

    Cases: a null url or time matches nothing; null validators do not take part;
    an etag's weak mark ``W/`` is ignored; a kind other than these two is
    treated as a response that no revisit may use, with status ``other``; equal
    records may repeat; an empty table gives an empty table.
    """
    added = ["canonical_url", "source_id", "status", "merged_headers"]
    bare = lambda c: F.regexp_replace(c, "^W/", "")
    # the record is one column, so that its columns may have any names
    df = records.select(F.struct(*[c for c in records.columns if c not in added]).alias("row"), canonical_url(F.col("url")).alias("canonical_url"), "kind", "ts", "record_id")
    df = df.withColumn("bucket", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(bucket_seconds * 1_000_000)))
    usable = (F.col("kind") == "response") & F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    row = F.col("row")
    full = F.when(usable, F.struct("ts", "record_id", *[row[c].alias(c) for c in ("etag", "digest", "last_modified", "headers")]))
    order = ["ts", "record_id"]
    # a url or time that is null gives a key of its own to each row, as it matches nothing
    lone = F.when(F.col("canonical_url").isNull() | F.col("ts").isNull(), F.xxhash64("record_id", "kind", row["digest"]))
    df = df.withColumn("lone", lone).withColumn("full", full)
    within = Window.partitionBy("canonical_url", "lone", "bucket").orderBy(*order, F.col("kind") != "response")
    last_of = df.where(usable).groupBy("canonical_url", "bucket").agg(F.max_by("full", F.struct(*order)).alias("last"))
    filled = df.select("canonical_url", "bucket").where(F.col("canonical_url").isNotNull() & F.col("bucket").isNotNull()).distinct().join(last_of, ["canonical_url", "bucket"], "left")
    before = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.select("canonical_url", "bucket", F.last("last", ignorenulls=True).over(before).alias("carried"))
    df = df.withColumn("seen", F.last("full", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.join(filled, ["canonical_url", "bucket"], "left")
    df = df.withColumn("src", F.when(F.col("kind") == "revisit", F.coalesce("seen", "carried")))

    def differs(a: Column, b: Column) -> Column:
        return F.coalesce(a != b, F.lit(False))

    src = F.col("src")
    pairs = [(bare(row["etag"]), bare(src["etag"])), (row["digest"], src["digest"]), (row["last_modified"], src["last_modified"])]
    agree = F.coalesce(*[F.when(a.isNotNull() & b.isNotNull(), F.lit(True)) for a, b in pairs], F.lit(False))
    for a, b in pairs:
        agree = agree & ~differs(a, b)
    status = F.when(F.col("kind") == "response", "response").when(F.coalesce(F.col("kind") != "revisit", F.lit(True)), "other").when(src.isNull(), "no_response").when(agree, "resolved").otherwise("mismatch")
    df = df.withColumn("status", status).withColumn("source_id", src["record_id"])
    merged = F.when(F.col("status") == "resolved", merge_headers(src["headers"], row["headers"])).otherwise(merge_headers(row["headers"], F.lit(None).cast("map<string,string>")))
    return df.withColumn("merged_headers", merged).select(*[row[c].alias(c) for c in records.columns if c not in added], *added)


def captures_of(pages: DataFrame) -> DataFrame:
    """Capture records that Spark derives from the ``pages`` table: each page's response, and for some a later revisit.

    Page p is captured at p minutes; every third page is revisited two hours later, every
    fifteenth with another etag, every 21st without validators but the date of change.
    """
    p, day = F.col("page_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    at = lambda m: F.timestamp_add("MINUTE", m, day)
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")))
    etag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    base = pages.select("page_id", "url", digest.alias("digest"), etag.alias("etag"), F.date_format(at(p % 1000), "yyyy-MM-dd HH:mm:ss").alias("changed"))
    ids = lambda kind, n: (p * 2 + n).alias("record_id")
    first = base.select(ids("response", 0), "page_id", F.lit("response").alias("kind"), "url", at(p).alias("ts"), "etag", "digest", F.col("changed").alias("last_modified"), F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), F.col("etag"), F.lit("Date"), F.date_format(at(p), "yyyy-MM-dd HH:mm:ss")).alias("headers"))
    again = base.where(p % 3 == 0).select(
        ids("revisit", 1),
        "page_id",
        F.lit("revisit").alias("kind"),
        F.concat("url", F.lit("#again")).alias("url"),
        at(p + 120).alias("ts"),
        F.when(p % 15 == 0, F.lit('"other"')).when(p % 21 == 0, F.lit(None)).otherwise(F.concat(F.lit("W/"), F.col("etag"))).alias("etag"),
        F.when(p % 21 == 0, F.lit(None)).otherwise(F.col("digest")).alias("digest"),
        F.col("changed").alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/plain"), F.lit("Date"), F.date_format(at(p + 120), "yyyy-MM-dd HH:mm:ss"), F.lit("Expires"), F.lit("0")).alias("headers"),
    )
    return first.unionByName(again)
