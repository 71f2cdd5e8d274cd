"""Signs: preprocessing of inventory rows, tables for staging, and reading as batch enrichment."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import policies as P
from . import spatial, tables
from .lineage import cut


def guid(value: Column) -> Column:
    """A GUID in lower case without braces; what is none gives null."""
    bare = F.lower(F.regexp_replace(F.trim(value), "[{}]", ""))
    return F.when(bare.rlike("^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"), bare)


def name_uuid(namespace: str, name: Column) -> Column:
    """The version-5 UUID of a text in a namespace, which is a UUID itself."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    # the two bits after the third group are the variant's
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    part = lambda at, n: F.substring(digest, at, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def array_text(values: Column) -> Column:
    """A list of texts as database array text, each in double quotes: {"a","b"}; null for null."""
    quoted = lambda v: F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.concat(F.lit("{"), F.array_join(F.transform(values, lambda v: F.coalesce(quoted(v), F.lit("NULL"))), ","), F.lit("}"))


def array_of_text(text: Column) -> Column:
    """The list of a database array text whose elements are quoted or hold no comma, brace or quote; null for null."""
    bare = F.regexp_extract_all(text, F.lit('"(?:[^"\\\\]|\\\\.)*"|[^,{}"]+'), F.lit(0))
    clean = lambda v: F.when(F.startswith(v, F.lit('"')), F.regexp_replace(F.substring(v, F.lit(2), F.length(v) - 2), r"\\(.)", "$1")).when(v != "NULL", v)
    return F.transform(bare, clean)


def when(value: Column) -> Column:
    """Epoch milliseconds or text to a timestamp; anything else gives null."""
    return F.coalesce(F.timestamp_millis(value.try_cast("bigint")), F.try_to_timestamp(value.cast("string")))


def grid_snap(df: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    """Points moved to the lower corner of their grid cell."""
    return df.withColumns({x: F.floor(F.col(x) / cell) * cell, y: F.floor(F.col(y) / cell) * cell})


def preprocess(rows: DataFrame, *, key: str, modified: str, inspected: str, code: str, prefixes: Sequence[str], cell: float) -> DataFrame:
    """Inventory rows with a place and code, the latest of each key, of wanted codes, on the grid; removed signs dated."""
    df = rows.dropna(subset=["x", "y", code])
    df = tables.latest(df, [key], [F.col(modified).desc_nulls_last(), F.col(inspected).desc_nulls_last(), F.xxhash64(*rows.columns)])
    df = grid_snap(tables.filter_column(df, code, "starts_with", prefixes), "x", "y", cell)
    return df.withColumn("sign_removed_date", F.when(F.lower("status") == "removed", F.col(modified)))


def preprocess_area(rows: DataFrame, polygons: DataFrame, *, lon: str, lat: str, area_cell: float, **how: Any) -> DataFrame:
    """:func:`preprocess` of rows in degrees that lie in ``polygons`` (an edge table in feet); the grid is one of feet.

    ``how`` has the other arguments of :func:`preprocess`; ``x`` and ``y`` are
    the grid's corner in feet, ``lon`` and ``lat`` the same in degrees.
    """
    x, y = G.to_feet(F.col(lon), F.col(lat))
    placed = cut(rows.withColumns({"x": x, "y": y}).withColumn("__row", F.monotonically_increasing_id()))
    inside = spatial.in_polygons(placed.select(F.col("__row").alias("point_id"), "x", "y"), polygons, cell=area_cell).select(F.col("point_id").alias("__row")).distinct()
    kept = preprocess(placed.join(inside, "__row", "left_semi").drop("__row"), **how)
    to_lon, to_lat = G.to_degrees(F.col("x"), F.col("y"))
    return kept.withColumns({lon: to_lon, lat: to_lat})


def active(signs: DataFrame, at: Column | None = None) -> DataFrame:
    """Signs without a removal date, or removed after ``at``."""
    gone = F.col("sign_removed_date")
    return signs.where(gone.isNull() if at is None else gone.isNull() | (gone > at))


def sign_tables(rows: DataFrame, *, job_id: str, source_id: str, attachments: str = "attachments") -> dict[str, DataFrame]:
    """Locations (one for each point), signs, images (one for each attachment), and the job and source rows."""
    tag = [F.lit(job_id).alias("job_id"), F.lit(source_id).alias("data_source_id")]
    place = F.sha2(F.concat_ws("|", F.lit(source_id), "x", "y"), 256)
    df = rows.withColumn("asset_location_id", place).withColumn("sign_id", F.sha2(F.concat_ws("|", F.lit(source_id), F.col("source_sign_id").cast("string")), 256))
    spark = rows.sparkSession
    return {
        "asset_locations": df.groupBy("asset_location_id", "x", "y").agg(F.array_join(F.array_sort(F.collect_set(F.col("source_sign_id").cast("string"))), ", ").alias("source_location_id")).select("*", *tag),
        "signs": df.select("sign_id", F.col("asset_location_id").alias("sign_location_id"), "source_sign_id", "added_date", "sign_removed_date", *tag),
        "images": df.select("sign_id", F.explode(attachments).alias("url")).select(F.sha2(F.concat_ws("|", "sign_id", "url"), 256).alias("image_id"), "sign_id", "url", *tag),
        "asset_jobs": spark.createDataFrame([(job_id,)], "job_id string"),
        "data_sources": spark.createDataFrame([(source_id,)], "data_source_id string"),
    }


def survey(parents: DataFrame, children: DataFrame, allowed: DataFrame, excluded_types: Sequence[str], *, now: Column) -> DataFrame:
    """Child rows with their parent's point, of the allowed parents; unknown parents and excluded types are dropped.

    The allow-list must name exactly the parents: otherwise the job stops.
    """
    p = parents.select(guid(F.col("globalid")).alias("parent"), "x", "y").where(F.col("parent").isNotNull()).dropDuplicates(["parent"])
    a = allowed.select(guid(F.col("GlobalID")).alias("parent")).where(F.col("parent").isNotNull()).distinct()
    odd = tables.reconcile(a, p, "parent")
    if not odd.isEmpty():
        raise ValueError("the allow-list and the survey name different places")
    c = tables.exclude_words(children, "sign_type", excluded_types).withColumn("parent", guid(F.col("parentglobalid")))
    return c.join(p, "parent").withColumn("added_date", F.coalesce(when(F.col("CreationDate")), now))


def unusable(reason: str = "unusable image") -> str:
    """The policy of an image that cannot be read, as JSON text."""
    return f'{{"name":"{reason}","priority":{P.UNUSABLE_PRIORITY},"rules":[],"time_spans":[]}}'


def read_signs(work: DataFrame, checks: Sequence[Callable[[pd.Series], pd.Series]], read: Callable[[pd.Series], pd.DataFrame], *, job_id: str, retries: int = 2) -> DataFrame:
    """(sign_id, policy_json, policy_arrow, job_id): each image of ``work`` (sign_id, url) through a caller's scorer.

    ``checks`` are asked in turn of the urls that passed so far; ``read``
    returns columns ``policy`` and ``arrow`` and is asked again, up to
    ``retries`` times, for texts that are no policy. What fails gets the policy
    of an unusable image; arrow ``none`` is null. Runs in batches on the
    executors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = pd.Series(True, index=pdf.index)
            for check in checks:
                some = pdf.index[good]
                if len(some):
                    good.loc[some] = check(pdf.loc[some, "url"]).to_numpy(dtype=bool)
            out = pd.DataFrame({"sign_id": pdf["sign_id"], "text": None, "arrow": None}, dtype=object)
            left = pdf.index[good]
            for _ in range(retries + 1):
                if not len(left):
                    break
                got = read(pdf.loc[left, "url"])
                out.loc[left, "text"], out.loc[left, "arrow"] = got["policy"].to_numpy(), got["arrow"].to_numpy()
                left = left[[not str(t).lstrip().startswith("{") for t in got["policy"]]]
            yield out

    raw = work.select("sign_id", "url").mapInPandas(run, "sign_id string, text string, arrow string")
    policy = P.parse(F.col("text"))
    usable = F.col("text").isNotNull() & policy["rules"].isNotNull() & P.times_valid(policy)
    normal = P.normalise(policy)
    ranked = F.to_json(F.struct(normal["name"].alias("name"), P.priority(normal).alias("priority"), normal["rules"].alias("rules"), normal["time_spans"].alias("time_spans")))
    return raw.select("sign_id", F.when(F.coalesce(usable, F.lit(False)), ranked).otherwise(F.lit(unusable())).alias("policy_json"), F.when(F.coalesce(usable, F.lit(False)) & (F.col("arrow") != "none"), F.col("arrow")).alias("policy_arrow"), F.lit(job_id).alias("job_id"))


def confirmed_missing(signs: DataFrame, images: DataFrame, confirmed: DataFrame, note: str) -> DataFrame:
    """``signs`` with ``note`` on those without an image, which must be exactly the confirmed ones."""
    missing = signs.join(images, "sign_id", "left_anti").select("sign_id")
    if not tables.reconcile(confirmed, missing, "sign_id").isEmpty():
        raise ValueError("signs without an image differ from the confirmed list")
    marked = missing.select("sign_id", F.lit(note).alias("note"))
    return signs.drop("note").join(marked, "sign_id", "left")
