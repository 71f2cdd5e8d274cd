"""Sources: CSV, GeoJSON, road files, geometry columns and binary files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs as C
from ..functions import geometry as G
from ..operators import tables


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns as text, empty fields null."""
    return spark.read.csv(path, header=True, inferSchema=False, nullValue="", multiLine=True, escape='"')


def scan(spark: SparkSession, path: str, condition: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table with a filter and columns; unknown columns are an error before any work."""
    df = spark.read.parquet(path)
    if columns is not None and not columns:
        raise ValueError("no columns asked for")
    df = df.where(condition) if condition else df
    return df.select(*columns) if columns else df


def job_rows(df: DataFrame, job_id: str | None, column: str = "job_id") -> DataFrame:
    """Rows of one job, which must be named."""
    if not job_id or job_id == "auto":
        raise ValueError("a job id is needed")
    return df.where(F.col(column) == job_id)


def roads(spark: SparkSession, path: str, include: Mapping[str, Sequence[Any]] | None = None, exclude: Mapping[str, Sequence[Any]] | None = None) -> DataFrame:
    """Roads from Parquet or GeoJSON by extension, filtered by value lists."""
    df = geojson(spark, path) if path.endswith((".json", ".geojson")) else spark.read.parquet(path)
    return tables.keep_values(df, include, exclude)


def geojson(spark: SparkSession, path: str, crs: str | None = None, properties: str | None = None) -> DataFrame:
    """FeatureCollections: properties as columns and ``geometry`` as GeoJSON text; another declared CRS is an error.

    ``properties`` is their schema; without one it is found in a pass over the
    data. A FeatureCollection is one JSON text, so a file goes through one task:
    give large sources line by line to :func:`geojson_lines`.
    """
    whole = spark.read.text(path, wholetext=True)
    if crs is not None:
        found = whole.select(F.get_json_object("value", "$.crs.properties.name").alias("n")).where(F.col("n").isNotNull() & ~F.contains(F.col("n"), F.lit(crs.split(":")[-1])))
        if not found.isEmpty():
            raise ValueError("the file has another coordinate system")
    return _features(whole.select(F.explode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("f")), properties)


def geojson_lines(spark: SparkSession, path: str, properties: str | None = None) -> DataFrame:
    """One GeoJSON feature in each line of text, as :func:`generations.write_geojson_lines` writes them; files are split over tasks."""
    return _features(spark.read.text(path).select(F.col("value").alias("f")), properties)


def _features(features: DataFrame, properties: str | None) -> DataFrame:
    parts = features.select(F.get_json_object("f", "$.properties").alias("p"), F.get_json_object("f", "$.geometry").alias("geometry"))
    if properties is None:
        found = parts.agg(F.schema_of_variant_agg(F.try_parse_json("p")).alias("s")).first()["s"] or "VOID"
        if not found.startswith("OBJECT"):
            return parts.select("geometry")
        # a property that is null everywhere is text
        properties = found.replace("OBJECT<", "STRUCT<").replace(": VOID", ": STRING")
    kind = properties if properties.upper().startswith("STRUCT<") else f"struct<{properties}>"
    return parts.select(F.from_json("p", kind).alias("p"), "geometry").select("p.*", "geometry")


def declared_crs(spark: SparkSession, path: str, otherwise: int | str | None = None) -> int:
    """The EPSG code that the FeatureCollections under ``path`` declare; ``otherwise`` where none does, and an error if they differ or none is known.

    A declaration stands before the features, so only the head of a file's text is looked at.
    """
    head = spark.read.text(path, wholetext=True).select(F.substring("value", 1, 4096).alias("head"))
    name = F.regexp_extract("head", '"crs"\\s*:\\s*\\{.*?"name"\\s*:\\s*"([^"]*)"', 1)
    names = [r["n"] for r in head.select(name.alias("n")).distinct().limit(100).collect()]
    found = {C.system(n).code for n in names if n} | ({C.system(otherwise).code} if otherwise is not None and "" in names else set())
    if len(found) != 1 or ("" in names and otherwise is None):
        raise ValueError("the files name no coordinate system, or several")
    return found.pop()


def lines_of(df: DataFrame, candidates: Sequence[str], *, bad: str = "raise", explode: bool = True, crs: int | str | None = None, to: int | str | None = None) -> DataFrame:
    """``df`` with ``line`` from the first candidate column that is there, as WKT or GeoJSON text.

    Rows without a usable geometry stop the job, or go if ``bad`` is ``drop``.
    With ``explode`` each part is a row of its own, numbered by ``part``. Lines
    in the system ``crs`` come out in the system ``to``, if both are given.
    """
    column = next((c for c in candidates if c in df.columns), None)
    if column is None:
        raise ValueError(f"no geometry column among {list(candidates)}")
    lines = G.normalise_geometry(F.col(column).cast("string"))
    if to is not None:
        if crs is None:
            raise ValueError("the lines' own coordinate system is needed to change it")
        lines = F.transform(lines, lambda part: C.reproject_line(part, crs, to))
    df = df.withColumn("__lines", lines)
    if bad == "drop":
        df = df.where(F.col("__lines").isNotNull())
    elif bad == "raise":
        df = df.withColumn("__lines", F.when(F.col("__lines").isNull(), F.raise_error(F.lit("a geometry is missing or malformed"))).otherwise(F.col("__lines")))
    else:
        raise ValueError(f"unknown policy for bad geometries: {bad}")
    if explode:
        return df.select(*[c for c in df.columns if c != "__lines"], F.posexplode("__lines").alias("part", "line"))
    return df.withColumnRenamed("__lines", "lines")


def blockfaces(spark: SparkSession, path: str, job_id: str | None, *, crs: int | str | None, to: int | str = 2249, geometry: Sequence[str] = ("geometry", "line", "wkt")) -> DataFrame:
    """The blockfaces of one job from Parquet, with ``line`` in the system ``to``; their own system must be named, and an empty load is an error."""
    if crs is None:
        raise ValueError("the blockfaces' coordinate system is needed")
    rows = job_rows(spark.read.parquet(path), job_id)
    if rows.isEmpty():
        raise ValueError(f"no blockfaces of job {job_id}")
    return lines_of(rows, geometry, crs=crs, to=to)


def binary_store(spark: SparkSession, path: str) -> DataFrame:
    """(name, path, length): files under ``path`` by content, each content once; the name is its sha256 and extension."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ext = F.lower(F.regexp_extract("path", "(\\.[A-Za-z0-9]+)$", 1))
    named = files.select(F.concat(F.sha2("content", 256), ext).alias("name"), "path", "length")
    return named.groupBy("name").agg(F.min("path").alias("path"), F.min("length").alias("length"))
