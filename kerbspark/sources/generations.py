"""Sinks: versioned tables, moved forward together by one pointer."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs as C
from ..functions import geometry as G


def _folder(spark: SparkSession, root: str):
    """The folder of pointers and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_pointers")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all pointers, newest first."""
    path, fs = _folder(spark, root)
    if not fs.exists(path):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _generation(spark: SparkSession, root: str, number: int) -> str:
    return spark.read.text(f"{root}/_pointers/{number:012d}").first()["value"]


def _point(spark: SparkSession, root: str, after: int, generation: str) -> None:
    """Make the pointer that follows number ``after``; of two publishers at once one fails.

    The text is written under another name and the file then renamed, which no
    file system does over a file that is there, so no reader meets a pointer
    that is empty or half written, and a publisher that dies leaves none. On an
    object store a rename copies and may not be exclusive: keep ``root`` on a
    file system, or let one publisher run at a time.
    """
    path, fs = _folder(spark, root)
    name = spark._jvm.org.apache.hadoop.fs.Path(path, f"{after + 1:012d}")
    draft = spark._jvm.org.apache.hadoop.fs.Path(path, f"_draft-{uuid.uuid4().hex}")
    if fs.exists(name):
        raise ValueError("another publication came first")
    out = fs.create(draft, False)
    out.write(bytearray(generation.encode()))
    out.close()
    if not _renamed(spark, fs, draft, name):
        fs.delete(draft, False)
        raise ValueError("another publication came first")


def _renamed(spark: SparkSession, fs, draft, name) -> bool:
    """Whether ``draft`` has become ``name``, which must not be there before."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, name, none)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def publish(tables: Mapping[str, DataFrame], root: str) -> str:
    """Write all tables to a new generation, then move the pointer to it: readers see all or nothing.

    If another publication came in between, this one stops with an error and
    its generation is never pointed to.
    """
    spark = next(iter(tables.values())).sparkSession
    generation = uuid.uuid4().hex
    after = next(iter(_pointers(spark, root)), -1)
    for name, df in tables.items():
        df.write.parquet(f"{root}/{generation}/{name}")
    _point(spark, root, after, generation)
    return generation


def current(spark: SparkSession, root: str, name: str, back: int = 0) -> DataFrame:
    """A table of the current generation, or of the one before it."""
    found = _pointers(spark, root)
    if len(found) <= back:
        raise ValueError("no such generation")
    return spark.read.parquet(f"{root}/{_generation(spark, root, found[back])}/{name}")


def roll_back(spark: SparkSession, root: str) -> str:
    """Make the previous generation current again, by a new pointer to it."""
    found = _pointers(spark, root)
    if len(found) < 2:
        raise ValueError("no previous generation")
    generation = _generation(spark, root, found[1])
    _point(spark, root, found[0], generation)
    return generation


#: The slots of :func:`slot`: what was read before, what is read now, and what is being made.
SLOTS = ("previous", "current", "next")


def _slots(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The number of the newest pointer to the slots, and what it says: a generation (or null) for each, and the tables' names."""
    home = f"{root}/slots"
    found = _pointers(spark, home)
    return (found[0], json.loads(_generation(spark, home, found[0]))) if found else (-1, {})


def _written(tables: Mapping[str, DataFrame], root: str, *, empty: bool = False) -> str:
    generation = uuid.uuid4().hex
    for name, df in tables.items():
        (df.limit(0) if empty else df).write.parquet(f"{root}/{generation}/{name}")
    return generation


def slot(spark: SparkSession, root: str, which: str, name: str) -> DataFrame:
    """A table of a slot; an error if nothing is in it."""
    generation = _slots(spark, root)[1].get(which)
    if not generation:
        raise ValueError(f"nothing is in the slot {which}")
    return spark.read.parquet(f"{root}/{generation}/{name}")


def write_next(tables: Mapping[str, DataFrame], root: str) -> None:
    """Put all tables into the slot ``next``; the first call also makes ``current``, empty and of the same schema."""
    spark = next(iter(tables.values())).sparkSession
    number, now = _slots(spark, root)
    if now and sorted(tables) != now["tables"]:
        raise ValueError(f"the slots hold the tables {now['tables']}")
    current = now["current"] if now else _written(tables, root, empty=True)
    told = {"previous": now.get("previous"), "current": current, "next": _written(tables, root), "tables": sorted(tables)}
    _point(spark, f"{root}/slots", number, json.dumps(told))


def roll_over(spark: SparkSession, root: str) -> None:
    """``current`` becomes ``previous``, ``next`` becomes ``current``, and an empty ``next`` of its schema is made: one pointer moves all three."""
    number, now = _slots(spark, root)
    if not now:
        raise ValueError("nothing is in the slot next")
    empty = _written({name: slot(spark, root, "next", name) for name in now["tables"]}, root, empty=True)
    _point(spark, f"{root}/slots", number, json.dumps(now | {"previous": now["current"], "current": now["next"], "next": empty}))


def undo_roll_over(spark: SparkSession, root: str) -> None:
    """``previous`` becomes ``current`` again and ``current`` becomes ``next``; no ``previous`` is left, so it can be done once."""
    number, now = _slots(spark, root)
    if not now.get("previous"):
        raise ValueError("nothing is in the slot previous")
    _point(spark, f"{root}/slots", number, json.dumps(now | {"previous": None, "current": now["previous"], "next": now["current"]}))


def publish_in_order(state: Mapping[str, DataFrame], deletes: Mapping[str, tuple[DataFrame, list[str]]], appends: Mapping[str, DataFrame], root: str) -> str:
    """A new generation of all tables of ``state``: deletes (rows and their keys) come before appends, and empty ones change nothing."""
    tables = dict(state)
    for name, (rows, keys) in deletes.items():
        tables[name] = tables[name].join(rows.select(*keys).distinct(), keys, "left_anti").select(*tables[name].columns)
    for name, rows in appends.items():
        tables[name] = tables[name].unionByName(rows.to(tables[name].schema))
    return publish(tables, root)


def write_geojson_lines(df: DataFrame, path: str, line: str = "line", *, crs: int | str = C.DEGREES, to: int | str | None = None) -> None:
    """One GeoJSON feature in each line of text; lines in the system ``crs`` are written in the system ``to``."""
    moved = C.reproject_line(F.col(line), crs, crs if to is None else to)
    coordinates = F.transform(moved, lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*[c for c in df.columns if c != line]).alias("properties"), geometry.alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.text(path)


def write_lines(df: DataFrame, path: str, line: str = "line", *, crs: int | str, to: int | str) -> None:
    """Rows as Parquet, their lines moved from the system ``crs`` to the system ``to``."""
    df.withColumn(line, C.reproject_line(F.col(line), crs, to)).write.parquet(path)


def write_policy_csv(lists: DataFrame, path: str) -> None:
    """Segments and their policies, the list as JSON text."""
    lists.select("segment_id", F.to_json("policy_list").alias("policy_list")).write.csv(path, header=True)


def write_rows_wkt(df: DataFrame, path: str, line: str = "line") -> None:
    """Rows with their line as WKT text, appended."""
    df.withColumn(line, G.to_wkt(F.col(line))).write.mode("append").parquet(path)


def job_row(spark: SparkSession, job_id: str, name: str, description: str, settings: str, created: str) -> DataFrame:
    """The lineage row of a run."""
    return spark.createDataFrame([(job_id, name, description, settings, created)], "job_id string, name string, description string, settings string, created string")
