"""Loading the assets that curbs are cut at: one row for each location, whose id becomes the asset's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.readers import job_rows


def at_locations(assets: DataFrame, locations: DataFrame, *, location: str, job_id: str) -> DataFrame:
    """(point_id, and the columns of ``locations`` but its id): the locations of one job that an asset stands at, each once.

    Assets without a location, or at one of another job, are left out.
    """
    used = assets.select(F.col(location).alias("asset_location_id")).where("asset_location_id IS NOT NULL").distinct()
    found = job_rows(locations, job_id).join(used, "asset_location_id", "left_semi").dropDuplicates(["asset_location_id"])
    return found.drop("job_id").withColumnRenamed("asset_location_id", "point_id")


def features(table: DataFrame, locations: DataFrame, kind: str, *, job_id: str) -> DataFrame:
    """Hydrants or bus stops: ``table`` has feature_type and feature_location."""
    return at_locations(table.where(F.col("feature_type") == kind), locations, location="feature_location", job_id=job_id)


def active_signs(signs: DataFrame, locations: DataFrame, *, job_id: str) -> DataFrame:
    """Signs without a removal date."""
    return at_locations(signs.where("sign_removed_date IS NULL"), locations, location="sign_location_id", job_id=job_id)


def meters(policies: DataFrame, locations: DataFrame, *, job_id: str) -> DataFrame:
    """Both ends of each meter policy."""
    ends = policies.unpivot("meter_policy_id", ["start_asset_location_id", "end_asset_location_id"], "end", "location_id")
    return at_locations(ends, locations, location="location_id", job_id=job_id)


def open_zones(zones: DataFrame) -> DataFrame:
    """Published zones that have not ended."""
    return zones.where("end_date IS NULL")
