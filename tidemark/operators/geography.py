"""Centroids and the coordinate fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import geo_source, in_bounds
from tidemark.operators.quantiles import quantiles_by_running_totals
from tidemark.operators.ranking import dominant

LAT, LNG = "geolocation_lat", "geolocation_lng"
AXES = {"lat": LAT, "lng": LNG}


def points_in_bounds(geolocation: DataFrame) -> DataFrame:
    return geolocation.where(in_bounds(F.col(LAT), F.col(LNG)))


def bounds_report(geolocation: DataFrame) -> DataFrame:
    """Points kept and dropped by the bounding box, in one scan."""
    inside = in_bounds(F.col(LAT), F.col(LNG))
    return geolocation.agg(
        F.count("*").alias("points"),
        F.count_if(inside).alias("kept"),
        F.count_if(~inside).alias("dropped"),
    )


def _medians(points: DataFrame, key: str) -> DataFrame:
    """Median point and point count per key.

    Both axes share one range shuffle, so that a key with any number of points is split by value.
    """
    axes = points.select(
        key,
        F.inline(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(c).alias("degrees")) for a, c in AXES.items()])),
    )
    medians = quantiles_by_running_totals(axes, [key, "axis"], "degrees", {"median": 0.5})
    wide = medians.groupBy(key).agg(*[F.max(F.when(F.col("axis") == a, F.col("median"))).alias(a) for a in AXES])
    return wide.join(points.groupBy(key).agg(F.count("*").alias("n_points")), key)


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Median point per zip prefix, with the most frequent state (ties: smallest)."""
    points = points_in_bounds(geolocation).select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_state").alias("state"),
        LAT,
        LNG,
    )
    states = dominant(points, ["zip_code_prefix"], "state", F.count("*"), "state")
    return _medians(points, "zip_code_prefix").join(states, "zip_code_prefix", "left").select(
        "zip_code_prefix", "lat", "lng", "state", "n_points"
    )


def state_centroids(geolocation: DataFrame) -> DataFrame:
    points = points_in_bounds(geolocation).select(F.col("geolocation_state").alias("state"), LAT, LNG)
    return _medians(points, "state")


def locate(
    places: DataFrame, zip_column: str, state_column: str, zips: DataFrame, states: DataFrame, prefix: str
) -> DataFrame:
    """Add ``<prefix>_lat``, ``_lng`` and ``_geo_source``: zip centroid first, then the state's.

    Plain joins: Spark broadcasts a centroid table whose measured size is below its threshold
    and shuffles one that is not.
    """
    by_zip = zips.select(
        F.col("zip_code_prefix").alias(zip_column), F.col("lat").alias("_zlat"), F.col("lng").alias("_zlng")
    )
    by_state = states.select(
        F.col("state").alias(state_column), F.col("lat").alias("_slat"), F.col("lng").alias("_slng")
    )
    return (
        places.join(by_zip, zip_column, "left")
        .join(by_state, state_column, "left")
        .withColumns(
            {
                f"{prefix}_lat": F.coalesce("_zlat", "_slat"),
                f"{prefix}_lng": F.coalesce("_zlng", "_slng"),
                f"{prefix}_geo_source": geo_source(F.col("_zlat"), F.col("_slat")),
            }
        )
        .drop("_zlat", "_zlng", "_slat", "_slng")
    )
