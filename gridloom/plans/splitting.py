"""Energy splitting: coefficients, wind and solar references, aligned input."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.constants import BLENDED_SOURCE, PROFILE_FIELDS
from gridloom.functions import timeops
from gridloom.functions.numeric import wind_at_height
from gridloom.operators.joins import fan_out_join
from gridloom.operators.load import system_means, weighted_job_load
from gridloom.operators.places import systems_near_sites
from gridloom.operators.reshape import align_inner, finite_rows
from gridloom.plans.predictors import join_by_time, load_profiles
from gridloom.plans.weather import preferred, weather_latest
from gridloom.sources.tables import scan_series


def latest_coefficients(coefs: DataFrame) -> DataFrame:
    """All coefficients a job received at its latest time, ties kept.

    The latest time is a small aggregate that joins back on job and time, so a job with
    very many coefficients is neither sorted nor gathered in one task.
    """
    newest = coefs.groupBy("pid").agg(F.max("created").alias("created"))
    return coefs.join(newest, ["pid", "created"]).select("pid", "coef_name", "coef_value", "created")


def mean_coefficients(coefs: DataFrame, as_of: datetime, days: int = 180) -> DataFrame:
    """Mean coefficient per job and name over the last days, the bound itself excluded."""
    after = F.lit(timeops.as_utc(as_of) - timedelta(days=days))
    recent = coefs.where(F.col("created") > after)
    return recent.groupBy("pid", "coef_name").agg(F.avg("coef_value").alias("coef_value"))


def normalise_p99(df: DataFrame, column: str, series: Sequence[str]) -> DataFrame:
    """Divide by the exact, interpolated 99th percentile of the series.

    For bucketed series: a window over one holds at most as many rows as there are buckets.
    """
    scale = F.percentile(column, 0.99).over(Window.partitionBy(*series))
    return df.withColumn(column, F.try_divide(F.col(column), scale))


def normalise_absmax(df: DataFrame, column: str, series: Sequence[str]) -> DataFrame:
    """Divide by the absolute value of the series' maximum; for bucketed series."""
    scale = F.abs(F.max(column).over(Window.partitionBy(*series)))
    return df.withColumn(column, F.try_divide(F.col(column), scale))


def wind_ref(
    weather: DataFrame,
    sites: DataFrame,
    locations: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    source: str | Sequence[str] = BLENDED_SOURCE,
    source_order: Sequence[str] | None = None,
) -> DataFrame:
    """Wind speed at 100 m per site, relative to its maximum."""
    source, source_order = preferred(source, source_order)
    speed = weather_latest(
        weather, sites, locations, ["windspeed_100m"], start, end, source, minutes, source_order=source_order
    )
    speed = speed.select("site", "datetime", wind_at_height(F.col("windspeed_100m"), 100.0, 100.0).alias("windspeed"))
    return normalise_absmax(speed, "windspeed", ["site"])


def solar_ref(
    readings: DataFrame,
    systems: DataFrame,
    sites: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    quality: float = 0.95,
    freq: int = 5,
    radius: float = 15.0,
    wide_radius: float = 30.0,
) -> DataFrame:
    """Mean PV output near each site, relative to its 99th percentile.

    Systems come from within ``radius``, or from ``wide_radius`` where there are none. One
    search with the wide radius serves both.
    """
    near = systems_near_sites(sites, systems, wide_radius, quality, freq)
    closest = near.groupBy("site").agg(F.min("distance").alias("__closest"))
    chosen = near.join(closest, "site").where((F.col("distance") < radius) | (F.col("__closest") >= radius))
    output = site_load(readings, chosen, start, end, minutes, average_output=True)
    return normalise_p99(output.withColumnRenamed("load", "aggregated"), "aggregated", ["site"])


def site_load(
    readings: DataFrame,
    site_systems: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int,
    average_output: bool,
) -> DataFrame:
    """Load over the systems of each site; systems are reduced to bucket means before the join.

    Only systems of some site take part. A short list of them reaches the scan.
    """
    stop = timeops.floor_value(end, minutes) + timedelta(minutes=minutes)
    points = scan_series(readings, timeops.floor_value(start, minutes), stop)
    members = site_systems.select("site", F.col("sid").alias("system")).distinct()
    means = system_means(points, minutes).join(members.select("system").distinct(), "system", "left_semi")
    load = F.sum("output")
    load = load / F.count("output") if average_output else load
    joined = fan_out_join(means, members, ["system"], by=["datetime"])
    return joined.groupBy("site", "datetime").agg(load.alias("load"))


def splitting_input(
    readings: DataFrame,
    systems: DataFrame,
    job_systems: DataFrame,
    sites: DataFrame,
    weather: DataFrame,
    locations: DataFrame,
    profiles: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    ignore_factor: bool = False,
    source: str | Sequence[str] = BLENDED_SOURCE,
    source_order: Sequence[str] | None = None,
    profile_fields: Sequence[str] = tuple(PROFILE_FIELDS),
    quality: float = 0.95,
    freq: int = 5,
) -> DataFrame:
    """Load, wind and solar reference and standard profiles per job, where all are present.

    ``sites`` gives the position of each job as ``site, lat, lon``. References are negative:
    they stand for production. Every part has one row per job and time already, so no
    later removal of duplicates is needed.
    """
    stop = timeops.floor_value(end, minutes) + timedelta(minutes=minutes)
    load = weighted_job_load(scan_series(readings, start, stop), systems, job_systems, minutes, ignore_factor)
    load = load.select(F.col("pid").alias("site"), "datetime", "load")
    wind = wind_ref(weather, sites, locations, start, end, minutes, source, source_order)
    wind = wind.select("site", "datetime", (-F.col("windspeed")).alias("wind_ref"))
    solar = solar_ref(readings, systems, sites, start, end, minutes, quality, freq)
    solar = solar.select("site", "datetime", (-F.col("aggregated")).alias("pv_ref"))
    curves = finite_rows(load_profiles(profiles, start, end, minutes, profile_fields), profile_fields)
    parts = align_inner([load, wind, solar], ["site", "datetime"])
    return join_by_time(parts, curves, start, end, minutes, "inner").withColumnRenamed("site", "pid")
