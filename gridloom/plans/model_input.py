"""Model input per job, and the inputs of solar and wind forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import BLENDED_SOURCE, LOAD_GAP_LIMIT
from gridloom.functions import timeops
from gridloom.functions.timeops import floor_value
from gridloom.operators.grids import fill_gaps, interpolate_cubic, interpolate_inside, key_grid
from gridloom.operators.load import weighted_job_load
from gridloom.operators.places import systems_near_sites
from gridloom.plans.predictors import GROUPS, predictors, with_city
from gridloom.plans.splitting import site_load
from gridloom.plans.weather import preferred, weather_latest
from gridloom.sources.tables import scan_series


def filled_job_load(
    readings: DataFrame, systems: DataFrame, job_systems: DataFrame, start: datetime, end: datetime, minutes: int
) -> DataFrame:
    """Net load per job on its grid, gaps of up to 3 steps filled."""
    stop = floor_value(end, minutes) + timedelta(minutes=minutes)
    points = scan_series(readings, floor_value(start, minutes), stop)
    load = weighted_job_load(points, systems, job_systems, minutes)
    return fill_gaps(load, ["pid"], ["load"], minutes, limit=LOAD_GAP_LIMIT, span=(start, end))


def model_input(
    sites: DataFrame,
    readings: DataFrame,
    systems: DataFrame,
    job_systems: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    **sources,
) -> DataFrame:
    """Load and predictors of every job (``site, lat, lon``) on the requested grid.

    Exactly one row per job and grid point; a job without load has null ``load``. The
    predictor tables and options go to ``predictors``.
    """
    # The location of a site is settled on the short table, before it becomes a grid.
    keys = sites.select("site").distinct()
    if "weather_data" in (sources.get("groups") or GROUPS):
        keys = sources["cities"] = with_city(sites, sources.pop("locations"))
    grid = key_grid(keys, start, end, minutes)
    load = filled_job_load(readings, systems, job_systems, start, end, minutes)
    loaded = grid.join(load.withColumnRenamed("pid", "site"), ["site", "datetime"], "left")
    result = predictors(loaded, start, end, minutes, **sources)
    return result.withColumnRenamed("site", "pid")


def solar_input(
    sites: DataFrame,
    readings: DataFrame,
    systems: DataFrame,
    weather: DataFrame,
    locations: DataFrame,
    datetime_start: datetime,
    forecast_horizon: int,
    minutes: int = 15,
    radius: float = 0.0,
    history: int = 14,
    source: str | Sequence[str] = BLENDED_SOURCE,
    source_order: Sequence[str] | None = None,
    site_systems: DataFrame | None = None,
    quality: float = 0.75,
    freq: int = 5,
) -> DataFrame:
    """PV output near each site beside radiation and clouds, history and horizon.

    Radius 0 takes the nearest system within 15 km (``site_systems`` names them instead),
    otherwise the sum over all within the radius. Output is made positive; where it is
    missing it counts as 0 before ``datetime_start`` and stays null after. Sites without
    any output give no rows.
    """
    start = datetime_start - timedelta(days=history)
    end = datetime_start + timedelta(minutes=forecast_horizon)
    if site_systems is None:
        near = systems_near_sites(sites, systems, radius or 15.0, quality, freq)
        if radius == 0:
            near = near.groupBy("site").agg(F.min(F.struct("distance", "sid")).alias("__n")).select("site", "__n.sid")
        site_systems = near
    output = site_load(readings, site_systems, start, datetime_start, minutes, average_output=radius == 0)
    output = output.select("site", "datetime", F.abs("load").alias("aggregated"))

    fields = ["radiation", "clouds"]
    source, source_order = preferred(source, source_order)
    series = weather_latest(weather, sites, locations, fields, start, end, source, minutes, source_order=source_order)
    series = interpolate_inside(series, ["site"], fields, minutes, span=(start, end))
    # Only sites with output: a site's weather alone is not an answer.
    series = series.join(output.select("site").distinct(), "site", "left_semi")
    joined = output.join(series, ["site", "datetime"], "full_outer")
    past = F.col("datetime") < F.lit(timeops.as_utc(datetime_start))
    return joined.withColumn("aggregated", F.when(F.col("aggregated").isNull() & past, 0.0).otherwise(F.col("aggregated")))


def wind_input(
    sites: DataFrame,
    weather: DataFrame,
    locations: DataFrame,
    datetime_start: datetime,
    forecast_horizon: int,
    minutes: int = 15,
    source: str | Sequence[str] = BLENDED_SOURCE,
    source_order: Sequence[str] | None = None,
) -> DataFrame:
    """Wind speed at 100 m per site on the grid; what linear filling left open is filled by a spline."""
    end = datetime_start + timedelta(minutes=forecast_horizon)
    source, source_order = preferred(source, source_order)
    speed = weather_latest(
        weather, sites, locations, ["windspeed_100m"], datetime_start, end, source, minutes, source_order=source_order
    )
    return interpolate_cubic(speed.select("site", "datetime", "windspeed_100m"), ["site"], "windspeed_100m", minutes)
