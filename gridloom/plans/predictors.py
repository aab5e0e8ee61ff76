"""Predictors: market prices, standard profiles and weather on one grid."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import (
    BLENDED_SOURCE,
    PROFILE_FIELDS,
    PROFILE_GAP_LIMIT,
    WEATHER_PARAMS,
)
from gridloom.functions.timeops import grid_size
from gridloom.operators.grids import bucket_any, bucket_mean, fill_columns, forward_fill
from gridloom.operators.places import nearest_locations
from gridloom.plans.weather import preferred, weather_by_city, weather_on_wider_grid
from gridloom.sources.tables import scan_series

# Largest table by time that is broadcast, from its rows and columns.
BROADCAST_BYTES = 64 * 1024 * 1024

GROUPS = ["weather_data", "market_data", "load_profiles"]


def prices_by_zone(prices: DataFrame, start: datetime, end: datetime, minutes: int) -> DataFrame:
    """Prices of every market zone, repeated on the finer grid."""
    points = scan_series(prices, start, end)
    means = bucket_mean(points, ["Name"], ["Price"], minutes).where(F.col("Price").isNotNull())
    filled = forward_fill(means, ["Name"], ["Price"], minutes, span=(start, end))
    return filled.withColumnRenamed("Price", "day_ahead_electricity_price")


def day_ahead_price(
    prices: DataFrame, start: datetime, end: datetime, minutes: int = 15, zone: str = "NL"
) -> DataFrame:
    """Day-ahead price of one zone, each price repeated up to the next."""
    return prices_by_zone(prices.where(F.col("Name") == zone), start, end, minutes).drop("Name")


def load_profiles(
    profiles: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    fields: Sequence[str] = tuple(PROFILE_FIELDS),
) -> DataFrame:
    """Standard load profiles: bucket means on one grid, gaps of up to 3 steps filled.

    There is one series; its columns are filled side by side.
    """
    fields = list(fields)
    series = bucket_mean(scan_series(profiles, start, end), ["year_created"], fields, minutes)
    means = series.groupBy("datetime").agg(*[F.avg(f).alias(f) for f in fields]).where(bucket_any(fields))
    return fill_columns(means, fields, minutes, limit=PROFILE_GAP_LIMIT, span=(start, end))


def weather_fields(add: Sequence[str] = ()) -> list[str]:
    return [*WEATHER_PARAMS, *[p for p in add if p not in WEATHER_PARAMS]]


def weather_predictors(
    weather: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    source: str | Sequence[str] = BLENDED_SOURCE,
    source_order: Sequence[str] | None = None,
    add_weather_params: Sequence[str] = (),
    cities: DataFrame | None = None,
) -> DataFrame:
    """Weather parameters of every location, or of ``cities``, on the target grid.

    Several sources are blended in the order given. Stored fields that the table lacks are left out. Weather is read on the quarter grid
    and filled there, then brought to the target grid and filled again.
    """
    fields = [f for f in weather_fields(add_weather_params) if f in weather.columns]
    source, source_order = preferred(source, source_order)
    if minutes == 15:
        return weather_by_city(weather, fields, start, end, source, 15, source_order, cities=cities).drop("source")
    return weather_on_wider_grid(weather, fields, start, end, source, 15, minutes, source_order, cities=cities)


def with_city(sites: DataFrame, locations: DataFrame) -> DataFrame:
    """(site, input_city): the nearest weather location, null for a site without one in range or without coordinates."""
    nearest = nearest_locations(sites, locations).select("site", "input_city")
    return sites.select("site").distinct().join(nearest, "site", "left")


def join_by_time(
    result: DataFrame, shared: DataFrame, start: datetime, end: datetime, minutes: int, how: str = "left"
) -> DataFrame:
    """Join a table that has at most one row per grid point.

    The range bounds its rows, so whether it may be broadcast is known beforehand; a
    longer table is joined by shuffle.
    """
    size = grid_size(start, end, minutes) * len(shared.columns) * 8
    return result.join(F.broadcast(shared) if size <= BROADCAST_BYTES else shared, "datetime", how)


def predictors(
    grid: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int = 15,
    groups: Sequence[str] | None = None,
    weather: DataFrame | None = None,
    sites: DataFrame | None = None,
    locations: DataFrame | None = None,
    prices: DataFrame | None = None,
    profiles: DataFrame | None = None,
    zone: str = "NL",
    source: str | Sequence[str] = BLENDED_SOURCE,
    source_order: Sequence[str] | None = None,
    add_weather_params: Sequence[str] = (),
    profile_fields: Sequence[str] = tuple(PROFILE_FIELDS),
    cities: DataFrame | None = None,
) -> DataFrame:
    """Join the asked predictor groups to ``grid`` (``datetime``, and ``site`` for weather).

    Weather is filled once per location that a site needs and joined through the site's
    nearest location; prices and profiles have one row per time. Where the grid already
    carries ``input_city``, the ``cities`` it came from take the place of sites and locations.
    """
    groups = list(GROUPS if groups is None else groups)
    unknown = [g for g in groups if g not in GROUPS]
    if unknown:
        raise ValueError(f"unknown predictor groups: {unknown}")
    if "weather_data" in groups and cities is None and (sites is None or locations is None):
        raise ValueError("weather predictors need sites and locations")
    result = grid
    if "weather_data" in groups:
        if cities is None:
            cities = with_city(sites, locations)
            result = result.join(cities, "site", "left")
        series = weather_predictors(weather, start, end, minutes, source, source_order, add_weather_params, cities)
        result = result.join(series, ["input_city", "datetime"], "left").drop("input_city")
    if "market_data" in groups:
        price = day_ahead_price(prices, start, end, minutes, zone)
        result = join_by_time(result, price, start, end, minutes)
    if "load_profiles" in groups:
        curves = load_profiles(profiles, start, end, minutes, profile_fields)
        result = join_by_time(result, curves, start, end, minutes)
    return result
