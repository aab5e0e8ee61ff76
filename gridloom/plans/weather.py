"""Weather series per site: nearest location, blended sources, filled gaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.constants import BLENDED_SOURCE, WEATHER_GAP_LIMIT, WEATHER_SOURCES
from gridloom.functions import timeops
from gridloom.functions.numeric import known
from gridloom.operators.grids import bucket_any, bucket_mean, fill_gaps, refill_gaps
from gridloom.operators.places import attach_distance, nearest_locations
from gridloom.sources.tables import scan_series


def combine_sources(
    df: DataFrame,
    fields: Sequence[str],
    source_order: Sequence[str] | None = None,
    keys: Sequence[str] = ("datetime", "input_city"),
) -> DataFrame:
    """Per key and per column the value of the first source in order that has one.

    NaN counts as missing. Sources that are not listed are left out. One hash aggregate whatever the number of
    sources; the values may be of any type.
    """
    order = list(source_order or WEATHER_SOURCES)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)}
    value = lambda f: known(F.col(f)) if f in floating else F.col(f)
    cells = [F.coalesce(*[F.max(F.when(F.col("source") == s, value(f))) for s in order]).alias(f) for f in fields]
    return df.where(F.col("source").isin(*order)).groupBy(*keys).agg(*cells)


def with_source_run(df: DataFrame, time: str = "datetime", horizon: str = "tAhead") -> DataFrame:
    """Add ``created``: the forecast time minus its horizon in hours."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if not isinstance(types[time], T.TimestampType):
        raise ValueError(f"{time} must be a timestamp")
    if not isinstance(types[horizon], T.NumericType):
        raise ValueError(f"{horizon} must be a number")
    return df.withColumn("created", timeops.hours_before(F.col(time), F.col(horizon)))


def preferred(source: str | Sequence[str], source_order: Sequence[str] | None):
    """Source and order of preference where one series per location is wanted.

    A list of sources is blended in the order given; one source, or the blended one, stays as it is.
    """
    if isinstance(source, str) or len(source) == 1 or BLENDED_SOURCE in source:
        return source, source_order
    return BLENDED_SOURCE, list(source)


def _sources(source: str | Sequence[str]) -> tuple[list[str] | None, bool]:
    names = [source] if isinstance(source, str) else list(source)
    return (None, True) if BLENDED_SOURCE in names else (names, False)


def _means(
    weather: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    minutes: int,
    start: datetime,
    end: datetime,
    source: str | Sequence[str],
    source_order: Sequence[str] | None,
    cities: DataFrame | None,
) -> DataFrame:
    names, blend = _sources(source)
    names = list(source_order or WEATHER_SOURCES) if blend else names
    points = scan_series(weather, start, end, source=names)
    means = bucket_mean(points, [*keys, "source"], fields, minutes).where(bucket_any(fields))
    if blend:
        means = combine_sources(means, fields, names, ["datetime", *keys])
        means = means.withColumn("source", F.lit(BLENDED_SOURCE))
    if cities is not None:
        # Stated after the aggregation: a list of cities too long to broadcast must not
        # shuffle raw points. A short one is pushed down to the scan by the optimizer.
        means = means.join(cities.select("input_city").distinct(), "input_city", "left_semi")
    return means


def weather_by_city(
    weather: DataFrame,
    fields: Sequence[str],
    start: datetime,
    end: datetime,
    source: str | Sequence[str] = BLENDED_SOURCE,
    minutes: int = 15,
    source_order: Sequence[str] | None = None,
    limit: int | None = WEATHER_GAP_LIMIT,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Latest weather per location on a regular grid, gaps filled up to ``limit`` steps.

    ``cities`` (``input_city``) keeps only the locations it lists.
    """
    means = _means(weather, ["input_city"], fields, minutes, start, end, source, source_order, cities)
    return fill_gaps(means, ["source", "input_city"], fields, minutes, limit=limit, span=(start, end))


def weather_on_wider_grid(
    weather: DataFrame,
    fields: Sequence[str],
    start: datetime,
    end: datetime,
    source: str | Sequence[str] = BLENDED_SOURCE,
    minutes: int = 15,
    wider: int = 60,
    source_order: Sequence[str] | None = None,
    limit: int | None = WEATHER_GAP_LIMIT,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Weather of one source, or the blended one, filled on the grid of ``minutes``, then brought to
    that of ``wider`` minutes and filled there again."""
    means = _means(weather, ["input_city"], fields, minutes, start, end, source, source_order, cities)
    return refill_gaps(means, ["input_city"], fields, minutes, wider, limit, span=(start, end))


def weather_latest(
    weather: DataFrame,
    sites: DataFrame,
    locations: DataFrame,
    fields: Sequence[str],
    start: datetime,
    end: datetime,
    source: str | Sequence[str] = BLENDED_SOURCE,
    minutes: int = 15,
    number_locations: int = 1,
    source_order: Sequence[str] | None = None,
) -> DataFrame:
    """Latest weather of the nearest location(s) of every site.

    Sites without a location in range, or without coordinates, have no weather;
    ``nearest_locations`` flags them.

    Sites near the same location share one blended and filled series: the series are
    made per location, and only for locations that some site needs.
    """
    nearest = nearest_locations(sites, locations, number_locations)
    series = weather_by_city(weather, fields, start, end, source, minutes, source_order, cities=nearest)
    return attach_distance(series, nearest, number_locations)


def weather_by_run_city(
    weather: DataFrame,
    fields: Sequence[str],
    start: datetime,
    end: datetime,
    source: str | Sequence[str] = BLENDED_SOURCE,
    minutes: int = 15,
    source_order: Sequence[str] | None = None,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Every stored forecast run of a location as its own series.

    The run is the forecast time minus the horizon; the horizon is filled like a field.
    """
    runs = with_source_run(weather, "time", "tAhead")
    fields = [*fields, "tAhead"]
    means = _means(runs, ["input_city", "created"], fields, minutes, start, end, source, source_order, cities)
    return fill_gaps(
        means,
        ["source", "input_city", "created"],
        fields,
        minutes,
        limit=WEATHER_GAP_LIMIT,
        span=(start, end),
    )


def weather_by_run(
    weather: DataFrame,
    sites: DataFrame,
    locations: DataFrame,
    fields: Sequence[str],
    start: datetime,
    end: datetime,
    source: str | Sequence[str] = BLENDED_SOURCE,
    minutes: int = 15,
    number_locations: int = 1,
    source_order: Sequence[str] | None = None,
) -> DataFrame:
    """The runs of the nearest location(s) of every site."""
    nearest = nearest_locations(sites, locations, number_locations)
    series = weather_by_run_city(weather, fields, start, end, source, minutes, source_order, cities=nearest)
    return attach_distance(series, nearest, number_locations)


def latest_weather_run(weather: DataFrame, sources: DataFrame, as_of: datetime, days: int = 2) -> DataFrame:
    """Newest ``source_run`` per asked source in the last days; the epoch where there is none."""
    instant = F.lit(timeops.as_utc(as_of))
    recent = weather.where((F.col("time") >= timeops.shift(instant, -days * 1440)) & (F.col("time") < instant))
    newest = recent.groupBy("source").agg(F.max("source_run").alias("source_run"))
    run = F.timestamp_seconds(F.coalesce(F.col("source_run"), F.lit(0)))
    return sources.join(newest, "source", "left").select("source", run.alias("last_stored_run"))
