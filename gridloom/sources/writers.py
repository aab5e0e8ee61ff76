"""Ingest jobs: forecasts, weather, readings, KPIs, prices and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import (
    FORECAST_HORIZONS,
    FORECAST_TAGS,
    FORECAST_TYPES,
    KPI_TAGS,
    TAHEAD_COLUMNS,
    WEATHER_HORIZONS,
    WEATHER_TYPES,
)
from gridloom.functions import timeops
from gridloom.operators.quality import fill_quality, kpi_wide, strict_cast, tag_constants
from gridloom.sources.sinks import append_series, check_batch, insert_if_absent, upsert_last_write_wins



@contextmanager
def kept(df: DataFrame):
    """A batch that is read several times, kept in memory, then on disk, meanwhile."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _unix(created: datetime) -> int:
    return int(timeops.as_utc(created).timestamp())


def _cast_besides_time(df: DataFrame, time: str, types: dict, quantiles: bool = False) -> DataFrame:
    """Strict cast of every column but the time, which becomes ``time``."""
    typed = strict_cast(df.drop(time), types, quantiles)
    return df.select(
        F.col(time).cast("timestamp").alias("time"),
        *[F.col(c).cast(t).alias(c) for c, t in typed.dtypes],
    )


def with_horizon(df: DataFrame, options: Sequence[float], time: str = "time", created: str = "created") -> DataFrame:
    """Rows whose lead over ``created`` (unix seconds) exceeds some option, with the largest such option."""
    lead = timeops.horizon_hours(F.col(time), F.timestamp_seconds(created))
    return df.withColumn("tAhead", timeops.round_down_horizon(lead, options)).where(F.col("tAhead").isNotNull())


def prepare_forecast(data: DataFrame, created: datetime | None, time: str = "datetimeFC", force_quality: bool = True) -> DataFrame:
    """Forecast rows as they are stored; ``created`` may also be a column of the data."""
    if created is not None:
        data = data.withColumn("created", F.lit(_unix(created)))
    if force_quality:
        data = fill_quality(data)
    return _cast_besides_time(data, time, FORECAST_TYPES, quantiles=True)


def forecast_taheads(forecast: DataFrame, options: Sequence[float] = tuple(FORECAST_HORIZONS)) -> DataFrame:
    """The part of a forecast kept per horizon."""
    kept = [c for c in forecast.columns if c in TAHEAD_COLUMNS or "quantile_" in c]
    return with_horizon(forecast, options).select("time", *kept, "tAhead")


def write_forecast(
    data: DataFrame,
    path: str,
    created: datetime | None,
    tahead_path: str | None = None,
    time: str = "datetimeFC",
    force_quality: bool = True,
    options: Sequence[float] = tuple(FORECAST_HORIZONS),
) -> int:
    """Check and upsert a forecast batch; with ``tahead_path`` also its horizon series.

    The whole batch is checked before the first row is written. The two tables are two
    writes; a failure between them is mended by writing the batch again.
    """
    forecast = prepare_forecast(data, created, time, force_quality)
    tags = [t for t in FORECAST_TAGS if t in forecast.columns]
    with kept(forecast):
        rows, touched = check_batch(forecast, path, tags)
        if rows:
            upsert_last_write_wins(forecast, path, tags, touched=touched)
            if tahead_path:
                upsert_last_write_wins(forecast_taheads(forecast, options), tahead_path, [*tags, "tAhead"])
    return rows


def prepare_weather(data: DataFrame, source: str | None, created: datetime | None, time: str = "datetime") -> DataFrame:
    """Weather rows as they are stored; source and ``created`` may be columns of the data."""
    constants = {} if source is None else {"source": source}
    constants |= {} if created is None else {"created": _unix(created)}
    return _cast_besides_time(tag_constants(data, **constants), time, WEATHER_TYPES)


def write_weather(
    data: DataFrame,
    path: str,
    source: str | None,
    created: datetime | None,
    time: str = "datetime",
    options: Sequence[float] = tuple(WEATHER_HORIZONS),
    tags: Sequence[str] = ("input_city", "source"),
) -> int:
    """Upsert a weather batch into ``path`` and its horizon series into ``path_tAhead``."""
    weather = prepare_weather(data, source, created, time)
    with kept(weather):
        rows, touched = check_batch(weather, path, tags)
        if rows:
            upsert_last_write_wins(weather, path, list(tags), touched=touched)
            upsert_last_write_wins(with_horizon(weather, options), f"{path}_tAhead", [*tags, "tAhead"])
    return rows


def prepare_realised(df: DataFrame, created: datetime | None, kind: str = "measurement", sid: str | None = None, time: str = "datetime") -> DataFrame:
    """Readings as they are stored; system and ``created`` may be columns of the data."""
    constants: dict = {"type": kind}
    if sid is not None:
        constants["system"] = sid
    if created is not None:
        constants["created"] = _unix(created)
    return tag_constants(df, **constants).select(
        F.col(time).cast("timestamp").alias("time"),
        F.col("system").cast("string").alias("system"),
        "type",
        F.col("output").cast("double").alias("output"),
        F.col("created").cast("bigint").alias("created"),
    )


def write_realised(df: DataFrame, path: str, created: datetime | None, sid: str | None = None, time: str = "datetime") -> int:
    return append_series(prepare_realised(df, created, sid=sid, time=time), path, ["system", "type"])


def write_realised_pv(
    df: DataFrame, path: str, systems_path: str, region: str, created: datetime | None, time: str = "datetime"
) -> int:
    """Upsert PV readings, then add systems that are not in the systems table yet."""
    readings = prepare_realised(df, created, kind="solar", time=time)
    rows = append_series(readings, path, ["system", "type"])
    systems = readings.select(F.col("system").alias("sid")).distinct().withColumn("region", F.lit(region))
    insert_if_absent(systems, systems_path, "sid")
    return rows


def write_kpi(kpis: DataFrame, jobs: DataFrame, names: Sequence[str], path: str) -> int:
    """Clean KPIs (``pid, horizon, date, kpi, value``) and upsert one row per job, horizon and date.

    A batch with KPIs of jobs that are not known, or known without texts, is refused;
    ``unknown_kpis`` has their rows.
    """
    wide = kpi_wide(kpis, jobs, names).withColumn("time", F.col("date").cast("timestamp")).drop("date")
    return append_series(wide, path, [t for t in KPI_TAGS if t in wide.columns])


def unknown_kpis(kpis: DataFrame, jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """KPIs of known jobs, and those of jobs that are not in ``jobs``, for a report."""
    pids = jobs.select(F.col("id").alias("pid")).distinct()
    return kpis.join(pids, "pid", "left_semi"), kpis.join(pids, "pid", "left_anti")


def write_prices(prices: DataFrame, path: str) -> int:
    """Market prices (``time, Name, Price``)."""
    return append_series(prices, path, ["Name"])


def write_load_profiles(profiles: DataFrame, fields: Sequence[str], path: str) -> int:
    """Standard profiles (``time, year_created`` and the given fields)."""
    return append_series(profiles.select("time", "year_created", *fields), path, ["year_created"])
