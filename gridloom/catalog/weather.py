"""Blending sources, weather per site, forecast runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridloom.catalog.registry import (
    EVENT_TYPES,
    EVENTS,
    ORDERS,
    query,
    r6,
    rounded,
    sql_blend,
    sql_fill,
    sql_means,
    sql_nearest,
    sql_present,
    sql_span,
)
from gridloom.constants import WEATHER_PARAMS
from gridloom.operators import grids, places
from gridloom.plans import weather

DAILY = ["temp", "clouds", "rain"]
# One of the six sources of the daily table is not listed, and so left out.
DAILY_ORDER = ["NO", "RF", "AF", "NF", "AO"]


def _columns(fields) -> str:
    return ", ".join(f"{r6(f)} as {f}" for f in fields)


_MEANS = sql_means("weather_daily", ["input_city", "source"], DAILY, 1440)
_BLENDED = sql_blend(_MEANS, ["datetime", "input_city"], DAILY, DAILY_ORDER)


@query("combine_sources", f"select datetime, input_city, {_columns(DAILY)} from {_BLENDED}")
def combine_sources(t):
    means = grids.bucket_mean(t.weather_daily, ["input_city", "source"], DAILY, 1440)
    return rounded(weather.combine_sources(means, DAILY, DAILY_ORDER), *DAILY)


_SPAN = sql_span(*ORDERS)
_IN_SPAN = sql_means("weather_daily", ["input_city", "source"], DAILY, 1440, where=_SPAN)
_PRESENT = f"(select * from {_IN_SPAN} where {sql_present(DAILY)})"
_FILLED = sql_fill(sql_blend(_PRESENT, ["datetime", "input_city"], DAILY, DAILY_ORDER), ["input_city"], DAILY, 1440, 11)


@query(
    "weather_latest",
    f"""select site, 'optimum' as source, datetime, {_columns(DAILY)}
    from {sql_nearest('sites', 1)} n join {_FILLED} w using (input_city)""",
)
def weather_latest(t):
    found = weather.weather_latest(
        t.weather_daily, t.sites, t.nl_locations, DAILY, *ORDERS, minutes=1440, source_order=DAILY_ORDER
    )
    return rounded(found, *DAILY)


NAMED_SITES = """(select n_nationkey as site, lat, lon from nation left join NameToLatLon on n_name = regionInput)"""


@query(
    "weather_latest_by_name",
    f"""select site, 'optimum' as source, datetime, {_columns(DAILY)}
    from {sql_nearest(NAMED_SITES, 1)} n join {_FILLED} w using (input_city)""",
)
def weather_latest_by_name(t):
    names = t.raw("nation").select(F.col("n_nationkey").alias("site"), F.col("n_name").alias("name"))
    sites = places.named_sites(names, t.NameToLatLon)
    found = weather.weather_latest(
        t.weather_daily, sites, t.nl_locations, DAILY, *ORDERS, minutes=1440, source_order=DAILY_ORDER
    )
    return rounded(found, *DAILY)


_HOURLY = ["temp", "windspeed_100m"]
_TWO_SOURCES = (
    "(select * from "
    + sql_means(
        "weather", ["input_city", "source"], _HOURLY, 60, where=sql_span(*EVENTS) + " and source in ('view', 'click')"
    )
    + f" where {sql_present(_HOURLY)})"
)


@query(
    "weather_latest_two_locations",
    f"""select site, input_city, distance, source, datetime, {_columns(_HOURLY)}
    from {sql_nearest('sites', 2)} n
    join {sql_fill(_TWO_SOURCES, ['source', 'input_city'], _HOURLY, 60, 11)} w using (input_city)""",
)
def weather_latest_two_locations(t):
    found = weather.weather_latest(
        t.weather,
        t.sites,
        t.nl_locations,
        _HOURLY,
        *EVENTS,
        source=["view", "click"],
        minutes=60,
        number_locations=2,
    )
    return rounded(found, *_HOURLY)


_RUN_FIELDS = ["temp", "clouds"]
_RUN_KEYS = ["input_city", "created"]
_RUNS = f"""(select *, time - to_microseconds(cast(tAhead * 3.6e9 as bigint)) as created from weather_tAhead
    where {_SPAN})"""
_RUN_MEANS = sql_means(_RUNS, [*_RUN_KEYS, "source"], [*_RUN_FIELDS, "tAhead"], 720)
_RUN_BLEND = sql_blend(_RUN_MEANS, ["datetime", *_RUN_KEYS], [*_RUN_FIELDS, "tAhead"], ["N", "R", "A"])


_RUN_FILLED = sql_fill(_RUN_BLEND, _RUN_KEYS, [*_RUN_FIELDS, "tAhead"], 720, 11)


@query(
    "weather_by_run",
    f"""select site, 'optimum' as source, created, datetime, {_columns([*_RUN_FIELDS, 'tAhead'])}
    from {sql_nearest('sites', 1)} n join {_RUN_FILLED} w using (input_city)""",
)
def weather_by_run(t):
    found = weather.weather_by_run(
        t.weather_tAhead, t.sites, t.nl_locations, _RUN_FIELDS, *ORDERS, minutes=720, source_order=["N", "R", "A"]
    )
    return rounded(found, *_RUN_FIELDS, "tAhead")


@query(
    "weather_by_run_city",
    f"""select 'optimum' as source, input_city, created, datetime, {_columns([*_RUN_FIELDS, 'tAhead'])}
    from {_RUN_FILLED}""",
)
def weather_by_run_city(t):
    found = weather.weather_by_run_city(
        t.weather_tAhead, _RUN_FIELDS, *ORDERS, minutes=720, source_order=["N", "R", "A"]
    )
    return rounded(found, *_RUN_FIELDS, "tAhead")


@query(
    "latest_weather_run",
    """select s.source, timestamp '1970-01-01' + to_seconds(coalesce(max(w.source_run), 0)) as last_stored_run
    from (select distinct event_type as source from events union all select 'none') s
    left join (select * from weather where time >= timestamp '2024-01-18' and time < timestamp '2024-01-20') w
    on w.source = s.source group by s.source""",
)
def latest_weather_run(t):
    none = t.spark.range(1).select(F.lit("none").alias("source"))
    sources = t.weather.select("source").distinct().unionByName(none)
    return weather.latest_weather_run(t.weather, sources, datetime(2024, 1, 20))


# Weather by event type, in this order of preference, for the composed queries.
EVENT_ORDER = EVENT_TYPES
EVENT_FIELDS = list(WEATHER_PARAMS)


def sql_event_weather(fields, minutes: int, order=None, where: str = sql_span(*EVENTS)) -> str:
    """Blended and filled weather per location over the events span."""
    means = sql_means("weather", ["input_city", "source"], fields, minutes, where=where)
    present = f"(select * from {means} where {sql_present(fields)})"
    blended = sql_blend(present, ["datetime", "input_city"], fields, order or EVENT_ORDER)
    return sql_fill(blended, ["input_city"], fields, minutes, 11)
