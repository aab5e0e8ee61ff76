"""Predictors, model input, solar and wind input, splitting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridloom.catalog.load import BY_SYSTEM, MEMBERS, ONE
from gridloom.catalog.registry import (
    EVENTS,
    ORDERS,
    query,
    r6,
    rounded,
    sql_cubic,
    sql_fill,
    sql_great_circle,
    sql_means,
    sql_nearest,
    sql_present,
    sql_span,
)
from gridloom.catalog.weather import EVENT_FIELDS, EVENT_ORDER, NAMED_SITES, sql_event_weather
from gridloom.constants import PROFILE_FIELDS
from gridloom.functions.numeric import wind_at_height
from gridloom.operators import grids, places
from gridloom.plans import model_input as model
from gridloom.plans import predictors, splitting

PRICE = "day_ahead_electricity_price"
_SPAN = sql_span(*EVENTS)


def _columns(fields) -> str:
    return ", ".join(f"{r6(f)} as {f}" for f in fields)


def _prices(source: str, minutes: int, where: str) -> str:
    means = sql_means(source, ["Name"], ["Price"], minutes, where=where)
    return sql_fill(means, ["Name"], ["Price"], minutes, ffill=True)


def _profiles(fields, minutes: int) -> str:
    means = sql_means("sjv", ["year_created"], fields, minutes, where=_SPAN)
    cells = ", ".join(f"avg({f}) as {f}" for f in fields)
    merged = f"(select datetime, {cells} from {means} group by datetime)"
    return sql_fill(f"{merged} where {sql_present(fields)}", [], fields, minutes, 3)


_NL = _prices("marketprices_hourly", 15, f"{_SPAN} and Name = 'NL'")


@query("day_ahead_price", f"select datetime, {r6('Price')} as {PRICE} from {_NL}")
def day_ahead_price(t):
    return rounded(predictors.day_ahead_price(t.marketprices_hourly, *EVENTS, minutes=15), PRICE)


@query(
    "prices_by_zone",
    f"select Name, datetime, {r6('Price')} as {PRICE} from {_prices('marketprices', 720, sql_span(*ORDERS))}",
)
def prices_by_zone(t):
    return rounded(predictors.prices_by_zone(t.marketprices, *ORDERS, minutes=720), PRICE)


@query("load_profiles", f"select datetime, {_columns(PROFILE_FIELDS)} from {_profiles(PROFILE_FIELDS, 15)}")
def load_profiles(t):
    return rounded(predictors.load_profiles(t.sjv, *EVENTS, minutes=15), *PROFILE_FIELDS)


_HALF_HOURS = sql_fill(
    sql_means(sql_event_weather(EVENT_FIELDS, 15), ["input_city"], EVENT_FIELDS, 30, time="datetime"),
    ["input_city"],
    EVENT_FIELDS,
    30,
    11,
)


@query("weather_predictors", f"select input_city, datetime, {_columns(EVENT_FIELDS)} from {_HALF_HOURS}")
def weather_predictors(t):
    found = predictors.weather_predictors(t.weather, *EVENTS, minutes=30, source_order=EVENT_ORDER)
    return rounded(found, *EVENT_FIELDS)


_STEPS = """(select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-30 23:45:00',
    interval '15 minutes')) as datetime)"""


@query(
    "predictors",
    f"""select datetime, {r6('Price')} as {PRICE}, {_columns(PROFILE_FIELDS)} from {_STEPS} g
    left join {_NL} n using (datetime) left join {_profiles(PROFILE_FIELDS, 15)} p using (datetime)""",
)
def predictors_without_weather(t):
    grid = grids.time_grid(t.spark, *EVENTS, minutes=15)
    found = predictors.predictors(
        grid, *EVENTS, 15, ["market_data", "load_profiles"], prices=t.marketprices_hourly, profiles=t.sjv
    )
    return rounded(found, PRICE, *PROFILE_FIELDS)


_WEIGHT = f"({ONE.format(c='factor')}) * ({ONE.format(c='polarity')})"


def _job_load(minutes: int) -> str:
    means = sql_means("power", ["system"], ["output"], minutes)
    return f"""(select prediction_id as pid, datetime, sum(output * {_WEIGHT}) as load
        from {means} m join {MEMBERS} on m.system = sid group by prediction_id, datetime)"""


_LOAD = sql_fill(_job_load(15), ["pid"], ["load"], 15, 3)


def model_input_of(t, sites=None, **options):
    """The flagship: load and predictors of every job over the whole month."""
    return model.model_input(
        t.sites if sites is None else sites,
        t.power,
        t.systems,
        t.predictions_systems,
        *EVENTS,
        15,
        weather=t.weather,
        locations=t.nl_locations,
        prices=t.marketprices_hourly,
        profiles=t.sjv,
        **options,
    )


def _model_sql(weather: str, sites: str = "sites") -> str:
    return f"""select s.site as pid, g.datetime, {r6('load')} as load, {_columns(EVENT_FIELDS)}, {r6('Price')} as {PRICE},
    {_columns(PROFILE_FIELDS)} from {sites} s cross join {_STEPS} g
    left join {_LOAD} l on l.pid = s.site and l.datetime = g.datetime
    left join {sql_nearest(sites, 1)} c on c.site = s.site
    left join {weather} w on w.input_city = c.input_city and w.datetime = g.datetime
    left join {_NL} n on n.datetime = g.datetime
    left join {_profiles(PROFILE_FIELDS, 15)} p on p.datetime = g.datetime"""


@query("model_input", _model_sql(sql_event_weather(EVENT_FIELDS, 15)))
def model_input(t):
    return rounded(model_input_of(t, source_order=EVENT_ORDER), "load", *EVENT_FIELDS, PRICE, *PROFILE_FIELDS)


def _named(t):
    """Jobs given by the name of their place; some names are not in the gazetteer."""
    names = t.raw("nation").select(F.col("n_nationkey").cast("long").alias("site"), F.col("n_name").alias("name"))
    return places.named_sites(names, t.NameToLatLon)


@query("model_input_by_name", _model_sql(sql_event_weather(EVENT_FIELDS, 15), NAMED_SITES))
def model_input_by_name(t):
    found = model_input_of(t, _named(t), source_order=EVENT_ORDER)
    return rounded(found, "load", *EVENT_FIELDS, PRICE, *PROFILE_FIELDS)


_TWO = ["view", "click"]


@query("model_input_two_sources", _model_sql(sql_event_weather(EVENT_FIELDS, 15, _TWO)))
def model_input_two_sources(t):
    """A list of sources is blended in its order, so that a job still has one row per time."""
    return rounded(model_input_of(t, source=_TWO), "load", *EVENT_FIELDS, PRICE, *PROFILE_FIELDS)


def _near_systems(radius: float, quality: float, freq: int) -> str:
    distance = sql_great_circle("s.lat", "s.lon", "y.lat", "y.lon")
    return f"""(select * from (select s.site, y.sid, {distance} as distance from sites s, systems y
        where y.qual > {quality}e0 and y.freq <= {freq} and y.lat is not null) where distance < {radius})"""


def _site_load(chosen: str, minutes: int, where: str, average: bool) -> str:
    means = sql_means("power", ["system"], ["output"], minutes, where=where)
    total = "sum(output) / count(output)" if average else "sum(output)"
    return f"""(select site, datetime, {total} as load from {means} m join {chosen} c on c.sid = m.system
        group by site, datetime)"""


_SOLAR_START = datetime(2024, 1, 20)


def _solar_sql(radius: float) -> str:
    near = _near_systems(radius or 15.0, 0.3, 10)
    if radius == 0:
        near = f"""(select site, sid from (select *, row_number() over (partition by site order by distance, sid) as rn
            from {near}) where rn = 1)"""
    where = "time >= timestamp '2024-01-06' and time < timestamp '2024-01-20 01:00:00'"
    output = _site_load(near, 60, where, radius == 0)
    fields = ["radiation", "clouds"]
    span = sql_span(datetime(2024, 1, 6), datetime(2024, 1, 22))
    by_site = f"""(select site, datetime, radiation, clouds from {sql_nearest('sites', 1)} n
        join {sql_event_weather(fields, 60, where=span)} w using (input_city))"""
    inside = sql_fill(by_site, ["site"], fields, 60, tail=False)
    return f"""with pv as (select site, datetime, abs(load) as aggregated from {output}),
        sky as (select * from {inside} where site in (select site from pv))
        select site, datetime, {r6("case when aggregated is null and datetime < timestamp '2024-01-20' then 0.0e0 else aggregated end")}
        as aggregated, {_columns(fields)} from pv full join sky using (site, datetime)"""


def _solar(t, radius: float):
    found = model.solar_input(
        t.sites, t.power, t.systems, t.weather, t.nl_locations, _SOLAR_START, 2880, 60, radius,
        source_order=EVENT_ORDER, quality=0.3, freq=10,
    )
    return rounded(found, "aggregated", "radiation", "clouds")


@query("solar_input", _solar_sql(0.0))
def solar_input(t):
    return _solar(t, 0.0)


@query("solar_input_radius", _solar_sql(25.0))
def solar_input_radius(t):
    return _solar(t, 25.0)


@query(
    "wind_at_height",
    f"select l_orderkey, l_linenumber, l_partkey, l_quantity, {r6('l_quantity * pow(l_linenumber * 20.0e0 / 10.0e0, 0.143e0)')} as speed from lineitem",
)
def wind_at_height_of(t):
    speed = wind_at_height(F.col("l_quantity"), 10.0, F.col("l_linenumber") * F.lit(20.0))
    found = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", speed.alias("speed"))
    return rounded(found, "speed")


def _wind(sites: str) -> str:
    return f"""(select site, datetime, windspeed_100m as windspeed from {sql_nearest(sites, 1)} n
    join {sql_event_weather(['windspeed_100m'], 60)} w using (input_city))"""


_WIND = _wind("sites")
_WIND_REF = f"""(select site, datetime, windspeed / nullif(abs(max(windspeed) over (partition by site)), 0) as windspeed
    from {_WIND})"""


def _wind_input_sql(sites: str) -> str:
    return f"select site, datetime, {r6('windspeed')} as windspeed_100m from {sql_cubic(_wind(sites), 'site', 'windspeed', 60)}"


def _wind_input(t, sites):
    month = datetime(2024, 1, 1), 30 * 1440
    found = model.wind_input(sites, t.weather, t.nl_locations, *month, 60, source_order=EVENT_ORDER)
    return rounded(found, "windspeed_100m")


@query("wind_input", _wind_input_sql("sites"))
def wind_input(t):
    return _wind_input(t, t.sites)


@query("wind_input_by_name", _wind_input_sql(NAMED_SITES))
def wind_input_by_name(t):
    return _wind_input(t, _named(t))


@query("wind_ref", f"select site, datetime, {r6('windspeed')} as windspeed from {_WIND_REF}")
def wind_ref(t):
    found = splitting.wind_ref(t.weather, t.sites, t.nl_locations, *EVENTS, minutes=60, source_order=EVENT_ORDER)
    return rounded(found, "windspeed")


_WIDE_NEAR = _near_systems(30.0, 0.5, 5)
_CHOSEN = f"""(select * from (select *, min(distance) over (partition by site) as closest from {_WIDE_NEAR})
    where distance < 15 or closest >= 15)"""


def _solar_ref_sql(minutes: int) -> str:
    return f"""(select site, datetime, load / nullif(quantile_cont(load, 0.99) over (partition by site), 0) as aggregated
        from {_site_load(_CHOSEN, minutes, 'true', True)})"""


@query("solar_ref", f"select site, datetime, {r6('aggregated')} as aggregated from {_solar_ref_sql(15)}")
def solar_ref(t):
    found = splitting.solar_ref(t.power, t.systems, t.sites, *EVENTS, quality=0.5)
    return rounded(found, "aggregated")


@query(
    "splitting_input",
    f"""select l.pid, l.datetime, {r6('load')} as load, {r6('-windspeed')} as wind_ref, {r6('-aggregated')} as pv_ref,
    {_columns(PROFILE_FIELDS)} from {_job_load(60)} l
    join {_WIND_REF} w on w.site = l.pid and w.datetime = l.datetime
    join {_solar_ref_sql(60)} s on s.site = l.pid and s.datetime = l.datetime
    join {_profiles(PROFILE_FIELDS, 60)} p on p.datetime = l.datetime
    where load is not null and windspeed is not null and aggregated is not null and {' and '.join(f'{f} is not null' for f in PROFILE_FIELDS)}""",
)
def splitting_input(t):
    found = splitting.splitting_input(
        t.power, t.systems, t.predictions_systems, t.sites, t.weather, t.nl_locations, t.sjv, *EVENTS,
        minutes=60, source_order=EVENT_ORDER, quality=0.5,
    )
    return rounded(found, "load", "wind_ref", "pv_ref", *PROFILE_FIELDS)


@query(
    "latest_coefficients",
    """select pid, coef_name, coef_value, created from energy_split_coefs c
    where created = (select max(created) from energy_split_coefs d where d.pid = c.pid)""",
)
def latest_coefficients(t):
    return splitting.latest_coefficients(t.energy_split_coefs)


@query(
    "mean_coefficients",
    f"""select pid, coef_name, {r6('avg(coef_value)')} as coef_value from energy_split_coefs
    where created > timestamp '2001-06-01' - interval '180 days' group by pid, coef_name""",
)
def mean_coefficients(t):
    return rounded(splitting.mean_coefficients(t.energy_split_coefs, datetime(2001, 6, 1)), "coef_value")


@query(
    "normalise_p99",
    f"""select system, datetime, {r6('output / nullif(quantile_cont(output, 0.99) over (partition by system), 0)')} as output
    from {BY_SYSTEM}""",
)
def normalise_p99(t):
    means = grids.bucket_mean(t.power, ["system"], ["output"], 15)
    return rounded(splitting.normalise_p99(means, "output", ["system"]), "output")


@query(
    "normalise_absmax",
    f"""select system, datetime, {r6('output / nullif(abs(max(output) over (partition by system)), 0)')} as output
    from {BY_SYSTEM}""",
)
def normalise_absmax(t):
    means = grids.bucket_mean(t.power, ["system"], ["output"], 15)
    return rounded(splitting.normalise_absmax(means, "output", ["system"]), "output")

