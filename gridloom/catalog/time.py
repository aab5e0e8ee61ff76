"""Grids, gap filling and time arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridloom.catalog.registry import EVENTS, ORDERS, query, r6, rounded, sql_cubic, sql_fill, sql_means
from gridloom.functions import timeops
from gridloom.operators import grids, reshape
from gridloom.plans.weather import with_source_run


@query(
    "time_grid",
    """select prediction_id, unnest(generate_series(timestamp '2024-01-01 10:00:00', timestamp '2024-01-03 09:30:00',
    interval '30 minutes')) as datetime from (select distinct prediction_id from predictions_systems)""",
)
def time_grid(t):
    keys = t.predictions_systems.select("prediction_id").distinct()
    return grids.key_grid(keys, datetime(2024, 1, 1, 10, 7), datetime(2024, 1, 3, 9, 59), 30)


_SYSTEM_15 = sql_means("power", ["system"], ["output"], 15)


@query(
    "interpolate_linear_limit",
    f"""select system, datetime, {r6('output')} as output
    from {sql_fill(_SYSTEM_15, ['system'], ['output'], 15, limit=11)}""",
)
def interpolate_linear_limit(t):
    found = grids.resample_interpolate(t.power, ["system"], ["output"], 15, limit=11, span=EVENTS)
    return rounded(found, "output")


_CITY = ["input_city"]
_FIELDS = ["temp", "clouds", "rain"]
_CITY_DAILY = sql_means("weather_daily", _CITY, _FIELDS, 1440)


@query(
    "interpolate_linear_limit_chunked",
    "select input_city, datetime, "
    + ", ".join(f"{r6(c)} as {c}" for c in _FIELDS)
    + f" from {sql_fill(_CITY_DAILY, _CITY, _FIELDS, 1440, limit=3)}",
)
def interpolate_linear_limit_chunked(t):
    means = grids.bucket_mean(t.weather_daily, _CITY, _FIELDS, 1440)
    return rounded(grids.fill_gaps(means, _CITY, _FIELDS, 1440, limit=3, chunk_steps=256), *_FIELDS)


@query(
    "interpolate_inside",
    "select input_city, datetime, "
    + ", ".join(f"{r6(c)} as {c}" for c in _FIELDS)
    + f" from {sql_fill(_CITY_DAILY, _CITY, _FIELDS, 1440, tail=False)}",
)
def interpolate_inside(t):
    means = grids.bucket_mean(t.weather_daily, _CITY, _FIELDS, 1440)
    return rounded(grids.interpolate_inside(means, _CITY, _FIELDS, 1440, span=ORDERS), *_FIELDS)


_HOURLY = sql_fill(sql_means("power", ["system"], ["output"], 60), ["system"], ["output"], 60, limit=0)


@query("interpolate_cubic", f"select system, datetime, {r6('output')} as output from {sql_cubic(_HOURLY, 'system', 'output', 60)}")
def interpolate_cubic(t):
    filled = grids.resample_mean(t.power, ["system"], ["output"], 60, span=EVENTS)
    return rounded(grids.interpolate_cubic(filled, ["system"], "output", 60), "output")


_PRICES = sql_means("marketprices", ["Name"], ["Price"], 480)


@query(
    "forward_fill",
    f"""select Name, datetime, {r6('Price')} as Price
    from {sql_fill(_PRICES, ['Name'], ['Price'], 480, ffill=True)}""",
)
def forward_fill(t):
    means = grids.bucket_mean(t.marketprices, ["Name"], ["Price"], 480)
    return rounded(grids.forward_fill(means, ["Name"], ["Price"], 480, span=ORDERS), "Price")


@query(
    "shift_time",
    "select system, type, time - interval '15 minutes' as time, output from power",
)
def shift_time(t):
    return t.power.select("system", "type", timeops.shift(F.col("time"), -15).alias("time"), "output")


@query(
    "floor_time",
    """select system, time, date_trunc('hour', time)
        + to_minutes(cast(extract(minute from time) as integer) // 20 * 20) as quarter,
    date_trunc('hour', time) + to_minutes(cast(extract(minute from time) as integer) // 7 * 7) as sevens from power""",
)
def floor_time(t):
    return t.power.select(
        "system",
        "time",
        timeops.floor_within_hour(F.col("time"), 20).alias("quarter"),
        timeops.floor_within_hour(F.col("time"), 7).alias("sevens"),
    )


_HOURS = "(date_diff('microsecond', o_orderdate, l_shipdate) / 3.6e9)"
_OPTIONS = [0.0, 720.0, 2160.0, 8760.0, 17520.0]
_ROUND = "case " + " ".join(f"when {_HOURS} > {o} then {o}e0" for o in reversed(_OPTIONS)) + " end"


@query(
    "horizon_hours",
    f"""select l_orderkey, l_shipdate, {_HOURS} as hours, {_ROUND} as tAhead
    from lineitem join orders on l_orderkey = o_orderkey""",
)
def horizon_hours(t):
    joined = t.raw("lineitem").join(t.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    hours = timeops.horizon_hours(F.col("l_shipdate"), F.col("o_orderdate"))
    return joined.select(
        "l_orderkey", "l_shipdate", hours.alias("hours"), timeops.round_down_horizon(hours, _OPTIONS).alias("tAhead")
    )


_TENTHS = [0, 30, 70, 110, 190]
_ROUND_TENTHS = "case " + " ".join(f"when output > {o / 10}e0 then {o / 10}e0" for o in reversed(_TENTHS)) + " end"


@query("round_down_tahead", f"select system, time, output, {_ROUND_TENTHS} as option from power")
def round_down_tahead(t):
    option = timeops.round_down_horizon(F.col("output"), [o / 10 for o in _TENTHS])
    return t.power.select("system", "time", "output", option.alias("option"))


@query(
    "source_run",
    """select input_city, time, tAhead, time - to_microseconds(cast(tAhead * 3.6e9 as bigint)) as created
    from weather_tAhead""",
)
def source_run(t):
    return with_source_run(t.weather_tAhead, "time", "tAhead").select("input_city", "time", "tAhead", "created")


_PIVOT = ["E1A_AMI_A", "E1C_AZI_I", "E2B_AMI_A", "E3A_A", "E4A_I"]


@query(
    "pivot_fields",
    "select time, year_created, "
    + ", ".join(f"{r6(f'''avg(case when field = '{f}' then value end)''')} as {f}" for f in _PIVOT)
    + f" from profile_points where field in ({', '.join(repr(f) for f in _PIVOT)}) group by time, year_created",
)
def pivot_fields(t):
    return rounded(reshape.pivot_fields(t.profile_points, ["time", "year_created"], _PIVOT), *_PIVOT)


@query("rename_order_columns", "select time as datetime, output as load, system as sid from power")
def rename_order_columns(t):
    names = {"time": "datetime", "output": "load", "system": "sid"}
    return reshape.rename_order(t.power, names, ["datetime", "load", "absent", "sid"])
