"""Scans and load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridloom.catalog.registry import EVENT_TYPES, EVENTS, query, r6, rounded, sql_bucket, sql_fill, sql_means
from gridloom.functions import timeops
from gridloom.operators import grids, load, reshape
from gridloom.sources import sinks, tables


@query(
    "scan_series",
    """select system, type, time, output from power where time >= timestamp '2024-01-08' and
    time < timestamp '2024-01-22' and type in ('click', 'view', 'error')""",
)
def scan_series(t):
    found = tables.scan_series(t.power, datetime(2024, 1, 8), datetime(2024, 1, 22), type=["click", "view", "error"])
    return found.select("system", "type", "time", "output")


@query("scan_table", "select sid, region, qual from systems where autoupdate = 1 and qual > 0.25e0")
def scan_table(t):
    text = "select sid, region, qual from {systems} where autoupdate = :auto and qual > :quality"
    return tables.scan_table(t.spark, text, {"auto": 1, "quality": 0.25}, systems=t.systems)


@query(
    "union_results",
    """select time, 'output' as field, output as value from power
    union all select time, 'Price' as field, Price as value from marketprices""",
)
def union_results(t):
    one = t.power.select("time", F.lit("output").alias("field"), F.col("output").alias("value"), "system")
    two = t.marketprices.select(F.col("Price").alias("value"), "time", F.lit("Price").alias("field"))
    return sinks.union_results([one, two], ["time", "field", "value"])


@query("filter_tags", "select system, type, time, output from power where system in ('pv_3', 'pvx1', 'sys_8')")
def filter_tags(t):
    return tables.filter_tags(t.power, "system", ["pv_3", "pvx1", "sys_8"]).drop("created")


@query(
    "filter_tags_by_table",
    """select system, type, time, output from power
    where system in (select system_id from predictions_systems)""",
)
def filter_tags_by_table(t):
    found = tables.filter_tags(t.power, "system", t.predictions_systems.select("system_id"))
    return found.select("system", "type", "time", "output")


@query(
    "bucket_mean",
    f"""select system, type, datetime, {r6('output')} as output
    from {sql_means('power', ['system', 'type'], ['output'], 60)}""",
)
def bucket_mean(t):
    return rounded(grids.bucket_mean(t.power, ["system", "type"], ["output"], 60), "output")


BY_SYSTEM = sql_means("power", ["system"], ["output"], 15)
_TOTALS = f"(select datetime, sum(output) as load, count(output) as nEntries from {BY_SYSTEM} group by datetime)"


@query("load_by_systems", f"select datetime, {r6('load')} as load, nEntries from {_TOTALS}")
def load_by_systems(t):
    return rounded(load.load_by_systems(t.power, 15), "load")


@query("load_by_systems_average", f"select datetime, {r6('load / nEntries')} as load, nEntries from {_TOTALS}")
def load_by_systems_average(t):
    return rounded(load.load_by_systems(t.power, 15, average_output=True), "load")


_HOURLY = sql_means("power", ["system"], ["output"], 60)


@query(
    "load_per_system",
    f"select system, datetime, {r6('output')} as output from {sql_fill(_HOURLY, ['system'], ['output'], 60, limit=0)}",
)
def load_per_system(t):
    return rounded(load.load_per_system(t.power, 60, span=EVENTS), "output")


_WIDE = ["pv_0", "pvx1", "sys_2", "pv_3", "pvx4", "sys_5", "pv_6", "pvx7"]


@query(
    "load_per_system_wide",
    "select datetime, "
    + ", ".join(f"{r6(f'''avg(case when system = '{s}' then output end)''')} as {s}" for s in _WIDE)
    + f" from {_HOURLY} where system in ({', '.join(repr(s) for s in _WIDE)}) group by datetime",
)
def load_per_system_wide(t):
    return rounded(load.load_per_system_wide(t.power, _WIDE, 60), *_WIDE)


@query(
    "resample_mean",
    f"""select type, datetime, {r6('output')} as output
    from {sql_fill(sql_means('power', ['type'], ['output'], 5), ['type'], ['output'], 5, limit=0)}""",
)
def resample_mean(t):
    return rounded(grids.resample_mean(t.power, ["type"], ["output"], 5, span=EVENTS), "output")


MEMBERS = "predictions_systems join systems on system_id = sid"
ONE = "case when {c} = 0 then 1 else {c} end"


def _job_load(weight: str) -> str:
    return f"""select prediction_id as pid, datetime, {r6(f'sum(output * {weight})')} as load,
        count(output) as nEntries from {BY_SYSTEM} m join {MEMBERS} on m.system = sid
        group by prediction_id, datetime"""


@query("weighted_job_load", _job_load(f"({ONE.format(c='factor')}) * ({ONE.format(c='polarity')})"))
def weighted_job_load(t):
    return rounded(load.weighted_job_load(t.power, t.systems, t.predictions_systems, 15), "load")


@query("job_load_ignore_factor", _job_load(f"({ONE.format(c='polarity')})"))
def job_load_ignore_factor(t):
    found = load.weighted_job_load(t.power, t.systems, t.predictions_systems, 15, ignore_factor=True)
    return rounded(found, "load")


@query(
    "job_load_per_system",
    f"""select prediction_id as pid, system, datetime,
    {r6(f"output * factor * ({ONE.format(c='polarity')})")} as load
    from {BY_SYSTEM} m join {MEMBERS} on m.system = sid""",
)
def job_load_per_system(t):
    return rounded(load.job_load_per_system(t.power, t.systems, t.predictions_systems, 15), "load")


@query(
    "missing_systems",
    """select prediction_id as pid, system_id from predictions_systems
    where system_id not in (select system from power)""",
)
def missing_systems(t):
    return load.missing_systems(t.power, t.predictions_systems)


@query("system_count", "select type, count(distinct system) as systems from power group by type")
def system_count(t):
    return load.system_count(t.power)


@query(
    "pivot_systems",
    "select datetime, "
    + ", ".join(f"{r6(f'''avg(case when type = '{s}' then output end)''')} as {s}" for s in EVENT_TYPES)
    + f" from {sql_means('power', ['type'], ['output'], 15)} group by datetime",
)
def pivot_systems(t):
    means = grids.bucket_mean(t.power, ["type"], ["output"], 15)
    return rounded(reshape.pivot_values(means, ["datetime"], "type", {s: s for s in EVENT_TYPES}, "output"), *EVENT_TYPES)


@query(
    "systems_by_job",
    f"select prediction_id, sid, region, polarity, factor from {MEMBERS}",
)
def systems_by_job(t):
    found = load.systems_by_job(t.systems, t.predictions_systems)
    return found.select("prediction_id", "sid", "region", "polarity", "factor")


@query(
    "dedupe_time",
    f"""select system, datetime, output, type from (
    select *, row_number() over (partition by system, datetime order by type, output) as rn from (
    select system, type, output, {sql_bucket('time', 60)} as datetime from power)) where rn = 1""",
)
def dedupe_time(t):
    placed = t.power.select("system", timeops.bucket(F.col("time"), 60).alias("datetime"), "output", "type")
    return reshape.dedupe_time(placed, ["system", "datetime"], ["type", "output"])


_A = "(select system, {b} as datetime, avg(output) as {n} from power where type = '{t}' group by all)"
_CLICK = _A.format(b=sql_bucket("time", 60), n="clicks", t="click")
_VIEW = _A.format(b=sql_bucket("time", 60), n="views", t="view")


def _two(t):
    one = grids.bucket_mean(t.power.where("type = 'click'"), ["system"], ["output"], 60)
    two = grids.bucket_mean(t.power.where("type = 'view'"), ["system"], ["output"], 60)
    return [one.withColumnRenamed("output", "clicks"), two.withColumnRenamed("output", "views")]


@query(
    "align_outer",
    f"""select system, datetime, {r6('clicks')} as clicks, {r6('views')} as views
    from {_CLICK} a full join {_VIEW} b using (system, datetime)""",
)
def align_outer(t):
    return rounded(reshape.align_outer(_two(t), ["system", "datetime"]), "clicks", "views")


@query(
    "align_inner",
    f"""select system, datetime, {r6('clicks')} as clicks, {r6('views')} as views
    from {_CLICK} a join {_VIEW} b using (system, datetime) where clicks is not null and views is not null""",
)
def align_inner(t):
    return rounded(reshape.align_inner(_two(t), ["system", "datetime"]), "clicks", "views")
