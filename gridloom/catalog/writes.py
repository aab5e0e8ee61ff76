"""Sinks, ingest jobs and streams. Each query writes a table and returns it read again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridloom.catalog.quality import DOCUMENTS_SQL, KPIS, TEXTS, described_jobs, kpi_cells
from gridloom.catalog.registry import query, r6, rounded, sql_means
from gridloom.constants import FORECAST_HORIZONS, PROFILE_FIELDS, WEATHER_HORIZONS
from gridloom.functions.timeops import as_utc
from gridloom.operators import quality
from gridloom.session import shared_folder
from gridloom.sources import sinks, writers
from gridloom.sources.tables import read_series
from gridloom.streaming import readings as streams

# Batches are cut at a moment of creation, and the later part is written first: what
# counts is when a value was created, not when it arrived.
_CUT = int(as_utc(datetime(2024, 1, 12)).timestamp())


def _stored(t, path: str):
    return read_series(t.spark, path).drop("date")


def _seconds(source: str) -> str:
    """Times as they are stored."""
    return f"(select * replace (date_trunc('second', time) as time) from {source})"


def _newest(source: str, keys, fields, extra: str = "") -> str:
    listed = ", ".join(keys)
    cells = ", ".join(
        f"first({f} order by created desc, {f} desc) filter (where {f} is not null) as {f}" for f in fields
    )
    return f"select {listed}, {cells}, max(created) as created {extra} from {_seconds(source)} group by {listed}"


@query("append_series", _newest("power_feed", ["system", "type", "time"], ["output"]))
def append_series(t):
    path = shared_folder(t.spark)
    sinks.append_series(t.power_feed.where("created >= 1000000000"), path, ["system", "type"])
    sinks.append_series(t.power_feed.where("created < 1000000000"), path, ["system", "type"])
    return _stored(t, path)


@query("upsert_last_write_wins", _newest("power_feed", ["system", "time"], ["output", "type"]))
def upsert_last_write_wins(t):
    path = shared_folder(t.spark)
    feed = t.power_feed.select("system", "time", "type", "output", "created")
    # The originals lack the output at first: fields of one point arrive apart.
    sinks.upsert_last_write_wins(feed.drop("output").where("created < 1000000000"), path, ["system"])
    sinks.upsert_last_write_wins(feed, path, ["system"])
    sinks.upsert_last_write_wins(feed, path, ["system"])
    return _stored(t, path)


_APART = """(select system, time, output, null as type, created + 10 as created from power union all
    select system, time, null, 'old', created + 5 from power union all
    select system, time, null, type, created + 7 from power)"""


@query("upsert_fields_apart", _newest(_APART, ["system", "time"], ["output", "type"]))
def upsert_fields_apart(t):
    """One field is newest of all and arrives first; the other is corrected after it."""
    path = shared_folder(t.spark)
    keys = ["system", "time"]
    sinks.upsert_last_write_wins(
        t.power.select(*keys, "output", (F.col("created") + 10).alias("created")), path, ["system"]
    )
    for lead, kind in ((5, F.lit("old")), (7, F.col("type"))):
        part = t.power.select(*keys, kind.alias("type"), (F.col("created") + lead).alias("created"))
        sinks.upsert_last_write_wins(part, path, ["system"])
    return _stored(t, path)


@query("write_table_mode", "select * from genericpowercurves union all select * from genericpowercurves")
def write_table_mode(t):
    path = shared_folder(t.spark)
    sinks.write_table(t.genericpowercurves, path)
    sinks.write_table(t.genericpowercurves, path, if_exists="replace")
    sinks.write_table(t.genericpowercurves, path, if_exists="append")
    return t.spark.read.parquet(path)


_OLD_SYSTEMS = "(select sid, region from systems where autoupdate = 1)"


def _with_new(rows: str) -> str:
    return f"select * from {_OLD_SYSTEMS} union all {rows} where system not in (select sid from {_OLD_SYSTEMS})"


@query("insert_if_absent", _with_new("select distinct system as sid, 'new' as region from power"))
def insert_if_absent(t):
    path = shared_folder(t.spark)
    sinks.write_table(t.systems.where("autoupdate = 1").select("sid", "region"), path)
    new = t.power.select(F.col("system").alias("sid"), F.lit("new").alias("region"))
    sinks.insert_if_absent(new, path, "sid")
    return t.spark.read.parquet(path)


@query(
    "append_location",
    """select regionInput, lat, lon from NameToLatLon union all
    select n_name, n_nationkey + 0.5e0, n_regionkey + 0.5e0 from nation
    where n_name not in (select regionInput from NameToLatLon)""",
)
def append_location(t):
    path = shared_folder(t.spark)
    sinks.write_table(t.NameToLatLon, path)
    resolved = t.raw("nation").select(
        F.col("n_name").alias("regionInput"),
        (F.col("n_nationkey") + F.lit(0.5)).alias("lat"),
        (F.col("n_regionkey") + F.lit(0.5)).alias("lon"),
    )
    sinks.append_locations(resolved, path)
    return t.spark.read.parquet(path)


@query("write_documents", DOCUMENTS_SQL)
def write_documents(t):
    """Two exports of different days, read again as text."""
    path = shared_folder(t.spark)
    for part in ("time < timestamp '2024-01-15'", "time >= timestamp '2024-01-15'"):
        sinks.write_documents(quality.measurement_documents(t.power.where(part)), path)
    lines = t.spark.read.text(path)
    sid = F.get_json_object("value", "$.sid")
    return lines.select(sid.alias("sid"), F.col("date").cast("string").alias("date"), F.col("value").alias("document"))


_FORECAST_KEYS = ["pid", "type", "customer", "time"]
_FILLED = "(select * replace (coalesce(quality, 'actual') as quality), datetimeFC as time from forecast_batches)"


def _write_forecast(t) -> str:
    path = shared_folder(t.spark)
    for part in (f"created >= {_CUT}", f"created < {_CUT}"):
        writers.write_forecast(t.forecast_batches.where(part), f"{path}/latest", None, f"{path}/tAheads")
    return path


@query("write_forecast", _newest(_FILLED, _FORECAST_KEYS, ["forecast", "stdev", "quality"]))
def write_forecast(t):
    return _stored(t, _write_forecast(t) + "/latest")


def _lead(options, time: str) -> str:
    hours = f"((epoch_us({time}) - created * 1000000) / 3.6e9)"
    return "case " + " ".join(f"when {hours} > {o} then {o}e0" for o in sorted(options, reverse=True)) + " end"


@query(
    "write_forecast_taheads",
    _newest(
        f"(select *, {_lead(FORECAST_HORIZONS, 'time')} as tAhead from {_FILLED}) as f where tAhead is not null",
        [*_FORECAST_KEYS, "tAhead"],
        ["forecast", "stdev", "quality"],
    ),
)
def write_forecast_taheads(t):
    return _stored(t, _write_forecast(t) + "/tAheads")


_WEATHER_KEYS = ["input_city", "source", "time"]
_BATCH = "(select *, datetime as time from weather_batches)"


def _write_weather(t) -> str:
    path = f"{shared_folder(t.spark)}/weather"
    for part in (f"created >= {_CUT}", f"created < {_CUT}"):
        writers.write_weather(t.weather_batches.where(part), path, None, None)
    return path


@query("write_weather", _newest(_BATCH, _WEATHER_KEYS, ["temp", "windspeed"]))
def write_weather(t):
    return _stored(t, _write_weather(t))


@query(
    "write_weather_taheads",
    _newest(
        f"(select *, {_lead(WEATHER_HORIZONS, 'time')} as tAhead from {_BATCH}) as f where tAhead is not null",
        [*_WEATHER_KEYS, "tAhead"],
        ["temp", "windspeed"],
    ),
)
def write_weather_taheads(t):
    return _stored(t, _write_weather(t) + "_tAhead")


@query(
    "write_realised",
    f"""select time, system, 'measurement' as type, max(output) as output, 1704067200 as created
    from {_seconds('power')} group by time, system""",
)
def write_realised(t):
    path = shared_folder(t.spark)
    batch = t.power.select(F.col("time").alias("datetime"), "system", "output")
    writers.write_realised(batch, path, datetime(2024, 1, 1))
    return _stored(t, path)


def _written_pv(t) -> str:
    path = shared_folder(t.spark)
    sinks.write_table(t.systems.where("autoupdate = 1").select("sid", "region"), f"{path}/systems")
    batch = t.power.select(F.col("time").alias("datetime"), "system", "output")
    writers.write_realised_pv(batch, f"{path}/power", f"{path}/systems", "pv region", datetime(2024, 1, 1))
    return path


@query(
    "write_realised_pv",
    f"""select time, system, 'solar' as type, max(output) as output, 1704067200 as created
    from {_seconds('power')} group by time, system""",
)
def write_realised_pv(t):
    return _stored(t, _written_pv(t) + "/power")


@query("write_realised_pv_systems", _with_new("select distinct system as sid, 'pv region' as region from power"))
def write_realised_pv_systems(t):
    return t.spark.read.parquet(_written_pv(t) + "/systems")


@query(
    "write_kpi",
    f"""select cast(pid as integer) as pid, cast(replace(horizon, 'h', '') as double) as tAhead, description,
    name as customer, date as time, {kpi_cells(KPIS)} from kpis join {TEXTS} on id = pid group by all""",
)
def write_kpi(t):
    path = shared_folder(t.spark)
    known, _ = writers.unknown_kpis(t.kpis, t.predictions)
    writers.write_kpi(known, described_jobs(t), KPIS, path)
    return _stored(t, path)


@query(
    "unknown_kpis",
    """select pid, horizon, date, kpi, case when isnan(value) then null else value end as value from kpis
    where pid is null or pid not in (select id from predictions where id % 3 <> 0)""",
)
def unknown_kpis(t):
    """The report of KPIs that none of some jobs takes."""
    _, unknown = writers.unknown_kpis(t.kpis, t.predictions.where("id % 3 <> 0"))
    return unknown.select("pid", "horizon", "date", "kpi", F.nanvl("value", F.lit(None).cast("double")).alias("value"))


@query("write_prices", "select Name, time, max(Price) as Price from marketprices_hourly group by Name, time")
def write_prices(t):
    path = shared_folder(t.spark)
    writers.write_prices(t.marketprices_hourly, path)
    return _stored(t, path)


_BATCH_CELLS = ", ".join(f"max({f}) as {f}" for f in PROFILE_FIELDS)


@query(
    "write_load_profiles",
    f"select time, year_created, {_BATCH_CELLS} from {_seconds('profile_batch')} group by time, year_created",
)
def write_load_profiles(t):
    """All thirty profile fields."""
    path = shared_folder(t.spark)
    writers.write_load_profiles(t.profile_batch, PROFILE_FIELDS, path)
    return _stored(t, path)


def _staged(t, name: str) -> tuple[str, str]:
    """The feed as files in a folder, as a stream finds it."""
    base = shared_folder(t.spark)
    feed = getattr(t, name).select("time", "system", "type", "output", "created")
    feed.repartition(4, "created").write.parquet(f"{base}/feed")
    return base, f"{base}/feed"


@query("stream_realised", _newest("power_feed", ["system", "type", "time"], ["output"]))
def stream_realised(t):
    base, folder = _staged(t, "power_feed")
    feed = streams.read_stream(t.spark, folder, files_per_batch=2)
    streams.stream_realised(feed, f"{base}/power", f"{base}/checkpoint").awaitTermination()
    return _stored(t, f"{base}/power")


@query(
    "stream_load_buckets",
    f"""select system, datetime as time, {r6('output')} as output, points from
    {sql_means('power', ['system'], ['output'], 15)} join
    (select system, time_bucket(interval '15 minutes', time, timestamp '1970-01-01') as datetime, count(output) as points
    from power group by all) using (system, datetime)""",
)
def stream_load_buckets(t):
    base, folder = _staged(t, "power")
    feed = streams.read_stream(t.spark, folder, state_partitions=t.spark.sparkContext.defaultParallelism)
    streams.stream_bucket_means(feed, 15, "1 hour", f"{base}/buckets", f"{base}/checkpoint").awaitTermination()
    return rounded(_stored(t, f"{base}/buckets"), "output")


_CORRECTED = f"({_newest('power_feed', ['system', 'type', 'time'], ['output'])})"


@query(
    "stream_corrected_buckets",
    f"select system, datetime as time, {r6('output')} as output from {sql_means(_CORRECTED, ['system'], ['output'], 60)}",
)
def stream_corrected_buckets(t):
    base, folder = _staged(t, "power_feed")
    feed = streams.read_stream(t.spark, folder, files_per_batch=2)
    streams.stream_corrected_buckets(
        feed, 60, f"{base}/power", f"{base}/buckets", f"{base}/checkpoint"
    ).awaitTermination()
    return rounded(_stored(t, f"{base}/buckets"), "output")
