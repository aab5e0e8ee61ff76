"""Prediction jobs and their metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.catalog.registry import query
from gridloom.operators import jobs

_COLUMNS = """id, ean, name, forecast_type, model, horizon_minutes, train_horizons_minutes, resolution_minutes,
    train_components"""
_SYSTEMS = """(select prediction_id, min(lat) as lat, min(lon) as lon, min(sid) as sid
    from predictions_systems join systems on sid = system_id group by prediction_id)"""


@query(
    "filter_jobs",
    """select id, name, model, active from predictions where model in ('xgb', 'lgb') and active = 1
    and name like 'ATO%' and name not like '%HS%'""",
)
def filter_jobs(t):
    found = jobs.filter_jobs(t.predictions, model_type=["xgb", "lgb"], is_active=7, only_ato=True)
    return found.select("id", "name", "model", "active")


@query("filter_jobs_by_id", "select id, name, model, active from predictions where id in (1, 3, 7)")
def filter_jobs_by_id(t):
    return jobs.filter_jobs(t.predictions, pid=[1, "3", 7]).select("id", "name", "model", "active")


@query("limit_rows", "select id, name from predictions where active = 1 order by id limit 7")
def limit_rows(t):
    return jobs.filter_jobs(t.predictions, is_active=1, limit=7).select("id", "name")


@query("prediction_jobs", f"select {_COLUMNS}, lat, lon from predictions left join {_SYSTEMS} on prediction_id = id")
def prediction_jobs(t):
    return jobs.prediction_jobs(t.predictions, t.predictions_systems, t.systems)


_TYPED = "id, forecast_type, model, horizon_minutes, resolution_minutes, name"


@query(
    "wind_jobs",
    f"""select {_TYPED}, s.sid, w.lat, w.lon, turbine_type, n_turbines, hub_height from predictions
    left join {_SYSTEMS} s on prediction_id = id left join windspecs w on w.pid = id
    where forecast_type = 'wind' and active = 1""",
)
def wind_jobs(t):
    return jobs.wind_jobs(t.predictions, t.predictions_systems, t.systems, t.windspecs)


@query(
    "solar_jobs",
    f"""select {_TYPED}, s.lat as system_lat, s.lon as system_lon, s.sid, w.lat, w.lon, radius, peak_power
    from predictions left join {_SYSTEMS} s on prediction_id = id left join solarspecs w on w.pid = id
    where forecast_type = 'solar' and active = 1""",
)
def solar_jobs(t):
    return jobs.solar_jobs(t.predictions, t.predictions_systems, t.systems, t.solarspecs)


@query(
    "attach_quantiles",
    """select p.id, coalesce(q.quantiles, '') as quantiles from predictions p left join (
        select prediction_id, string_agg(cast(v as varchar), ',' order by v) as quantiles from (
            select prediction_id, unnest(cast(quantiles as json)::double[]) as v
            from predictions_quantile_sets join quantile_sets on id = quantile_set_id)
        group by prediction_id) q on q.prediction_id = p.id""",
)
def attach_quantiles(t):
    found = jobs.attach_quantiles(t.predictions, t.predictions_quantile_sets, t.quantile_sets)
    texts = F.transform("quantiles", lambda q: q.cast("string"))
    return found.select("id", F.array_join(texts, ",").alias("quantiles"))


@query(
    "attach_description",
    """select p.id, coalesce(d.description, '') as description from predictions p left join (
        select prediction_id, string_agg(system_id, '+' order by system_id) as description
        from predictions_systems join systems on sid = system_id group by prediction_id) d on d.prediction_id = p.id""",
)
def attach_description(t):
    return jobs.attach_description(t.predictions, t.predictions_systems, t.systems).select("id", "description")


_BAD = "(forecast_type is null or train_horizons_minutes = 'not json')"


@query(
    "job_records",
    f"""select id, name, forecast_type,
    case when train_horizons_minutes <> '' then replace(replace(replace(train_horizons_minutes, '[', ''), ']', ''), ' ', '')
    end as horizons from predictions where not coalesce({_BAD}, false)""",
)
def job_records(t):
    found = jobs.job_records(t.predictions.withColumnRenamed("forecast_type", "typ"))
    texts = F.transform("train_horizons_minutes", lambda h: h.cast("string"))
    return found.select("id", "name", "forecast_type", F.array_join(texts, ",").alias("horizons"))


@query("rejected_jobs", f"select id, name, train_horizons_minutes from predictions where {_BAD}")
def rejected_jobs(t):
    return jobs.rejected_jobs(t.predictions).select("id", "name", "train_horizons_minutes")


@query(
    "pids_for_api_keys",
    """select distinct apiKey, p.id from customersApiKeys k join customers c on k.cid = c.id
    join customers_predictions cp on cp.customer_id = c.id join predictions p on p.id = cp.prediction_id""",
)
def pids_for_api_keys(t):
    return jobs.pids_for_api_keys(t.customersApiKeys, t.customers, t.customers_predictions, t.predictions)


@query(
    "eans_for_pids",
    """select s.id, coalesce(string_agg(ean, ',' order by ean), '') as eans
    from (select distinct prediction_id as id from predictions_systems) s left join predictions p on p.id = s.id
    group by s.id""",
)
def eans_for_pids(t):
    asked = t.predictions_systems.select(F.col("prediction_id").alias("id"))
    return jobs.eans_for_pids(asked, t.predictions).select("id", F.array_join("eans", ",").alias("eans"))


@query(
    "api_keys_for_systems",
    """select distinct p.system as sid, coalesce(k.apiKey, '') as apiKey from power p
    left join systems s on s.sid = p.system left join systemsApiKeys k on k.id = s.measurements_customer_api_key_id""",
)
def api_keys_for_systems(t):
    return jobs.api_keys_for_systems(t.power.select(F.col("system").alias("sid")), t.systems, t.systemsApiKeys)


@query(
    "distinct_api_keys",
    """select distinct coalesce(k.apiKey, '') as apiKey from systems s
    left join systemsApiKeys k on k.id = s.measurements_customer_api_key_id""",
)
def distinct_api_keys(t):
    return jobs.distinct_api_keys(t.systems.select("sid"), t.systems, t.systemsApiKeys)


@query(
    "power_curves",
    """select pid, turbine_type, cut_in, kind, cast(rated_power as double) as rated_power,
    cast(slope_center as double) as slope_center, cast(steepness as double) as steepness
    from windspecs left join genericpowercurves on name = turbine_type""",
)
def power_curves(t):
    found = jobs.power_curves(t.windspecs, t.genericpowercurves)
    return found.select("pid", "turbine_type", "cut_in", "kind", "rated_power", "slope_center", "steepness")
