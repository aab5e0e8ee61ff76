"""Reading stored forecasts."""

from __future__ import annotations

from datetime import datetime

from gridloom.catalog.registry import query, r6, rounded, sql_means
from gridloom.constants import FORECAST_FIELDS
from gridloom.operators import jobs
from gridloom.plans import forecasts

START, END = datetime(1995, 1, 1), datetime(2002, 1, 1)
_KEYS = ["pid", "type", "customer"]
_KEPT = "(type is null or type not in ('est_demand', 'est_wind', 'est_pv'))"


def _series_means(source: str, fields, minutes: int, where: str = "true", keys=tuple(_KEYS)) -> str:
    return sql_means(source, list(keys), fields, minutes, where=where)


def _mean(fields) -> str:
    return ", ".join(f"{r6(f'avg({f})')} as {f}" for f in fields)


@query("exclude_types", f"select pid, type, customer, time, forecast from prediction where {_KEPT}")
def exclude_types(t):
    return forecasts.exclude_types(t.prediction).select("pid", "type", "customer", "time", "forecast")


@query(
    "predicted_load",
    f"""select pid, datetime, {_mean(['forecast', 'stdev'])}
    from {_series_means('prediction', ['forecast', 'stdev'], 1440, _KEPT)} group by pid, datetime""",
)
def predicted_load(t):
    return rounded(forecasts.predicted_load(t.prediction, START, END, 1440), "forecast", "stdev")


@query(
    "forecast_quality",
    """select pid, time as datetime, quality from (
    select *, row_number() over (partition by pid, time
        order by type nulls first, customer nulls first, quality) as rn
    from prediction where quality is not null) where rn = 1""",
)
def forecast_quality(t):
    return forecasts.forecast_quality(t.prediction, START, END)


_LABELS = ["quantile_P10", "quantile_P50", "quantile_P90"]
_ALL = [*FORECAST_FIELDS, *_LABELS]
_OWN = "(select distinct prediction_id, unnest(cast(quantiles as json)::double[]) as q from predictions_quantile_sets join quantile_sets on id = quantile_set_id)"


def _listed(label: str, value: float) -> str:
    return f"case when exists (select 1 from {_OWN} o where o.prediction_id = pid and o.q = {value}) then {label} end as {label}"


@query(
    "prediction_components",
    f"""select pid, datetime, {_mean(FORECAST_FIELDS)}
    from {_series_means('prediction', FORECAST_FIELDS, 1440)} group by pid, datetime""",
)
def prediction_components(t):
    return rounded(forecasts.prediction_components(t.prediction, START, END, 1440), *FORECAST_FIELDS)


@query(
    "prediction_components_quantiles",
    f"""select pid, datetime, {', '.join(FORECAST_FIELDS)}, {_listed(_LABELS[0], 0.1)}, {_listed(_LABELS[1], 0.5)},
    {_listed(_LABELS[2], 0.9)} from (select pid, datetime, {_mean(_ALL)}
    from {_series_means('prediction', _ALL, 1440)} group by pid, datetime)""",
)
def prediction_components_quantiles(t):
    own = jobs.attach_quantiles(t.predictions.select("id"), t.predictions_quantile_sets, t.quantile_sets)
    found = forecasts.prediction_components(t.prediction, START, END, 1440, [0.1, 0.5, 0.9], own)
    return rounded(found, *_ALL)


def _tahead_sql(field: str, horizons) -> str:
    means = _series_means("prediction_tAheads", [field, "stdev"], 1440, _KEPT, [*_KEYS, "tAhead"])
    names = {(f, h): f'"{f}_{h}h"' for f in (field, "stdev") for h in horizons}
    cells = ", ".join(
        f"{r6(f'avg(case when tAhead = {h} then {f} end)')} as {name}" for (f, h), name in names.items()
    )
    return f"select pid, datetime, {cells} from {means} where tAhead in {tuple(horizons)} group by pid, datetime"


def _rounded_all(df):
    names = df.columns
    plain = df.toDF(*[c.replace(".", "_") for c in names])
    return rounded(plain, *plain.columns[2:]).toDF(*names)


@query("predicted_load_tahead", _tahead_sql("forecast", [4.0, 47.0]))
def predicted_load_tahead(t):
    return _rounded_all(forecasts.predicted_load_tahead(t.prediction_tAheads, START, END, 1440, ["4h", "47H"]))


@query(
    "predicted_load_tahead_component",
    _tahead_sql("forecast_solar", [0.0, 1.0, 4.0, 8.0, 15.0, 24.0, 39.0, 47.0, 50.0, 144.0]),
)
def predicted_load_tahead_component(t):
    return _rounded_all(forecasts.predicted_load_tahead(t.prediction_tAheads, START, END, 1440, component=True))

