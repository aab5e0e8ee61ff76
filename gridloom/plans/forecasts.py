"""Reading stored load forecasts, for all jobs at once."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import ESTIMATE_TYPES, FORECAST_FIELDS, FORECAST_HORIZONS
from gridloom.functions.numeric import quantile_label
from gridloom.functions.timeops import floor_value
from gridloom.operators.grids import bucket_any, bucket_mean
from gridloom.operators.reshape import pivot_fields
from gridloom.sources.tables import scan_series

SERIES = ["pid", "type", "customer"]


def exclude_types(df: DataFrame, types: Sequence[str] = tuple(ESTIMATE_TYPES)) -> DataFrame:
    """Drop estimate series; a series without a type stays."""
    return df.where(F.col("type").isNull() | ~F.col("type").isin(*types))


def predicted_load(
    predictions: DataFrame, start: datetime, end: datetime, minutes: int, end_given: bool = True
) -> DataFrame:
    """Forecast and deviation per job and bucket.

    A given end is included: one quarter is added and the sum floored to the grid.
    Buckets are averaged per series first, then over the series of a job, so a series
    with more points does not weigh more.
    """
    stop = floor_value(end + timedelta(minutes=15) if end_given else end, minutes)
    fields = ["forecast", "stdev"]
    points = exclude_types(scan_series(predictions, start, stop))
    return _mean_of_series(points, fields, minutes)


def _mean_of_series(points: DataFrame, fields: Sequence[str], minutes: int) -> DataFrame:
    series = bucket_mean(points, SERIES, fields, minutes)
    return (
        series.groupBy("pid", "datetime")
        .agg(*[F.avg(f).alias(f) for f in fields])
        .where(bucket_any(fields))
    )


def forecast_quality(predictions: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Quality text per job and time: that of the first series by type and customer."""
    points = scan_series(predictions, start, end).select(
        "pid", F.col("time").alias("datetime"), "type", "customer", F.lit("quality").alias("field"), "quality"
    )
    return pivot_fields(
        points, ["pid", "datetime"], ["quality"], value="quality", agg="first", first_by=["type", "customer", "quality"]
    )


def prediction_components(
    predictions: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int,
    quantiles: Sequence[float] = (),
    job_quantiles: DataFrame | None = None,
) -> DataFrame:
    """Forecast, its components and the asked quantiles per job and bucket, estimates included.

    With ``job_quantiles`` (``id, quantiles``) a job only shows the quantiles of its own list.
    """
    labels = [f"quantile_P{q * 100:02.0f}" for q in quantiles]
    fields = [*FORECAST_FIELDS, *labels]
    result = _mean_of_series(scan_series(predictions, start, end), fields, minutes)
    if labels and job_quantiles is not None:
        own = job_quantiles.select(F.col("id").alias("pid"), F.transform("quantiles", quantile_label).alias("__own"))
        result = result.join(own, "pid", "left")
        listed = {c: F.when(F.array_contains("__own", c), F.col(c)) for c in labels}
        result = result.withColumns(listed).drop("__own").where(bucket_any(fields))
    return result


def parse_horizons(t_ahead: str | Sequence[str] | None) -> list[float]:
    """``"4h"`` or a list of such texts as hours; ``None`` means every kept horizon."""
    if t_ahead is None:
        return list(FORECAST_HORIZONS)
    items = [t_ahead] if isinstance(t_ahead, str) else list(t_ahead)
    if not all(isinstance(i, str) for i in items):
        raise ValueError("horizons must be texts such as '4h'")
    return [float(re.sub("h", "", i, flags=re.IGNORECASE)) for i in items]


def predicted_load_tahead(
    predictions: DataFrame,
    start: datetime,
    end: datetime,
    minutes: int,
    t_ahead: str | Sequence[str] | None = None,
    component: bool = False,
) -> DataFrame:
    """One column per field and horizon, as ``forecast_4.0h``, per job and bucket."""
    horizons = parse_horizons(t_ahead)
    fields = ["forecast_solar" if component else "forecast", "stdev"]
    points = exclude_types(scan_series(predictions, start, end).where(F.col("tAhead").isin(*horizons)))
    series = bucket_mean(points, [*SERIES, "tAhead"], fields, minutes)
    # The mean over series and the pivot are one aggregate. Its rows are wide and most jobs and buckets
    # have few series, so that aggregating them before they are dealt would only fill memory. The
    # number of parts is given: the bytes that are dealt say little of what the wide rows take.
    parts = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    series = series.repartition(parts, "pid", "datetime")
    names = {(f, h): f"{f}_{h}h" for f in fields for h in horizons}
    cells = [F.avg(F.when(F.col("tAhead") == h, F.col(f))).alias(name) for (f, h), name in names.items()]
    result = series.groupBy("pid", "datetime").agg(*cells)
    return result.where(bucket_any([f"`{name}`" for name in names.values()]))
