"""Prediction jobs and the metadata joined to them, for all jobs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JOB_COLUMNS = [
    "id",
    "ean",
    "name",
    "forecast_type",
    "model",
    "horizon_minutes",
    "train_horizons_minutes",
    "resolution_minutes",
    "train_components",
]
REQUIRED = ["id", "name", "forecast_type", "model", "horizon_minutes", "resolution_minutes"]


def _as_list(value, kinds: tuple[type, ...], what: str) -> list:
    values = value if isinstance(value, list) else [value]
    if not all(isinstance(v, kinds) and not isinstance(v, bool) for v in values):
        raise ValueError(f"{what} must be one of {[k.__name__ for k in kinds]}, or a list of them")
    return values


def filter_jobs(
    jobs: DataFrame,
    pid: int | str | list | None = None,
    model_type: str | list[str] | None = None,
    is_active: int | None = None,
    only_ato: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Jobs by id, model, activity (any number but 0 is active) and name; limited in id order."""
    if pid is not None:
        jobs = jobs.where(F.col("id").isin(*[int(p) for p in _as_list(pid, (int, str), "pid")]))
    if model_type is not None:
        jobs = jobs.where(F.col("model").isin(*_as_list(model_type, (str,), "model_type")))
    if is_active is not None:
        jobs = jobs.where(F.col("active") == int(is_active != 0))
    if only_ato:
        jobs = jobs.where(F.col("name").startswith("ATO") & ~F.col("name").contains("HS"))
    return jobs.orderBy("id").limit(limit) if limit else jobs


def with_system_position(jobs: DataFrame, job_systems: DataFrame, systems: DataFrame) -> DataFrame:
    """Jobs with the smallest latitude, longitude and id of their systems.

    The systems are reduced to one row per job before the join, so that job columns
    need no grouping.
    """
    position = (
        job_systems.select(F.col("prediction_id").alias("id"), F.col("system_id").alias("sid"))
        .join(systems.select("sid", "lat", "lon"), "sid")
        .groupBy("id")
        .agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.min("sid").alias("sid"))
    )
    return jobs.join(position, "id", "left")


def prediction_jobs(jobs: DataFrame, job_systems: DataFrame, systems: DataFrame) -> DataFrame:
    located = with_system_position(jobs.select(*JOB_COLUMNS), job_systems, systems)
    return located.select(*JOB_COLUMNS, "lat", "lon")


def require_jobs(jobs: DataFrame, pid: int) -> DataFrame:
    """One job by id; an unknown id is an error."""
    found = filter_jobs(jobs, pid=pid)
    if found.isEmpty():
        raise ValueError(f"no prediction job with id {pid}")
    return found


def _typed_jobs(jobs: DataFrame, forecast_type: str) -> DataFrame:
    columns = ["id", "forecast_type", "model", "horizon_minutes", "resolution_minutes", "name"]
    return jobs.where((F.col("forecast_type") == forecast_type) & (F.col("active") == 1)).select(*columns)


def _one_spec(specs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One specification per job; the smallest where several were stored."""
    chosen = specs.groupBy(F.col("pid").alias("id")).agg(F.min(F.struct(*columns)).alias("__spec"))
    return chosen.select("id", *[F.col("__spec")[c].alias(c) for c in columns])


def wind_jobs(jobs: DataFrame, job_systems: DataFrame, systems: DataFrame, windspecs: DataFrame) -> DataFrame:
    """Active wind jobs with the turbine's position and build."""
    columns = ["lat", "lon", "turbine_type", "n_turbines", "hub_height"]
    located = with_system_position(_typed_jobs(jobs, "wind"), job_systems, systems).drop("lat", "lon")
    return located.join(_one_spec(windspecs, columns), "id", "left")


def solar_jobs(jobs: DataFrame, job_systems: DataFrame, systems: DataFrame, solarspecs: DataFrame) -> DataFrame:
    """Active solar jobs; ``lat``/``lon`` are the specification's, the systems' minimum is kept beside."""
    columns = ["lat", "lon", "radius", "peak_power"]
    located = with_system_position(_typed_jobs(jobs, "solar"), job_systems, systems)
    located = located.withColumnsRenamed({"lat": "system_lat", "lon": "system_lon"})
    return located.join(_one_spec(solarspecs, columns), "id", "left")


def attach_quantiles(jobs: DataFrame, job_sets: DataFrame, quantile_sets: DataFrame) -> DataFrame:
    """All quantiles of a job's sets in one sorted list, duplicates kept; empty without a set."""
    parsed = quantile_sets.select(
        F.col("id").alias("quantile_set_id"), F.from_json("quantiles", T.ArrayType(T.DoubleType())).alias("q")
    )
    lists = (
        job_sets.join(parsed, "quantile_set_id")
        .groupBy(F.col("prediction_id").alias("id"))
        .agg(F.array_sort(F.flatten(F.collect_list("q"))).alias("quantiles"))
    )
    empty = F.array().cast("array<double>")
    return jobs.join(lists, "id", "left").withColumn("quantiles", F.coalesce("quantiles", empty))


def attach_description(jobs: DataFrame, job_systems: DataFrame, systems: DataFrame) -> DataFrame:
    """System ids joined by ``+``, in id order; empty without systems."""
    known = job_systems.join(systems.select(F.col("sid").alias("system_id")), "system_id")
    text = known.groupBy(F.col("prediction_id").alias("id")).agg(
        F.array_join(F.array_sort(F.collect_list("system_id")), "+").alias("description")
    )
    return jobs.join(text, "id", "left").withColumn("description", F.coalesce("description", F.lit("")))


def _parsed_jobs(jobs: DataFrame) -> DataFrame:
    if "typ" in jobs.columns:
        jobs = jobs.withColumnRenamed("typ", "forecast_type")
    text = F.when(F.col("train_horizons_minutes") != "", F.col("train_horizons_minutes"))
    parsed = jobs.withColumn("__horizons", F.from_json(text, T.ArrayType(T.IntegerType())))
    readable: Column = text.isNull() | F.col("__horizons").isNotNull()
    complete = readable
    for c in REQUIRED:
        complete = complete & (F.col(c).isNotNull() if c in parsed.columns else F.lit(False))
    return parsed.withColumn("__ok", complete)


def job_records(jobs: DataFrame) -> DataFrame:
    """Valid jobs with the training horizons as a list."""
    valid = _parsed_jobs(jobs).where("__ok")
    return valid.withColumn("train_horizons_minutes", F.col("__horizons")).drop("__horizons", "__ok")


def rejected_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs that lack a required value or hold an unreadable list."""
    return _parsed_jobs(jobs).where(~F.col("__ok")).drop("__horizons", "__ok")


def pids_for_api_keys(keys: DataFrame, customers: DataFrame, customer_jobs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Distinct (api key, job) pairs. Links that lead nowhere yield no job."""
    owned = keys.select(F.col("cid").alias("customer_id"), "apiKey").join(
        customers.select(F.col("id").alias("customer_id")), "customer_id"
    )
    linked = owned.join(customer_jobs, "customer_id").select("apiKey", F.col("prediction_id").alias("id"))
    return linked.distinct().join(jobs.select("id"), "id", "left_semi")


def eans_for_pids(pids: DataFrame, jobs: DataFrame) -> DataFrame:
    """List of EANs per asked job id; empty where the job is unknown."""
    eans = jobs.where(F.col("ean").isNotNull()).groupBy("id").agg(F.array_sort(F.collect_list("ean")).alias("eans"))
    empty = F.array().cast("array<string>")
    return pids.select("id").distinct().join(eans, "id", "left").withColumn("eans", F.coalesce("eans", empty))


def api_keys_for_systems(sids: DataFrame, systems: DataFrame, system_keys: DataFrame) -> DataFrame:
    """API key per asked system; an empty text for an unknown system or key."""
    keys = systems.select("sid", F.col("measurements_customer_api_key_id").alias("id")).join(
        system_keys.select("id", "apiKey"), "id"
    )
    found = sids.select("sid").distinct().join(keys.select("sid", "apiKey"), "sid", "left")
    return found.withColumn("apiKey", F.coalesce("apiKey", F.lit(""))).distinct()


def distinct_api_keys(sids: DataFrame, systems: DataFrame, system_keys: DataFrame) -> DataFrame:
    return api_keys_for_systems(sids, systems, system_keys).select("apiKey").distinct()


def power_curves(jobs: DataFrame, curves: DataFrame) -> DataFrame:
    """The power curve of each job's turbine, its coefficients as numbers."""
    numbers = ["rated_power", "slope_center", "steepness"]
    typed = curves.withColumns({c: F.col(c).cast("double") for c in numbers}).withColumnRenamed("name", "turbine_type")
    return jobs.join(typed, "turbine_type", "left")
