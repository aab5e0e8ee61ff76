"""Load from meter readings: per system, per job, with signs and factors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numeric import one_if_zero
from gridloom.operators.grids import bucket_mean, fill_gaps
from gridloom.operators.joins import fan_out_join
from gridloom.operators.reshape import pivot_values


def system_means(readings: DataFrame, minutes: int) -> DataFrame:
    """First stage of every load: mean output per system and bucket.

    This is where raw readings collapse: partial means leave the map side, so a system
    with a third of all readings still ships one row per bucket and task.
    """
    return bucket_mean(readings, ["system"], ["output"], minutes).where(F.col("output").isNotNull())


def load_by_systems(
    readings: DataFrame,
    minutes: int,
    average_output: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Sum over systems of their bucket means, with the number of systems.

    Two stages on purpose: a system that reports more often must not weigh more.
    ``keys`` are columns of ``readings`` that split the result, such as a site.
    """
    means = bucket_mean(readings, [*keys, "system"], ["output"], minutes)
    totals = means.groupBy(*keys, "datetime").agg(
        F.sum("output").alias("load"), F.count("output").alias("nEntries")
    )
    totals = totals.where(F.col("load").isNotNull())
    if average_output:
        totals = totals.withColumn("load", F.col("load") / F.col("nEntries"))
    return totals


def load_per_system(readings: DataFrame, minutes: int, span: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Mean per system on its own grid; empty buckets inside are null."""
    return fill_gaps(bucket_mean(readings, ["system"], ["output"], minutes), ["system"], ["output"], minutes, limit=0, span=span)


def load_per_system_wide(
    readings: DataFrame, systems: Sequence[str], minutes: int, keys: Sequence[str] = ()
) -> DataFrame:
    """One column per listed system. For a short list; the long form has no such bound."""
    means = bucket_mean(readings.where(F.col("system").isin(*systems)), [*keys, "system"], ["output"], minutes)
    return pivot_values(means, [*keys, "datetime"], "system", {s: s for s in systems}, "output")


def systems_by_job(systems: DataFrame, job_systems: DataFrame) -> DataFrame:
    """All columns of the systems of every job, with the job's factor."""
    return job_systems.join(systems, job_systems.system_id == systems.sid, "inner")


def _weight(polarity: bool, factor: bool, zero_factor_is_one: bool) -> Column:
    weight = F.lit(1.0)
    if polarity:
        weight = weight * one_if_zero(F.col("polarity"))
    if factor:
        weight = weight * (one_if_zero(F.col("factor")) if zero_factor_is_one else F.col("factor").cast("double"))
    return weight


def job_weights(
    systems: DataFrame, job_systems: DataFrame, ignore_factor: bool = False, zero_factor_is_one: bool = True
) -> DataFrame:
    """(pid, system, weight): the sign and factor with which a system counts in a job."""
    return systems_by_job(systems, job_systems).select(
        F.col("prediction_id").alias("pid"),
        F.col("system_id").alias("system"),
        _weight(True, not ignore_factor, zero_factor_is_one).alias("weight"),
    )


def weighted_job_load(
    readings: DataFrame,
    systems: DataFrame,
    job_systems: DataFrame,
    minutes: int,
    ignore_factor: bool = False,
) -> DataFrame:
    """Net load of every job: bucket means times weight, summed over its systems.

    Systems are reduced to bucket means before they meet the jobs, so the join handles
    one row per system and bucket however many readings there were; a system that most
    jobs use is spread over tasks. A factor of 0 counts as 1; with ``ignore_factor`` only
    the polarity is applied.
    """
    weights = job_weights(systems, job_systems, ignore_factor=ignore_factor)
    return (
        fan_out_join(system_means(readings, minutes), weights, ["system"], by=["datetime"])
        .groupBy("pid", "datetime")
        .agg(F.sum(F.col("output") * F.col("weight")).alias("load"), F.count("output").alias("nEntries"))
    )


def job_load_per_system(
    readings: DataFrame,
    systems: DataFrame,
    job_systems: DataFrame,
    minutes: int,
    ignore_factor: bool = False,
) -> DataFrame:
    """Load per job and system. Polarity 0 counts as 1 here, but a factor of 0 stays 0."""
    weights = job_weights(systems, job_systems, ignore_factor=ignore_factor, zero_factor_is_one=False)
    return (
        fan_out_join(system_means(readings, minutes), weights, ["system"], by=["datetime"])
        .select("pid", "system", "datetime", (F.col("output") * F.col("weight")).alias("load"))
    )


def missing_systems(readings: DataFrame, job_systems: DataFrame) -> DataFrame:
    """Systems of a job that have no reading; they do not stop the job."""
    seen = readings.where(F.col("output").isNotNull()).select(F.col("system").alias("system_id")).distinct()
    return job_systems.select(F.col("prediction_id").alias("pid"), "system_id").join(seen, "system_id", "left_anti")


def system_count(readings: DataFrame, keys: Sequence[str] = ("type",)) -> DataFrame:
    """Number of systems in a batch."""
    return readings.groupBy(*keys).agg(F.count_distinct("system").alias("systems"))
