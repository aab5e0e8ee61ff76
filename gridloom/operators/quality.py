"""Checks and casts in front of every write."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.constants import QUANTILE_PATTERN
from gridloom.functions import numeric, timeops


class RejectedBatch(ValueError):
    """The batch was refused; nothing of it was written."""


def _missing(column: str, dtype: str) -> Column:
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if dtype in ("double", "float") else missing


def _profile(df: DataFrame) -> list[Column]:
    checks = [F.count(F.lit(1)).alias("rows")]
    checks += [F.count_if(_missing(c, t)).alias(f"missing:{c}") for c, t in df.dtypes]
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return checks + [F.count_if(numeric.is_infinite(F.col(c))).alias(f"infinite:{c}") for c in floats]


def batch_profile(df: DataFrame) -> DataFrame:
    """One row: how many values of each column are missing, and how many infinite."""
    return df.agg(*_profile(df))


def guard_values(df: DataFrame, extra: Sequence[Column] = ()) -> dict:
    """Refuse the batch, naming the columns, if any value is missing or infinite.

    The one action of the library's checks: a single pass that returns one row.
    ``extra`` aggregates ride along and come back with the row count.
    """
    row = df.agg(*_profile(df), *extra).first().asDict()
    for kind in ("missing", "infinite"):
        bad = [name.split(":", 1)[1] for name in row if name.startswith(f"{kind}:") and row[name]]
        if bad:
            raise RejectedBatch(f"batch holds {kind} values in columns: {bad}")
    return row


def strict_cast(df: DataFrame, types: Mapping[str, str], quantiles: bool = False) -> DataFrame:
    """Cast every column to its declared type. A column without one refuses the batch.

    Values that do not fit stop the job when the batch is read (ANSI casts).
    """
    wanted = dict(types)
    if quantiles:
        wanted.update({c: "double" for c in df.columns if re.match(QUANTILE_PATTERN, c)})
    unknown = [c for c in df.columns if c not in wanted]
    if unknown:
        raise RejectedBatch(f"columns without a declared type: {unknown}")
    return df.select(*[F.col(c).cast(wanted[c]).alias(c) for c in df.columns])


def fill_quality(df: DataFrame, default: str = "actual") -> DataFrame:
    """A missing quality column or value means ``actual``."""
    value = F.coalesce(F.col("quality"), F.lit(default)) if "quality" in df.columns else F.lit(default)
    return df.withColumn("quality", value)


def tag_constants(df: DataFrame, **values: object) -> DataFrame:
    """Add constant columns such as source, created, type, system."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def _clean_kpis(kpis: DataFrame) -> DataFrame:
    return (
        kpis.withColumn("tAhead", F.replace(F.col("horizon"), F.lit("h"), F.lit("")).cast("double"))
        .withColumn("value", numeric.kpi_value(F.col("value")))
        .withColumn("pid", F.col("pid").cast("int"))
        .drop("horizon")
    )


def kpi_rows(kpis: DataFrame, jobs: DataFrame) -> DataFrame:
    """KPIs in long form (``pid, horizon, date, kpi, value``) cleaned, with the job's texts.

    ``horizon`` is a text as ``47.0h``. Infinite values become +-9999.9, missing ones 0.

    The texts are looked up by hash, so that KPIs keep the order they come in. Sorted by job, long
    texts would come in runs, after which Parquet's writer gathers more of the next job's than it can hold.
    """
    rows = _clean_kpis(kpis)
    texts = jobs.select(F.col("id").alias("pid"), "description", F.col("name").alias("customer"))
    return rows.join(texts.hint("shuffle_hash"), "pid", "left")


def kpi_wide(kpis: DataFrame, jobs: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per job, horizon and date with a column per KPI; an absent KPI is 0.

    The texts, whose length has no bound, meet the rows that are left, not every KPI.
    """
    cells = [F.coalesce(F.max(F.when(F.col("kpi") == n, F.col("value"))), F.lit(0.0)).alias(n) for n in names]
    wide = _clean_kpis(kpis).groupBy("pid", "tAhead", "date").agg(*cells)
    texts = jobs.select(F.col("id").alias("pid"), "description", F.col("name").alias("customer")).distinct()
    return wide.join(texts, "pid", "left").select("pid", "tAhead", "description", "customer", "date", *[F.col(f"`{n}`") for n in names])


def well_formed_measurements(df: DataFrame, column: str = "datetime") -> DataFrame:
    """Measurements whose time text reads as ``2019-10-16T20:00:00`` with ``+0200``, ``+02:00`` or ``Z``."""
    return df.where(_measurement_time(column).isNotNull())


def malformed_measurements(df: DataFrame, column: str = "datetime") -> DataFrame:
    return df.where(_measurement_time(column).isNull())


def _measurement_time(column: str) -> Column:
    # XXX reads +02:00 and Z, Z reads +0200.
    forms = [F.lit(f"yyyy-MM-dd'T'HH:mm:ss{zone}") for zone in ("Z", "XXX")]
    return F.coalesce(*[F.try_to_timestamp(F.col(column), form) for form in forms])


def measurement_documents(readings: DataFrame, zone: str = "CET") -> DataFrame:
    """Export documents ``{"sid", "data": [{"datetime", "output"}]}``, one per system and UTC day.

    Readings of one system in one second become one, the largest, before they are gathered, so a
    document has at most a day's seconds; a document per system alone would have no bound.
    """
    readings = readings.groupBy("system", F.date_trunc("second", "time").alias("time")).agg(F.max("output").alias("output"))
    item = F.struct(F.col("time"), timeops.offset_text(F.col("time"), zone).alias("datetime"), F.col("output"))
    documents = readings.groupBy(F.col("system").alias("sid"), F.to_date("time").alias("date")).agg(
        F.array_sort(F.collect_list(item)).alias("__items")
    )
    data = F.transform("__items", lambda i: F.struct(i["datetime"].alias("datetime"), i["output"].alias("output")))
    return documents.select("sid", "date", F.to_json(F.struct("sid", data.alias("data"))).alias("document"))
