"""Scans: series by time range and tags, tables by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.timeops import as_utc
from gridloom.sources import snapshots

# Of each field of a stored point, when its value was created.
FIELD_CREATED = "__created"


def read_series(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    version: int | None = None,
) -> DataFrame:
    """A measurement the library wrote, with all fields any batch brought, and its ``date`` partition.

    The newest version counts, or the one asked for. Columns and folders are those the version
    names, so that no file is opened to learn them; with a range, only its days are listed.
    """
    held = snapshots.load(spark, path, version)
    if held is None:
        raise ValueError(f"no stored series at {path}")
    first = "" if start is None else as_utc(start).date().isoformat()
    last = "9999-12-31" if end is None else as_utc(end).date().isoformat()
    days = None if start is None and end is None else [p for p in held.folders if first <= p[0] <= last]
    rows = snapshots.read(spark, path, held, days).drop("bucket", FIELD_CREATED)
    return rows if start is None and end is None else scan_series(rows, start, end)


def scan_series(
    df: DataFrame, start: datetime | None = None, end: datetime | None = None, **tags: Sequence | object
) -> DataFrame:
    """Rows with ``start <= time < end`` and each tag equal to, or in, the given values.

    Where the table is partitioned by ``date`` the range is stated on it as well, so that
    the scan skips whole partitions; the rest is pushed to the Parquet reader.
    """
    dated = "date" in df.columns
    if start is not None:
        df = df.where(F.col("time") >= F.lit(as_utc(start)))
        df = df.where(F.col("date") >= F.lit(as_utc(start).date())) if dated else df
    if end is not None:
        df = df.where(F.col("time") < F.lit(as_utc(end)))
        df = df.where(F.col("date") <= F.lit(as_utc(end).date())) if dated else df
    for name, wanted in tags.items():
        df = filter_tags(df, name, wanted)
    return df


def filter_tags(df: DataFrame, tag: str, wanted: object) -> DataFrame:
    """``tag in (values)``; a single value counts as a list of one, a DataFrame as a long list."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(F.col(wanted.columns[0]).alias(tag)), tag, "left_semi")
    if isinstance(wanted, str) or not isinstance(wanted, Sequence):
        wanted = [wanted]
    return df.where(F.col(tag).isin(*wanted))


def scan_table(spark: SparkSession, query: str, args: Mapping[str, object], **views: DataFrame) -> DataFrame:
    """A metadata query with named parameters; tables are given as ``{name}`` in the text."""
    return spark.sql(query, args=dict(args), **views)
