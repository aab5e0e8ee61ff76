"""Long and wide forms, alignment on time, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numeric import known


def pivot_fields(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    field: str = "field",
    value: str = "value",
    agg: str = "mean",
    first_by: Sequence[str] = (),
) -> DataFrame:
    """One column per field; equal keys are averaged, or the first is taken.

    ``first`` needs the columns that define the order. Rows with a null key or without
    any value are left out. One conditional aggregate: the pivot costs one shuffle.
    """
    if agg == "mean":
        cells = [F.avg(F.when(F.col(field) == f, known(F.col(value)))).alias(f) for f in fields]
    elif agg == "first" and first_by:
        order = F.struct(*first_by)
        present = F.col(value).isNotNull()
        cells = [F.min_by(value, F.when((F.col(field) == f) & present, order)).alias(f) for f in fields]
    else:
        raise ValueError("agg must be 'mean', or 'first' with the columns that order the rows")
    wanted = df.where(F.col(field).isin(*fields)).dropna(how="any", subset=list(keys))
    return wanted.groupBy(*keys).agg(*cells).dropna(how="all", subset=list(fields))


def pivot_values(
    df: DataFrame, keys: Sequence[str], column: str, names: Mapping[object, str], value: str
) -> DataFrame:
    """One column per listed value of ``column``, holding the mean of ``value``."""
    cells = [F.avg(F.when(F.col(column) == v, known(F.col(value)))).alias(name) for v, name in names.items()]
    return df.where(F.col(column).isin(*names)).groupBy(*keys).agg(*cells)


def rename_order(df: DataFrame, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Rename, then keep the given columns in order; columns that are absent are skipped."""
    renamed = df.withColumnsRenamed(dict(renames))
    return renamed.select(*[c for c in columns if c in renamed.columns])


def align_outer(frames: Sequence[DataFrame], keys: Sequence[str] = ("datetime",)) -> DataFrame:
    """Full outer join of all frames on the keys."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.join(frame, list(keys), "full_outer")
    return result


def is_finite(column: str, dtype: str) -> Column:
    present = F.col(column).isNotNull()
    if dtype in ("double", "float"):
        return present & ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))
    return present


def finite_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in which every value is present and finite."""
    types = dict(df.dtypes)
    for c in columns or df.columns:
        df = df.where(is_finite(c, types[c]))
    return df


def align_inner(frames: Sequence[DataFrame], keys: Sequence[str] = ("datetime",)) -> DataFrame:
    """Rows whose keys occur in every frame with only finite values.

    Stated as inner joins of filtered frames: an outer join with a later drop of nulls
    would have to keep and shuffle the unmatched rows.
    """
    result = finite_rows(frames[0])
    for frame in frames[1:]:
        result = result.join(finite_rows(frame), list(keys))
    return result


def dedupe_time(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order.

    A minimum over structs combines before the shuffle, unlike a row number.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*ordered)).alias("__row"))
        .select(*keys, *[F.col("__row")[c].alias(c) for c in rest])
    )
