"""Number expressions: missing values, blending of labels, wind profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.constants import KPI_INFINITY, WIND_SHEAR_EXPONENT


def known(value: Column) -> Column:
    """NaN as NULL: Spark's averages and counts must see one kind of missing."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def is_infinite(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))


def kpi_value(value: Column) -> Column:
    """Infinite values become +-9999.9 and missing ones 0."""
    number = value.cast("double")
    bounded = F.when(number == F.lit(float("inf")), F.lit(KPI_INFINITY)).when(
        number == F.lit(float("-inf")), F.lit(-KPI_INFINITY)
    )
    return F.coalesce(bounded, known(number), F.lit(0.0))


def one_if_zero(value: Column) -> Column:
    """Polarity and factor 0 mean "not set" and count as 1."""
    return F.when(value == 0, F.lit(1).cast("double")).otherwise(value.cast("double"))


def quantile_label(quantile: Column) -> Column:
    """``quantile_P05`` for 0.05; halves go to the even neighbour."""
    percent = F.bround(quantile * F.lit(100.0), 0).cast("int").cast("string")
    return F.concat(F.lit("quantile_P"), F.when(F.length(percent) < 2, F.lpad(percent, 2, "0")).otherwise(percent))


def wind_at_height(speed: Column, from_height: Column | float = 10.0, hub_height: Column | float = 100.0) -> Column:
    """Wind speed at hub height by the power law; a negative speed stops the job."""
    lower = F.lit(from_height) if isinstance(from_height, (int, float)) else from_height
    upper = F.lit(hub_height) if isinstance(hub_height, (int, float)) else hub_height
    scaled = speed * F.pow(upper / lower, F.lit(WIND_SHEAR_EXPONENT))
    failure = F.raise_error(F.lit("wind speed must not be negative")).cast("double")
    return F.when(speed < 0, failure).otherwise(scaled)
