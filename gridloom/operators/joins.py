"""Joins whose keys may be very unequal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Members of a key for each of its shares, and shares of a key at most: so many tasks it occupies,
# and so often are its members repeated.
PER_SHARE, MOST_SHARES = 16, 1024
# Keys that can be hot in one join: as many are sent to all tasks at most. A sketch of TRACKED
# counters per task finds them.
HOT_KEYS, TRACKED = 1000, 10_000


def hot_keys(members: DataFrame, keys: Sequence[str], per_share: int = PER_SHARE) -> DataFrame:
    """``__key`` (a hash) and ``__shares`` of the keys with more than ``per_share`` members, the hottest ones.

    Counted by a sketch whose partial results are merged; it never says less than there are.
    """
    top = members.agg(
        F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(HOT_KEYS), F.lit(TRACKED)).alias("top")
    )
    shares = F.least(F.ceil(F.col("count") / F.lit(per_share)), F.lit(MOST_SHARES)).cast("int")
    return top.select(F.inline("top")).where(F.col("count") > per_share).select(F.col("item").alias("__key"), shares.alias("__shares"))


def _with_rows(hot: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The hot keys that some row has, none with more shares than rows."""
    told = rows.select(F.xxhash64(*keys).alias("__key")).join(F.broadcast(hot), "__key")
    counted = told.groupBy("__key").agg(F.first("__shares").alias("__shares"), F.count(F.lit(1)).alias("__rows"))
    return counted.select("__key", F.least("__shares", "__rows").cast("int").alias("__shares"))


def fan_out_join(
    series: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    per_share: int = PER_SHARE,
    count_rows: bool = False,
) -> DataFrame:
    """Inner join of rows with all members of their key, where one key may have most of either.

    The output of a key with many members is large although its input may be small, which no skew
    handling by input size notices. So the rows of such a key are dealt by a hash of ``by`` over
    shares in proportion to its members, and those are repeated for each share. All other keys
    have one share and no copies; where one of them has most of the rows, its partition is split
    by size while the join runs. Which keys are hot is measured on the members, the short side.
    Where they may be the long side, ``count_rows`` counts the rows of hot keys too (``series`` is
    read once more for it): a key with few rows has as few shares, so that its members are copied
    no more often than they are joined.
    """
    hot = hot_keys(members, keys, per_share)
    hot = F.broadcast(_with_rows(hot, series, keys) if count_rows else hot)
    shares = F.coalesce("__shares", F.lit(1))

    def beside(rows: DataFrame, share: Column) -> DataFrame:
        told = rows.withColumn("__key", F.xxhash64(*keys)).join(hot, "__key", "left")
        return told.withColumn("__share", share).drop("__key", "__shares")

    dealt = beside(series, F.pmod(F.xxhash64(*by), shares).cast("int"))
    copied = beside(members, F.explode(F.sequence(F.lit(0), shares - 1)))
    return dealt.join(copied, [*keys, "__share"]).drop("__share")
