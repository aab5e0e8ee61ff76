"""Readings as a stream: ingest with corrections, and load buckets kept up to date."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridloom.functions import timeops
from gridloom.operators.grids import bucket_mean
from gridloom.operators.quality import RejectedBatch
from gridloom.session import SETTINGS, apply_settings
from gridloom.sources.sinks import append_series, upsert_last_write_wins
from gridloom.sources.tables import read_series

READING_SCHEMA = "time timestamp, system string, type string, output double, created bigint"
TAGS = ["system", "type"]


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: str = READING_SCHEMA,
    files_per_batch: int | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Files of readings as they arrive in a folder.

    ``state_partitions`` sets the number of state stores of an aggregation over this
    stream, which stays as it is for the life of its checkpoint.
    """
    if state_partitions:
        spark = apply_settings(spark.newSession())
        spark.conf.set("spark.sql.shuffle.partitions", state_partitions)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    rejects: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch, kept while it is used, and its number to ``handle``.

    A batch is read several times; without keeping it, each time would run its plan,
    state included, again. A batch that the checks refuse is written whole below ``rejects``, with
    the reason, in a folder of its own number, and the stream goes on; a replay writes it again.
    The query ends with the data there is, or looks for more ``every`` so often until it is stopped.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                handle(batch, number)
        except RejectedBatch as refused:
            if rejects is None:
                raise
            reason = F.lit(str(refused)).alias("reason")
            batch.select("*", reason).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def stream_realised(readings: DataFrame, path: str, checkpoint: str, rejects: str | None = None) -> StreamingQuery:
    """Upsert every micro-batch; each is checked whole before it is written.

    Late and corrected points are welcome, so there is no watermark and no removal of
    repeated keys: the upsert makes replays harmless, as ``created`` comes with the data.
    Refused micro-batches go to ``rejects``, by default beside the table's files.
    """
    return _start(
        readings, lambda batch, _: append_series(batch, path, TAGS), checkpoint, rejects=rejects or f"{path}/_rejected"
    )


def stream_bucket_means(readings: DataFrame, minutes: int, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Mean per system and bucket of an append-only feed, updated as points arrive.

    State is one row per system and open bucket. Points later than ``delay`` are lost (the query's
    progress counts them as rows dropped by the watermark), and a corrected point would count
    twice: ``stream_corrected_buckets`` loses none and is the one to use unless a feed is known to
    be in order.
    """
    means = (
        readings.withWatermark("time", delay)
        .groupBy(F.window("time", f"{minutes} minutes"), "system")
        .agg(F.avg("output").alias("output"), F.count("output").alias("points"))
        .select(F.col("window.start").alias("time"), "system", "output", "points")
    )

    return _start(means, lambda batch, _: upsert_last_write_wins(batch, path, ["system"]), checkpoint, "update")


OUTCOME = "kind string, system string, type string, time timestamp, output double, created bigint, reason string"
# What a state holds: points as text (system, type, second, output, created), and whether it is closed.
STATE = "points string, closed boolean"
# A state has the points of one day and of one of so many shares of the systems. A state for each
# system and bucket would have few points, and each costs milliseconds.
SYSTEM_SHARES = 1024


def bucket_points(minutes: int, keep_ms: int | None) -> Callable:
    """Keep the points of the buckets of a day, so that a correction replaces the old value in the mean.

    Of a point the value created last counts, of those the one that came last, of one batch the
    largest. With ``keep_ms``, the points go so long after the state was last touched, and a
    mark stays: what comes later is passed on as of closed buckets.
    """
    width = minutes * 60

    def update(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.update(("[]", True))
            return
        # Plain lists: most groups are small, and a frame's own operations would take longer than the work.
        rows: dict[str, list] = {}
        for frame in frames:
            for name in _ROW:
                rows.setdefault(name, []).extend(frame[name].tolist())
        refused = [reason is not None for reason in rows["reason"]]
        out = [["refused" if bad else "point" for bad in refused], *(rows[c] for c in _CARRIED)]
        newest = _newest(rows, refused)
        if newest:
            points, closed = state.get if state.exists else ("[]", False)
            # The values of each bucket that was touched.
            touched: dict[tuple, list] = {(system, at - at % width): [] for system, _, at in newest}
            if not closed:
                held = {(system, kind, at): (output, created) for system, kind, at, output, created in json.loads(points)}
                for place, (created, output) in newest.items():
                    if place not in held or created >= held[place][1]:
                        held[place] = output, created
                state.update((json.dumps([[*place, *value] for place, value in held.items()]), False))
                if keep_ms is not None:
                    state.setTimeoutDuration(keep_ms)
                for (system, _, at), (output, _) in held.items():
                    if (system, at - at % width) in touched:
                        touched[system, at - at % width].append(output)
            starts = {(s, int(at) - int(at) % width): b for bad, s, at, b in zip(refused, rows["system"], rows["second"], rows["bucket"], strict=True) if not bad}
            for (system, start), values in touched.items():
                mean = math.nan if closed else math.fsum(values) / len(values)
                told = "closed" if closed else "mean", system, None, starts[system, start], mean, None, None
                for column, value in zip(out, told, strict=True):
                    column.append(value)
        yield pd.DataFrame(dict(zip(_OUTCOMES, out, strict=True)))

    return update


_OUTCOMES = [part.split()[0] for part in OUTCOME.split(", ")]
_CARRIED = _OUTCOMES[1:]
_ROW = [*_CARRIED, "second", "bucket"]


def _newest(rows: dict[str, list], refused: list[bool]) -> dict[tuple, tuple]:
    """For each point (system, type, second) of a batch when its newest value was created, and that value."""
    newest: dict[tuple, tuple] = {}
    columns = (rows[c] for c in ("system", "type", "second", "created", "output"))
    for bad, system, kind, at, created, output in zip(refused, *columns, strict=True):
        if not bad:
            value, place = (int(created), output), (system, kind, int(at))
            newest[place] = max(newest.get(place, value), value)
    return newest


def _reason() -> Column:
    """Why a reading cannot count; null where it can."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("time", "system", "type", "output", "created")]
    wild = F.when(F.isnan("output") | (F.abs("output") == float("inf")), F.lit("output"))
    named = F.array_compact(F.array(*missing, wild))
    return F.when(F.size(named) > 0, F.concat(F.lit("missing or infinite: "), F.array_join(named, ", ")))


def stream_corrected_buckets(
    readings: DataFrame,
    minutes: int,
    table: str | None,
    buckets: str,
    checkpoint: str,
    rejects: str | None = None,
    keep: timedelta | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Mean per (system, bucket), kept right under late and corrected points; readings go to ``table``.

    The points of a bucket are state (``bucket_points``), kept with those of its day and share of the
    systems: a corrected point replaces its old value, and no stored reading is read again. Readings with missing or infinite values are set aside
    below ``rejects``, with the reason, and the others of their batch count. Everything written is
    an upsert, so a replayed micro-batch changes nothing. Without ``table`` the readings themselves
    are not stored.

    State grows with the points. With ``keep``, a state's points are dropped so long after it was
    last touched; a later point makes a mean be taken from ``table`` once more, so none is lost.
    Timers run as long as the query does, so such a one looks for data ``every`` so often.
    """
    if keep is not None and (table is None or every is None):
        raise ValueError("buckets can only be closed where the readings are stored and the query goes on")
    rejects = rejects or f"{table or buckets}/_rejected"
    spark = readings.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SETTINGS["spark.sql.streaming.stateStore.providerClass"])
    keyed = readings.select(
        F.col("time").cast("timestamp").alias("time"),
        F.col("system").cast("string").alias("system"),
        F.col("type").cast("string").alias("type"),
        F.col("output").cast("double").alias("output"),
        F.col("created").cast("bigint").alias("created"),
    ).withColumns({"second": F.unix_seconds("time"), "reason": _reason()})
    keyed = keyed.withColumn("bucket", timeops.bucket(F.col("time"), minutes)).withColumns(
        {"share": F.pmod(F.xxhash64("system"), F.lit(SYSTEM_SHARES)), "day": F.to_date("bucket")}
    )
    outcomes = keyed.groupBy("share", "day").applyInPandasWithState(
        bucket_points(minutes, None if keep is None else int(keep.total_seconds() * 1000)), OUTCOME, STATE, "update",
        GroupStateTimeout.NoTimeout if keep is None else GroupStateTimeout.ProcessingTimeTimeout,
    )

    def write(batch: DataFrame, number: int) -> None:
        points = batch.where("kind = 'point'").select("time", *TAGS, "output", "created")
        if table is not None and not points.isEmpty():
            append_series(points, table, TAGS)
        means = batch.where("kind = 'mean'").select("time", "system", "output")
        closed = batch.where("kind = 'closed'").select("system", F.col("time").alias("__bucket"))
        if not closed.isEmpty():
            means = means.unionByName(_stored_means(closed, table, minutes))
        upsert_last_write_wins(means, buckets, ["system"])
        refused = batch.where("kind = 'refused'")
        if not refused.isEmpty():
            refused.drop("kind").write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    return _start(outcomes, write, checkpoint, "update", every=every)


def _stored_means(touched: DataFrame, table: str, minutes: int) -> DataFrame:
    """Means of some buckets from the stored readings, of which only their days are read."""
    ends = touched.agg(F.min("__bucket"), F.max(timeops.shift(F.col("__bucket"), minutes))).first()
    days = [r["day"] for r in touched.select(F.to_date("__bucket").alias("day")).distinct().collect()]
    days += [d + timedelta(days=1) for d in days]  # a bucket may reach into the next one
    stored = read_series(touched.sparkSession, table, ends[0], ends[1]).where(F.col("date").isin(*set(days)))
    stored = stored.withColumn("__bucket", timeops.bucket(F.col("time"), minutes))
    means = bucket_mean(stored.join(touched, ["system", "__bucket"], "left_semi"), ["system"], ["output"], minutes)
    return means.select(F.col("datetime").alias("time"), "system", "output")
