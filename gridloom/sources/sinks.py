"""Writing: upserts into partitioned Parquet, table modes, absent rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.quality import guard_values
from gridloom.sources import snapshots
from gridloom.sources.snapshots import PARTITIONS
from gridloom.sources.tables import FIELD_CREATED

# Parts of a day, by hash of the tags: a corrected point rewrites one of them. The setting counts
# when a table is first written, and stays with it; large tables want more.
BUCKETS_SETTING, BUCKETS = "spark.gridloom.buckets", 4
# Row groups are small, so that a scan for one series of a partition reads few rows besides.
ROW_GROUP_BYTES = 16 << 20
# Of the filter on a tag of a row group, which takes all of it: enough for some 10,000 values.
BLOOM_BYTES = 16 << 10
# The folder of rows without a time.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path holds Parquet files; a folder without any does not count."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def _check_tags(tags: Sequence[str]) -> list[str]:
    if not isinstance(tags, list):
        raise ValueError("tag columns must be a list")
    if not tags:
        raise ValueError("at least one tag column is needed")
    return tags


def _bucket(tags: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(t).cast("string") for t in sorted(tags)]), F.lit(buckets)).cast("int")


def _placed(batch: DataFrame, tags: Sequence[str], time: str, buckets: int) -> DataFrame:
    """Times cut to seconds, as they are stored, and the partition of each row."""
    cut = F.date_trunc("second", time)
    return batch.withColumn(time, cut).withColumn("date", F.to_date(time)).withColumn("bucket", _bucket(tags, buckets))


def _merged(rows: DataFrame, keys: Sequence[str], by_created: bool) -> DataFrame:
    """One row per key; each field has its newest value, and ``__created`` when that was created.

    ``__table`` marks what the table holds already: there each field has its own moment, in a new
    batch all fields of a row share one. Without ``created`` in the batch the batch is newer.
    """
    hidden = {FIELD_CREATED, "__table", "created", *keys}
    fields = [c for c in rows.columns if c not in hidden]
    cells, moments = [], []
    for c in fields:
        moment = F.col("created")
        if FIELD_CREATED in rows.columns:
            moment = F.when(F.col("__table"), F.col(FIELD_CREATED)[c]).otherwise(moment)
        order = [moment] if by_created else []
        position = F.when(F.col(c).isNotNull(), F.struct(*order, ~F.col("__table"), F.col(c)))
        cells.append(F.max_by(c, position).alias(c))
        moments.append(F.max_by(F.struct(F.lit(c).alias("key"), moment.alias("value")), position))
    created = F.map_from_entries(F.filter(F.array(*moments), lambda m: m["value"].isNotNull()))
    return rows.groupBy(*keys).agg(*cells, created.alias(FIELD_CREATED), F.max("created").alias("created"))


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(BUCKETS_SETTING, str(BUCKETS)))


def upsert_last_write_wins(
    batch: DataFrame, path: str, tags: list[str], time: str = "time", touched: Sequence | None = None
) -> None:
    """Merge a batch into the table at ``path``; key = tags + time to the second, newest non-null field wins.

    Newest is by ``created`` where the batch carries it, then the batch over the table. Each field
    keeps the moment its value was created, so that the order in which batches arrive does not
    count; ``created`` of a row is that of its newest batch. The table has a partition per day and
    hash bucket of the tags. Only those the batch touches are read, and written anew beside the old
    ones; one new version then puts them in their place (``snapshots``). A writer that dies leaves
    the old table. Of two writers that touch one partition, the later gets ``WriteConflict`` and
    may try again; writers of different partitions do not disturb each other. Writing the same
    batch again changes nothing. A folder with data but without versions is refused.

    Rows of a partition are in the order of tags and time, and the file tells which tags a row
    group holds, so that a scan for one of many series reads few of them.
    """
    spark = batch.sparkSession
    keys = [*_check_tags(tags), time]
    held = snapshots.begin(spark, path, _buckets(spark))
    placed = _placed(batch, tags, time, held.buckets)
    by_created = "created" in batch.columns
    rows = placed.withColumn("__table", F.lit(False))
    if not by_created:
        rows = rows.withColumn("created", F.lit(None).cast("bigint"))
    if touched is None:
        # At most one row per day of the batch and bucket.
        touched = [tuple(r) for r in placed.select("date", "bucket").distinct().collect()]
    partitions = [(NO_DAY if day is None else str(day), bucket) for day, bucket in touched]
    if not partitions:
        return
    if any(p in held.folders for p in partitions):
        stored = snapshots.read(spark, path, held, partitions)
        if "created" not in stored.columns:
            stored = stored.withColumn("created", F.lit(None).cast("bigint"))
        rows = stored.withColumn("__table", F.lit(True)).unionByName(rows, allowMissingColumns=True)
    merged = _merged(rows, [*keys, *PARTITIONS], by_created)
    if not by_created and "created" not in held.schema.names:
        merged = merged.drop("created", FIELD_CREATED)
    snapshots.with_columns(held.schema, merged.schema)  # refuses a type that changed before anything is written
    write = f"w{uuid.uuid4().hex}"
    # Rows of a partition go together, so that tasks do not open a file for each; a partition too
    # large for one task is split again at run time.
    writer = merged.hint("rebalance", *[F.col(c) for c in PARTITIONS]).sortWithinPartitions(*PARTITIONS, *sorted(tags), time).write
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.bloom.filter.max.bytes", BLOOM_BYTES)
    for tag in tags:
        writer = writer.option(f"parquet.bloom.filter.enabled#{tag}", "true")
    writer.partitionBy(*PARTITIONS).parquet(f"{path}/{snapshots.WRITE}={write}")
    snapshots.commit(spark, path, held, merged.schema, write, partitions)


def check_batch(batch: DataFrame, path: str, tags: Sequence[str], time: str = "time") -> tuple[int, list]:
    """Number of rows and the (date, bucket) partitions of a batch; refuses missing or infinite values."""
    held = snapshots.load(batch.sparkSession, path)
    buckets = held.buckets if held else _buckets(batch.sparkSession)
    place = F.struct(F.to_date(F.date_trunc("second", time)).alias("date"), _bucket(tags, buckets).alias("bucket"))
    row = guard_values(batch, [F.collect_set(place).alias("__touched")])
    return row["rows"], [tuple(r) for r in row["__touched"]]


def append_series(batch: DataFrame, path: str, tags: list[str], time: str = "time") -> int:
    """Check the whole batch, then upsert it; returns the number of rows given.

    A batch with a missing or infinite value is refused before anything is written.
    """
    _check_tags(tags)
    rows, touched = check_batch(batch, path, tags, time)
    if rows:
        upsert_last_write_wins(batch, path, tags, time, touched)
    return rows


def write_table(df: DataFrame, path: str, if_exists: str = "fail") -> None:
    """Write a whole table: refuse (default), replace or append where it exists."""
    modes = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
    if if_exists not in modes:
        raise ValueError(f"if_exists must be one of {sorted(modes)}")
    df.write.mode(modes[if_exists]).parquet(path)


def absent_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key ``old`` lacks, one per key."""
    rest = [c for c in new.columns if c != key]
    one = new.groupBy(key).agg(*[F.min(c).alias(c) for c in rest]) if rest else new.distinct()
    return one.join(old.select(key), key, "left_anti")


def insert_if_absent(new: DataFrame, path: str, key: str) -> None:
    """Append rows for keys the table does not hold yet."""
    spark = new.sparkSession
    if table_exists(spark, path):
        new = absent_rows(new, spark.read.parquet(path), key)
    else:
        new = absent_rows(new, spark.createDataFrame([], T.StructType([new.schema[key]])), key)
    new.write.mode("append").parquet(path)


def append_locations(names: DataFrame, path: str) -> None:
    """Add resolved places (``regionInput, lat, lon``) to the gazetteer."""
    insert_if_absent(names, path, "regionInput")


def union_results(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Stack answers of the same form, with the given columns."""
    result = frames[0].select(*columns)
    for frame in frames[1:]:
        result = result.unionByName(frame.select(*columns))
    return result


def write_documents(documents: DataFrame, path: str) -> None:
    """Export documents as text, one per line, in one folder per day; other days stay as they are."""
    (
        documents.select("date", "document")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .text(path)
    )
