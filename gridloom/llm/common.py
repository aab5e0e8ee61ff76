"""What several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import shared_folder

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below the cluster's shared folder and read it back: lineage ends there."""
    path = f"{shared_folder(frame.sparkSession)}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# Rows of an Arrow batch where whole texts go to Python, and the setting that bounds them.
TEXTS_PER_BATCH, BATCH_ROWS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the texts that the JVM and a Python worker hold at once: by default 10,000 rows whatever their length."""
    rows = int(spark.conf.get(BATCH_ROWS))
    if rows <= 0 or rows > TEXTS_PER_BATCH:
        spark.conf.set(BATCH_ROWS, str(TEXTS_PER_BATCH))


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


class FieldOfBits:
    """Tells of longs that most of them are not in a set: a bit for the hash of each member."""

    def __init__(self, held, bits: int):
        self.held, self.bits = held, bits

    def __call__(self, values: pa.Array) -> np.ndarray:
        """False for nulls and most values beside the set, true for all of its members."""
        known = values.is_valid().to_numpy(zero_copy_only=False)
        own = _bit_of(values.fill_null(0), self.bits)
        return known & ((self.held.value[own >> 6] >> (own & 63)) & 1).astype(bool)


def _bit_of(values: pa.Array, bits: int) -> np.ndarray:
    hashed = values.cast(pa.int64()).to_numpy(zero_copy_only=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (hashed >> np.uint64(64 - bits)).astype(np.int64)


def maybe_in(frame: DataFrame, column: str, bits: int = 26) -> FieldOfBits:
    """A field of bits of a column of longs, for use in tasks.

    Its size is fixed (8 MB for 26 bits) and it goes to all tasks. However many values there are,
    it only ever lets more through: an exact join follows.
    """

    def slots(batches):
        for batch in batches:
            own = _bit_of(batch.column(0), bits)
            masks = np.left_shift(np.int64(1), own & 63)
            yield pa.RecordBatch.from_arrays([pa.array(own >> 6), pa.array(masks)], ["word", "mask"])

    rows = frame.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(slots, "word long, mask long")
    found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    field = np.zeros(1 << (bits - 6), np.int64)
    field[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return FieldOfBits(frame.sparkSession.sparkContext.broadcast(field), bits)


def text_pieces(texts: list, most: int = 1_000_000):
    """Slices (from, to) of a list of texts of about ``most`` characters; a longer text stands alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "") + 1
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def uniform_hash(column: str, seed: int) -> Column:
    """A number from 0 to 1 that depends on the value and the seed."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(column)), 11)
    return bits.cast("double") / float(1 << 53)


def label_sample(frame: DataFrame, label: str, per_label: int, longest: int, seed: int = 11) -> list:
    """About ``per_label`` rows of each label with whole texts of at most ``longest`` characters.

    The rows are chosen by a hash of their id, so reruns choose the same; sorted by id. The driver
    receives no more than this sample.
    """
    usable = frame.where(F.col(label).isNotNull() & F.col("text").isNotNull() & (F.length("text") <= longest))
    counts = {r[label]: r["count"] for r in usable.groupBy(label).count().collect()}
    if not counts:
        return []
    share = F.coalesce(
        *[F.when(F.col(label) == value, F.lit(per_label / n)) for value, n in counts.items()], F.lit(0.0)
    )
    rows = usable.where(uniform_hash("doc_id", seed) < share).select("doc_id", "text", label).collect()
    return sorted(rows, key=lambda r: (str(r["doc_id"]), r["text"]))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, per_label: int, longest: int, modulus: int, held_out: int
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """Texts with their label, about ``per_label`` of each value, and how many there are of each.

    Only rows whose crc32 of the id modulo ``modulus`` is not ``held_out``. Labels of an id that
    differ between repeated rows count once each. The sample is chosen from the labels alone, so
    that its join with the documents sends ids of bounded number; texts longer than ``longest``
    characters are left out.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(id_remainder("doc_id", modulus) != held_out)
        .distinct()
    )
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    if not counts:
        return [], {}
    share = F.coalesce(*[F.when(F.col("label") == v, F.lit(per_label / n)) for v, n in counts.items()])
    chosen = usable.where(uniform_hash("doc_id", 23) < share)
    rows = (
        docs.where(F.length("text") <= longest)
        .select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .distinct()
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["label"]))
    return [(r["text"], r["label"]) for r in rows], counts


def score_texts(docs: DataFrame, scorer) -> DataFrame:
    """doc_id and ``scorer(list of texts) -> scores`` of every row; null texts count as empty.

    ``scorer`` goes to the executors as a broadcast; its size is bounded by its training sample.
    """
    held = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in text_pieces(texts):
                scores = pa.array(held.value(texts[start:end]), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[start:end], scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
