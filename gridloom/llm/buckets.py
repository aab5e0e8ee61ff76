"""Compare the members of buckets pair by pair, in blocks of bounded size, and join what links."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import shared_table

# Members of a larger bucket are dealt over chunks of about this many; chunks meet two at a time.
CHUNK = 512

LOG = logging.getLogger(__name__)


def dealt_blocks(members: DataFrame, member: str, chunk: int = CHUNK) -> DataFrame:
    """Members of buckets in blocks: each two of a bucket meet in exactly one block, in one task each.

    ``members`` has bucket, its size n and the column ``member``. A bucket of up to ``chunk`` members
    is one block. A larger one is dealt by hash over chunks, and a block is a pair of chunks (a, b),
    a <= b; for a < b only members of different chunks are to be compared. ``chunk_of`` says where
    a member belongs.
    """
    chunks = F.greatest(F.ceil(F.col("n") / chunk).cast("int"), F.lit(1))
    return (
        members.withColumn("chunks", chunks)
        .withColumn("chunk_of", F.pmod(F.xxhash64(F.lit(5), F.col(member)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("a", F.least("chunk_of", "other"))
        .withColumn("b", F.greatest("chunk_of", "other"))
        .drop("chunks", "other", "n")
    )


def together(blocks: DataFrame) -> DataFrame:
    """Rows of a block in one partition, next to each other, sorted by block."""
    return blocks.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")


def whole_blocks(batches: Iterator[pa.RecordBatch], least: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole blocks, of ``least`` rows or more where there are, and where each block starts."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        starts = block_starts(table)
        if starts[-1]:
            yield table.slice(0, int(starts[-1])), starts[:-1]
        table = table.slice(int(starts[-1])).combine_chunks()
        held, rows = table.to_batches(), 0
    if held:
        table = pa.Table.from_batches(held)
        yield table, block_starts(table)


def block_starts(table: pa.Table) -> np.ndarray:
    keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "a", "b")])
    return np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))


def block_pairs(starts: np.ndarray, rows: int, a: np.ndarray, b: np.ndarray, chunk_of: np.ndarray, most: int = 400_000):
    """Pairs of row numbers to be compared, in arrays of bounded size; blocks of one size together."""
    sizes = np.diff(np.append(starts, rows))
    for size in np.unique(sizes[sizes > 1]):
        left, right = np.triu_indices(size, 1)
        own = starts[sizes == size]
        step = max(1, most // len(left))
        for begin in range(0, len(own), step):
            i = (own[begin : begin + step, None] + left).ravel()
            j = (own[begin : begin + step, None] + right).ravel()
            meet = (a[i] == b[i]) | (chunk_of[i] != chunk_of[j])
            yield i[meet], j[meet]


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the smallest id that links reach from it, by repeated minima."""
    root = ids.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        if (after == root).all():
            break
        root = after
    return root


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hooked to the smallest node beside it, or to itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("at")).agg(F.least(F.first("u"), F.min("v")).alias("least"))
    hooked = both.join(least, both["u"] == least["at"]).where("v > u")
    return hooked.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hooked to the smallest of them."""
    least = edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("least"))
    hooked = edges.join(least, edges["u"] == least["at"]).where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hooked.unionByName(least.select(F.col("at").alias("u"), F.col("least").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node that has none itself."""
    roles = edges.select(F.col("u").alias("node"), "v").unionByName(
        edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v"))
    )
    found = roles.groupBy("node").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count_if(F.col("v").isNull()).alias("above"))
    return found.where("least <> most or (least is not null and above > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node that the edges (u, v) reach; nodes of no edge are left out.

    Large stars and small stars in turn, until all edges lead from a node to the smallest of its
    component: the number of rounds grows with the logarithm of a component's nodes, also where it
    is one long chain, and there is no limit to it. The edges are written to the shared folder
    after each half round, so that lineage stays short. Minima of a node with many edges are
    reduced before the shuffle, and its rows in joins are split while they run.
    """
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    held = shared_table(edges.where("u <> v").select(larger.alias("u"), smaller.alias("v")).distinct(), "edges")
    rounds = 0
    while not _are_stars(held):
        held = shared_table(_large_star(held), "large_star")
        held = shared_table(_small_star(held), "small_star")
        rounds += 1
    LOG.info("components settled after %d rounds", rounds)
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        held.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
