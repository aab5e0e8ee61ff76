"""Find near copies of embeddings: a subspace pigeonhole join at a cosine threshold."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.buckets import components
from gridloom.llm.common import BATCH_ROWS, shared_table, table, uniform_hash

THRESHOLD = 0.95
# Blocks of dimensions; each has its share of the squared distance the threshold allows.
BLOCKS = 4
# Vectors of a chunk: so many chunks at least are aimed at, within these bounds and this many bytes.
CHUNKS, LEAST_CHUNK, MOST_CHUNK, CHUNK_BYTES = 24, 1024, 16_384, 8 << 20
# Cells per block: about one for so many vectors of a chunk, within these bounds.
VECTORS_PER_CELL = 128
LEAST_CELLS, MOST_CELLS = 16, 512
# Bound of the sample from which the cells' centers come, in vectors.
SAMPLE_VECTORS = 20_000
# Tasks in which chunks meet at most, about; chunks a worker remembers; distances and pairs in hand at once.
MOST_TASKS, REMEMBERED, DISTANCES, PAIRS = 10_000, 4, 4_000_000, 50_000
SLACK = 1e-6
# Distances are first taken in single precision, which may miss by less than this.
SCREEN = 1e-5


def rotated(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Random signs and a Walsh-Hadamard transform: lengths and distances stay.

    Made of additions row by row, so that a vector gives the same numbers in every batch.
    """
    x = np.zeros((len(vectors), len(signs)))
    x[:, : vectors.shape[1]] = vectors
    x *= signs
    step = 1
    while step < x.shape[1]:
        x = x.reshape(len(vectors), -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(vectors), -1)
        step *= 2
    return x / np.sqrt(len(signs))


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1) - 2 * x @ y.T, 0)


def centers(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 6) -> np.ndarray:
    """k-means, from random vectors of the sample."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = squared_distances(x, c).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


@dataclass
class Subspaces:
    """The rotation, the blocks of dimensions and the cells of each block."""

    threshold: float
    signs: np.ndarray
    cuts: list[tuple[int, int]]
    centers: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, threshold: float, blocks: int, cells: int, seed: int = 9):
        rng = np.random.default_rng(seed)
        width = 1 << max(0, int(np.ceil(np.log2(max(sample.shape[1], 1)))))
        signs = rng.choice([-1.0, 1.0], width)
        edges = [i * width // min(blocks, width) for i in range(min(blocks, width) + 1)]
        cuts = list(zip(edges[:-1], edges[1:], strict=True))
        x = rotated(unit(sample), signs)
        return cls(threshold, signs, cuts, [centers(x[:, a:b], cells, rng) for a, b in cuts])

    def budget(self, block: int) -> float:
        """Squared distance in a block that one of all blocks of a linked pair must keep within."""
        a, b = self.cuts[block]
        return (2 - 2 * self.threshold) * (b - a) / len(self.signs) + SLACK

    def cells(self, x: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Home cell of each rotated vector, and which cells it visits, its own among them.

        Of two vectors in different cells one is no farther from the plane between the cells than
        half their distance. So a vector visits each cell whose plane is within half the radius.
        """
        a, b = self.cuts[block]
        c = self.centers[block]
        d = squared_distances(x[:, a:b], c)
        home = d.argmin(axis=1)
        apart = np.sqrt(squared_distances(c, c))[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d - d[np.arange(len(x)), home][:, None]) / (2 * apart)
        reach = np.where(apart > 0, plane, 0) <= np.sqrt(self.budget(block)) / 2 + SLACK
        reach[np.arange(len(x)), home] = True
        return home, reach


def unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; the largest component is divided out first, so that no square leaves the range."""
    x = x.astype(np.float64)
    # In two steps, as the inverse of a tiny number has no place in the range either.
    _, power = np.frexp(np.abs(x).max(axis=1))
    x = np.ldexp(x, -power[:, None])
    return x / np.sqrt((x**2).sum(axis=1))[:, None]


def _padded(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of a column of lists, filled up with zeros."""
    whole = np.zeros((len(column), size))
    whole[np.arange(size) < column.value_lengths().to_numpy()[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return whole


CHUNK = "chunk long, class_id binary, copies binary, vectors binary, home binary, visits binary"


def _packed(space: Subspaces, number: int, ids: np.ndarray, copies: np.ndarray, whole: np.ndarray, kind: type) -> dict:
    """A chunk as one row: its vectors once, and the cells in which they live and which they visit."""
    home = np.zeros((len(space.cuts), len(ids)), np.int16)
    visits = [[] for _ in space.cuts]
    for begin in range(0, len(ids), 2048):
        x = rotated(unit(whole[begin : begin + 2048]), space.signs)
        for block, seen in enumerate(visits):
            home[block, begin : begin + 2048], reach = space.cells(x, block)
            seen.append(np.packbits(reach.T, axis=1))
    bits = b"".join(np.concatenate(seen, axis=1).tobytes() for seen in visits)
    return {
        "chunk": number, "class_id": ids.tobytes(), "copies": copies.tobytes(), "vectors": whole.astype(kind).tobytes(),
        "home": home.tobytes(), "visits": zlib.compress(bits, 1),
    }


def chunked(batches: Iterator[pa.RecordBatch], space: Subspaces, size: int, chunk: int, kind: type) -> Iterator[pa.RecordBatch]:
    """Classes of a partition packed by ``chunk``."""
    number, held, rows = TaskContext.get().partitionId() << 32, [], 0

    def sent(parts: list) -> pa.RecordBatch:
        row = _packed(space, number, *(np.concatenate(p) for p in zip(*parts, strict=True)), kind)
        return pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64() if k == "chunk" else pa.binary()) for k, v in row.items()})

    for batch in batches:
        begin = 0
        while begin < batch.num_rows:
            part = batch.slice(begin, chunk - rows)
            ids, copies = (part.column(c).to_numpy(zero_copy_only=False) for c in ("class_id", "copies"))
            held.append((ids, copies, _padded(part.column("vector"), size)))
            begin, rows = begin + part.num_rows, rows + part.num_rows
            if rows == chunk:
                yield sent(held)
                number, held, rows = number + 1, [], 0
    if held:
        yield sent(held)


class Chunk:
    """A chunk unpacked: unit vectors, rotated ones, and by block the vectors that live in a cell and its guests."""

    def __init__(self, space: Subspaces, row: dict, size: int, kind: type):
        self.space, self.number = space, row["chunk"]
        self.ids, self.copies = (np.frombuffer(row[c], np.int64) for c in ("class_id", "copies"))
        n, blocks = len(self.ids), len(space.cuts)
        self.unit = unit(np.frombuffer(row["vectors"], kind).reshape(n, size))
        self.home = np.frombuffer(row["home"], np.int16).reshape(blocks, n)
        # By block a row for each cell: which vectors live in it or visit it, in bits.
        bits, at, self.guests = np.frombuffer(zlib.decompress(row["visits"]), np.uint8), 0, []
        for c in space.centers:
            width = (n + 7) // 8
            self.guests.append(bits[at : at + len(c) * width].reshape(len(c), width))
            at += len(c) * width

    def rows_in(self, block: int, cell: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.guests[block][cell], count=len(self.ids)))

    def is_in(self, block: int, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether each row lives in the cell beside it or visits it."""
        return (self.guests[block][cells, rows >> 3] >> (7 - (rows & 7)).astype(np.uint8) & 1).astype(bool)

    @cached_property
    def turned(self) -> np.ndarray:
        return rotated(self.unit, self.space.signs)

    @cached_property
    def screens(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By block: rows in the order of their cells, where each cell starts, and what two sides multiply.

        The product of a host's and a guest's row is minus half their squared distance.
        """
        found = []
        for block, (a, b) in enumerate(self.space.cuts):
            part = self.turned[:, a:b]
            half, one = -(part**2).sum(axis=1, keepdims=True) / 2, np.ones((len(part), 1))
            order = np.argsort(self.home[block], kind="stable")
            starts = np.searchsorted(self.home[block][order], np.arange(len(self.space.centers[block]) + 1))
            host = np.concatenate([part, half, one], axis=1).astype(np.float32)[order]
            found.append((order, starts, host, np.concatenate([part, one, half], axis=1).astype(np.float32)))
        return found


def _meetings(host: Chunk, guest: Chunk, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (host, guest) that a block leaves, of cells where the host lives and which the guest visits."""
    order, starts, own, _ = host.screens[block]
    others, edge = guest.screens[block][3], -(host.space.budget(block) + SLACK) / 2 - SCREEN
    for cell in np.flatnonzero(np.diff(starts)):
        here = guest.rows_in(block, cell)
        if not len(here):
            continue
        theirs, step = others[here].T, max(1, DISTANCES // len(here))
        for begin in range(starts[cell], starts[cell + 1], step):
            end = min(begin + step, starts[cell + 1])
            close = np.flatnonzero(own[begin:end] @ theirs >= edge)
            if len(close):
                i, j = np.divmod(close, len(here))
                yield order[begin + i], here[j]


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same in arrays of about PAIRS."""
    held, rows = [], 0
    for pair in pairs:
        held.append(pair)
        rows += len(pair[0])
        if rows >= PAIRS:
            yield tuple(np.concatenate(p) for p in zip(*held, strict=True))
            held, rows = [], 0
    if held:
        yield tuple(np.concatenate(p) for p in zip(*held, strict=True))


def _once(one: Chunk, other: Chunk) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, rows of one, rows of other) that a block leaves, each pair of classes once in a block."""
    for block in range(len(one.space.cuts)):
        for i, j in _gathered(_meetings(one, other, block)):
            if one is other:
                # Where each visits the other's cell, the pair also comes the other way around.
                mirrored = other.is_in(block, i, one.home[block][j])
                keep = (i < j) | ((i > j) & ~mirrored)
                i, j = i[keep], j[keep]
            yield block, i, j
        if one is not other:
            for j, i in _gathered(_meetings(other, one, block)):
                new = ~other.is_in(block, j, one.home[block][i])
                yield block, i[new], j[new]


def _hooked(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots of a forest, each row under the smallest it reaches, after more links (i, j)."""
    while True:
        i, j = root[i], root[j]
        apart = i != j
        if not apart.any():
            return root
        i, j = i[apart], j[apart]
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while (root[root] != root).any():
            root = root[root]


def _linked(space: Subspaces, one: Chunk, other: Chunk) -> pa.RecordBatch:
    """Links that the classes of two chunks, or of one, have there."""
    shift = 0 if one is other else len(one.ids)
    ids = one.ids if one is other else np.concatenate([one.ids, other.ids])
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    sums, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for block, rows, others in _once(one, other):
        for begin in range(0, len(rows), PAIRS):
            i, j = rows[begin : begin + PAIRS], others[begin : begin + PAIRS]
            gap = (one.turned[i] - other.turned[j]) ** 2
            passed = np.stack([gap[:, p:q].sum(axis=1) <= space.budget(k) for k, (p, q) in enumerate(space.cuts)])
            mine = passed[block] & (passed.argmax(axis=0) == block)
            mine &= (one.unit[i] * other.unit[j]).sum(axis=1) >= space.threshold
            i, j = i[mine], j[mine]
            np.add.at(sums, i, other.copies[j])
            np.add.at(sums, j + shift, one.copies[i])
            root = _hooked(root, rank[i], rank[j + shift])
    hit = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[hit]), pa.array(sums[hit]), pa.array(ids[order[root[rank[hit]]]])], ["class_id", "near", "root"]
    )


def vector_key() -> Column:
    return F.xxhash64("vector")


def join_embeddings(
    embeddings: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, sample_vectors: int = SAMPLE_VECTORS
) -> DataFrame:
    """Links, component and survivor of each vector at a cosine of ``threshold`` or more, exactly.

    Equal vectors are one class; only classes are joined. Unit vectors are rotated and cut into
    blocks of dimensions. Of a pair within the squared distance that the threshold allows, at least
    one block keeps within its share (pigeonhole). So each block is range-joined alone: its space
    is dealt into cells around centers from a bounded sample, a vector lives in the nearest cell
    and visits those within reach, and pairs meet in a cell where one of them lives. What passes a
    block is verified with all dimensions in double precision.

    Classes are packed into chunks of bounded size, written once with the cells of their vectors. Each
    two chunks meet in one task that reads both: nothing is shuffled or copied for it, whatever the
    number of cells a vector visits. A pair counts in the first block it passes, in one cell, so that
    pairs are never rows: two chunks return the number of links of each vector and the smallest
    vector they reach.

    Vectors that are null, empty or zero, or hold null or non-finite components, and rows without
    vec_id, link with nothing. Shorter vectors count as filled up with zeros. Rows that repeat a
    vec_id count as copies where the vectors agree. Labels and other columns are ignored.

    Result: vec_id, n_links (other rows linked directly), component_id (smallest vec_id that links
    reach), kept (vec_id = component_id); one row per input row.
    """
    spark = embeddings.sparkSession
    single = isinstance(getattr(embeddings.schema["embedding"].dataType, "elementType", None), T.FloatType)
    values = F.col("embedding").cast("array<float>" if single else "array<double>")
    sound = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(values, lambda v: v != 0)
    )
    rows = embeddings.select(F.col("vec_id").cast("long"), values.alias("vector"), F.coalesce(sound, F.lit(False)).alias("sound"))
    classes = shared_table(
        rows.where("sound").groupBy("vector").agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    n, size = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    alone = rows.where("not sound").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not n:
        return alone
    sample = classes.where(uniform_hash("class_id", 41) < sample_vectors / n).select("vector").collect()
    sample = sample or classes.select("vector").limit(1).collect()
    chunk = int(np.clip(n // CHUNKS, LEAST_CHUNK, max(1, min(MOST_CHUNK, CHUNK_BYTES // (8 * size)))))
    cells = int(np.clip(chunk // VECTORS_PER_CELL, LEAST_CELLS, MOST_CELLS))
    padded = np.zeros((len(sample), size))
    for i, r in enumerate(sample):
        padded[i, : len(r["vector"])] = r["vector"]
    held = spark.sparkContext.broadcast(Subspaces.fit(padded, threshold, blocks, cells))
    kind = np.float32 if single else np.float64

    def deal(batches):
        yield from chunked(batches, held.value, size, chunk, kind)

    chunks = shared_table(classes.select("class_id", "copies", "vector").mapInArrow(deal, CHUNK), "chunks")

    def compare(batches):
        remembered: dict[int, Chunk] = {}

        def unpacked(batch: pa.RecordBatch, row: int, prefix: str) -> Chunk:
            number = batch.column(f"{prefix}chunk")[row].as_py()
            found = remembered.pop(number, None)
            if found is None:
                names = [c.split()[0] for c in CHUNK.split(", ")]
                found = Chunk(held.value, {c: batch.column(prefix + c)[row].as_py() for c in names}, size, kind)
                while len(remembered) >= REMEMBERED:
                    remembered.pop(next(iter(remembered)))
            remembered[number] = found
            return found

        for batch in batches:
            for row in range(batch.num_rows):
                yield _linked(held.value, unpacked(batch, row, "a_"), unpacked(batch, row, "b_"))

    one, other = (chunks.select(*[F.col(c).alias(prefix + c) for c in chunks.columns]) for prefix in ("a_", "b_"))
    parts = chunks.rdd.getNumPartitions()
    one = one.coalesce(max(1, min(parts, MOST_TASKS // parts)))
    # Of each two chunks one order, as often with either in front.
    odd = F.pmod(F.col("a_chunk") + F.col("b_chunk"), F.lit(2)) == 1
    met = one.hint("shuffle_replicate_nl").join(
        other, F.when(F.col("a_chunk") < F.col("b_chunk"), ~odd).when(F.col("a_chunk") > F.col("b_chunk"), odd).otherwise(True)
    )
    # Two chunks are some megabytes: they go to Python alone.
    batch_rows = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "1")
    try:
        found = shared_table(met.mapInArrow(compare, "class_id long, near long, root long"), "found")
    finally:
        spark.conf.set(BATCH_ROWS, batch_rows)
    joined = components(found.select(F.col("class_id").alias("u"), F.col("root").alias("v")))
    near = found.groupBy("class_id").agg(F.sum("near").alias("near"))
    # Rows find their class by a hash; by the vector itself where two classes share one.
    unlike = classes.groupBy(vector_key()).count().where("count > 1").isEmpty()
    key = vector_key() if unlike else F.col("vector")
    of_class = shared_table(
        classes.select("class_id", "copies", key.alias("of_key"))
        .join(near, "class_id", "left")
        .join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            "of_key",
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class_id").alias("component_id"),
        ),
        "of_class",
    )
    return (
        rows.where("sound")
        .select("vec_id", key.alias("key"))
        .join(of_class, F.col("key") == F.col("of_key"))
        .select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
        .unionByName(alone)
    )


def embedding_query(spark, sf_dir) -> DataFrame:
    return join_embeddings(table(spark, sf_dir, "embeddings"))
