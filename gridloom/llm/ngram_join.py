"""Find near copies of documents: a chosen-path join of their word shingles at a Jaccard threshold."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.buckets import block_pairs, components, dealt_blocks, local_roots, together, whole_blocks
from gridloom.llm.common import documents, maybe_in, shared_table, small_batches, text_pieces

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
# Tokens of a path before its bucket is looked at, and at most. Sets share a sampled token with
# the probability of their Jaccard similarity, so two keep apart sets that share but a passage.
FIRST, LEVELS = 2, 4
# A larger bucket is split on another sampled token, unless its sets stay together.
BUCKET = 512
# A bucket whose largest part keeps so much of it holds sets alike: it is compared as it is.
DENSE = 0.5
# Bytes of the sketch by which pairs are passed on to exact comparison, and how far its estimate
# may fall short: more than four deviations at the threshold.
SKETCH = 128
SHORT = 0.15

# Characters whose shingles a worker makes at once, and words whose hashes it remembers.
PIECE, WORDS = 250_000, 100_000

_WORD = re.compile(r"\w+")
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.random.default_rng(17).integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_words: dict[str, int] = {}


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """Runs until sets at the threshold have met with the probability asked for.

    A path split to the last level holds both with the threshold to the power of its tokens; one
    that ends before holds them more often.
    """
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**LEVELS))


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * _M1
    keys = (keys ^ (keys >> np.uint64(27))) * _M2
    return keys ^ (keys >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, one text after the other and sorted in each, and where each starts.

    Words are runs of letters, digits and underscores in lower case. A text of fewer words is one
    shingle of all of them; a text without words has none.
    """
    if len(_words) > WORDS:
        _words.clear()
    listed = [_WORD.findall((t or "").lower()) for t in texts]
    known = _words
    flat = np.empty(sum(map(len, listed)), np.uint64)
    at = 0
    for own in listed:
        for w in own:
            key = known.get(w)
            if key is None:
                key = known[w] = xxhash.xxh64_intdigest(w)
            flat[at] = key
            at += 1
    sizes = np.array([len(x) for x in listed], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(listed)), sizes)
    keys = np.zeros(len(flat), np.uint64)
    # A word beyond a text's end counts as nothing, which only texts that are short ever hash.
    for i in range(words):
        part = np.zeros(len(flat), np.uint64)
        rest = max(len(flat) - i, 0)  # a piece may hold fewer words in all
        part[:rest] = flat[i:]
        if i:
            inside = np.zeros(len(flat), bool)
            inside[:rest] = owner[i:] == owner[:rest]
            part[~inside] = 0
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + part
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    whole = place <= np.maximum(np.repeat(sizes, sizes) - words, 0)
    keys, owner = mixed(keys[whole]), owner[whole]
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]) if len(keys) else np.zeros(0, bool)
    keys, owner = keys[fresh], owner[fresh]
    return keys, np.searchsorted(owner, np.arange(len(listed) + 1))


def set_names(keys: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Two numbers that name each set: sums of two hashes of its shingles."""
    full = np.flatnonzero(np.diff(starts))
    name = [np.zeros(len(starts) - 1, np.uint64) for _ in range(2)]
    if len(full):
        first = starts[:-1][full]
        name[0][full] = np.add.reduceat(keys, first)
        name[1][full] = np.add.reduceat(mixed(keys + np.uint64(1)), first)
    return name


def signatures(keys: np.ndarray, starts: np.ndarray, runs: int):
    """Per set: name (two numbers), size, sketch, and its sampled tokens, by level and run.

    The token sampled in a run and level is the one with the smallest hash of that run and level.
    Sets share it with the probability of their Jaccard similarity. The sketch holds a byte of each
    of ``SKETCH`` smallest hashes, the sampled tokens' among them.
    """
    if runs * LEVELS > SKETCH:
        raise ValueError("the recall asked for needs more runs than the sketch has hashes")
    sizes = np.diff(starts)
    full = np.flatnonzero(sizes)
    first = starts[:-1][full]
    name = set_names(keys, starts)
    sketch = np.zeros((len(sizes), SKETCH), np.uint8)
    tokens = np.zeros((LEVELS, len(sizes), runs), np.uint64)
    if len(full):
        for i in range(SKETCH):
            least = np.minimum.reduceat(keys * _ODD[i], first)
            sketch[full, i] = (least >> np.uint64(13)).astype(np.uint8)
            if i < runs * LEVELS:
                tokens[i % LEVELS, full, i // LEVELS] = mixed(least)
    return name, sizes, sketch, tokens


def _first_paths(tokens: np.ndarray) -> np.ndarray:
    """A path per run from the tokens of the first levels; its last byte is the run."""
    path = np.zeros(tokens.shape[1:], np.uint64)
    for level in range(FIRST):
        path = mixed(path * np.uint64(3) + tokens[level])
    return (path & ~np.uint64(0xFF)) | np.arange(tokens.shape[2], dtype=np.uint64)


# The first paths of all runs, then the tokens of each further level.
TOKENS = ["paths_0", *[f"tokens_{i}" for i in range(FIRST, LEVELS)]]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def document_sets(docs: DataFrame, runs: int) -> DataFrame:
    """doc_id, name of its set, size, sketch and sampled tokens of each document."""

    def build(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in text_pieces(texts, PIECE):
                keys, starts = shingle_sets(texts[start:end])
                name, sizes, sketch, tokens = signatures(keys, starts, runs)
                columns = [_first_paths(tokens), *tokens[FIRST:]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[start:end],
                        pa.array(_signed(name[0])),
                        pa.array(_signed(name[1])),
                        pa.array(sizes),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                        *[pa.array(list(_signed(c)), pa.list_(pa.int64())) for c in columns],
                    ],
                    ["doc_id", "name_1", "name_2", "size", "sketch", *TOKENS],
                )

    tokens = ", ".join(f"{c} array<long>" for c in TOKENS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        build, f"doc_id long, name_1 long, name_2 long, size long, sketch binary, {tokens}"
    )


def chosen_paths(classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """class_key, bucket and n: members of the buckets at the ends of all paths, and their sizes.

    A bucket of more than ``bucket`` sets is split on the token its sets sampled in the next level
    of the run. Buckets of sets alike would not shrink, and those of the last level are not split:
    they are compared in blocks.
    """
    members = shared_table(classes.select("class_key", F.explode("paths_0").alias("bucket")), "paths")
    ends, end_sizes = [], []
    for level in range(FIRST, LEVELS + 1):
        sizes = shared_table(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"sizes_{level}")
        large = sizes.where(F.col("n") > bucket)
        if level == LEVELS or large.isEmpty():
            ends.append(members)
            end_sizes.append(sizes)
            break
        run = F.col("bucket").bitwiseAND(F.lit(0xFF))
        child = F.xxhash64("bucket", F.element_at(f"tokens_{level}", run.cast("int") + 1))
        child = child.bitwiseAND(F.lit(~0xFF)).bitwiseOR(run)
        children = shared_table(
            members.join(large, "bucket")
            .join(classes.select("class_key", f"tokens_{level}"), "class_key")
            .select("class_key", child.alias("child"), "bucket", "n"),
            f"paths_{level}",
        )
        parts = children.groupBy("bucket", "child").agg(F.count(F.lit(1)).alias("part"), F.first("n").alias("n"))
        dense = parts.groupBy("bucket").agg(F.max("part").alias("part"), F.first("n").alias("n"))
        dense = shared_table(dense.where(F.col("part") > DENSE * F.col("n")).select("bucket", "n"), f"dense_{level}")
        ends.append(members)
        end_sizes.append(shared_table(sizes.where(F.col("n") <= bucket).unionByName(dense), f"ends_{level}"))
        members = children.join(dense, "bucket", "left_anti").select("class_key", F.col("child").alias("bucket"))
    found = None
    for own, sizes in zip(ends, end_sizes, strict=True):
        part = own.join(sizes.select("bucket", "n").hint("merge"), "bucket")
        found = part if found is None else found.unionByName(part)
    return shared_table(found, "ends")


def _columns(table: pa.Table):
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
    paths = table.column("paths").combine_chunks()
    if isinstance(paths, pa.ChunkedArray):
        paths = paths.chunk(0)
    counts = np.diff(paths.offsets.to_numpy())
    wide = np.zeros((len(counts), max(counts.max(initial=0), 1)), np.int64)
    filled = np.arange(wide.shape[1]) < counts[:, None]
    wide[filled] = paths.values.to_numpy()[paths.offsets[0].as_py() : paths.offsets[-1].as_py()]
    return sketch, wide, filled


def owned_pairs(table: pa.Table, starts: np.ndarray, threshold: float):
    """Pairs of rows worth an exact comparison, each in one bucket of all in which the two meet.

    Sizes must allow the threshold, the sketch must not be far below it, and the bucket must be
    the smallest of those on the paths of both.
    """
    number = lambda c: table.column(c).to_numpy()
    size, bucket = number("size"), number("bucket")
    sketch, paths, filled = _columns(table)
    for i, j in block_pairs(starts, table.num_rows, number("a"), number("b"), number("chunk_of")):
        fits = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
        i, j = i[fits], j[fits]
        keep = []
        for begin in range(0, len(i), 65536):
            s, t = i[begin : begin + 65536], j[begin : begin + 65536]
            alike = (sketch[s] == sketch[t]).mean(axis=1)
            alike = (alike - 1 / 256) / (1 - 1 / 256)
            near = np.flatnonzero(alike >= threshold - SHORT)
            s, t = s[near], t[near]
            for low in range(0, len(s), 8192):
                u, v = s[low : low + 8192], t[low : low + 8192]
                shared = np.zeros((len(u), paths.shape[1]), bool)
                for k in range(paths.shape[1]):
                    shared |= (paths[u] == paths[v][:, k : k + 1]) & filled[v][:, k : k + 1]
                shared &= filled[u]
                first = np.where(shared, paths[u], np.iinfo(np.int64).max).min(axis=1)
                mine = first == bucket[u]
                keep.append(np.stack([u[mine], v[mine]]))
        if keep:
            found = np.concatenate(keep, axis=1)
            if found.shape[1]:
                yield found[0], found[1]


def shared_counts(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    rows = np.unique(np.concatenate([i, j]))
    if len(i) <= 8 * len(rows):
        out = np.empty(len(i), np.int64)
        for n, (s, t) in enumerate(zip(i, j, strict=True)):
            small, large = (sets[s], sets[t]) if len(sets[s]) <= len(sets[t]) else (sets[t], sets[s])
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            out[n] = (large[at] == small).sum()
        return out
    # Many pairs of few sets: products of membership tables, some thousand tokens at a time.
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    tokens, column, n = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    common = n[column] > 1
    owner, column = owner[common], column[common]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    product = np.zeros((len(rows), len(rows)), np.float32)
    _, column = np.unique(column, return_inverse=True)
    for begin in range(0, (column.max() + 1) if len(column) else 0, 4096):
        low, high = np.searchsorted(column, [begin, begin + 4096])
        held = np.zeros((len(rows), 4096), np.float32)
        held[owner[low:high], column[low:high] - begin] = 1
        product += held @ held.T
    return product[np.searchsorted(rows, i), np.searchsorted(rows, j)].astype(np.int64)


NAME = ["name_1", "name_2", "size"]
BLOCK_COLUMNS = "bucket long, a int, b int, chunk_of int, class_key long, copies long, size long, sketch binary, paths array<long>"


def join_documents(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET
) -> DataFrame:
    """Class, links and component of each document at a Jaccard similarity of word shingles.

    Documents with equal shingle sets are one class, named by its smallest doc_id; only classes are
    joined. Each run of the chosen-path join gathers classes in buckets by shared sampled shingles
    and splits large buckets on further ones; there are as many runs as bring two sets at the
    threshold together with probability ``recall``, even where all buckets are split to the last
    level. Within buckets all pairs are compared, in blocks of bounded size: first their sketches,
    then, for pairs that may reach the threshold, the whole sets. Pairs are never rows: a block returns for each class the number of its links
    and the smallest class they reach. A pair that meets in several buckets counts in one.

    Documents without words, null ones among them, and rows without doc_id link with nothing. Rows
    that repeat a doc_id count as copies where the texts agree, and each gets the values of its own
    text; unlike texts of one doc_id are judged apart. Other columns are ignored.

    Result: doc_id, class_id, n_links (other rows that reach the threshold, copies included),
    component_id (smallest doc_id that links reach), kept (doc_id = component_id); one row per
    input row.
    """
    own, of_class, _ = _joined(docs, threshold, recall, bucket)
    compared = (F.col("size") > 0) & F.col("doc_id").isNotNull()
    alone = own.where(~compared).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return (
        own.where(compared)
        .join(of_class, NAME)
        .select("doc_id", "class_id", "n_links", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
        .unionByName(alone)
    )


def _joined(docs: DataFrame, threshold: float, recall: float, bucket: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The set of each document, links and component of each class of sets, and the class each component keeps."""
    small_batches(docs.sparkSession)
    runs = runs_for(recall, threshold)
    sets = shared_table(document_sets(docs, runs), "sets")
    firsts = [F.first(c).alias(c) for c in ("sketch", *TOKENS)]
    # A class has a number of its own, so that unlike texts of one doc_id stay apart. It is fixed
    # once the table is written.
    classes = shared_table(
        sets.where("size > 0 and doc_id is not null")
        .groupBy(*NAME)
        .agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), *firsts)
        .withColumn("class_key", F.monotonically_increasing_id()),
        "classes",
    )
    # Tables here grow with the documents, so that none is broadcast: joins are asked to merge.
    # Blocks are dealt on narrow rows; sketches and paths join them once.
    ends = chosen_paths(classes, bucket)
    paths = ends.groupBy("class_key").agg(F.collect_list("bucket").alias("paths"))
    members = classes.select("class_key", "copies", "size", "sketch").join(paths.hint("merge"), "class_key")
    dealt = dealt_blocks(ends, "class_key").join(members.hint("merge"), "class_key")
    blocks = together(dealt).select(*[part.split()[0] for part in BLOCK_COLUMNS.split(", ")])

    def screen(batches):
        for table, starts in whole_blocks(batches):
            live = [np.concatenate(pair) for pair in owned_pairs(table, starts, threshold)]
            if live:
                yield from table.take(pa.array(np.unique(np.concatenate(live)))).to_batches()

    live = shared_table(blocks.mapInArrow(screen, BLOCK_COLUMNS), "live")
    wanted = classes.join(live.select("class_key").distinct(), "class_key", "left_semi")
    wanted = shared_table(wanted.select("class_key", "class_id", *NAME), "wanted")

    maybe_wanted = maybe_in(wanted, "class_id")

    def shingles(batches):
        for batch in batches:
            batch = batch.filter(pa.array(maybe_wanted(batch.column("class_id"))))
            texts = batch.column("text").to_pylist()
            for start, end in text_pieces(texts, PIECE):
                keys, starts = shingle_sets(texts[start:end])
                part = [keys[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                names = [x.view(np.int64) for x in set_names(keys, starts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class_id")[start:end], *map(pa.array, names), pa.array(np.diff(starts)), pa.array([x.tobytes() for x in part], pa.binary())],
                    ["class_id", *NAME, "shingles"],
                )

    # Only the sets of texts that may be wanted leave their task.
    texts = docs.select(F.col("doc_id").cast("long").alias("class_id"), "text")
    texts = texts.mapInArrow(shingles, "class_id long, name_1 long, name_2 long, size long, shingles binary")
    texts = texts.join(wanted.hint("merge"), ["class_id", *NAME]).select("class_key", "shingles").dropDuplicates(["class_key"])
    full = live.join(texts.hint("merge"), "class_key")

    def verify(batches):
        for table, starts in whole_blocks(batches, 256):
            keys = table.column("class_key").to_numpy()
            copies = table.column("copies").to_numpy()
            held = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            size = np.array([len(x) for x in held])
            links, near = [], np.zeros(len(keys), np.int64)
            for i, j in owned_pairs(table, starts, threshold):
                both = shared_counts(held, i, j)
                linked = both >= threshold * (size[i] + size[j] - both) - 1e-9
                i, j = i[linked], j[linked]
                np.add.at(near, i, copies[j])
                np.add.at(near, j, copies[i])
                links.append(np.stack([i, j]))
            if links:
                i, j = np.concatenate(links, axis=1)
                root = local_roots(keys, i, j)
                hit = near > 0
                yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (keys, near, root)], ["class_key", "near", "root"])

    columns = BLOCK_COLUMNS + ", shingles binary"
    found = together(full).select(*[part.split()[0] for part in columns.split(", ")])
    found = shared_table(found.mapInArrow(verify, "class_key long, near long, root long"), "found")
    joined = components(found.select(F.col("class_key").alias("u"), F.col("root").alias("v")))
    near = found.groupBy("class_key").agg(F.sum("near").alias("near"))
    of_class = shared_table(
        classes.select(*NAME, "class_key", "class_id", "copies")
        .join(near, "class_key", "left")
        .join(joined.withColumnRenamed("node", "class_key"), "class_key", "left")
        .select(
            *NAME, "class_id", F.coalesce("component", "class_key").alias("component"),
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        ),
        "of_class",
    )
    first = F.min(F.struct("class_id", *NAME))
    kept = shared_table(of_class.groupBy("component").agg(first.alias("first")).select("component", "first.*"), "components")
    smallest = kept.select("component", F.col("class_id").alias("component_id"))
    return sets.select("doc_id", *NAME), of_class.join(smallest, "component"), kept


def one_of_each_group(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The documents with one of each component of near copies left, in their own columns.

    Of a component the row with the smallest doc_id stays; of rows that repeat that id, the one
    whose set comes first by its name, and of equal sets the first text. Unlike texts of one id are
    judged apart. Rows without an id or without words all stay.

    Most documents stay as they are: they are recognised by a bit per hash of their id and never
    leave their task. Only what may go is shuffled, once, to be judged by its id and set.
    """
    own, of_class, kept = _joined(docs, threshold, recall, BUCKET)
    compared = own.where("size > 0 and doc_id is not null")
    rows = compared.groupBy("doc_id", *NAME).agg(F.count(F.lit(1)).alias("n"))
    survivors = kept.select(F.col("class_id").alias("doc_id"), *NAME, F.lit(True).alias("stays"))
    judged = rows.join(survivors, ["doc_id", *NAME], "left").select("doc_id", *NAME, "n", F.coalesce("stays", F.lit(False)).alias("stays"))
    touched = shared_table(judged.where("not stays or n > 1"), "touched")

    maybe = maybe_in(touched, "doc_id")
    names = [f"__{c}" for c in NAME]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType()) for n in names]])

    def untouched(batches):
        for batch in batches:
            yield batch.filter(pa.array(~maybe(batch.column("doc_id"))))

    def named(batches):
        for batch in batches:
            batch = batch.filter(pa.array(maybe(batch.column("doc_id"))))
            texts = batch.column("text").to_pylist()
            for start, end in text_pieces(texts, PIECE):
                keys, starts = shingle_sets(texts[start:end])
                columns = [*(x.view(np.int64) for x in set_names(keys, starts)), np.diff(starts)]
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, columns)], [*batch.schema.names, *names])

    asked = docs.mapInArrow(named, schema)
    of_row = touched.select(*[F.col(c).alias(f"__of_{c}") for c in ("doc_id", *NAME)], F.col("stays").alias("__stays"))
    same = F.col("doc_id").cast("long") == F.col("__of_doc_id")
    for c in NAME:
        same = same & (F.col(f"__{c}") == F.col(f"__of_{c}"))
    found = asked.join(of_row, same, "left")
    first = Window.partitionBy("__of_doc_id", *[f"__of_{c}" for c in NAME]).orderBy("text")
    doubled = found.where("__stays").withColumn("__place", F.row_number().over(first)).where("__place = 1")
    left = docs.mapInArrow(untouched, docs.schema)
    return left.unionByName(found.where("__stays is null").select(docs.columns)).unionByName(doubled.select(docs.columns))


def ngram_query(spark, sf_dir) -> DataFrame:
    return join_documents(documents(spark, sf_dir))
