"""Mine phrases: pairs of frequency-ranked ids counted in tiles, frequent pairs ranked and paired again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import documents, shared_table, text_pieces

LONGEST = 3
LEAST_COUNT = 10
# A longer phrase replaces a shorter one inside it that it holds so many percent of.
COVERED_PERCENT = 50
KEEP = 2000
UNKNOWN_LANGUAGE = "und"

# Bound of the ids that are ranked and sent to all tasks, for words and for the phrases of each
# length. All others are counted as well, under hashes (words) or as lists of words (phrases).
RANKED = 1 << 19
# Side of the tile of the most frequent ids; the sides double from one band of ranks to the next.
TILE = 1024
# Tiles of at most so many cells are counted in dense arrays, where a task has a pair for every
# SPARSE cells; it holds at most DENSE_HELD of those arrays.
DENSE_CELLS, SPARSE, DENSE_HELD = TILE * TILE, 16, 8
# Pairs that a task gathers before it counts them, and counts it holds before it sends them on.
GATHERED, HELD = 1 << 20, 3 << 19
# Counts of a tile are dealt over shards, one for about so many words of the corpus.
WORDS_PER_SHARD = 1 << 22

_HASHED = 1 << 62
_BREAK = b"\r"
_FOLDED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10
)
COUNTS = "lang string, width int, tile int, shard int, cells array<binary>, counts binary"


def tokens(texts: list[str]) -> list[bytes]:
    """Words of the texts in lower case (A to Z), with a break where a piece or a text ends."""
    data = "\r".join(texts).encode("utf-8", "surrogatepass").translate(_FOLDED)
    return [w for w in data.replace(_BREAK, b" \r ").split(b" ") if w]


def word_key(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed) >> 2 | _HASHED


def texts_by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """Texts of a batch of one language, in slices of bounded size."""
    langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
    own: dict[str, list[str]] = {}
    for lang, text in zip(langs, texts, strict=True):
        if text:
            own.setdefault(UNKNOWN_LANGUAGE if lang is None else lang, []).append(text)
    for lang, listed in own.items():
        for start, end in text_pieces(listed):
            yield lang, listed[start:end]


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """lang, word, its hash and n: how often it occurs. Counted in each task before the shuffle."""

    def count(batches):
        held: dict[str, dict[bytes, int]] = {}

        def rows():
            for lang, counts in held.items():
                words = list(counts)
                for start in range(0, len(words), 100_000):
                    part = words[start : start + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array([w.decode("utf-8", "replace") for w in part], pa.string()),
                            pa.array([word_key(w, seed) for w in part], pa.int64()),
                            pa.array([counts[w] for w in part], pa.int64()),
                        ],
                        ["lang", "word", "key", "n"],
                    )
            held.clear()

        for batch in batches:
            for lang, texts in texts_by_language(batch):
                counts = held.setdefault(lang, {})
                get = counts.get
                for word in tokens(texts):
                    counts[word] = get(word, 0) + 1
                counts.pop(_BREAK, None)
                if sum(map(len, held.values())) > 500_000:
                    yield from rows()
        yield from rows()

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, word string, key long, n long")
    return counted.groupBy("lang", "word").agg(F.first("key").alias("key"), F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows with the largest n, at most ``most``: those above a level found by counting levels."""
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    held, cut = 0, None
    for row in levels:
        held += row["count"]
        if held > most:
            break
        cut = row["level"]
    return counted.where(F.lit(False) if cut is None else level >= cut)


class Vocabulary(dict):
    """Ids of words: their rank by frequency, a hash where they have none and are not all known, else none."""

    def __init__(self, ranked: dict[bytes, int], complete: bool, seed: int):
        super().__init__(ranked)
        self.ranked, self.complete, self.seed = len(ranked), complete, seed
        self[_BREAK] = -1
        self.added: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        if self.complete:
            return -1
        if len(self.added) > 200_000:
            for w in self.added:
                del self[w]
            self.added.clear()
        key = self[word] = word_key(word, self.seed)
        self.added.append(word)
        return key


class Ranks:
    """What all tasks know: ranked words and, for each length, ranked phrases of each language.

    All of it is arrays, so that the driver holds some bytes for each; tasks make what they look up.
    """

    def __init__(self, words: dict[str, pa.Array], complete: bool, seed: int):
        self.words, self.complete, self.seed = words, complete, seed
        # By length: language to sorted keys, their ranks, and (first part, last word) by rank; and
        # whether these are all phrases that may be part of a longer one.
        self.phrases: list[tuple[dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]], bool]] = []
        self._vocabularies: dict[str, Vocabulary] = {}

    def __getstate__(self):
        return self.__dict__ | {"_vocabularies": {}}

    def vocabulary(self, lang: str) -> Vocabulary:
        known = self._vocabularies.get(lang)
        if known is None:
            ranked = {w.as_py(): i for i, w in enumerate(self.words.get(lang, pa.array([], pa.binary())))}
            known = self._vocabularies[lang] = Vocabulary(ranked, self.complete, self.seed)
        return known

    def ids(self, lang: str, listed: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary(lang).__getitem__, listed), np.int64, len(listed))

    def rank_phrases(self, found: dict[str, tuple[np.ndarray, np.ndarray]], complete: bool) -> None:
        """Take phrases (ranks of the first parts, ids of the last words), most frequent first, as ranked."""
        tables = {}
        for lang, (first, last) in found.items():
            keys = first << 32 | last
            order = np.argsort(keys, kind="stable")
            tables[lang] = keys[order], order, np.stack([first, last], axis=1)
        self.phrases.append((tables, complete))

    def words_of(self, lang: str, length: int, ranks: np.ndarray) -> list[np.ndarray]:
        """The words' ids of ranked phrases, a column for each place."""
        if length == 1:
            return [ranks]
        pairs = self.phrases[length - 2][0][lang][2][ranks]
        return [*self.words_of(lang, length - 1, pairs[:, 0]), pairs[:, 1]]


def phrase_pairs(ranks: Ranks, lang: str, ids: np.ndarray, length: int) -> list[list[np.ndarray]]:
    """Columns of ids for each occurrence of a phrase of so many words that may be frequent.

    Both parts without one word at an end must be so frequent themselves. Where the first part is
    ranked it is one column, else its words are.
    """
    unit = np.where(ids < ranks_limit(ranks, lang), ids, -1)  # rank of the stretch that begins here
    listed = np.where((unit < 0) & (ids >= 0), 1, 0).astype(bool)  # it may be frequent, but is not ranked
    for before in range(2, length):
        tables, complete = ranks.phrases[before - 2]
        n = max(len(unit) - 1, 0)
        last = ids[before - 1 : before - 1 + n]
        can = (unit[:n] >= 0) & (last >= 0) & (last < ranks_limit(ranks, lang))
        keys, order, _ = tables.get(lang, (np.zeros(0, np.int64),) * 2 + (None,))
        found = np.full(n, -1, np.int64)
        if len(keys):
            asked = unit[:n][can] << 32 | last[can]
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            found[can] = np.where(keys[at] == asked, order[at], -1)
        maybe = np.zeros(n, bool) if complete else (found < 0) & alive(unit, listed, n)
        unit, listed = found, maybe
    n = max(len(unit) - 1, 0)
    both = alive(unit, listed, n)
    last = ids[length - 1 : length - 1 + n]
    ranked = both & (unit[:n] >= 0)
    unranked = np.flatnonzero(both & (unit[:n] < 0))
    out = [[unit[:n][ranked], last[ranked]]]
    if len(unranked):
        out.append([ids[unranked + i] for i in range(length)])
    return out


def alive(unit: np.ndarray, listed: np.ndarray, n: int) -> np.ndarray:
    """Whether a stretch and the one that begins a word later may both be frequent."""
    possible = (unit >= 0) | listed
    return possible[:n] & possible[1 : n + 1]


def ranks_limit(ranks: Ranks, lang: str) -> int:
    return len(ranks.words.get(lang, ()))


def bands(ids: np.ndarray) -> np.ndarray:
    """Band of each id: 0 for the first TILE ranks, then one for each doubling; hashes have the last."""
    out = np.zeros(len(ids), np.int64)
    large = ids >= TILE
    out[large] = np.minimum(np.floor(np.log2(ids[large] // TILE)).astype(np.int64) + 1, 31)
    return out


def combined(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted coordinates with the counts of equal ones added up."""
    if not len(counts):
        return columns, counts
    if len(columns) == 2 and columns[0].max() < 1 << 31 and columns[1].max() < 1 << 31:
        key = columns[0] << 32 | columns[1]
        order = np.argsort(key)
        key, counts = key[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return [key[first] >> 32, key[first] & 0xFFFFFFFF], np.add.reduceat(counts, first)
    order = np.lexsort(columns[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    fresh = np.zeros(len(counts), bool)
    fresh[0] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(fresh)
    return [c[first] for c in columns], np.add.reduceat(counts, first)


class TileCounter:
    """Counts of pairs of one language in one task: dense arrays for full tiles, sorted coordinates else."""

    def __init__(self):
        self.gathered: dict[int, list[list[np.ndarray]]] = {}
        self.size = 0
        self.dense: dict[int, np.ndarray] = {}
        self.held: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}

    def add(self, columns: list[np.ndarray]) -> None:
        if len(columns[0]):
            self.gathered.setdefault(len(columns), []).append(columns)
            self.size += len(columns[0])

    def count(self) -> None:
        """Count what was gathered."""
        for width, parts in self.gathered.items():
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            if width == 2:
                columns = self._count_dense(columns)
            old, n = self.held.get(width, ([np.zeros(0, np.int64)] * width, np.zeros(0, np.int64)))
            new, m = combined(columns, np.ones(len(columns[0]), np.int64))
            self.held[width] = combined([np.concatenate(c) for c in zip(old, new, strict=True)], np.concatenate([n, m]))
        self.gathered, self.size = {}, 0

    def _count_dense(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """Count the pairs of full tiles in their dense arrays; the others are left."""
        one, other = bands(columns[0]), bands(columns[1])
        tile = one * 32 + other
        pairs = np.bincount(tile, minlength=1024)
        left = np.ones(len(tile), bool)
        for t in np.flatnonzero(pairs).tolist():
            (low_a, side_a), (low_b, side_b) = tile_sides(t)
            cells = side_a * side_b
            if t not in self.dense:
                if cells > DENSE_CELLS or pairs[t] * SPARSE < cells or len(self.dense) >= DENSE_HELD:
                    continue
                self.dense[t] = np.zeros(cells, np.int64)
            own = tile == t
            left &= ~own
            cell = (columns[0][own] - low_a) * side_b + columns[1][own] - low_b
            self.dense[t] += np.bincount(cell, minlength=cells)
        return [c[left] for c in columns]

    def held_counts(self) -> int:
        return sum(len(n) for _, n in self.held.values())

    def rows(self, shards: int) -> Iterator[tuple]:
        """(width, tile, shard, columns of coordinates, counts) of all counts; nothing stays held."""
        for tile, cells in self.dense.items():
            (low_a, _), (low_b, side_b) = tile_sides(tile)
            full = np.flatnonzero(cells)
            yield from dealt(2, [full // side_b + low_a, full % side_b + low_b], cells[full], shards)
        for width, (columns, counts) in self.held.items():
            yield from dealt(width, columns, counts, shards)
        self.dense, self.held = {}, {}


def tile_sides(tile: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """First rank and number of ranks of both sides of a tile."""
    side = lambda band: (0, TILE) if band == 0 else (TILE << (band - 1), TILE << (band - 1))
    return side(tile // 32), side(tile % 32)


def dealt(width: int, columns: list[np.ndarray], counts: np.ndarray, shards: int) -> Iterator[tuple]:
    tile = bands(columns[0]) * 32 + bands(columns[1])
    mix = columns[0].astype(np.uint64)
    for c in columns[1:]:
        mix = (mix ^ (mix >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64)
    mix = (mix ^ (mix >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    shard = ((mix >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)
    group = tile * shards + shard
    order = np.argsort(group, kind="stable")
    group = group[order]
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    for begin, end in zip(cuts, np.append(cuts[1:], len(group)), strict=True):
        own = order[begin:end]
        yield width, int(group[begin]) // shards, int(group[begin]) % shards, [c[own] for c in columns], counts[own]


def packed(values: np.ndarray) -> bytes:
    """Numbers in four bytes each where they fit, else in eight; the first byte says which."""
    small = len(values) == 0 or values.max() < 1 << 31
    return (b"\4" if small else b"\10") + values.astype(np.int32 if small else np.int64).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int32 if data[0] == 4 else np.int64, offset=1).astype(np.int64)


def count_phrases(docs: DataFrame, ranks: Ranks, length: int, least: int, shards: int) -> DataFrame:
    """lang, key_1 .. key_length and n of the phrases of so many words that occur ``least`` times.

    Tasks count pairs in tiles and send the counts of a tile and shard as one row; what a tile
    holds is then added up, again in a dense array where the tile is small, in bounded pieces.
    """
    held = docs.sparkSession.sparkContext.broadcast(ranks)

    def count(batches):
        counters: dict[str, TileCounter] = {}

        def rows(lang):
            counter = counters.pop(lang)
            counter.count()  # pairs that are gathered go along
            for width, tile, shard, columns, counts in counter.rows(shards):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang], pa.string()),
                        pa.array([width], pa.int32()),
                        pa.array([tile], pa.int32()),
                        pa.array([shard], pa.int32()),
                        pa.array([[packed(c) for c in columns]], pa.list_(pa.binary())),
                        pa.array([packed(counts)], pa.binary()),
                    ],
                    ["lang", "width", "tile", "shard", "cells", "counts"],
                )

        for batch in batches:
            for lang, texts in texts_by_language(batch):
                counter = counters.setdefault(lang, TileCounter())
                for columns in phrase_pairs(held.value, lang, held.value.ids(lang, tokens(texts)), length):
                    counter.add(columns)
                while sum(c.size for c in counters.values()) > GATHERED:
                    counters[max(counters, key=lambda k: counters[k].size)].count()
                while sum(c.held_counts() for c in counters.values()) > HELD or sum(len(c.dense) for c in counters.values()) > DENSE_HELD:
                    yield from rows(max(counters, key=lambda k: counters[k].held_counts() + len(counters[k].dense)))
        for lang in list(counters):
            yield from rows(lang)

    keys = [f"key_{i + 1}" for i in range(length)]

    def add_up(batches):
        def rows(group, columns, counts):
            lang, width, _, _ = group
            often = np.flatnonzero(counts >= least)
            columns = [c[often] for c in columns]
            if width == 2 and length > 2:
                columns = [*held.value.words_of(lang, length - 1, columns[0]), columns[1]]
            for start in range(0, len(often), 100_000):
                part = slice(start, start + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(columns[0][part]), pa.string())]
                    + [pa.array(c[part]) for c in columns]
                    + [pa.array(counts[often][part])],
                    ["lang", *keys, "n"],
                )

        group, parts, size = None, [], 0

        def merged():
            columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)]
            return combined(columns, np.concatenate([p[1] for p in parts]))

        for batch in batches:
            for row in batch.to_pylist():
                own = row["lang"], row["width"], row["tile"], row["shard"]
                if own != group:
                    if parts:
                        yield from rows(group, *merged())
                    group, parts, size = own, [], 0
                counts = unpacked(row["counts"])
                parts.append(([unpacked(c) for c in row["cells"]], counts))
                size += len(counts)
                if size > GATHERED:
                    parts = [merged()]
                    # What is left grows only with the different pairs of the tile's shard.
                    size = min(len(parts[0][1]), GATHERED // 2)
        if parts:
            yield from rows(group, *merged())

    by = ["lang", "width", "tile", "shard"]
    sent = docs.select("lang", "text").mapInArrow(count, COUNTS).repartition(*by).sortWithinPartitions(*by)
    return sent.mapInArrow(add_up, ", ".join(["lang string", *[f"{k} long" for k in keys], "n long"]))


def phrase_counts(docs: DataFrame, longest: int, least: int, ranked: int) -> tuple[DataFrame, list[DataFrame]]:
    """Counts of all words, and of the phrases of each length that occur ``least`` times.

    The first of the list has the frequent words themselves.
    """
    for seed in range(8):
        every = shared_table(word_counts(docs, seed), "words")
        if every.groupBy("lang", "key").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("hashes of words collide under all seeds")
    frequent = every.where(F.col("n") >= least)
    counts = frequent.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).first()
    shards = max(1, (counts["n"] or 0) // WORDS_PER_SHARD)
    words = {
        lang: part.column("word").cast(pa.binary()).combine_chunks()
        for lang, part in by_language(most_frequent(frequent, ranked).orderBy("lang", F.desc("n"), "word"))
    }
    ranks = Ranks(words, sum(map(len, words.values())) == counts["words"], seed)
    # Ids of ranked words in place of their hashes.
    single = shared_table(with_ids(frequent, ranks), "frequent")
    found = [single]
    for length in range(2, longest + 1):
        phrases = shared_table(count_phrases(docs, ranks, length, least, shards), f"phrases_{length}")
        found.append(phrases)
        if length == longest:
            break
        keys = [f"key_{i + 1}" for i in range(length)]
        # Only phrases whose words and first part are ranked can be.
        rankable = phrases.where(F.greatest(*keys) < _HASHED)
        taken, of_lang = 0, {}
        for lang, part in by_language(most_frequent(rankable, ranked).orderBy("lang", F.desc("n"), *keys)):
            columns = [part.column(k).to_numpy() for k in keys]
            first = ranked_prefix(ranks, lang, columns[:-1])
            whole = first >= 0
            of_lang[lang] = first[whole], columns[-1][whole]
            taken += int(whole.sum())
        ranks.rank_phrases(of_lang, taken == phrases.count())
    return every, found


def by_language(ordered: DataFrame) -> Iterator[tuple[str, pa.Table]]:
    """The rows of each language of a frame of bounded size that is in their order."""
    table = ordered.toArrow()
    if not table.num_rows:
        return
    langs = table.column("lang").combine_chunks().dictionary_encode()
    codes = langs.indices.to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(codes)], strict=True):
        yield langs.dictionary[codes[start]].as_py(), table.slice(start, end - start)


def with_ids(words: DataFrame, ranks: Ranks) -> DataFrame:
    """Words with their ids as key_1: the rank where there is one, else the hash."""
    held = words.sparkSession.sparkContext.broadcast(ranks)

    def place(batches):
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for i, (lang, word) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist(), strict=True)):
                known = held.value.vocabulary(lang)
                rank = dict.get(known, word.encode("utf-8", "surrogatepass"))
                if rank is not None:
                    keys[i] = rank
            columns = [batch.column("lang"), pa.array(keys, pa.int64()), batch.column("word"), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "key_1", "word", "n"])

    return words.select("lang", "key", "word", "n").mapInArrow(place, "lang string, key_1 long, word string, n long")


def ranked_prefix(ranks: Ranks, lang: str, columns: list[np.ndarray]) -> np.ndarray:
    """Rank of the phrase with these words' ids, -1 where it has none."""
    unit = columns[0]
    for before, last in enumerate(columns[1:], 2):
        keys, order, _ = ranks.phrases[before - 2][0].get(lang, (np.zeros(0, np.int64),) * 2 + (None,))
        asked = np.where(unit >= 0, unit << 32 | last, -1)
        if not len(keys):
            return np.full(len(asked), -1, np.int64)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        unit = np.where(keys[at] == asked, order[at], -1)
    return unit


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(38,0)") * (wide(a) * wide(a)), wide(left) * wide(right))


def find_collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
    keep: int = KEEP,
    covered: int = COVERED_PERCENT,
    ranked: int = RANKED,
) -> DataFrame:
    """The phrases of each language whose words stand together most above chance.

    Texts are put in lower case (A to Z), cut at marks and line ends, and split at spaces and tabs.
    All counts are exact and cover all texts. Words and phrases are ranked by frequency; those with
    a rank are counted under it, all others as well, under hashes that are checked to differ. A
    phrase is counted only where both of its parts without one word at an end are frequent enough.

    Candidates have 2 to ``longest`` words and occur ``least`` times. Cut in two, a candidate scores
    floor(1000000 a a / (l r)) by its own count and those of its parts; the lowest cut counts, the
    first of equal ones. A candidate inside a longer one that holds ``covered`` percent of its
    occurrences goes. The first ``keep`` of each language stay, by score, count, then phrase.

    Null and empty texts have no words; a null language is ``und``. Rows that repeat a document
    count each time; other columns are ignored.

    Result: lang, rank, phrase, a, l, r, n (words of the language), score.
    """
    every, found = phrase_counts(docs, longest, least, ranked)
    keys = lambda n, first=1: [f"key_{i}" for i in range(first, first + n)]
    candidates = None
    for length in range(2, longest + 1):
        rows = found[length - 1].withColumnRenamed("n", "a")
        for i in range(1, length + 1):
            words = found[0].select("lang", F.col("key_1").alias(f"key_{i}"), F.col("word").alias(f"word_{i}"), F.col("n").alias(f"n_1_{i}"))
            rows = rows.join(words, ["lang", f"key_{i}"])
        # Counts of the parts: n_<words>_<place of the first>.
        for size in range(2, length):
            for first in (1, length - size + 1):
                part = found[size - 1].select("lang", *[F.col(k).alias(o) for k, o in zip(keys(size), keys(size, first), strict=True)], F.col("n").alias(f"n_{size}_{first}"))
                rows = rows.join(part, ["lang", *keys(size, first)])
        cuts = []
        for k in range(1, length):
            left, right = F.col(f"n_{k}_1"), F.col(f"n_{length - k}_{k + 1}")
            cuts.append(F.struct(exact_score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        best = F.array_min(F.array(*cuts))
        for longer in range(length + 1, longest + 1):
            inside = None
            for first in range(1, longer - length + 2):
                own = found[longer - 1].select(
                    "lang", *[F.col(o).alias(k) for k, o in zip(keys(length), keys(length, first), strict=True)], F.col("n").alias("held")
                )
                inside = own if inside is None else inside.unionByName(own)
            inside = inside.groupBy("lang", *keys(length)).agg(F.max("held").alias(f"held_{longer}"))
            rows = rows.join(inside, ["lang", *keys(length)], "left").where(
                F.coalesce(F.col(f"held_{longer}") * 100 < F.col("a") * covered, F.lit(True))
            )
        rows = rows.select("lang", F.concat_ws(" ", *[f"word_{i}" for i in range(1, length + 1)]).alias("phrase"), "a", best.alias("best"))
        candidates = rows if candidates is None else candidates.unionByName(rows)
    candidates = candidates.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # The first of each part of a language, then the first of those: no task gets a whole language.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = (
        candidates.withColumn("part", part)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        .where(F.col("rank") <= keep)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .where(F.col("rank") <= keep)
    )
    totals = every.groupBy(F.col("lang").alias("of_lang")).agg(F.sum("n").alias("n"))
    return first.join(totals, F.col("lang") == F.col("of_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_query(spark, sf_dir) -> DataFrame:
    return find_collocations(documents(spark, sf_dir))


COLLOCATIONS_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN_LANGUAGE}') AS lang, row_number() OVER () AS text_no,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS held
  FROM documents),
piece AS (SELECT lang, text_no, unnest(held) AS piece, unnest(range(len(held))) AS piece_no FROM pieces),
words AS (SELECT lang, text_no, piece_no, regexp_extract_all(piece, '[^\\x20\\x09]+') AS held FROM piece),
word AS (SELECT lang, text_no, piece_no, unnest(held) AS w1, unnest(range(len(held))) AS place FROM words),
following AS (
  SELECT lang, w1, lead(w1, 1) OVER beside AS w2, lead(w1, 2) OVER beside AS w3
  FROM word WINDOW beside AS (PARTITION BY text_no, piece_no ORDER BY place)),
ones AS (SELECT lang, w1, count(*) AS f FROM following GROUP BY ALL),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM following WHERE w2 IS NOT NULL GROUP BY ALL),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM following WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}),
inside AS (
  SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON t.lang = x.lang AND t.w1 = x.w1 JOIN ones y ON t.lang = y.lang AND t.w2 = y.w1
  LEFT JOIN inside i ON t.lang = i.lang AND t.w1 = i.w1 AND t.w2 = i.w2
  WHERE t.f >= {LEAST_COUNT} AND (i.f IS NULL OR 100 * i.f < {COVERED_PERCENT} * t.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM threes t JOIN ones x ON t.lang = x.lang AND t.w1 = x.w1
  JOIN twos y ON t.lang = y.lang AND t.w2 = y.w1 AND t.w3 = y.w2
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM threes t JOIN twos x ON t.lang = x.lang AND t.w1 = x.w1 AND t.w2 = x.w2
  JOIN ones y ON t.lang = y.lang AND t.w3 = y.w1),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM best)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(f)::BIGINT FROM ones o WHERE o.lang = ranked.lang) AS n, score
FROM ranked WHERE rank <= {KEEP}
"""
