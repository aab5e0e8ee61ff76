"""Find benchmark passages in documents by pigeonhole pieces and bit-parallel edit distance."""

from __future__ import annotations

import bisect
import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, table, text_pieces
from gridloom.llm.language_id import HashArray, mixed

# Edits allowed per word of an item.
RATE = 0.2
# Items of fewer words are no passages unless asked for: their words stand anywhere by chance.
LEAST_WORDS = 5
# Items are looked for in blocks of about so many characters; a block goes to every task.
BLOCK_CHARACTERS = 8_000_000

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Words in lower case, each for itself, so that they are as many as in the text as it stands."""
    lower = (text or "").lower()
    if len(lower) == len(text or ""):
        return _WORD.findall(lower)
    return [w.lower() for w in _WORD.findall(text)]


def budget(n_words: int, rate: float = RATE) -> int:
    return int(rate * n_words + 1e-9)


def pieces(n_words: int, edits: int) -> list[tuple[int, int]]:
    """Where the ``edits + 1`` pieces of an item begin and end: that many edits leave one whole."""
    cuts = [i * n_words // (edits + 1) for i in range(edits + 2)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def myers(masks: dict[int, int], size: int, text) -> list[int]:
    """For each place of the text, the fewest edits between the pattern and a stretch that ends there.

    The column of the distance table is held as two sets of bits, of steps up and steps down.
    ``masks`` has, for each word of the pattern, the places it stands at.
    """
    full = (1 << size) - 1
    top = 1 << (size - 1)
    up, down, score, out = full, 0, size, []
    for word in text:
        match = masks.get(word, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        across_up = (down | ~(diagonal | up)) & full
        across_down = up & diagonal
        if across_up & top:
            score += 1
        elif across_down & top:
            score -= 1
        across_up = (across_up << 1) & full
        across_down = (across_down << 1) & full
        up = (across_down | ~(diagonal | across_up)) & full
        down = across_up & diagonal
        out.append(score)
    return out


def masks_of(words) -> dict[int, int]:
    found: dict[int, int] = {}
    for i, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << i
    return found


@dataclass
class Item:
    item_id: int
    words: list[int]
    edits: int
    forward: dict[int, int]
    backward: dict[int, int]


class Passages:
    """The items of a block: their words, and their pieces in one sorted hash array per length."""

    def __init__(self, rows: list[tuple[int, str]], rate: float = RATE, least_words: int = LEAST_WORDS):
        self.vocabulary: dict[str, int] = {}
        self.items: list[Item] = []
        known: dict[tuple[int, ...], int] = {}
        found: dict[int, list[tuple[int, int, int]]] = {}
        for item_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
            words = words_of(text)
            if len(words) < max(least_words, 1):
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if tuple(ids) in known:  # the smallest id stands for items of the same words
                continue
            known[tuple(ids)] = number = len(self.items)
            edits = budget(len(ids), rate)
            self.items.append(Item(item_id, ids, edits, masks_of(ids), masks_of(ids[::-1])))
            for start, end in pieces(len(ids), edits):
                keys = self.keys(np.array(ids[start:end], np.int64), end - start)
                found.setdefault(end - start, []).append((int(keys[0]), number, start))
        self.tables = {}
        for length, entries in sorted(found.items()):
            entries.sort()
            keys = np.array([e[0] for e in entries], np.uint64)
            distinct, first = np.unique(keys, return_index=True)
            targets = np.array([(e[1], e[2]) for e in entries], np.int64)
            self.tables[length] = HashArray(distinct, np.append(first, len(entries))), targets

    @staticmethod
    def keys(ids: np.ndarray, length: int) -> np.ndarray:
        """Keys of all stretches of so many words."""
        wide, n = ids.astype(np.uint64), len(ids) - length + 1
        out = np.zeros(max(n, 0), np.uint64)
        for i in range(length):
            out = out * _BASE + wide[i : i + n]
        return mixed(out)

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item_id, distance, first word, last word) of every place that holds an item."""
        return [(text, item.item_id, *place) for text, item, *place in self.places(texts)]

    def places(self, texts: list[str]) -> list[tuple[int, Item, int, int, int]]:
        """The same with the item itself."""
        get = self.vocabulary.get
        listed = [words_of(t) for t in texts]
        # A zero after each text, and for each word of no item: no piece holds one.
        ids = np.array([i for words in listed for i in (*[get(w, 0) for w in words], 0)], np.int64)
        ends = np.cumsum([len(words) + 1 for words in listed]) if listed else np.zeros(0, np.int64)
        zeros = np.concatenate([[0], np.cumsum(ids == 0)])
        hits = []
        for length, (table, targets) in self.tables.items():
            if len(ids) < length:
                continue
            places = np.flatnonzero(zeros[length:] == zeros[:-length])
            wide = ids.astype(np.uint64)
            keys = np.zeros(len(places), np.uint64)
            for i in range(length):
                keys = keys * _BASE + wide[places + i]
            at, known = table.find(mixed(keys))
            places, at = places[known], at[known]
            low, count = table.rows[at], table.rows[at + 1] - table.rows[at]
            place = np.repeat(places, count)
            entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            hits.append(np.stack([targets[entry, 0], place - targets[entry, 1]], axis=1))
        if not hits:
            return []
        # One look at each stretch of places where an item may begin.
        spots = np.unique(np.concatenate(hits), axis=0)
        out, i = [], 0
        while i < len(spots):
            number, first = spots[i]
            item, j = self.items[number], i
            while j + 1 < len(spots) and spots[j + 1][0] == number and spots[j + 1][1] - spots[j][1] <= len(item.words):
                j += 1
            out += self._verified(ids, ends, item, int(first), int(spots[j][1]))
            i = j + 1
        return out

    def _verified(self, ids, ends, item: Item, first: int, last: int):
        """Places of an item among those that begin from ``first`` to ``last``, none overlapping another."""
        size, found = len(item.words), []
        inside = first + size // 2 if first < 0 else first
        for text in range(int(np.searchsorted(ends, max(inside - item.edits, 0), "right")), len(ends)):
            begin = int(ends[text - 1]) if text else 0
            if begin > last + size + item.edits:
                break
            low, high = max(begin, first - item.edits), min(int(ends[text]) - 1, last + size + item.edits)
            if low >= high:
                continue
            for start, end, distance in apart(item, ids[low:high].tolist()):
                found.append((text, item, distance, low + start - begin, low + end - begin))
        return found


def apart(item: Item, stretch: list[int]) -> list[tuple[int, int, int]]:
    """(first word, last word, edits) of places of an item that do not overlap, by place.

    The place with the fewest edits is taken first, the first of equal ones; then the next in what
    is left, until that holds none within the budget.
    """
    size = len(item.words)
    # The edits at an end only grow as places before it are taken: those listed are the fewest.
    open_ends = [(n, end) for end, n in enumerate(myers(item.forward, size, stretch)) if n <= item.edits]
    heapq.heapify(open_ends)
    taken: list[tuple[int, int, int]] = []
    while open_ends:
        listed, end = heapq.heappop(open_ends)
        at = bisect.bisect_left(taken, (end + 1,))
        free = taken[at - 1][1] + 1 if at else 0
        if end < free:
            continue
        low = max(free, end - size - item.edits + 1)
        back = myers(item.backward, size, stretch[low : end + 1][::-1])
        least = min(back)
        if least == listed:
            taken.insert(at, (end - back.index(least), end, least))
        elif least <= item.edits:
            heapq.heappush(open_ends, (least, end))
    return taken


def find_passages(docs: DataFrame, items: DataFrame, rate: float = RATE, least_words: int = LEAST_WORDS) -> DataFrame:
    """Places in documents within ``rate`` edits per word of a benchmark item.

    Edits insert, drop or replace whole words; words are compared in lower case without marks. An
    item of m words with a budget of k = floor(rate m) edits is cut into k + 1 pieces; any place
    within the budget holds one of them unchanged. All exact hits of pieces are found by hash, and
    each stretch they point to is verified by Myers' bit-parallel distance, so no place is lost.
    Places of one item that are reported do not overlap: of those that do, the one with the fewest
    edits counts, the first of equal ones.

    Items of fewer than ``least_words`` words are no passages (``left_out_items`` lists them), nor
    are null ones; with fewer than five words an item is found unchanged, as its budget is 0. Of
    items with the same words the smallest item_id is reported. Null texts hold nothing. Rows that repeat a document
    give repeated rows. Items go to the tasks in blocks of bounded size, one pass over the
    documents for each; other columns are ignored.

    Result: doc_id, item_id, distance, item_words, start and end (code points, end exclusive).
    """
    found = None
    for passages in _blocks(items, rate, least_words):
        part = _block_passages(docs, passages)
        found = part if found is None else found.unionByName(part)
    return found


def _blocks(items: DataFrame, rate: float, least_words: int):
    """The items in blocks of bounded size; those of the same words go to one block, which merges them."""
    items = items.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_CHARACTERS) or 1
    keyed = items.mapInArrow(_with_key, "item_id long, text string, words_key long")
    for block in range(blocks):
        rows = keyed.where(F.pmod("words_key", F.lit(blocks)) == block).collect()
        yield Passages([(r["item_id"], r["text"]) for r in rows], rate, least_words)


def left_out_items(items: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """item_id and item_words of the items that are too short to be looked for, null texts included."""

    def short(batches):
        for batch in batches:
            sizes = [len(words_of(t)) for t in batch.column("text").to_pylist()]
            out = pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(sizes, pa.int64())], ["item_id", "item_words"])
            yield out.filter(pa.array([n < max(least_words, 1) for n in sizes]))

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(short, "item_id long, item_words long")


def _with_key(batches):
    for batch in batches:
        keys = [xxhash.xxh64_intdigest(" ".join(words_of(t))) >> 1 for t in batch.column("text").to_pylist()]
        columns = [batch.column("item_id"), batch.column("text"), pa.array(keys, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "text", "words_key"])


def _block_passages(docs: DataFrame, passages: Passages) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(passages)

    def search(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for start, end in text_pieces(texts):
                part = texts[start:end]
                rows, spans = [], {}
                for text, item, distance, first, last in held.value.places(part):
                    if text not in spans:  # places are those of the text as it stands
                        spans[text] = [m.span() for m in _WORD.finditer(part[text])]
                        if len(part[text].lower()) == len(part[text]):
                            spans[text] = [m.span() for m in _WORD.finditer(part[text].lower())]
                    own = spans[text]
                    rows.append((ids[start + text].as_py(), item.item_id, distance, len(item.words), own[first][0], own[last][1]))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], ids.type)] + [pa.array(c, pa.int64()) for c in columns[1:]],
                                                     ["doc_id", "item_id", "distance", "item_words", "start", "end"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {kind}, item_id long, distance long, item_words long, start long, end long"
    )


def passages_query(spark, sf_dir) -> DataFrame:
    return find_passages(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def without_passages(docs: DataFrame, items: DataFrame, rate: float = RATE, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that hold no benchmark passage, in their own columns.

    Each row is judged by its own text, whether its id is null or repeated or not.
    """
    for passages in _blocks(items, rate, least_words):
        docs = _block_free(docs, passages)
    return docs


def _block_free(docs: DataFrame, passages: Passages) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(passages)

    def keep(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            clean = np.ones(len(texts), bool)
            for start, end in text_pieces(texts):
                for text, *_ in held.value.matches(texts[start:end]):
                    clean[start + text] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
