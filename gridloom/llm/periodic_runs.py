"""Find periodic runs of words: maximal pairs at bounded distance from a bottom-up LCP-interval tree."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, text_pieces

LEAST_LENGTH = 6
LEAST_EXPONENT = 4

_WORD = re.compile(r"[^ \t-\r]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)

RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def shortest_pair(least: int, exponent: int) -> int:
    """The fewest words that both members of a maximal pair of a run can have.

    A run of period p and length n is a pair at distance p with n - p words: at least
    (exponent - 1) p, and least - p.
    """
    words = exponent - 1
    while words + words // (exponent - 1) < least:
        words += 1
    return words


def repeated_places(ids: np.ndarray, owner: np.ndarray, words: int) -> np.ndarray:
    """Places whose next ``words`` words stand in the same text again, and perhaps some others.

    A suffix that begins at any other place shares fewer words with all suffixes of its text.
    """
    n = len(ids) - words + 1
    if n < 2:
        return np.zeros(0, np.int64)
    keys = owner[:n].astype(np.uint64) + np.uint64(1)
    wide = ids.astype(np.uint64)
    for i in range(words):
        keys = keys * _BASE + wide[i : i + n]
        keys ^= keys >> np.uint64(29)
    inside = np.flatnonzero(owner[words - 1 :] == owner[:n])
    if len(inside) < 2:
        return np.zeros(0, np.int64)
    keys = keys[inside]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    equal = keys[1:] == keys[:-1]
    twice = np.concatenate([equal, [False]]) | np.concatenate([[False], equal])
    return np.sort(inside[order[twice]])


def suffix_ranks(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Rank of each suffix of its text in word order, texts one after the other; by prefix doubling.

    Only suffixes that still share a rank are looked at in a round.
    """
    n = len(ids)
    keys = owner.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    ends = np.searchsorted(owner, owner, "right")
    rank = np.zeros(n, np.int64)
    active, old, step = np.arange(n), np.zeros(n, np.int64), 0
    while len(active):
        order = np.lexsort((keys, old)) if step else np.argsort(keys, kind="stable")
        active, old, keys = active[order], old[order], keys[order]
        place = np.arange(len(active))
        first_old = np.concatenate([[True], old[1:] != old[:-1]])
        first = first_old | np.concatenate([[True], keys[1:] != keys[:-1]])
        head = np.maximum.accumulate(np.where(first, place, 0))
        old_head = np.maximum.accumulate(np.where(first_old, place, 0))
        new = old + head - old_head
        rank[active] = new
        alone = first & np.concatenate([first[1:], [True]])
        active, old = active[~alone], new[~alone]
        step = step * 2 or 1
        beyond = active + step
        inside = beyond < ends[active]
        keys = np.where(inside, rank[np.minimum(beyond, n - 1)] + 1, 0)
    return rank


def shared_prefixes(ids: list[int], order: list[int], end: int, fewest: int) -> list[int]:
    """Words that each suffix of ``order`` shares with the one before it in the order.

    Places are looked at from left to right: what a suffix shares, its successor shares but one.
    That holds while both of their successors are in the order, that is for ``fewest`` words or more.
    """
    before = dict(zip(order[1:], order[:-1], strict=True))
    shared: dict[int, int] = {}
    held, last = 0, -2
    for place in sorted(order):
        held -= place - last
        if held < fewest:
            held = 0
        last = place
        other = before.get(place)
        if other is None:
            held = 0
            continue
        limit = end - max(place, other)
        while held < limit and ids[place + held] == ids[other + held]:
            held += 1
        shared[place] = held
    return [0, *(shared[p] for p in order[1:])]


class Interval:
    """A node of the tree: the places of its suffixes, in order and by the word to their left."""

    __slots__ = ("shared", "places", "classes")

    def __init__(self, shared: int, place: int, left: int):
        self.shared, self.places, self.classes = shared, [place], {left: [place]}


def join_children(one: Interval, other: Interval, shared: int, reach: int, left: dict[int, int], found: Callable) -> Interval:
    """Report the maximal pairs of two children of a node that are at most ``reach`` apart; join them.

    Places of different children differ in the word behind the shared ones, places of different
    classes in the word before them. The smaller child looks into the larger one. Within reach all
    places but the first of a run have one left word, so that what is passed over is reported or cheap.
    """
    if len(one.places) < len(other.places):
        one, other = other, one
    places, classes = one.places, one.classes
    for word, members in other.classes.items():
        same = classes.get(word, ())
        for place in members:
            low, high = bisect_left(places, place - reach), bisect_right(places, place + reach)
            if low == high:
                continue
            if same and bisect_right(same, place + reach) - bisect_left(same, place - reach) == high - low:
                continue
            if len(classes) <= high - low:
                for beside, listed in classes.items():
                    if beside != word:
                        for there in listed[bisect_left(listed, place - reach) : bisect_right(listed, place + reach)]:
                            found(place, there, shared)
            else:
                for there in places[low:high]:
                    if left[there] != word:
                        found(place, there, shared)
    for word, members in other.classes.items():
        into = classes.setdefault(word, [])
        for place in members:
            insort(into, place)
            insort(places, place)
    return one


def maximal_runs(
    ids: list[int], start: int, end: int, order: list[int], least: int, exponent: int
) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of the text that stands from ``start`` to ``end`` in ``ids``.

    ``order`` has the suffixes that share enough words with another, in order. A maximal pair of
    equal stretches at distance p, p at most their length over (exponent - 1), is the run of
    period p from the first one's begin to the second one's end: nothing needs to be extended.
    Multiples of a period give the same run, of which the smallest counts.
    """
    fewest = shortest_pair(least, exponent)
    runs: dict[tuple[int, int], int] = {}
    left = {place: ids[place - 1] if place > start else -1 for place in order}

    def found(one: int, other: int, shared: int) -> None:
        period = abs(one - other)
        if shared + period >= least:
            key = min(one, other) - start, shared + period
            runs[key] = min(runs.get(key, period), period)

    def joined(below: Interval, above: Interval) -> Interval:
        node = join_children(above, below, above.shared, above.shared // (exponent - 1), left, found)
        node.shared = above.shared
        return node

    stack: list[Interval] = []
    last: Interval | None = None
    for place, shared in zip(order, shared_prefixes(ids, order, end, fewest), strict=True):
        if last is not None:
            depth = shared if shared >= fewest else -1
            while stack and stack[-1].shared > depth:
                shared_above = stack[-1].shared
                last = joined(last, stack.pop())
                last.shared = shared_above
            if depth < 0:
                stack = []
            elif stack and stack[-1].shared == depth:
                stack[-1] = joined(last, stack[-1])
            else:
                last.shared = depth
                stack.append(last)
        last = Interval(0, place, left[place])
    while stack:
        last = joined(last, stack.pop())
    return sorted((begin, length, period) for (begin, length), period in runs.items())


def runs_of_texts(listed: list[list[str]], least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as lists of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in listed]
    flat = [w for own in listed for w in own]
    known = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    ids = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
    sizes = np.array([len(own) for own in listed], np.int64)
    owner = np.repeat(np.arange(len(listed)), sizes)
    places = repeated_places(ids, owner, shortest_pair(least, exponent))
    if not len(places):
        return out
    # Only texts with such places are sorted.
    texts = np.unique(owner[places])
    chosen = np.zeros(len(listed), bool)
    chosen[texts] = True
    part = np.flatnonzero(chosen[owner])
    places = np.searchsorted(part, places)
    ids, owner = ids[part], owner[part]
    rank = suffix_ranks(ids, owner)
    places = places[np.argsort(rank[places], kind="stable")]
    places = places[np.argsort(owner[places], kind="stable")]
    words, of_place = ids.tolist(), owner[places]
    starts = np.searchsorted(owner, texts)
    ends = np.searchsorted(owner, texts, "right")
    cuts = np.searchsorted(of_place, np.append(texts, len(listed)))
    for n, text in enumerate(texts.tolist()):
        order = places[cuts[n] : cuts[n + 1]].tolist()
        out[text] = maximal_runs(words, int(starts[n]), int(ends[n]), order, least, exponent)
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words with one period of each run left, joined by spaces."""
    if not runs:
        return " ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return " ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def find_runs(
    docs: DataFrame,
    least: int = LEAST_LENGTH,
    exponent: int = LEAST_EXPONENT,
    listed: Callable[[object, str | None], list[str]] = lambda doc_id, text: words_of(text),
) -> DataFrame:
    """The periodic runs of words of each document, and its text with one period of each left.

    A run is a stretch of words with smallest period p and a length of at least ``least`` words and
    ``exponent`` periods that neither neighbour extends. ``listed`` gives the words of a row, runs
    of anything but spaces and the control characters 9 to 13. Every document is looked at whole
    within one task, in n log n steps and memory in proportion to its words; nothing is shuffled.
    Null and empty texts have no words and no runs. Rows that repeat a document give repeated
    rows; other columns are ignored.

    Result: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.
    """
    if exponent < 2 or least < 1:
        raise ValueError("a run repeats at least once")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for start, end in text_pieces(texts):
                words = [listed(i, t) for i, t in zip(ids[start:end].to_pylist(), texts[start:end], strict=True)]
                runs = runs_of_texts(words, least, exponent)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[start:end],
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array(
                            [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs],
                            pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])),
                        ),
                        pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id {kind}, {RESULT}")


def with_periodic_tail(doc_id, text: str | None) -> list[str]:
    """The words of a document; in a tenth of them, by hash of the id, the tail repeats itself.

    A null id counts as the empty text.
    """
    words = words_of(text)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    whole, rest = divmod(n - at, period)
    unit = words[at : at + period]
    return words[:at] + unit * whole + unit[:rest]


def runs_query(spark, sf_dir) -> DataFrame:
    found = find_runs(documents(spark, sf_dir), listed=with_periodic_tail)
    # The greatest length, then the smallest start, then the smallest period.
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(order)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), listing.alias("listing")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.length) div -best.p").alias("exponent_milli"),
        F.sha2("listing", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
