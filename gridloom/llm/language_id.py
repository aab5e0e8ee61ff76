"""Language identification by interpolated Kneser-Ney language models over characters."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, id_remainder, label_sample, small_batches, text_pieces

ORDER = 4
# Bound of the training sample, in documents of each language and characters of each document.
SAMPLE_DOCUMENTS = 400
LONGEST_SAMPLE = 50_000
# A text is rejected when its cross-entropy is so many deviations above what held-out texts of
# the language have.
DEVIATIONS = 6.0
# Least deviation between texts of a language: one that quotes another language stays.
LEAST_DEVIATION = 0.2
UNDETERMINED = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def words_of_letters(codes: np.ndarray) -> np.ndarray:
    """Which characters are letters, but for those in a run with digits: keys and numbers tell no language."""
    letters = letter_table()[codes]
    digits = (codes >= 48) & (codes <= 57)
    inside = letters | digits
    run = np.cumsum(inside & ~np.concatenate([[False], inside[:-1]]))
    marked = np.zeros(run[-1] + 1 if len(run) else 1, bool)
    marked[run[digits]] = True
    return letters & ~marked[run]


def encode(texts: list[str], pad: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters with single spaces between words; where each text starts, and its end.

    ``pad`` spaces stand before and after every text, so that no n-gram reaches into the next one;
    the first of them after a text counts as its end. All other characters count as space.
    """
    lowered = [t.lower() for t in texts]
    gap = "\n" * pad
    codes = np.frombuffer((gap + gap.join(lowered) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in lowered], np.int64)
    ends = np.cumsum(lengths + pad)
    letters = words_of_letters(codes)
    codes = np.where(letters, codes, np.uint32(_SPACE))
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    keep[:pad] = True
    keep[(ends[:, None] + np.arange(pad)).ravel()] = True
    places = np.cumsum(keep) - keep
    return codes[keep], places[ends - lengths], places[ends] + 1


def grams(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each place, for n up to ``order``; before the start is space."""
    wide = codes.astype(np.uint64) + np.uint64(1)
    keys = [wide]
    for _ in range(1, order):
        before = np.empty_like(wide)
        before[0] = _SPACE + 1
        before[1:] = keys[-1][:-1]
        keys.append(before * _STEP + wide)
    return [mixed(k) for k in keys]


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = keys ^ (keys >> np.uint64(29))
    keys = keys * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(32))


@dataclass
class HashArray:
    """Rows by key, in arrays sorted by key; the leading bits of a key lead to its place."""

    keys: np.ndarray
    rows: np.ndarray
    bits: int = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.bits = max(1, int(np.ceil(np.log2(max(2, len(self.keys))))) + 1)
        heads = (self.keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.starts = np.searchsorted(heads, np.arange(1 << self.bits)).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        last = len(self.keys) - 1
        if last < 0:
            return np.zeros(len(keys), np.int32), np.zeros(len(keys), bool)
        at = np.minimum(self.starts[keys >> np.uint64(64 - self.bits)], last)
        below = np.flatnonzero((self.keys[at] < keys) & (at < last))
        while len(below):
            at[below] += 1
            below = below[(self.keys[at[below]] < keys[below]) & (at[below] < last)]
        return at, self.keys[at] == keys


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _lookup(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray, missing) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(keys), missing, values.dtype)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], missing)


class KneserNey:
    """Counts of one language; used only to fill the shared arrays."""

    def __init__(self, codes: np.ndarray, order: int):
        levels = grams(codes, order)
        self.order = order
        self.alphabet = max(2, len(np.unique(codes)) + 1)
        # For each order: gram, its context and its tail, once for every different gram.
        self.grams, self.counts, context, tail = [], [], [], []
        for n in range(order):
            keys, first, counts = np.unique(levels[n], return_index=True, return_counts=True)
            before = np.maximum(first - 1, 0)
            context.append(levels[n - 1][before] if n else np.zeros(len(keys), np.uint64))
            tail.append(levels[n - 1][first] if n else keys)
            self.grams.append(keys)
            self.counts.append(counts.astype(np.float64))
        # Below the highest order a gram counts once for each different letter before it.
        for n in range(order - 1):
            keys, counts = _counted(tail[n + 1])
            self.counts[n] = _lookup(keys, counts.astype(np.float64), self.grams[n], 0.0)
        self.totals, self.followers, self.discounts, self.contexts = [], [], [], []
        for n in range(order):
            ones, twos = (self.counts[n] == 1).sum(), (self.counts[n] == 2).sum()
            self.discounts.append(ones / (ones + 2 * twos) if ones and twos else 0.5)
            keys, index = np.unique(context[n], return_inverse=True)
            self.contexts.append(keys)
            self.totals.append(np.bincount(index, self.counts[n], len(keys)))
            self.followers.append(np.bincount(index, self.counts[n] > 0, len(keys)))

    def backoff(self, n: int, contexts: np.ndarray) -> np.ndarray:
        """What a context of an n-gram leaves to the order below; all of it where it is new."""
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(self.totals[n] > 0, self.discounts[n] * self.followers[n] / self.totals[n], 1.0)
        return _lookup(self.contexts[n], left, contexts, 1.0)

    def probability(self, n: int, keys: np.ndarray, contexts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        counts = _lookup(self.grams[n], self.counts[n], keys, 0.0)
        totals = _lookup(self.contexts[n], self.totals[n], contexts, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.where(totals > 0, np.maximum(counts - self.discounts[n], 0.0) / totals, 0.0)
        return seen + self.backoff(n, contexts) * lower


class LanguageModels:
    """Models of all languages in shared sorted hash arrays, one row per gram, one column per language.

    A row holds the interpolated log-probability, so that the longest known gram answers at once;
    for a gram unknown to all languages the rows of its context give what is left to the next
    shorter one.
    """

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.languages = sorted(samples)
        self.order = order
        coded = [encode(samples[name], order)[0] for name in self.languages]
        models = [KneserNey(codes, order) for codes in coded]
        seen = [grams(codes, order) for codes in coded]
        self.grams, self.contexts = [], []
        self.unknown = np.log([1.0 / m.alphabet for m in models]).astype(np.float32)
        lower = None  # rows of the order below, by key
        for n in range(order):
            pairs = []
            for levels in seen:
                keys, first = np.unique(levels[n], return_index=True)
                before = np.maximum(first - 1, 0)
                pairs.append((keys, levels[n - 1][before] if n else np.zeros(len(keys), np.uint64),
                              levels[n - 1][first] if n else np.zeros(len(keys), np.uint64)))
            keys, first = np.unique(np.concatenate([p[0] for p in pairs]), return_index=True)
            contexts = np.concatenate([p[1] for p in pairs])[first]
            tails = np.concatenate([p[2] for p in pairs])[first]
            rows = np.empty((len(keys), len(models)))
            for column, model in enumerate(models):
                base = np.full(len(keys), 1.0 / model.alphabet) if lower is None else _lookup(
                    lower[0], lower[1][:, column], tails, 1e-9)
                rows[:, column] = model.probability(n, keys, contexts, base)
            lower = (keys, rows)
            self.grams.append(HashArray(keys, np.log(rows).astype(np.float32)))
            known = np.unique(contexts)
            left = np.stack([m.backoff(n, known) for m in models], axis=1)
            self.contexts.append(HashArray(known, np.log(np.maximum(left, 1e-9)).astype(np.float32)))

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of every place under every language."""
        levels = grams(codes, self.order)
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        todo = None
        for n in reversed(range(self.order)):
            keys = levels[n] if todo is None else levels[n][todo]
            at, known = self.grams[n].find(keys)
            if todo is None:
                out += self.grams[n].rows[at] * known[:, None]
                todo = np.flatnonzero(~known)
            else:
                out[todo[known]] += self.grams[n].rows[at[known]]
                todo = todo[~known]
            if not len(todo):
                return out
            if n:
                at, known = self.contexts[n].find(levels[n - 1][np.maximum(todo - 1, 0)])
                out[todo[known]] += self.contexts[n].rows[at[known]]
        out[todo] += self.unknown
        return out

    def cross_entropies(self, texts: list[str], piece: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, mean negative log-probability of its characters; and their number."""
        codes, first, last = encode(texts, self.order)
        total = np.zeros((len(texts), len(self.languages)))
        for begin in range(0, len(codes), piece):
            end = min(len(codes), begin + piece)
            ahead = max(0, begin - self.order)
            held = self.log_probabilities(codes[ahead:end])[begin - ahead :]
            sums = np.vstack([np.zeros((1, held.shape[1])), np.cumsum(held, axis=0, dtype=np.float64)])
            low, high = np.searchsorted(last, begin, side="right"), np.searchsorted(first, end, side="left")
            total[low:high] += sums[np.minimum(last[low:high], end) - begin] - sums[np.maximum(first[low:high], begin) - begin]
        sizes = last - first
        return -total / np.maximum(sizes, 1)[:, None], sizes


@dataclass
class Identifier:
    models: LanguageModels
    # Per language of held-out texts: mean cross-entropy, its deviation between long texts, and
    # the deviation of one character.
    mean: np.ndarray
    between: np.ndarray
    within: np.ndarray
    sharpness: float

    def judge(self, texts: list[str]):
        """Language, confidence, cross-entropy and rejection of each text."""
        entropies, sizes = self.models.cross_entropies(texts)
        letters = np.array([any(c.isalpha() for c in t) for t in texts], bool)
        best = entropies.argmin(axis=1)
        rows = np.arange(len(texts))
        lowest = entropies[rows, best]
        weight = self.sharpness * np.sqrt(np.maximum(sizes, 1))[:, None]
        score = 1.0 / np.exp(-(entropies - lowest[:, None]) * weight).sum(axis=1)
        allowed = self.mean[best] + DEVIATIONS * np.sqrt(
            self.between[best] ** 2 + self.within[best] ** 2 / np.maximum(sizes, 1)
        )
        names = [self.models.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0), lowest, (lowest > allowed) | ~letters


def train(rows: list[tuple[str, str]], order: int = ORDER) -> Identifier | None:
    """Models from four of five of the (language, text) rows, calibrated on the fifth."""
    by_language: dict[str, list[str]] = {}
    for language, text in rows:
        if any(c.isalpha() for c in text):
            by_language.setdefault(language, []).append(text)
    if not by_language:
        return None
    fit = {k: [t for i, t in enumerate(v) if i % 5 or len(v) < 5] for k, v in by_language.items()}
    models = LanguageModels(fit, order)
    held = [(k, t) for k, v in by_language.items() for i, t in enumerate(v) if not i % 5]
    names = np.array([models.languages.index(k) for k, _ in held])
    entropies, sizes = models.cross_entropies([t for _, t in held])
    own = entropies[np.arange(len(held)), names]
    mean, between, within = (np.zeros(len(models.languages)) for _ in range(3))
    for i in range(len(models.languages)):
        mine = names == i
        mean[i] = np.average(own[mine], weights=sizes[mine])
        off = own[mine] - mean[i]
        long = sizes[mine] >= np.median(sizes[mine])
        between[i] = max(LEAST_DEVIATION, np.sqrt(np.mean(off[long] ** 2)))
        within[i] = max(1.0, np.sqrt(np.median(off**2 * sizes[mine]) / 0.455))
    best, sharpness = np.inf, 1.0
    for tried in (0.25, 0.5, 1.0, 2.0, 4.0, 8.0):
        logits = -entropies * tried * np.sqrt(np.maximum(sizes, 1))[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        loss = np.mean(np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(held)), names])
        if loss < best - 1e-9:
            best, sharpness = loss, tried
    return Identifier(models, mean, between, within, sharpness)


def trained(
    labelled: DataFrame, order: int = ORDER, per_language: int = SAMPLE_DOCUMENTS, longest: int = LONGEST_SAMPLE
) -> Identifier | None:
    """Models and calibration from a bounded sample of labelled rows; nothing without any."""
    sample = label_sample(labelled.where(id_remainder("doc_id", 4) != 2), "lang", per_language, longest)
    return train([(r["lang"], r["text"]) for r in sample], order)


def judged(identifier: Identifier | None, texts: list[str]):
    if identifier is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), [None] * len(texts), np.ones(len(texts), bool)
    return identifier.judge(texts)


def identify_languages(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    order: int = ORDER,
    per_language: int = SAMPLE_DOCUMENTS,
    longest: int = LONGEST_SAMPLE,
) -> DataFrame:
    """Language of every whole text by the lowest cross-entropy per character.

    One Kneser-Ney model per language is learnt from ``labelled`` (``docs`` where not given): about
    ``per_language`` rows of each value of lang, chosen by a hash of the id, whole texts of at most
    ``longest`` characters, and only rows whose crc32 of the id modulo 4 is not 2. The sample is
    bounded, so that it and the models pass through the driver. Every text is scored.

    A text whose cross-entropy is far above that of held-out texts of its language is rejected;
    the room grows for short texts. Null texts and texts without a letter are ``und``, score 0 and
    rejected. Without any labelled row all are. One row per input row; other columns are ignored.

    Result: doc_id, lang_pred, score, cross_entropy (null where there is no model), rejected.
    """
    labelled = docs if labelled is None else labelled
    model = trained(labelled, order, per_language, longest)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in text_pieces(texts):
                found = judged(held.value, texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[start:end],
                        pa.array(found[0], pa.string()),
                        pa.array(found[1], pa.float64()),
                        pa.array(found[2], pa.float64()),
                        pa.array(found[3], pa.bool_()),
                    ],
                    names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )


def known_languages(docs: DataFrame) -> DataFrame:
    """The documents whose language is not rejected, in their own columns, one pass after training.

    Without any labelled row nothing can be judged, and all documents stay.
    """
    small_batches(docs.sparkSession)
    identifier = trained(docs)
    if identifier is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(identifier)

    def keep(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in text_pieces(texts):
                rejected = held.value.judge(texts[start:end])[3]
                yield batch.slice(start, end - start).filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)


def language_query(spark, sf_dir) -> DataFrame:
    found = identify_languages(documents(spark, sf_dir))
    return found.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred",
        F.col("score"), "rejected",
    )
