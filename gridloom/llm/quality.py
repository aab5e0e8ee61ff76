"""Quality of documents: random-indexing word vectors, pooled, and a small network."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, id_remainder, labelled_texts, score_texts, table

# Bound of the training sample: texts of each label, and characters of each text.
SAMPLE_TEXTS = 2000
LONGEST_SAMPLE = 50_000
DIMENSIONS = 48
NONZERO = 4
WINDOW = 2
HIDDEN = 24
EPOCHS = 40
THRESHOLD = 0.5

_TOKEN = re.compile(r"\w+|[^\w\s]+|\n+")


def tokens(text: str) -> list[str]:
    """Words, runs of marks, and line ends."""
    return _TOKEN.findall(text)


def shape(token: str) -> str:
    """What kind of token it is: case for words, the mark itself for marks."""
    if not token[0].isalnum() and token[0] != "_":
        return token[0] * min(len(token), 3)
    if token.isdigit():
        return "9"
    case = "X" if token.isupper() else "x" if token.islower() else "Xx"
    return case + ("+" if len(token) > 8 else "")


def index_vector(name: str) -> np.ndarray:
    """A sparse vector of +1 and -1 that depends on the name alone."""
    bits = np.random.default_rng(xxhash.xxh64_intdigest(name))
    vector = np.zeros(DIMENSIONS, np.float32)
    vector[bits.choice(DIMENSIONS, NONZERO, replace=False)] = bits.choice([-1.0, 1.0], NONZERO)
    return vector


class WordVectors:
    """Random indexing: a word's vector sums the index vectors of its neighbours, and its own shape's.

    Words seen fewer than twice, and words not seen, share the vector of their shape.
    """

    def __init__(self, listed: list[list[str]]):
        counts: dict[str, int] = {}
        for words in listed:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
        shapes = sorted({shape(w) for w in counts} | {"?"})
        frequent = sorted(w for w, n in counts.items() if n > 1)
        self.shape_rows = {s: i for i, s in enumerate(shapes)}
        self.rows = {w: i + len(shapes) for i, w in enumerate(frequent)}
        own = np.stack([index_vector("shape " + s) for s in shapes] + [index_vector(w) for w in frequent])
        shape_of = np.array(list(range(len(shapes))) + [self.shape_rows[shape(w)] for w in frequent])
        sums = np.zeros_like(own)
        for words in listed:
            ids = self.ids(words)
            for gap in range(1, WINDOW + 1):
                np.add.at(sums, ids[gap:], own[ids[:-gap]])
                np.add.at(sums, ids[:-gap], own[ids[gap:]])
        # A shape's vector is the mean direction of its words.
        by_shape = np.zeros((len(shapes), DIMENSIONS), np.float32)
        np.add.at(by_shape, shape_of, sums)
        sums[: len(shapes)] = by_shape
        sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-6)
        self.vectors = (sums + own[shape_of]).astype(np.float32)

    def ids(self, words: list[str]) -> np.ndarray:
        rows, shapes = self.rows, self.shape_rows
        found = [rows.get(w, -1) for w in words]
        for i, row in enumerate(found):
            if row < 0:
                found[i] = shapes.get(shape(words[i]), shapes["?"])
        return np.array(found, np.int32)

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Per text: mean and deviation of its word vectors, share of new words, repeats, length."""
        out = np.zeros((len(texts), 2 * DIMENSIONS + 4), np.float32)
        for i, text in enumerate(texts):
            words = tokens(text)
            if not words:
                continue
            ids = self.ids(words)
            distinct, counts = np.unique(ids, return_counts=True)
            share = (counts / len(ids)).astype(np.float32)
            vectors = self.vectors[distinct]
            mean = share @ vectors
            out[i, :DIMENSIONS] = mean
            out[i, DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(share @ vectors**2 - mean**2, 0))
            out[i, -4] = (ids < len(self.shape_rows)).mean()
            out[i, -3] = (ids[1:] == ids[:-1]).mean() if len(ids) > 1 else 0
            out[i, -2] = len(distinct) / len(ids)
            out[i, -1] = np.log1p(len(ids)) / 10
        return out


def fit_network(x: np.ndarray, y: np.ndarray, weights: np.ndarray, hidden: int, epochs: int, seed: int = 5):
    """A layer of rectified units and a logistic one, by Adam on weighted cross-entropy."""
    rng = np.random.default_rng(seed)
    shapes = [(x.shape[1], hidden), (hidden,), (hidden,), ()]
    p = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), shapes[0]), np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(()),
    ]
    m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for begin in range(0, len(x), 64):
            rows = order[begin : begin + 64]
            a = x[rows] @ p[0] + p[1]
            h = np.maximum(a, 0)
            off = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[rows]) * weights[rows] / len(rows)
            back = np.outer(off, p[2]) * (a > 0)
            grads = [x[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ off, off.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g**2
                p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return p


def calibrate(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The temperature with the least weighted cross-entropy on held-out logits."""
    def loss(t: float) -> float:
        z = logits / t
        return float(np.average(np.logaddexp(0, z) - y * z, weights=weights))

    return min(np.exp(np.linspace(np.log(0.25), np.log(8), 61)), key=loss)


@dataclass
class QualityModel:
    words: WordVectors
    center: np.ndarray
    scale: np.ndarray
    network: list
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> np.ndarray:
        x = (self.words.pooled(texts) - self.center) / self.scale
        first, bias, second, last = self.network
        return np.maximum(x @ first + bias, 0) @ second + last

    def __call__(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts) / self.temperature, -40, 40)))


class Constant:
    """The score of every text where nothing can be learnt."""

    def __init__(self, value: float):
        self.value = value

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.value)


def train(sample: list[tuple[str, int]], counts: dict[int, int]):
    """Fit on four of five texts, calibrate on the fifth; weights undo the even choice of labels."""
    labels = np.array([y for _, y in sample], float)
    if len(sample) < 10 or labels.min() == labels.max():
        return Constant(counts.get(1, 0) / sum(counts.values()) if counts else 0.5)
    weights = np.where(labels == 1, counts[1] / labels.sum(), counts[0] / (1 - labels).sum())
    weights /= weights.mean()
    texts = [t for t, _ in sample]
    held = np.arange(len(texts)) % 5 == 0
    words = WordVectors([tokens(t) for t, h in zip(texts, held, strict=True) if not h])
    x = words.pooled(texts)
    center, scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 0.05
    x = (x - center) / scale
    network = fit_network(x[~held], labels[~held], weights[~held], HIDDEN, EPOCHS)
    model = QualityModel(words, center, scale, network)
    model.temperature = calibrate(model.logits([t for t, h in zip(texts, held, strict=True) if h]), labels[held], weights[held])
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_TEXTS, longest: int = LONGEST_SAMPLE
) -> DataFrame:
    """Probability that a document is of good quality, from its whole text.

    Word vectors and network are learnt from a bounded sample of labelled texts (see
    ``labelled_texts``; ids whose crc32 modulo 3 is 1 are held out), on the driver; all texts are
    scored. Texts pool the mean and deviation of their word vectors, the shares of new words and of
    words that repeat the one before, and their length. Empty and null texts pool zeros. Without
    labels of both kinds the score is the share of good ones, or 0.5. One row per input row.

    Result: doc_id, score.
    """
    sample, counts = labelled_texts(docs, labels, "quality", per_label, longest, 3, 1)
    return score_texts(docs, train(sample, counts))


def quality_query(spark, sf_dir) -> DataFrame:
    scored = score_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
