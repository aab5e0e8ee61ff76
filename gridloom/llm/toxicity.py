"""Toxicity of documents: a bidirectional gated recurrent network with attention over windows."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, id_remainder, labelled_texts, score_texts, table
from gridloom.llm.quality import Constant

# Bound of the training sample: texts of each label, and characters of each text.
SAMPLE_TEXTS = 2500
LONGEST_SAMPLE = 50_000
WIDTH = 32
STRIDE = 16
WORD_SIZE, CHAR_SIZE, CHAR_ROWS = 8, 8, 4096
HIDDEN, ATTENTION = 8, 8
EPOCHS = 8
# A word has a row of its own when it stands in so many texts of the sample.
LEAST_TEXTS = 8
DROPPED = 0.2
DECAY = 0.02
THRESHOLD = 0.3

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character trigrams of all words, one after the other, and where each word starts."""
    codes = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = codes.astype(np.uint64)
    keys = (wide[:-2] * np.uint64(0x9E3779B1) + wide[1:-1]) * np.uint64(0x85EBCA77) + wide[2:]
    rows = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % CHAR_ROWS
    # A trigram belongs to the word of its middle character.
    inside = codes[1:-1] != 10
    lengths = np.array([len(w) for w in words])
    return rows[inside], np.concatenate([[0], np.cumsum(lengths)[:-1]])


def windows(n_words: int) -> list[int]:
    """Starts of windows that overlap by half and cover all words."""
    return list(range(0, max(n_words - STRIDE, 1), STRIDE)) if n_words else []


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Word rows and character rows -> two gated recurrent passes -> attention -> one logit."""

    def __init__(self, vocabulary: dict[str, float], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rows = {w: i + 1 for i, w in enumerate(vocabulary)}  # row 0: words not known
        size, h = WORD_SIZE + CHAR_SIZE, HIDDEN

        def drawn(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        self.p = {
            "word": rng.normal(0, 0.1, (len(vocabulary) + 1, WORD_SIZE)).astype(np.float32),
            "char": rng.normal(0, 0.3, (CHAR_ROWS, CHAR_SIZE)).astype(np.float32),
            "in": drawn(size, 6 * h), "bias": np.zeros(6 * h, np.float32),
            "fore": drawn(h, 3 * h), "back": drawn(h, 3 * h),
            "att": drawn(2 * h, ATTENTION), "att_out": drawn(ATTENTION),
            "out": drawn(2 * h), "last": np.zeros((), np.float32),
        }
        # The first place of a known word starts as its log-odds of standing in a text of label 1.
        self.p["word"][1:, 0] = np.fromiter(vocabulary.values(), np.float32, len(vocabulary))
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    def inputs(self, words: list[str], dropped: np.ndarray | None = None):
        """Input vectors of different words, with what is needed to train them."""
        rows = np.array([self.rows.get(w, 0) for w in words], np.int64)
        if dropped is not None:
            rows[dropped] = 0
        chars, starts = trigrams(words)
        lengths = np.diff(np.append(starts, len(chars)))
        char = np.add.reduceat(self.p["char"][chars], starts, axis=0) / lengths[:, None]
        return np.hstack([self.p["word"][rows], char]).astype(np.float32), (rows, chars, lengths)

    def passes(self, projected: np.ndarray, ids: np.ndarray, here: np.ndarray, keep: bool):
        """States of both directions, batch x place x 2 hidden; ``keep``: with the gates."""
        h, (batch, width) = HIDDEN, ids.shape
        states = np.zeros((batch, width, 2 * h), np.float32)
        gates = {}
        for way, (name, order) in enumerate((("fore", range(width)), ("back", reversed(range(width))))):
            weights, at = self.p[name], np.zeros((batch, h), np.float32)
            part = projected[:, way * 3 * h : (way + 1) * 3 * h]
            for t in order:
                given, own = part[ids[:, t]], at @ weights
                zr = sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(given[:, 2 * h :] + r * own[:, 2 * h :])
                after = np.where(here[:, t, None], new + z * (at - new), at)
                if keep:
                    gates[way, t] = (at, z, r, new, own[:, 2 * h :])
                at = after
                states[:, t, way * h : (way + 1) * h] = at
        return states, gates

    def pooled(self, states: np.ndarray, here: np.ndarray):
        inner = np.tanh(states @ self.p["att"])
        weight = np.where(here, inner @ self.p["att_out"], -30.0)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pool = np.einsum("bt,bth->bh", weight, states)
        return pool, weight, inner, pool @ self.p["out"] + self.p["last"]

    def logits(self, vectors: np.ndarray, ids: np.ndarray, here: np.ndarray, batch: int = 2048) -> np.ndarray:
        projected = vectors @ self.p["in"] + self.p["bias"]
        out = np.empty(len(ids), np.float32)
        for b in range(0, len(ids), batch):
            states, _ = self.passes(projected, ids[b : b + batch], here[b : b + batch], False)
            out[b : b + batch] = self.pooled(states, here[b : b + batch])[3]
        return out

    def step(self, words: list[str], ids: np.ndarray, here: np.ndarray, y: np.ndarray, rate: float, dropped=None) -> float:
        """One step of Adam on the cross-entropy of a batch of windows; large tables decay."""
        p, h = self.p, HIDDEN
        vectors, (rows, chars, lengths) = self.inputs(words, dropped)
        projected = vectors @ p["in"] + p["bias"]
        states, gates = self.passes(projected, ids, here, True)
        pool, weight, inner, logit = self.pooled(states, here)
        off = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["out"], grad["last"] = pool.T @ off, off.sum()
        d_pool = np.outer(off, p["out"])
        d_states = weight[:, :, None] * d_pool[:, None, :]
        d_weight = np.einsum("bh,bth->bt", d_pool, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        grad["att_out"] = np.einsum("bt,bta->a", d_score, inner)
        d_inner = d_score[:, :, None] * p["att_out"] * (1 - inner**2)
        grad["att"] = np.einsum("bth,bta->ha", states, d_inner)
        d_states += d_inner @ p["att"].T
        d_projected = np.zeros_like(projected)
        width = ids.shape[1]
        for way, (name, order) in enumerate((("fore", reversed(range(width))), ("back", range(width)))):
            carried = np.zeros((len(ids), h), np.float32)
            for t in order:
                before, z, r, new, own = gates[way, t]
                total = carried + d_states[:, t, way * h : (way + 1) * h]
                live = np.where(here[:, t, None], total, 0)
                d_z = live * (before - new) * z * (1 - z)
                d_new = live * (1 - z) * (1 - new**2)
                d_r = d_new * own * r * (1 - r)
                d_own = np.hstack([d_z, d_r, d_new * r])
                np.add.at(d_projected[:, way * 3 * h : (way + 1) * 3 * h], ids[:, t], np.hstack([d_z, d_r, d_new]))
                grad[name] += before.T @ d_own
                carried = np.where(here[:, t, None], live * z, total) + d_own @ p[name].T
        grad["in"], grad["bias"] = vectors.T @ d_projected, d_projected.sum(axis=0)
        d_vectors = d_projected @ p["in"].T
        np.add.at(grad["word"], rows, d_vectors[:, :WORD_SIZE])
        np.add.at(grad["char"], chars, np.repeat(d_vectors[:, WORD_SIZE:] / lengths[:, None], lengths, axis=0))
        self.steps += 1
        for k, g in grad.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            if k in ("word", "char"):
                p[k] = p[k] * (1 - rate * DECAY)
            p[k] = p[k] - (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)).astype(np.float32)
        return float(np.mean(np.logaddexp(0, logit) - y * logit))


def stacked(listed: list[list[str]]):
    """Different words, and all windows of all texts: word places, which are filled, and their text."""
    place: dict[str, int] = {}
    flat = np.array([place.setdefault(w, len(place)) for words in listed for w in words], np.int64)
    ends = np.cumsum([len(words) for words in listed]) if listed else np.zeros(0, int)
    starts, owner = [], []
    for i, words in enumerate(listed):
        own = windows(len(words))
        starts += [ends[i] - len(words) + s for s in own]
        owner += [i] * len(own)
    if not starts:
        return list(place), np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), bool), np.zeros(0, int)
    owner = np.array(owner)
    at = np.array(starts)[:, None] + np.arange(WIDTH)
    here = at < ends[owner][:, None]
    return list(place), flat[np.minimum(at, len(flat) - 1)], here, owner


def text_logits(network: Network, texts: list[str]) -> np.ndarray:
    """The largest logit of a text's windows; very low for a text without words."""
    words, ids, here, owner = stacked([words_of(t) for t in texts])
    out = np.full(len(texts), -20.0)
    if len(ids):
        np.maximum.at(out, owner, network.logits(network.inputs(words)[0], ids, here))
    return out


@dataclass
class ToxicityModel:
    network: Network
    slope: float = 1.0
    shift: float = 0.0

    def __call__(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.slope * text_logits(self.network, texts) + self.shift)


def calibrate(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-out logits, by Newton's method."""
    x = np.stack([np.clip(logits, -20, 20), np.ones(len(logits))], axis=1)
    fit = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ fit)
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        fit = fit - np.linalg.solve(bend, x.T @ (weights * (p - y)) + 1e-3 * (fit - [1.0, 0.0]))
    return float(max(fit[0], 0.05)), float(fit[1])


def train(sample: list[tuple[str, int]], counts: dict[int, int], seed: int = 3):
    """Learn windows from labels of whole texts, fit on four of five texts, calibrate on the fifth.

    A text is as toxic as its worst window: each round takes every text's worst window as the
    network sees it (at first: the one with the most telling word), and another window of each
    text of label 0.
    """
    labels = np.array([y for _, y in sample], float)
    if len(sample) < 10 or labels.min() == labels.max():
        return Constant(counts.get(1, 0) / sum(counts.values()) if counts else 0.0)
    listed = [words_of(t) for t, _ in sample]
    held = np.arange(len(sample)) % 5 == 0
    seen: dict[str, list[int]] = {}
    for words, y, h in zip(listed, labels, held, strict=True):
        if not h:
            for w in set(words):
                seen.setdefault(w, [0, 0])[int(y)] += 1
    total = [(~held & (labels == k)).sum() for k in (0, 1)]
    odds = {
        w: float(np.clip(np.log((n[1] + 0.5) / (total[1] + 1)) - np.log((n[0] + 0.5) / (total[0] + 1)), -3, 3)) / 3
        for w, n in sorted(seen.items())
        if sum(n) >= LEAST_TEXTS
    }
    network = Network(odds)
    fit = np.flatnonzero(~held)
    words, ids, here, owner = stacked([listed[i] for i in fit])
    y = labels[fit]
    rng = np.random.default_rng(seed)
    telling = network.inputs(words)[0][:, 0] if words else np.zeros(0)
    value = np.where(here, telling[ids], -9).max(axis=1) if len(ids) else np.zeros(0)
    first = np.searchsorted(owner, np.arange(len(fit)))
    last = np.searchsorted(owner, np.arange(len(fit)), side="right")
    for epoch in range(EPOCHS):
        if epoch:
            value = network.logits(network.inputs(words)[0], ids, here)
        worst = [a + int(value[a:b].argmax()) for a, b in zip(first, last, strict=True) if b > a]
        other = [int(rng.integers(a, b)) for a, b, k in zip(first, last, y, strict=True) if b > a and k == 0]
        chosen = rng.permutation(np.array(worst + other))
        for begin in range(0, len(chosen), 64):
            rows = chosen[begin : begin + 64]
            local, places = np.unique(ids[rows], return_inverse=True)
            network.step(
                [words[i] for i in local], places.reshape(len(rows), WIDTH), here[rows], y[owner[rows]],
                0.01 if epoch < EPOCHS - 3 else 0.003, rng.random(len(local)) < DROPPED,
            )
    weights = np.where(labels == 1, counts[1] / labels.sum(), counts[0] / (1 - labels).sum())
    logits = text_logits(network, [t for (t, _), h in zip(sample, held, strict=True) if h])
    return ToxicityModel(network, *calibrate(logits, labels[held], weights[held] / weights.mean()))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_TEXTS, longest: int = LONGEST_SAMPLE
) -> DataFrame:
    """Probability that a document is toxic, from all overlapping windows of its whole text.

    The network is learnt on the driver from a bounded sample of labelled texts (see
    ``labelled_texts``; ids whose crc32 modulo 4 is 2 are held out); all texts are scored by their
    worst window. Texts without words, and null ones, score near 0. Without labels of both kinds
    the score is the share of toxic ones, or 0. One row per input row.

    Result: doc_id, score.
    """
    sample, counts = labelled_texts(docs, labels, "toxic", per_label, longest, 4, 2)
    return score_texts(docs, train(sample, counts))


def toxicity_query(spark, sf_dir) -> DataFrame:
    scored = score_toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
