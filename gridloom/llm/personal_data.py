"""Personal data in documents: fixed patterns, and a skip-chain conditional random field."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, uniform_hash

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
# Bound of the training sample: documents, and characters of each.
SAMPLE_DOCUMENTS = 3000
LONGEST_SAMPLE = 50_000
# Tokens up to so many characters apart stand next to each other in the chain.
NEAR = 40
# Messages are sent anew until they change by no more than this, each at most so many times: that
# bounds the work where messages of a loop never settle, and not how far evidence travels.
SETTLED = 1e-4
SENDINGS = 1000
# A span beside the fixed patterns needs this belief.
BELIEF = 0.9
# Similar tokens are held to one entity by this much, and kept from one being none by half of it.
TOGETHER = 4.0
MASK = "[{}]"

# The base patterns. Where a leftmost match must begin at the start of a run of
# digits, a look-behind says so, and possessive repeats keep long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What may be an entity: words around an @, and runs of digits with the marks that join them.
_SIGN = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[0-9().+\x20-]*[0-9])?")
_WORD_END = frozenset(" \t\n\r\f\v@<>()[],;:\"'")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches of each kind that do not overlap, failing ones dropped; by start, then kind."""
    found = []
    at = text.find("@") if text else -1
    free = 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free, "email"))
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 or int(part.lstrip("0")[:4] or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens that may be personal data, by start; numbers inside a word around an @ belong to it."""
    if not _SIGN.search(text):
        return []
    words, at = [], text.find("@")
    while at >= 0:
        start, end = at, at + 1
        floor = words[-1][1] if words else 0
        while start > floor and text[start - 1] not in _WORD_END:
            start -= 1
        while end < len(text) and text[end] not in _WORD_END:
            end += 1
        words.append((start, end))
        at = text.find("@", end)
    numbers = [m.span() for m in _NUMBER.finditer(text)]
    if not words:
        return numbers
    found, i = list(words), 0
    for start, end in numbers:
        while i < len(words) and words[i][1] <= start:
            i += 1
        if i == len(words) or words[i][0] >= end:
            found.append((start, end))
    return sorted(found)


def features(text: str, start: int, end: int) -> list[str]:
    """What a token looks like, apart from its exact characters, and the words beside it."""
    token = text[start:end]
    digits = _digits(token)
    marks = "".join(sorted({c for c in token if not c.isalnum()}))
    parts = [p for p in re.split(r"[^0-9]+", token) if p]
    before = re.search(r"(\w+)\W{0,3}$", text[max(0, start - 24) : start])
    after = re.match(r"\W{0,3}(\w+)", text[end : end + 24])
    return [
        "bias",
        f"digits {min(len(digits), 20)}",
        f"marks {marks}",
        f"parts {min(len(parts), 6)}",
        f"longest {min(max(map(len, parts), default=0), 17)}",
        f"large {max((int(p[:4]) for p in parts), default=0) > 255}",
        f"luhn {len(digits) >= 12 and luhn(digits)}",
        f"mail {bool(re.search(r'[^@]@[^@]+[.][^@]', token))}",
        f"plus {token.startswith('+')}",
        f"glued {bool(start and text[start - 1].isalnum())}{bool(end < len(text) and text[end].isalnum())}",
        f"before {(before[1].lower() if before else '')[:8]}",
        f"after {(after[1].lower() if after else '')[:8]}",
    ]


def same_key(token: str) -> str:
    """Tokens with one key are the same or similar: letters in lower case, digits without the marks between."""
    return token.lower() if "@" in token else _digits(token)[-10:]


@dataclass
class Graph:
    """The tokens of some texts: features, given labels, and edges of the chain and across it."""

    spans: list[tuple[int, int, int]]  # text, start, end
    features: list[list[str]]
    labels: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def build_graph(texts: list[str], bases: list[list[tuple[int, int, str]]], certain: bool = False) -> Graph:
    """Edges join tokens that stand near each other, and each token with the next similar one.

    Similar tokens form a path, not all pairs, so that edges grow with the tokens. Along a path
    evidence fades with each token that looks like none. With ``certain``, what the patterns found
    counts as certain, and each similar token has its edge with the nearest of those before it, or
    else with the first: all hear of the evidence in full, however many there are.
    """
    spans, listed, labels, chain = [], [], [], []
    groups: dict[tuple[int, str], list[int]] = {}
    for number, (text, base) in enumerate(zip(texts, bases, strict=True)):
        exact = {(s, e): LABELS.index(k) for s, e, k in base}
        last, at = None, 0
        for start, end in candidates(text):
            here = len(spans)
            spans.append((number, start, end))
            listed.append(features(text, start, end))
            label = exact.get((start, end), 0)
            if not label and base:
                while at < len(base) and base[at][1] <= start:
                    at += 1
                over = [k for s, e, k in base[at : at + 4] if s < end and e > start]
                label = LABELS.index(over[0]) if over else 0
            labels.append(label)
            if last is not None and start - spans[last][2] <= NEAR:
                chain.append((last, here))
            key = same_key(text[start:end])
            if len(key) >= 6:
                groups.setdefault((number, key), []).append(here)
            last = here
    skip = [edge for group in groups.values() for edge in similar_edges(group, labels, certain)]
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return Graph(spans, listed, np.array(labels, np.int64), pairs(chain), pairs(skip))


def similar_edges(group: list[int], labels: list[int], certain: bool) -> list[tuple[int, int]]:
    """Edges among similar tokens of a text: each with the one before, or with a token that has a label."""
    held = next((i for i in group if labels[i]), None) if certain else None
    if held is None:
        return list(zip(group[:-1], group[1:], strict=True))
    edges = []
    for i in group:
        if labels[i]:
            held = i
        else:
            edges.append((min(i, held), max(i, held)))
    return edges


class SkipChain:
    """Weights of token features, of neighbours in the chain, and of similar tokens."""

    def __init__(self, names: list[str]):
        self.rows = {n: i for i, n in enumerate(names)}
        k = len(LABELS)
        self.unary = np.zeros((len(names), k))
        self.chain = np.zeros((k, k))
        self.skip = np.zeros((k, k))

    def scores(self, listed: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of each token's labels; and which weights each token uses."""
        tokens, rows = [], []
        for i, names in enumerate(listed):
            for n in names:
                row = self.rows.get(n)
                if row is not None:
                    tokens.append(i)
                    rows.append(row)
        tokens, rows = np.array(tokens, np.int64), np.array(rows, np.int64)
        scores = np.zeros((len(listed), len(LABELS)))
        np.add.at(scores, tokens, self.unary[rows])
        return scores, tokens, rows

    def beliefs(self, scores: np.ndarray, graph: Graph, rounds: int | None = None):
        """Loopy message passing: beliefs of tokens and of both kinds of edges.

        Messages travel in both directions of all edges at once, with half of each new message
        mixed in: ``rounds`` rounds, or until all have settled. A message is sent anew while it or
        one of those it depends on moves, so that work follows the evidence.
        """
        edges = np.concatenate([graph.chain, graph.skip])
        kinds = np.concatenate([np.zeros(len(graph.chain), int), np.ones(len(graph.skip), int)])
        n, k = len(edges), len(LABELS)
        if not n:
            return _normal(scores), np.zeros((0, k, k)), kinds
        tables = np.stack([self.chain, self.skip])[kinds]
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        table = np.concatenate([tables, tables.transpose(0, 2, 1)])
        twin = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
        messages = np.zeros((2 * n, k))
        total, times, live, done = scores.copy(), np.zeros(2 * n, np.int64), np.arange(2 * n), 0
        while len(live) and (rounds is None or done < rounds):
            given = total[source[live]] - messages[twin[live]]
            sent = _log_sum(given[:, :, None] + table[live], axis=1)
            sent -= _log_sum(sent, axis=1)[:, None]
            step = 0.5 * (sent - messages[live])
            messages[live] += step
            np.add.at(total, target[live], step)
            done += 1
            if rounds is None:
                times[live] += 1
                moved = np.abs(step).max(axis=1) > SETTLED
                heard = np.zeros(len(scores), bool)
                heard[target[live[moved]]] = True
                again = heard[source]
                again[live[moved]] = True
                live = np.flatnonzero(again & (times < SENDINGS))
        total = scores.copy()
        np.add.at(total, target, messages)
        left = total[edges[:, 0]] - messages[n:]
        right = total[edges[:, 1]] - messages[:n]
        pair = left[:, :, None] + tables + right[:, None, :]
        pair = np.exp(pair - _log_sum(_log_sum(pair, axis=2), axis=1)[:, None, None])
        return _normal(total), pair, kinds


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _normal(x: np.ndarray) -> np.ndarray:
    return np.exp(x - _log_sum(x, axis=1)[:, None])


def train(texts: list[str], rounds: int = 120, rate: float = 0.3, decay: float = 1e-3) -> SkipChain:
    """Fit to what the base patterns say of the sample, by gradient ascent with loopy beliefs.

    The features leave out the exact form that the patterns ask for, so that the field learns what
    entities look like and where they stand. Similar tokens are held together by a fixed bonus for
    equal entity labels on top of what is learnt: the patterns alone never disagree enough to teach
    it.
    """
    graph = build_graph(texts, [base_spans(t) for t in texts])
    counts: dict[str, int] = {}
    for names in graph.features:
        for n in names:
            counts[n] = counts.get(n, 0) + 1
    field = SkipChain(sorted(n for n, c in counts.items() if c > 2))
    if not len(graph.labels):
        return field
    k = len(LABELS)
    truth = np.eye(k)[graph.labels]
    _, tokens, rows = field.scores(graph.features)
    use = np.bincount(rows, minlength=len(field.rows)) + 1.0
    weights = [field.unary, field.chain, field.skip]
    sums = [np.zeros_like(w) for w in weights]
    edges = np.concatenate([graph.chain, graph.skip])
    for _ in range(rounds):
        scores = np.zeros((len(graph.labels), k))
        np.add.at(scores, tokens, field.unary[rows])
        belief, pair, kinds = field.beliefs(scores, graph, rounds=4)
        off = truth - belief
        grads = [np.zeros_like(w) for w in weights]
        np.add.at(grads[0], rows, off[tokens])
        grads[0] /= np.sqrt(use)[:, None]
        if len(edges):
            seen = truth[edges[:, 0]][:, :, None] * truth[edges[:, 1]][:, None, :]
            for kind in (0, 1):
                grads[1 + kind] = (seen - pair)[kinds == kind].sum(axis=0) / np.sqrt((kinds == kind).sum() + 1)
        for w, g, s in zip(weights, grads, sums, strict=True):
            g = g - decay * w
            s += g * g
            w += rate * g / np.sqrt(s + 1e-6)
    field.skip += TOGETHER * np.diag([0.0] + [1.0] * len(KINDS))
    field.skip[0, 1:] -= TOGETHER / 2
    field.skip[1:, 0] -= TOGETHER / 2
    return field


def field_spans(field: SkipChain, texts: list[str], bases: list[list[tuple[int, int, str]]]) -> list[list[tuple[int, int, str]]]:
    """Spans the field adds in each text: tokens it believes in that no base span touches.

    What the patterns found is certain evidence: those tokens are held to their label, and all
    similar tokens of the text hear of it.
    """
    added: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    graph = build_graph(texts, bases, certain=True)
    if not graph.spans:
        return added
    scores, _, _ = field.scores(graph.features)
    known = graph.labels > 0
    scores[known] += 20.0 * np.eye(len(LABELS))[graph.labels[known]]
    belief, _, _ = field.beliefs(scores, graph)
    best = belief.argmax(axis=1)
    for i in np.flatnonzero((best > 0) & ~known & (belief.max(axis=1) >= BELIEF)):
        number, start, end = graph.spans[i]
        added[number].append((start, end, LABELS[best[i]]))
    return added


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one, of the first kind."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK.format(kind)]
        at = max(at, end)
    return "".join(out) + text[at:]


def trained(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> SkipChain:
    """The field, learnt from a bounded sample of documents that hold a digit or an @."""
    usable = docs.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= LONGEST_SAMPLE))
    n = usable.count()
    rows = usable.where(uniform_hash("doc_id", 31) < sample_documents / max(n, 1)).select("doc_id", "text").collect()
    return train([r["text"] for r in sorted(rows, key=lambda r: (str(r["doc_id"]), r["text"]))])


def all_spans(field: SkipChain, texts: list[str]):
    """Spans of the patterns in each text, and those with the field's."""
    bases = [base_spans(t) for t in texts]
    added = field_spans(field, texts, bases)
    order = lambda x: (x[0], KINDS.index(x[2]), x[1])
    return bases, [sorted(b + a, key=order) for b, a in zip(bases, added, strict=True)]


def find_personal_data(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """All personal data of each document, by fixed patterns and by a skip-chain field.

    The field is learnt from about ``sample_documents`` documents that hold a digit or an @, chosen
    by a hash of the id, whole texts of at most ``LONGEST_SAMPLE`` characters. All documents are
    searched whole. Null texts count as empty. One row per input row; other columns are ignored.

    Result: doc_id, base (spans of the patterns), spans (those and the field's), masked_text; a
    span is a struct of start, end (code points, end exclusive) and kind, by start.
    """
    held = docs.sparkSession.sparkContext.broadcast(trained(docs, sample_documents))

    def search(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            step = 512
            for begin in range(0, len(texts), step):
                part = [t or "" for t in texts[begin : begin + step]]
                bases, spans = all_spans(held.value, part)
                struct = lambda found: [[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[begin : begin + step],
                        pa.array(struct(bases), _SPANS),
                        pa.array(struct(spans), _SPANS),
                        pa.array([masked(t, s) if s else t for t, s in zip(part, spans, strict=True)], pa.string()),
                    ],
                    ["doc_id", "base", "spans", "masked_text"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start: long, end: long, kind: string>>"
    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {kind}, base {spans}, spans {spans}, masked_text string"
    )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def without_personal_data(docs: DataFrame) -> DataFrame:
    """All documents in their own columns, each span of personal data masked by its kind.

    n_chars, where there is one, is the length of the masked text where that changed.
    """
    held = docs.sparkSession.sparkContext.broadcast(trained(docs))
    names = docs.columns

    def mask(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            changed, sizes = [], batch.column("n_chars").to_pylist() if "n_chars" in names else None
            for begin in range(0, len(texts), 512):
                part = [t or "" for t in texts[begin : begin + 512]]
                for i, (text, spans) in enumerate(zip(part, all_spans(held.value, part)[1], strict=True), begin):
                    changed.append(masked(text, spans) if spans else texts[i])
                    if spans and sizes:
                        sizes[i] = len(changed[i])
            batch = batch.set_column(names.index("text"), "text", pa.array(changed, batch.column("text").type))
            if sizes:
                at = names.index("n_chars")
                batch = batch.set_column(at, "n_chars", pa.array(sizes, batch.column(at).type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)


def personal_data_query(spark, sf_dir) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))

    def listed(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[_count(kind) for kind in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
