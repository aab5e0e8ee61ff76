"""Each operator against a brute-force version, an exact round trip or held-out labels."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from gridloom.llm import decontaminate, embedding_join, language_id, licenses, mixing, ngram_join, personal_data, quality, toxicity, warc
from gridloom.llm.queries import CHECKS, QUERIES
from tests import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    found = compare.duck(FOLDER)
    for name in ("documents", "pages"):
        found.execute(f"create or replace view {name} as select * from '{FOLDER}/{name}.parquet'")
    return found


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), con, CHECKS[name]) is None


def test_license_templates_by_counting(spark):
    rng = random.Random(1)
    templates = [(label, licenses.template_words(text), len(re.findall("[a-zA-Z0-9]+", text))) for label, text in licenses.TEMPLATES]
    texts = []
    for _ in range(60):
        words = rng.choices(["lorem", "of", "the", "ipsum", "dolor", "any"], k=rng.randint(0, 80))
        label, text = rng.choice(licenses.TEMPLATES)
        held = [w for w in text.split() if rng.random() < 0.9]
        at = rng.randint(0, len(words))
        texts.append(" ".join(words[:at] + held + words[at:]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: set(r["labels"].split(",")) - {""} for r in licenses.scan_licenses(frame).collect()}
    for i, text in enumerate(texts):
        words = re.findall("[a-z0-9]+", text.lower())
        want = {v for p, v in licenses.PHRASES.items() if f" {p} " in f" {' '.join(words)} "}
        for label, held, n_words in templates:
            length = next(n for n in licenses.LENGTHS if n >= n_words)
            for start in range(0, max(len(words), 1), length):
                if len(set(words[start : start + 2 * length]) & set(held)) >= licenses.CONTAINMENT * len(held) - 1e-9:
                    want.add(label)
        assert got[i] == want, text


def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([1, 5, 20, 200]), rng.choice("aaaaaabbc") if i % 50 else "d") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(frame).collect()
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in out:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    limit = {s: 3 * n for s, n in size.items()}
    weights = dict(zip(sorted(size), [5, 2, 1, 5], strict=True))
    want, open_ = {}, set(size)
    while True:
        left = sum(size.values()) - sum(want.values())
        share = {s: left * weights[s] / sum(weights[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > limit[s]}
        if not over:
            want |= share
            break
        want |= {s: float(limit[s]) for s in over}
        open_ -= over
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 100  # half of the longest document


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_recovers_all_but_damaged(compress):
    rng = random.Random(3)
    payloads = [bytes(rng.choices(b"ab \r\n", k=rng.randint(0, 400))) + b"WARC/1.1\r\nWARC-Type: response\r\n" for _ in range(40)]
    separator = warc.EMPTY_MEMBER if compress else b"\r\n\r\n"
    records = [warc.record_bytes(i, "http://x/", p, warc.base32_digest(p), None, compress) + separator for i, p in enumerate(payloads)]
    whole = b"".join(records)
    assert [r[4]["payload"] for r in warc.salvage(whole)] == payloads
    for _ in range(60):
        hurt = rng.sample(range(40), 3)
        parts = list(records)
        for i in hurt:
            cut = rng.randrange(1, len(parts[i]) - 40)
            parts[i] = rng.choice([
                parts[i][:cut] + b"\x00" + parts[i][cut + 1 :],
                parts[i][:cut],
                parts[i][:cut] + bytes(rng.choices(range(256), k=9)) + parts[i][cut:],
            ])
        data = b"".join(parts)
        found = list(warc.salvage(data))
        kept = {int(re.sub("[^0-9]", "", r[4]["record_id"] or "") or 99) for r in found if r[2] == "record"}
        assert kept >= set(range(40)) - set(hurt)
        sound = [r[4] for r in found if r[2] == "record" and (compress or r[4]["record_id"] in {str(i) for i in range(40) if i not in hurt})]
        assert all(payloads[int(r["record_id"])] == r["payload"] for r in sound)
        spans = sorted((r[0], r[1]) for r in found)
        assert spans[-1][0] + spans[-1][1] <= len(data)
        if compress and kept != set(range(40)):
            assert any(r[2] == "gap" and r[3] for r in found)


def test_archive_gaps_are_logged(spark, tmp_path):
    payload = b"hello"
    record = warc.record_bytes(5, "http://x/", payload, warc.base32_digest(payload), None, True)
    (tmp_path / "a.warc.gz").write_bytes(record + b"junk" + record[:30] + record)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r["kind"] for r in rows] == ["record", "gap", "record"]
    assert (rows[1]["start"], rows[1]["length"]) == (len(record), 34)


def _distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_passages_by_brute_force():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    for _ in range(60):
        items = [(i, rng.choices(words, k=rng.randint(5, 90))) for i in range(3)]
        texts = []
        for _ in range(5):
            text = rng.choices(words, k=rng.randint(0, 30))
            part = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 8)):
                k = rng.randrange(len(part))
                part[k : k + rng.choice([0, 1])] = rng.choice([[], [rng.choice(words)]]) or [rng.choice(words)]
            at = rng.randint(0, len(text))
            texts.append(text[:at] + part + text[at:])
        found: dict = {}
        for t, i, d, *_ in decontaminate.Passages([(i, " ".join(w)) for i, w in items]).matches([" ".join(t) for t in texts]):
            found[t, i] = min(d, found.get((t, i), 99))
        want = {(t, i): _distance(p, w) for t, w in enumerate(texts) for i, p in items}
        assert found == {k: d for k, d in want.items() if d <= decontaminate.budget(len(items[k[1]][1]))}


def _mutated(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("bucket", [4, 512])
def test_near_copies_by_brute_force(spark, bucket):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    common = rng.choices(vocabulary, k=60)
    texts = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.randint(6, 300))
        texts += [" ".join(_mutated(rng, base, rng.randint(0, max(1, len(base) // 40)))) for _ in range(rng.randint(1, 9))]
    big = rng.choices(vocabulary, k=250)
    texts += [" ".join(_mutated(rng, big, 2)) for _ in range(60)]  # one group larger than a bucket
    texts += [" ".join(rng.choices(vocabulary, k=80) + common) for _ in range(40)]  # one shared passage
    texts += texts[:5] + ["one two", "One, two!", "", "three"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in ngram_join.join_documents(frame, bucket=bucket).collect()}
    sets = []
    for text in texts:
        w = re.findall(r"\w+", text.lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(texts)
    linked = [[i != j and bool(a) and len(a & b) >= 0.8 * len(a | b) - 1e-9 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    root = list(range(n))
    while True:
        new = [min([root[i]] + [root[j] for j in range(n) if linked[i][j]]) for i in range(n)]
        if new == root:
            break
        root = new
    for i in range(n):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (sum(linked[i]), root[i], root[i] == i)


def test_dense_bucket_is_compared_in_chunks(spark, monkeypatch):
    """Blocks of a dealt bucket count every pair once."""
    from gridloom.llm import buckets

    monkeypatch.setattr(buckets.dealt_blocks, "__defaults__", (16,))
    rng = random.Random(6)
    base = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join(_mutated(rng, base, 1))) for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.join_documents(frame).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(89, 0)}


def test_embeddings_by_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 24))
    x[:200] = x[0] + 0.15 * rng.normal(size=(200, 24))
    x[300:320] = x[300]
    x[400:440] = x[440:480] + 0.3 * rng.normal(size=(40, 24))
    x = x.astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while True:
        new = np.array([min(root[i], root[linked[i]].min(initial=10**6)) for i in range(len(x))])
        if (new == root).all():
            break
        root = new
    assert linked.sum() > 3000
    for blocks in (1, 4):
        got = {r["vec_id"]: r for r in embedding_join.join_embeddings(frame, blocks=blocks).collect()}
        assert all((got[i]["n_links"], got[i]["component_id"]) == (linked[i].sum(), root[i]) for i in range(len(x)))


def test_kneser_ney_sums_to_one_and_interpolates():
    text = "abracadabra banana bandana cabana"
    models = language_id.LanguageModels({"x": [text], "y": ["zyx wvu zyx"]}, 3)
    codes = language_id.encode([text])[0]
    for context in ("ab", "na", "zz"):
        total = 0.0
        for c in np.unique(codes):
            probe = np.array([32] + [ord(k) for k in context] + [c], np.uint32)
            total += float(np.exp(models.log_probabilities(probe)[-1, 0]))
        assert 0.85 < total <= 1.0 + 1e-6, context  # the rest is kept for letters not seen


def test_keys_and_numbers_tell_no_language():
    codes, first, last = language_id.encode(["Ab c3d 12 efg", "9x9", ""])
    words = ["".join(map(chr, codes[a:b])) for a, b in zip(first, last, strict=True)]
    assert words[0].split() == ["ab", "efg"] and words[1].strip() == words[2].strip() == ""


def test_language_pieces_do_not_change_scores():
    samples = {"x": ["hello there general text of words " * 9], "y": ["otra lengua con palabras distintas " * 9]}
    models = language_id.LanguageModels(samples)
    texts = ["hello words", "", "lengua otra " * 50, "a\nb", "İstanbul there"]
    whole, sizes = models.cross_entropies(texts)
    cut, _ = models.cross_entropies(texts, piece=7)
    assert np.allclose(whole, cut, atol=1e-4)
    alone = np.vstack([models.cross_entropies([t])[0] for t in texts])
    assert np.allclose(whole, alone, atol=1e-4)


def test_personal_data_patterns_by_plain_expressions():
    def plain(text):
        out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(int(x) <= 255 for x in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = [int(c) for c in m[0] if c.isdigit()][::-1]
            if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
                out.append((m.start(), m.end(), "card"))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
        return sorted(out, key=lambda s: (s[0], personal_data.KINDS.index(s[2]), s[1]))

    rng = random.Random(8)
    for alphabet, n in (("a1.@+-% ()25", 12000), ("0123456789 -", 6000)):
        for _ in range(n):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
            assert personal_data.base_spans(text) == plain(text)


def test_skip_chain_carries_labels_and_long_runs_end():
    calls = [f"call +1 ({i:03}) 555-{i:04} or mail x{i}@y.org from 10.0.{i % 200}.1 please" for i in range(300)]
    field = personal_data.train(calls + ["version 2.0 of 1999 and 12 more"] * 50)
    text = "Call +1 (243) 555-5526 now, or again (243) 555-5526. Version 3.0 of 1999."
    base, spans = personal_data.all_spans(field, [text])
    assert [k for _, _, k in base[0]] == ["phone"]
    assert (37, 51, "phone") in spans[0] and all(e <= 52 for _, e, _ in spans[0])
    assert personal_data.masked(text, base[0]).startswith("Call [phone] now")
    for text in ("1" * 200_000, "a" * 200_000, "a@" * 20_000, "1.1." * 30_000, "+1 " * 30_000, "1 " * 60_000):
        personal_data.all_spans(field, [text])


def _held_out(spark, name, modulus, remainder, labels):
    rows = QUERIES[name](spark, "/root/testdata/sf0.1").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder) for r in rows)
    return [(r, labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def _labels(spark, column):
    frame = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", column)
    return {r[0]: r[1] for r in frame.collect()}


def test_language_accuracy(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang")
    rows = _held_out(spark, "op8_language_id", 4, 2, {r[0]: r[1] for r in frame.collect()})
    assert np.mean([r["lang_pred"] == y for r, y in rows]) > 0.995
    assert not any(r["rejected"] for r, _ in rows)


def test_toxicity_accuracy(spark):
    rows = _held_out(spark, "op6_toxicity", 4, 2, _labels(spark, "toxic"))
    assert np.mean([r["predicted"] == y for r, y in rows]) > 0.94


def test_quality_accuracy(spark):
    rows = _held_out(spark, "op10_quality", 3, 1, _labels(spark, "quality"))
    assert np.mean([r["predicted"] == y for r, y in rows]) > 0.98


def test_toxicity_gradients():
    network = toxicity.Network({"a": 0.1, "b": -0.2, "cc": 0.3})
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    network.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    words, rng = ["a", "b", "cc", "zz"], np.random.default_rng(0)
    ids, here = rng.integers(0, 4, (5, toxicity.WIDTH)), np.ones((5, toxicity.WIDTH), bool)
    here[2, 20:] = False
    y = np.array([0, 1, 0, 1, 1.0])

    def loss():
        z = network.logits(network.inputs(words)[0].astype(float), ids, here).astype(float)
        return np.mean(np.logaddexp(0, z) - y * z)

    before = {k: v.copy() for k, v in network.p.items()}
    network.step(words, ids, here, y, 0.0)
    for k, v in before.items():
        grad = np.atleast_1d(network.moments[k][0] / 0.1)
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        ends = []
        for move in (0.01, -0.01):
            network.p = {n: x.copy() for n, x in before.items()}
            changed = np.atleast_1d(network.p[k]).copy()
            changed[at] += move
            network.p[k] = changed.reshape(v.shape)
            ends.append(loss())
        assert (ends[0] - ends[1]) / 0.02 == pytest.approx(grad[at], rel=1e-2, abs=1e-5)


def test_random_indexing_puts_like_words_together():
    texts = [["the", w, "sat", "on", "it"] for w in ("cat", "dog") for _ in range(5)] + [["of", "a", "tall", "tree", "."]] * 5
    vectors = quality.WordVectors(texts)
    v = {w: vectors.vectors[vectors.rows[w]] for w in ("cat", "dog", "tree")}
    close = lambda a, b: float(v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]))
    assert close("cat", "dog") > close("cat", "tree")


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    leak = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    planted = spark.createDataFrame(
        [(10**6, f"Und dann und der die {leak} in das", "de", "src1", 9), (10**6 + 1, "1234 ... 5678", "en", "src1", 9),
         (10**6 + 2, "Ththe andthe that the thing with a.b@example.com in the inand", "en", "src2", 9)], docs.schema
    )
    frame = docs.unionByName(planted)
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, stage(spark, frame, FOLDER).cache()
        ids = {r["doc_id"] for r in frame.select("doc_id").collect()}
        if name == "language":
            assert 10**6 + 1 not in ids and frame.count() >= before.count() - 2
        if name == "near_copies":
            kept = {r["doc_id"] for r in ngram_join.join_documents(before).where("kept").collect()}
            assert ids == kept
        if name == "decontamination":
            leaks = {r["doc_id"] for r in decontaminate.find_passages(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
            assert 10**6 in leaks and ids == {r["doc_id"] for r in before.collect()} - leaks
        if name == "personal_data":
            assert frame.count() == before.count()
            assert "a.b@example.com" not in frame.where(f"doc_id = {10**6 + 2}").first()["text"]
        if name == "mixing":
            assert all(r["copies"] > 0 for r in frame.collect())


def test_every_mention_hears_of_certain_evidence():
    field = personal_data.SkipChain(["bias"])  # every token leans to none of the kinds
    field.unary[0, 0] = 2.0
    field.skip = personal_data.TOGETHER * np.diag([0.0, 1, 1, 1, 1])
    field.skip[0, 1:] = field.skip[1:, 0] = -personal_data.TOGETHER / 2
    filler = "and the mill stood empty for as long as anybody in town knew how to say"
    mentions = [f"{filler} (243) 555-5526 {filler}."] * 30
    for at in (0, 15, 30):
        text = " ".join(mentions[:at] + [f"{filler} +1 (243) 555-5526 {filler}."] + mentions[at:])
        (base,), (spans,) = personal_data.all_spans(field, [text])
        assert len(base) == 1 and [k for _, _, k in spans] == ["phone"] * 31
        assert "5526" not in personal_data.masked(text, spans)


def test_messages_settle_on_long_paths():
    """On a path of similar tokens without certain ones the beliefs are those of the exact sums."""
    field = personal_data.SkipChain([])
    k, n = len(personal_data.LABELS), 60
    field.skip = 3.0 * np.eye(k)
    scores = np.zeros((n, k))
    scores[0, 4], scores[1:, 0] = 9.0, 0.05
    edges = np.array([(i, i + 1) for i in range(n - 1)])
    graph = personal_data.Graph([], [], np.zeros(n, np.int64), np.zeros((0, 2), np.int64), edges)
    forward, backward = np.ones((n, k)), np.ones((n, k))
    for i in range(1, n):
        forward[i] = (forward[i - 1] * np.exp(scores[i - 1])) @ np.exp(field.skip)
        forward[i] /= forward[i].sum()
        j = n - 1 - i
        backward[j] = np.exp(field.skip) @ (backward[j + 1] * np.exp(scores[j + 1]))
        backward[j] /= backward[j].sum()
    exact = forward * np.exp(scores) * backward
    belief, _, _ = field.beliefs(scores, graph)
    assert np.abs(belief - exact / exact.sum(axis=1, keepdims=True)).max() < 0.01


@pytest.mark.parametrize("recall, threshold", [(0.9999, 0.8), (0.99, 0.8), (0.999, 0.9)])
def test_runs_reach_the_recall_at_the_deepest_level(recall, threshold):
    runs = ngram_join.runs_for(recall, threshold)
    assert 1 - (1 - threshold**ngram_join.LEVELS) ** runs >= recall
    assert runs * ngram_join.LEVELS <= ngram_join.SKETCH


def test_each_place_of_a_repeated_item_is_found(spark, monkeypatch):
    item = "a quick brown fox jumps over the lazy dog today"
    near = item.replace("brown", "red")
    texts = [f"{item} {item}", f"{near} so {item} {near} and {item}", " ".join([item] * 50), near]
    found = decontaminate.Passages([(1, item)]).matches(texts)
    assert [(d, a, b) for t, _, d, a, b in found if t == 0] == [(0, 0, 9), (0, 10, 19)]
    assert [(d, a, b) for t, _, d, a, b in found if t == 1] == [(1, 0, 9), (0, 11, 20), (1, 21, 30), (0, 32, 41)]
    assert [(d, a, b) for t, _, d, a, b in found if t == 2] == [(0, 10 * i, 10 * i + 9) for i in range(50)]
    assert [(d, a, b) for t, _, d, a, b in found if t == 3] == [(1, 0, 9)]
    # Items of the same words are one, however many blocks there are.
    monkeypatch.setattr(decontaminate, "BLOCK_CHARACTERS", 20)
    items = [(i, t) for i, t in enumerate([item, item.upper(), item.replace(" ", ", "), f"{item}!", f"({item})"], 1)]
    docs = spark.createDataFrame([(7, f"so {item} then")], "doc_id long, text string")
    rows = decontaminate.find_passages(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in rows] == [(7, 1, 0)]


def test_leaks_take_no_clean_document_along(spark, monkeypatch):
    item = "a quick brown fox jumps over the lazy dog today"
    other = "nine other words that stand in another block alone"
    rows = [(None, f"so {item} then"), (None, "clean and whole"), (1, item), (1, "clean as well"), (2, other), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    for size in (8_000_000, 20):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARACTERS", size)
        left = decontaminate.without_passages(docs, items).collect()
        assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left) == [(0, "clean and whole"), (1, "clean as well"), (3, "")]
