"""Chains and other shapes of links, tiny batches, repeated ids, damaged archives, and the mix with its texts."""

import collections
import logging
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import buckets, common, decontaminate, embedding_join, mixing, ngram_join, warc

FOLDER = "/root/testdata/sf0.001"


def plain_components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def shuffled(rng, n):
    names = list(range(n))
    rng.shuffle(names)
    return names


def shapes():
    rng = random.Random(11)
    path = shuffled(rng, 5000)
    ring = shuffled(rng, 1000)
    star = shuffled(rng, 1000)
    clique = shuffled(rng, 80)
    tree = shuffled(rng, 1023)
    return {
        "path": list(zip(path, path[1:])),
        "sorted path": [(i, i + 1) for i in range(3000)],
        "ring": list(zip(ring, ring[1:] + ring[:1])),
        "star": [(star[0], x) for x in star[1:]],
        "two cliques": [(a, b) for part in (clique[:40], clique[40:]) for a in part for b in part if a != b] + [(clique[0], clique[-1])],
        "tree": [(tree[i], tree[(i - 1) // 2]) for i in range(1, 1023)],
        "random": [(rng.randrange(3000), rng.randrange(3000)) for _ in range(2500)],
        "none": [],
    }


@pytest.mark.parametrize("name", list(shapes()))
def test_components_of_shapes(spark, name, caplog):
    edges = shapes()[name]
    frame = spark.createDataFrame(edges, "u long, v long")
    with caplog.at_level(logging.INFO, logger=buckets.LOG.name):
        found = {r["node"]: r["component"] for r in buckets.components(frame).collect()}
    assert found == plain_components([(u, v) for u, v in edges if u != v])
    (rounds,) = [r.args[0] for r in caplog.records]
    assert rounds <= 4 * math.log2(max(len(found), 2))


def test_tiny_batches_have_sets():
    rng = random.Random(12)
    for _ in range(3000):
        texts = [" ".join(rng.choices("abc", k=rng.randint(0, 3))) for _ in range(rng.randint(1, 3))]
        keys, starts = ngram_join.shingle_sets(texts)
        alone = [ngram_join.shingle_sets([t])[0].tolist() for t in texts]
        assert [keys[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == alone
        # A text of fewer words than a shingle is one shingle of all of them.
        assert [len(a) for a in alone] == [int(bool(t)) for t in texts]
        same = {tuple(t.split()): a for t, a in zip(texts, alone, strict=True)}
        assert len({tuple(a) for a in same.values()}) == len(same)


@pytest.mark.parametrize("texts", [["a third text"], ["only one"], ["w", "w", "w"], ["x y"], [""]])
def test_a_short_document_alone_in_its_partition(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert ngram_join.join_documents(frame).count() == len(texts)
    assert ngram_join.one_of_each_group(frame).count() == len(set(texts))


def chain(n, rng):
    """Texts each of which is a near copy of the next only."""
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(n):
        texts.append(" ".join(words))
        words = words[1:] + [f"n{i}"]
    return texts


def test_a_chain_of_near_copies(spark):
    rng = random.Random(13)
    texts = chain(300, rng)
    ids = shuffled(rng, 300)
    frame = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    rows = ngram_join.join_documents(frame).collect()
    assert {r["component_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1
    sets = [ngram_join.shingle_sets([t])[0] for t in texts]
    links = {
        ids[i]: sum(len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) - 1e-9 for j, b in enumerate(sets) if j != i and abs(i - j) < 20)
        for i, a in enumerate(sets)
    }
    assert {r["doc_id"]: r["n_links"] for r in rows} == links
    assert [r["doc_id"] for r in ngram_join.one_of_each_group(frame).collect()] == [0]


def test_a_chain_of_embeddings(spark):
    rng = np.random.default_rng(14)
    vectors = [rng.normal(size=32)]
    vectors[0] /= np.linalg.norm(vectors[0])
    for _ in range(2999):
        step = rng.normal(size=32)
        step -= step @ vectors[-1] * vectors[-1]
        step /= np.linalg.norm(step)
        vectors.append(0.955 * vectors[-1] + math.sqrt(1 - 0.955**2) * step)
    ids = rng.permutation(3000)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>")
    rows = embedding_join.join_embeddings(frame.repartition(4)).collect()
    assert {r["component_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1


def test_recall_at_the_threshold(spark):
    """Pairs planted just above a similarity of 0.8 are all found."""
    rng = random.Random(15)
    rows, planted = [], []
    for i in range(400):
        words = [f"p{i}x{k}" for k in range(200)]
        other = list(words)
        for k in rng.sample(range(0, 200, 10), 4):
            other[k] = f"q{i}x{k}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        a, b = (set(zip(*(w[k:] for k in range(5)))) for w in (words, other))
        if 0.8 <= len(a & b) / len(a | b) < 0.86:
            planted.append(2 * i + 1)
    assert len(planted) > 300
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.join_documents(frame).collect()}
    assert all(found[i] == i - 1 for i in planted)


def test_unlike_texts_of_one_id_all_stay(spark):
    base = "the mill of the town stood empty for as long as anybody knew how to say"
    rows = [
        (1, f"{base} one and two"), (1, "nine other words that stand in another text alone for sure"), (1, None), (1, ""),
        (2, "a third text that is like none of the others in this small table"),
        (2, f"{base} one and two"),  # a copy of a text of id 1
        (3, "nine other words that stand in another text alone for sure"),
        (4, "twice the same id and text stays once here"), (4, "twice the same id and text stays once here"),
        (None, f"{base} one and two"), (None, "a text"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, __name_9 string, size int").repartition(3)
    kept = ngram_join.one_of_each_group(frame)
    assert kept.columns == frame.columns
    want = [r for i, r in enumerate(rows) if i not in (5, 6, 8)]
    key = lambda r: (r[0] or 0, str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=key) == sorted(want, key=key)


def test_a_field_of_bits_lets_all_members_through(spark):
    some = spark.range(0, 3000, 3)
    for bits in (8, 20):
        passed = set(np.flatnonzero(common.maybe_in(some, "id", bits)(pa.array(range(4000)))).tolist())
        assert passed >= set(range(0, 3000, 3))
        if bits == 20:
            assert len(passed) < 1020
    maybe = common.maybe_in(some, "id")
    assert maybe(pa.array([None, 3, 4], pa.int64())).tolist() == [False, True, False]
    assert maybe(pa.array([3, None], pa.int32())).tolist() == [True, False]
    assert not common.maybe_in(some.limit(0), "id")(pa.array(range(9))).any()


# Archives


def test_salvage_takes_time_in_proportion():
    record = warc.record_bytes(1, "http://a/", b"payload", warc.base32_digest(b"payload"), compress=False) + b"\r\n\r\n"
    for line in (b"WARC/1.1\r\n", b"xWARC/1.1\r\n", b"WARC/1.1\r\nContent-Length: 5\r\n", b"\x1f\x8b\x08"):
        data = line * (4_000_000 // len(line)) + record
        begun = time.perf_counter()
        found = list(warc.salvage(data))
        assert time.perf_counter() - begun < 20, line
        assert found[-1][2] == "record" and sum(length for _, length, *_ in found) == len(data)


def test_long_headers_come_back(spark):
    url = "http://a/" + "long path " * 240_000
    rows = [(1, url, "one"), (2, url, "one"), (3, "http://b/", "x" * 3_000_000), (4, None, None), (5, "http://WARC/1.1\r\nc", "WARC/1.1\r\n\r\n" * 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    found = warc.archive_round_trip(pages).collect()
    assert {r["kind"] for r in found} == {"record"}
    assert sorted(int(r["record_id"]) for r in found) == [1, 2, 3, 4, 5]
    got = {int(r["record_id"]): r for r in found}
    assert len(got[1]["uri"]) > 2_000_000 and got[1]["refers_to"] == "2"
    assert got[5]["payload"] == b"WARC/1.1\r\n\r\n" * 9


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SIZE_CLASSES", [(1000, 50), (10_000, 5)])
    rng = random.Random(3)
    sizes = [10] * 200 + [5000] * 30 + [50_000] * 4
    rows = [(i, f"http://a/{i}", "".join(rng.choices("abcdefgh", k=n))) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "a"))
    found = warc.read_archives(spark, str(tmp_path / "a"))
    assert found.where("kind = 'record'").count() == len(rows)
    per_file = collections.Counter(r["file"] for r in found.collect())
    assert sorted(per_file.values()) == [1] * 4 + [5] * 6 + [50] * 4


@pytest.mark.parametrize("compress", [True, False])
def test_every_tenth_record_damaged(compress):
    rng = random.Random(16)
    records = []
    for i in range(300):
        payload = bytes(rng.choices(range(256), k=rng.randint(0, 300)))
        record = warc.record_bytes(i, f"http://a/{i}", payload, warc.base32_digest(payload), compress=compress)
        records.append(record if compress else record + b"\r\n\r\n")
    whole = [i for i in range(300) if i % 10]
    for i in range(0, 300, 10):
        cut = rng.randrange(10, len(records[i]) - 10)
        kind = rng.randrange(3)
        damaged = bytearray(records[i])
        if kind == 0:
            damaged = damaged[:cut] + damaged[cut + rng.randint(1, 9) :]
        elif kind == 1:
            damaged[-12 if compress else -6] ^= 0xFF
        else:
            damaged = damaged[:cut]
        records[i] = bytes(damaged)
    found = list(warc.salvage(b"".join(records)))
    got = [int(r["record_id"]) for _, _, kind, _, r in found if kind == "record"]
    assert [i for i in got if i % 10] == whole
    assert any(kind == "gap" for _, _, kind, *_ in found)


# Passages


def test_places_are_those_of_the_text_as_it_stands(spark):
    item = "a quick brown fox jumps over the lazy dog today"
    rng = random.Random(17)
    texts = []
    for n in range(60):
        words = item.split()
        if n % 3 == 0:
            words[3] = "cat"
        shown = " ".join(w.upper() if rng.random() < 0.5 else w for w in words)
        before = "".join(rng.choices(["İ ", "İx ", "plain ", "\U0001f600 ", "ß ", "."], k=rng.randint(0, 12)))
        texts.append((f"{before} {shown} İ and more", len(before) + 1, len(before) + 1 + len(shown)))
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: (r["start"], r["end"]) for r in decontaminate.find_passages(docs, items).collect()}
    assert found == {i: (a, b) for i, (_, a, b) in enumerate(texts)}


def test_items_of_one_id_keep_their_own_length(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so one two three four five six seven eight nine then"), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "doc_id long, text string")
    found = {r["doc_id"]: r["item_words"] for r in decontaminate.find_passages(docs, items).collect()}
    assert found == {1: 9, 2: 10}


def test_short_items_are_reported_or_matched(spark):
    items = spark.createDataFrame([(1, "red fox"), (2, "one two three four five"), (3, None), (4, "Solo")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a Red, fox"), (2, "a red big fox"), (3, "solo one two three four five")], "doc_id long, text string")
    left = decontaminate.left_out_items(items)
    assert {(r["item_id"], r["item_words"]) for r in left.collect()} == {(1, 2), (3, 0), (4, 1)}
    found = lambda **k: {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.find_passages(docs, items, **k).collect()}
    assert found() == {(3, 2, 0)}
    assert found(least_words=1) == {(3, 2, 0), (1, 1, 0), (3, 4, 0)}
    assert decontaminate.left_out_items(items, 1).count() == 1
    assert [r["doc_id"] for r in decontaminate.without_passages(docs, items, least_words=1).collect()] == [2]


def test_many_places_in_one_long_text(spark):
    item = "a quick brown fox jumps over the lazy dog today"
    text = " ".join(f"{item} number {i}" for i in range(8000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begun = time.perf_counter()
    rows = decontaminate.find_passages(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert len(rows) == 8000 and time.perf_counter() - begun < 60
    assert all(text[r["start"] : r["end"]] == item for r in rows)


# Embeddings, mixing, pipeline


def test_vectors_of_any_length(spark):
    rng = np.random.default_rng(18)
    base = rng.normal(size=8)
    rows = [(i, (base * scale).tolist()) for i, scale in enumerate([1.0, 1e200, 1e-200, 1e300, 1e-300])]
    rows.append((9, (-base * 1e180).tolist()))
    found = embedding_join.join_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    assert got == {0: (4, 0), 1: (4, 0), 2: (4, 0), 3: (4, 0), 4: (4, 0), 9: (0, 9)}


def test_the_mix_returns_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    mixed = {r["doc_id"]: r for r in corpus_pipeline.mixing(spark, docs, FOLDER).collect()}
    plain = {r["doc_id"]: r for r in mixing.mix_sources(docs).collect()}
    assert set(mixed) == {i for i, r in plain.items() if r["copies"]}
    for i, r in mixed.items():
        assert r["text"] == texts[i] and all(r[c] == plain[i][c] for c in mixing.MIX_COLUMNS)
    assert set(docs.columns) <= set(corpus_pipeline.mixing(spark, docs, FOLDER).columns)


def test_mix_of_repeated_rows_and_null_ids(spark):
    rng = random.Random(19)
    rows = [(None if i % 3 else i // 9, "w " * rng.randint(0, 30), rng.choice(["a", "a", "b", None]), 5) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(4)
    first = mixing.mixed_documents(docs)
    assert first.columns == ["doc_id", "text", "source", *mixing.MIX_COLUMNS]
    assert sorted(map(str, first.collect())) == sorted(map(str, mixing.mixed_documents(docs.repartition(7)).collect()))
    taken, target = collections.Counter(), {}
    for r in mixing.mix_sources(docs).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= 0.05 * t for s, t in target.items())
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_mix_cut_in_few_bins(spark, monkeypatch):
    """Whatever the number of bins, the same rows are taken."""
    rng = random.Random(20)
    rows = [(i, "w " * rng.choice([1, 5, 20, 200]), rng.choice("aaaaaabbc")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(str, mixing.mix_sources(docs).collect()))
    for bins in (1, 3, 64):
        monkeypatch.setattr(mixing, "BINS", bins)
        assert sorted(map(str, mixing.mix_sources(docs).collect())) == want


def test_documents_without_copies_are_not_shuffled(spark):
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(50))) for i in range(200)] + [(500, " ".join(f"t0x{k}" for k in range(50)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = ngram_join.one_of_each_group(frame)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(200))
    union = kept._jdf.queryExecution().optimizedPlan()
    assert union.nodeName() == "Union" and "Join" not in union.children().head().toString()


def test_a_worker_holds_few_texts_and_words_at_once(spark, monkeypatch):
    """Batches held 10,000 texts of any length, and half a million words stayed in each worker."""
    from gridloom.llm import common, ngram_join

    before = spark.conf.get(common.BATCH_ROWS)
    try:
        spark.conf.unset(common.BATCH_ROWS)
        docs = spark.range(20).selectExpr("id as doc_id", "concat('some words of the text ', id % 10) as text")
        assert ngram_join.one_of_each_group(docs).count() == 10
        assert int(spark.conf.get(common.BATCH_ROWS)) == common.TEXTS_PER_BATCH
        spark.conf.set(common.BATCH_ROWS, "7")
        common.small_batches(spark)
        assert spark.conf.get(common.BATCH_ROWS) == "7"
    finally:
        spark.conf.set(common.BATCH_ROWS, before)
    monkeypatch.setattr(ngram_join, "_words", {})
    texts = [" ".join(f"w{i}" for i in range(k, k + 30_000)) for k in range(0, 240_000, 30_000)]
    whole = ngram_join.shingle_sets(texts)[0]
    parts = [ngram_join.shingle_sets([t])[0] for t in texts]
    assert sum(map(len, parts)) == len(whole)
    assert all((a == b).all() for a, b in zip(parts, [whole[i * len(parts[0]) :][: len(parts[0])] for i in range(8)], strict=True))
    assert len(ngram_join._words) <= ngram_join.WORDS + 30_000


def test_languages_are_told_from_small_batches(spark):
    """The first stage of the pipeline took 10,000 texts of any length at once; only near copies bounded them."""
    from gridloom.llm import common, language_id

    before = spark.conf.get(common.BATCH_ROWS)
    try:
        spark.conf.unset(common.BATCH_ROWS)
        docs = spark.range(3000).selectExpr("id as doc_id", "concat('some words of the text ', id) as text", "'en' as lang")
        assert language_id.known_languages(docs).count() > 0
        assert int(spark.conf.get(common.BATCH_ROWS)) == common.TEXTS_PER_BATCH
    finally:
        spark.conf.set(common.BATCH_ROWS, before)


def test_embeddings_are_written_a_few_times_only(spark, tmp_path, monkeypatch):
    """Vectors that fill their dimensions evenly visit many cells; what is written does not grow with these."""
    monkeypatch.setattr(embedding_join, "LEAST_CHUNK", 300)
    rng = np.random.default_rng(31)
    x = rng.normal(size=(3000, 64)).astype(np.float32)
    x[:40] = x[40:80] * 2 + 0.02 * rng.normal(size=(40, 64)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(common, "shared_folder", lambda _: f"{tmp_path}/{len(list(tmp_path.iterdir()))}")
    rows = embedding_join.join_embeddings(frame).collect()
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 4 * x.nbytes
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows} == {
        i: (1, i % 40) if i < 80 else (0, i) for i in range(3000)
    }


def test_embeddings_that_share_a_hash(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "vector_key", lambda: F.size("vector") % 1)
    rows = [(1, [0.0, 1.0]), (2, [-0.0, 1.0]), (3, [1.0, 0.0]), (4, [0.0, 3.0])]
    found = embedding_join.join_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in found} == {(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 2, 1)}


def test_embeddings_of_either_zero(spark):
    rows = [(1, [-0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, -0.0])]
    found = embedding_join.join_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in found} == {(1, 1, 1), (2, 1, 1), (3, 0, 3)}
