"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest

import corpus_pipeline
from gridloom.llm.decontaminate import find_passages, without_passages
from gridloom.llm.embedding_join import join_embeddings
from gridloom.llm.language_id import identify_languages, known_languages
from gridloom.llm.licenses import scan_licenses
from gridloom.llm.mixing import mix_sources
from gridloom.llm.ngram_join import join_documents, one_of_each_group
from gridloom.llm.personal_data import find_personal_data, without_personal_data
from gridloom.llm.quality import score_quality
from gridloom.llm.toxicity import score_toxicity
from gridloom.llm.warc import archive_round_trip

EXTRA = "size long, score double, class_id long, spans string, target double, bucket long, label int, word string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
CLASH = (1, 0.5, 7, "x", 2.0, 3, 1, "w")
SENTENCE = "the quick brown fox jumps over the lazy dog and runs away from the farm"
LONG = " ".join(f"word{i % 977} {i % 13}" for i in range(60_000))
ROWS = [
    (1, SENTENCE, "en", "a", 10),
    (1, SENTENCE, "en", "a", 10),
    (2, SENTENCE, "en", None, None),
    (3, None, None, "a", None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", None, "b", 3),
    (None, SENTENCE, "en", "a", 10),
    (None, None, None, None, None),
    (6, LONG, "en", "c", len(LONG)),
    (7, "Один \U0001f600 два 0123", "xx", "c", 16),
]
ITEM = [(1, SENTENCE), (1, SENTENCE), (2, None), (None, "short one"), (3, "")]
LABELS = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, None, None), (3, None, 1), (6, 1, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([row + CLASH for row in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEM, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_licenses(docs, empty):
    rows = scan_licenses(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["labels"] == "" and r["score"] == 0 and r["first_word"] is None for r in rows)
    assert by_id(scan_licenses(docs))[4]["n_words"] == 0
    assert scan_licenses(empty).count() == 0


def test_mixing(docs, empty):
    rows = mix_sources(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert sorted(map(str, rows)) == sorted(map(str, mix_sources(docs.repartition(5)).collect()))
    assert mix_sources(empty).count() == 0


def test_passages(docs, empty, items):
    rows = find_passages(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["distance"]) for r in rows) == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert without_passages(docs, items).columns == docs.columns
    assert find_passages(empty, items).count() == 0
    assert find_passages(docs, items.limit(0)).count() == 0
    assert without_passages(docs, items.limit(0)).count() == len(ROWS)


def test_near_copies(docs, empty):
    rows = join_documents(docs).collect()
    assert len(rows) == len(ROWS)
    found = by_id(join_documents(docs))
    assert (found[1]["n_links"], found[2]["n_links"], found[2]["component_id"], found[2]["kept"]) == (2, 2, 1, False)
    assert (found[3]["n_links"], found[3]["component_id"]) == (0, 3)
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7]
    assert join_documents(empty).count() == 0 and one_of_each_group(empty).count() == 0


def test_languages(docs, empty):
    rows = by_id(identify_languages(docs))
    assert identify_languages(docs).count() == len(ROWS)
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["rejected"] and rows[i]["score"] == 0 for i in (3, 4, 5))
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert known_languages(docs).columns == docs.columns
    assert {r["lang_pred"] for r in identify_languages(docs, docs.where("lang is null")).collect()} == {"und"}
    assert identify_languages(empty).count() == 0 and known_languages(empty).count() == 0


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_scores(docs, empty, labels, score):
    rows = score(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert score(docs, labels.limit(0)).count() == len(ROWS)
    assert score(empty, labels).count() == 0


def test_personal_data(docs, empty):
    rows = find_personal_data(docs).collect()
    assert len(rows) == len(ROWS) and all(r["base"] == [] for r in rows)
    masked = without_personal_data(docs)
    assert masked.columns == docs.columns and masked.schema == docs.schema
    assert sorted(map(str, masked.collect())) == sorted(map(str, docs.collect()))
    assert find_personal_data(empty).count() == 0


def test_archives(spark):
    rows = [(1, "http://a/\r\nx: y", "<p>é</p>"), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "n", "lone"), (4, "v", "x" * 300_000)]
    pages = spark.createDataFrame([r + (9,) for r in rows], "page_id long, url string, html string, payload int")
    found = archive_round_trip(pages).where("kind = 'record'").collect()
    assert sorted((r["record_id"], r["warc_type"], r["refers_to"], r["payload_length"]) for r in found) == sorted(
        [("1", "response", None, 9), ("2", "revisit", "3", 0), ("3", "response", None, 0), ("3", "response", None, 0),
         ("null", "response", None, 4), ("4", "response", None, 300_000)], key=str
    )
    assert archive_round_trip(pages.limit(0)).count() == 0


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0]), (10, [0.0, 1.0])]
    frame = spark.createDataFrame([r + (5, 5) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    found = join_embeddings(frame).collect()
    assert len(found) == len(rows)
    links = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert links[1] == (3, 1, True) and links[2] == (3, 1, False) and links[9] == (3, 1, False)
    assert all(links[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 10))
    assert join_embeddings(frame.limit(0)).count() == 0
    assert join_embeddings(frame.where("vec_id = 3")).count() == 1


def test_stages_keep_columns(spark, docs, tmp_path):
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame(ITEM, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, base, str(tmp_path))
        assert out.columns == base.columns, name
        assert stage(spark, base.limit(0), str(tmp_path)).count() == 0, name
