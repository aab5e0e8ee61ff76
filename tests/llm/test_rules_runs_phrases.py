"""Threshold rules, periodic runs and collocations against plain versions of themselves."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridloom.llm import collocations, periodic_runs, quality_rules

SCHEMA = "doc_id long, text string, lang string"
CLASH = "rank long, phrase string, n_words long, kept boolean, runs string, word string, key long, size int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, True, "y", "z", 3, 4) for r in rows], f"{SCHEMA}, {CLASH}").repartition(3)


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "And", "ä", "x1", "\U0001f600", "...", "#tag", "b|c", "Q", "and,then", "end."]
    out = []
    for _ in range(n):
        parts = []
        while rng.random() < 0.9:
            unit = rng.choices(words[: rng.randint(1, 12)], k=rng.randint(1, 6))
            parts += unit * rng.choice([1, 1, 1, 2, 5, 9])
            parts.append(rng.choice([" ", "\n", "\t", "\x0b", "\r\n", "  ", "\x85", "\u00a0"]))
        out.append(rng.choice([" ", "\n"]).join(parts))
    return out


EDGES = [(None, None, None), (None, "the of the of the of", "en"), (7, None, "en"), (8, "", "en"), (9, " \n\t\x0b ", None), (10, "one", "en")]


# Rules


def plain_rules(text):
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    }


def test_rules_by_counting(spark):
    rows = EDGES + [(100 + i, t, "en") for i, t in enumerate(random_texts(1, 400))] + [(500, " ".join(f"w{i} of {i % 7}" for i in range(40_000)), "en")]
    rows += rows[-5:]
    found = quality_rules.judge_documents(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    want = collections.Counter((r[0], *plain_rules(r[1]).values()) for r in rows)
    got = collections.Counter((r["doc_id"], *(r[c] for c in plain_rules(""))) for r in found)
    assert got == want
    assert all(not r["kept"] for r in found if r["base_failed"] or r["failed_rules"])
    assert sum(r["n_repeat_words"] > 0 for r in found) > 50


def test_windows_of_equal_keys_are_told_apart(spark):
    """Were all hashes equal, the windows themselves would be compared."""
    rows = [(i, t, "en") for i, t in enumerate(random_texts(2, 200))]
    own = F.col("w")
    for key in (F.lit(5).cast("long"), None):
        keys = quality_rules.window_keys(own)
        if key is not None:
            keys = F.transform(keys, lambda k: key)
        found = frame(spark, rows).select("doc_id", quality_rules.words(F.col("text")).alias("w"))
        found = found.withColumn("k", keys).select("doc_id", quality_rules.repeated_words(own, F.col("k")).alias("n")).collect()
        assert {r["doc_id"]: r["n"] for r in found} == {i: plain_rules(t)["n_repeat_words"] for i, t, _ in rows}


def test_each_rule_decides(spark):
    prose = "the mill of the town stood empty for as long as anybody in it knew how to say " * 4
    cases = {
        None: " ".join(f"{w}{i % 3 * 'x'}" for i, w in enumerate(prose.split())),
        "word length": " ".join(f"supercalifragilistic{i}longword the" for i in range(60)),
        "symbols": " ".join(f"the w{i}x #" for i in range(60)),
        "stop words": " ".join(f"lorem{i}x" for i in range(60)),
        "repeated lines": "\n".join(["the same line"] + [f"the line {'abcdefgh'[i % 8] * 3}" for i in range(8)] * 6),
        "list lines": "\n".join(f"- the point named {chr(97 + i % 26) * (1 + i // 26)}" for i in range(40)),
        "cut lines": "\n".join(f"the story goes on {chr(97 + i % 26) * (1 + i // 26)}..." for i in range(40)),
        "letters": " ".join(f"the {i}{i * 7}{i * 13} 0000" for i in range(60)),
    }
    rows = [(i, t, "en") for i, t in enumerate(cases.values())]
    found = {r["doc_id"]: r for r in quality_rules.judge_documents(frame(spark, rows)).collect()}
    for i, name in enumerate(cases):
        assert (name in found[i]["failed_rules"]) if name else found[i]["failed_rules"] == [], (name, found[i])
    lax = quality_rules.judge_documents(frame(spark, rows), rules=[]).collect()
    assert all(r["kept"] != r["base_failed"] for r in lax)


def test_rules_use_no_user_functions(spark):
    plan = quality_rules.judge_documents(frame(spark, EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "")


# Runs


def plain_runs(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_by_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words, k = [], rng.choice([1, 2, 2, 3, 5])
            for _ in range(rng.randint(0, 7)):
                words += [rng.choice("abcde"[:k]) for _ in range(rng.randint(1, 5))] * rng.randint(1, 7)
            texts.append(words)
        least, exponent = rng.choice([(6, 4), (6, 4), (2, 2), (9, 3), (1, 5)])
        assert periodic_runs.runs_of_texts(texts, least, exponent) == [plain_runs(t, least, exponent) for t in texts]


def test_long_texts_with_many_repeats_end():
    n = 60_000
    a, b = "b", "a"
    while len(b) < n:
        a, b = b, b + a
    assert periodic_runs.runs_of_texts([["a"] * n])[0] == [(0, n, 1)]
    assert periodic_runs.runs_of_texts([list(b)])[0] == []
    lines = [w for i in range(n // 6) for w in ("a log line like others".split() + [str(i)])]
    assert periodic_runs.runs_of_texts([lines])[0] == []
    assert periodic_runs.runs_of_texts([["x", "y", "z"] * n + ["end"]])[0] == [(0, 3 * n, 3)]


def test_runs_of_documents(spark):
    rows = EDGES + [(20, "so it goes " * 5 + "on and on", "en"), (21, "a a a a a a b", "en"), (21, "a a a a a a b", "en"), (22, "a " * 5, "en")]
    found = periodic_runs.find_runs(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [tuple(r) for r in by_id[20]["runs"]] == [(0, 15, 3)] and by_id[20]["collapsed"] == "so it goes on and on"
    assert by_id[21]["collapsed"] == "a b" and by_id[22]["runs"] == []
    assert all(by_id[i]["n_words"] == 0 and by_id[i]["collapsed"] == "" for i in (7, 8, 9))
    assert periodic_runs.find_runs(frame(spark, EDGES).limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(frame(spark, EDGES), exponent=1)


def test_run_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = periodic_runs.runs_query(spark, folder).collect()
    assert len(found) == len(texts) and sum(r["n_runs"] > 0 for r in found) > 10
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in found:
        words, h = re.findall(r"[^ \t-\r]+", texts[r["doc_id"]] or ""), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2500 and not r["n_runs"]:
            continue  # the plain version takes too long
        runs = plain_runs(words)
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


# Collocations


def plain_collocations(rows, least=10, longest=3, keep=2000, covered=50):
    counts = collections.defaultdict(collections.Counter)
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(fold)):
            words = re.findall(r"[^ \t]+", piece)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            longer = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * candidates[q] >= covered * a for q in longer):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        found.sort()
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(found[:keep], 1)]
    return sorted(out)


def phrase_rows(seed, n):
    rng = random.Random(seed)
    vocabulary = ["Sea", "salt", "of", "the", "and", "Ünder", "\U0001f600", "a", "b", "c-d", "new", "york", "city", "x\u00a0y"]
    weights = [1 + 40 // (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 40))
        text = "".join(w + rng.choice([" "] * 9 + ["\t", ", ", ". ", "\n", "!? ", "  "]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("ranked", [1 << 19, 0, 9, 40])
@pytest.mark.parametrize("longest", [3, 4])
def test_collocations_by_counting(spark, ranked, longest):
    rows = EDGES + phrase_rows(5, 300)
    rows += rows[-20:]
    found = collocations.find_collocations(frame(spark, rows), longest=longest, ranked=ranked)
    got = sorted(tuple(r) for r in found.collect())
    want = plain_collocations(rows, longest=longest)
    assert got == want and len(got) > 30
    kept = collocations.find_collocations(frame(spark, rows), longest=longest, ranked=ranked, keep=5)
    assert sorted(tuple(r) for r in kept.collect()) == plain_collocations(rows, longest=longest, keep=5)


def test_collocations_in_small_pieces(spark, monkeypatch):
    """Tiles that are dense, flushed early and dealt over many shards give the same counts."""
    rows = phrase_rows(6, 400)
    want = plain_collocations(rows)
    for name, value in (("TILE", 4), ("DENSE_CELLS", 16), ("SPARSE", 4), ("DENSE_HELD", 1), ("GATHERED", 50), ("HELD", 60), ("WORDS_PER_SHARD", 500)):
        monkeypatch.setattr(collocations, name, value)
    counter = collocations.TileCounter()
    import numpy as np

    rng = np.random.default_rng(1)
    pairs = rng.integers(0, 9, (2, 500))
    for part in np.array_split(pairs, 7, axis=1):
        counter.add(list(part))
        counter.count()
    assert counter.dense
    total = collections.Counter()
    for _, _, shard, (a, b), n in counter.rows(3):
        total.update({(i, j): int(k) for i, j, k in zip(a.tolist(), b.tolist(), n.tolist(), strict=True)})
    assert total == collections.Counter(map(tuple, pairs.T.tolist()))
    found = collocations.find_collocations(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == want


def test_collocations_of_languages_that_alternate(spark, monkeypatch):
    """Counts of a language that are sent on early take along what was gathered but not yet counted."""
    rows = phrase_rows(8, 400)
    for name, value in (("GATHERED", 100), ("HELD", 250)):
        monkeypatch.setattr(collocations, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = collocations.find_collocations(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in found) == plain_collocations(rows)


def test_collocations_of_nothing(spark):
    assert collocations.find_collocations(frame(spark, EDGES).limit(0)).count() == 0
    assert collocations.find_collocations(frame(spark, EDGES)).count() == 0


def test_scores_beyond_64_bits(spark):
    a, l, r = 3 * 10**11, 4 * 10**11, 5 * 10**11
    row = spark.range(1).select(collocations.exact_score(*(F.lit(x).cast("long") for x in (a, l, r))).alias("s")).first()
    assert row["s"] == 10**6 * a * a // (l * r)
