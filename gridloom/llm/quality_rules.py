"""Judge documents by a table of thresholds, compiled into one projection of counts and ratios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents

# What separates words, what counts as a symbol, and the limits of the base verdict.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Frequent function words of the languages at hand.
STOP_WORDS = (
    "the of and to a in is that it for with as on be by this are or from at which not have was "
    "der die das und in zu den ist nicht von mit es ein eine auf dem sich des im für "
    "de la el que y en los del las un por con una su para no se al lo es "
    "le les et des du est que une dans pour pas au sur ne se ce il par plus qui"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where ``part`` is not from ``least`` to ``most`` thousandths of ``whole``.

    Both name measures. A document whose ``whole`` is 0 passes: there is nothing to judge.
    """

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


# Lax on purpose: a rule is to find text that is no prose, not to rank prose.
RULES = [
    Rule("word length", "word_chars", "n_words", least=2000, most=15000),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("stop words", "n_stop_words", "n_words", least=20),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=500),
    Rule("list lines", "n_bullet_lines", "n_lines", most=900),
    Rule("cut lines", "n_cut_lines", "n_lines", most=300),
    Rule("letters", "n_letters", "word_chars", least=600),
]


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words(text: Column) -> Column:
    """The words of a text in order; none for an empty text."""
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * len(SPACES[1:])), " ", -1), "")


def window_keys(own: Column) -> Column:
    """A hash for each three words in a row."""
    starts = F.slice(own, 1, F.greatest(F.size(own) - 2, F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, F.get(own, i + 1), F.get(own, i + 2)))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, whatever the number of its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def covered(places: Column) -> Column:
    """Words in windows of three at these places, in order: each adds those up to the next, three at most."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-3).cast("long").alias("last"))
    return F.aggregate(
        places,
        start,
        lambda acc, at: F.struct((acc["words"] + F.least(F.lit(3).cast("long"), at - acc["last"])).alias("words"), at.alias("last")),
    )["words"]


def repeated_words(own: Column, keys: Column) -> Column:
    """Words within windows of three words that stand twice or more in the text, the first included.

    ``keys`` are the windows' hashes. A text without equal keys has no such words. Else the keys
    are put in order with their places in the low bits, so that equal windows stand side by side.
    Where neighbours of one key differ in their words, the windows themselves are put in order.
    """
    bits = F.length(F.bin(F.size(own)))
    placed = F.sort_array(F.transform(keys, lambda k, i: F.call_function("shiftleft", k, bits).bitwiseOR(i.cast("long"))))
    place = lambda x: (x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)).cast("int")
    alike = lambda x, y: F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0

    def by_key(s: Column) -> Column:
        hits = F.filter(s, lambda x, i: alike(x, F.get(s, i + 1)) | alike(x, F.get(s, i - 1)))
        return F.get(F.transform(F.array(hits), by_hits), F.lit(0))

    def by_hits(hits: Column) -> Column:
        unlike = F.exists(
            F.transform(hits, lambda x, i: F.struct(x.alias("x"), F.get(hits, i + 1).alias("y"))),
            lambda pair: F.coalesce(alike(pair["x"], pair["y"]), F.lit(False))
            & (F.slice(own, place(pair["x"]) + 1, 3) != F.slice(own, place(pair["y"]) + 1, 3)),
        )
        fast = covered(F.sort_array(F.transform(hits, lambda x: place(x).cast("long"))))
        return F.when(unlike, in_full()).otherwise(fast)

    def in_full() -> Column:
        n = F.greatest(F.size(own) - 2, F.lit(0))
        windows = F.sort_array(F.transform(F.slice(own, 1, n), lambda w, i: F.struct(F.slice(own, i + 1, 3).alias("w"), i.cast("long").alias("i"))))
        twice = lambda s: F.filter(
            s, lambda x, i: F.coalesce(x["w"] == F.get(s, i + 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(s, i - 1)["w"], F.lit(False))
        )
        return covered(F.sort_array(F.transform(bound(windows, twice), lambda x: x["i"])))

    repeats = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeats, bound(placed, by_key)).otherwise(F.lit(0).cast("long"))


def line_measures(lines: Column) -> dict[str, Column]:
    """Counts over the lines that hold a word."""
    number = lambda c: F.size(c).cast("long")
    return {
        "n_lines": number(lines),
        "n_dup_lines": number(lines) - number(F.array_distinct(lines)),
        "n_bullet_lines": number(F.filter(lines, lambda line: line.rlike(r"^[ \t]*[-*•]"))),
        "n_cut_lines": number(F.filter(lines, lambda line: line.rlike(r"(\.\.\.|…)[ \t\r]*$"))),
    }


def verdict(rules: list[Rule]) -> Column:
    """Names of the rules that a document fails, as one expression over its measures."""
    failed = []
    for rule in rules:
        part, whole = F.col(rule.part) * 1000, F.col(rule.whole)
        broken = F.lit(False)
        if rule.least is not None:
            broken = broken | (part < whole * rule.least)
        if rule.most is not None:
            broken = broken | (part > whole * rule.most)
        failed.append(F.when((whole > 0) & broken, F.lit(rule.name)))
    return F.array_compact(F.array(*failed))


def judge_documents(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Measures, failed rules and verdict of each document; nothing is shuffled.

    Words are runs of anything but spaces and the control characters 9 to 13, lines are split at
    line feeds. A text fails the base verdict with fewer than 50 words, or where more than half
    of its words stand in repeated windows of three; ``rules`` add their limits. Null texts count
    as empty, have no words and fail. Rows that repeat a document are judged one by one; other
    columns are ignored. All of it is built-in functions, a long text takes n log n steps.

    Result: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_bullet_lines, n_cut_lines, n_stop_words, n_letters (long), base_failed, failed_rules
    (array), kept.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = docs.select(
        "doc_id",
        text.alias("__text"),
        words(text).alias("__words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.length(without(line, SPACES)) > 0).alias("__lines"),
    )
    bare = bare.withColumn("__keys", window_keys(F.col("__words")))
    text, own = F.col("__text"), F.col("__words")
    solid = without(text, SPACES)
    measured = bare.select(
        "doc_id",
        F.size(own).cast("long").alias("n_words"),
        F.length(solid).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        repeated_words(own, F.col("__keys")).alias("n_repeat_words"),
        F.size(F.filter(own, lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace(solid, r"\P{L}+", "")).cast("long").alias("n_letters"),
        *[c.alias(name) for name, c in line_measures(F.col("__lines")).items()],
    )
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    return measured.withColumns({"base_failed": base, "failed_rules": verdict(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )


def quality_rules_query(spark, sf_dir) -> DataFrame:
    return judge_documents(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_RULE_SQL = " AND ".join(
    f"NOT ({r.whole} > 0 AND ("
    + " OR ".join(
        [f"{r.part} * 1000 < {r.whole} * {r.least}"] * (r.least is not None)
        + [f"{r.part} * 1000 > {r.whole} * {r.most}"] * (r.most is not None)
    )
    + "))"
    for r in RULES
)
_STOP_SQL = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

QUALITY_RULES_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts),
windows AS (
  SELECT doc_id, place, word, lead(word, 1) OVER following AS second, lead(word, 2) OVER following AS third
  FROM tokens WINDOW following AS (PARTITION BY doc_id ORDER BY place)),
counted AS (
  SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, word, second, third) AS n
  FROM windows WHERE third IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT place + beside) AS n_repeat_words
  FROM counted, (SELECT unnest([0, 1, 2]) AS beside) WHERE n > 1 GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[ \\t]*[-*•]')))::BIGINT AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t\\r]*$')))::BIGINT AS n_cut_lines,
    len(list_filter(words, lambda x: lower(x) IN ({_STOP_SQL})))::BIGINT AS n_stop_words,
    len(regexp_extract_all(text, '\\p{{L}}'))::BIGINT AS n_letters
  FROM texts LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATED_PERCENT} AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_RULE_SQL} AS kept
FROM judged
"""
