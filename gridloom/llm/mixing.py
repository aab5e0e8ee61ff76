"""Mix documents of several sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import shared_table

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"
# A table of so many sources, a row each, is sent to all tasks; a larger one is joined by source.
MOST_SOURCES_SENT = 100_000
# Ranks are counted in so many bins per source, and again in the bin of the cut, before any row is sorted.
BINS = 4096


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def uniform(document: Column, seed: str) -> Column:
    """A number between 0 and 1 that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(document.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Target words per source: shares by weight, none above ``most`` times its own words.

    ``sizes`` has source and size. Weights go round over the sources in code point order, null
    last. What a limited source cannot take is dealt to the others by weight: with the sources in
    the order of limit over weight, the level of the unlimited ones is the highest that any
    prefix of limited sources leaves. The windows hold one row per source.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("filled")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    totals = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1))
    limit = F.col("source_size") * most
    filling = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    above = filling.rowsBetween(Window.unboundedPreceding, -1)
    below = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(above), F.lit(0))
    ) / F.sum("weight").over(below)
    return (
        totals.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(limit.cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "filled", "target")
    )


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """Documents with their size, their random number and a hash of the text that parts equal ids."""
    return docs.withColumns(
        {"__size": word_count(F.col("text")), "__u": uniform(F.col("doc_id"), seed), "__text": F.xxhash64("text")}
    )


def _beside(rows: DataFrame, of_source: DataFrame) -> DataFrame:
    """Rows with what is known of their source. That table has a row per source: counted, then sent to all tasks."""
    known = of_source.withColumnRenamed("source", "__source")
    if known.count() <= MOST_SOURCES_SENT:
        known = F.broadcast(known)
    return rows.join(known, rows["source"].eqNullSafe(F.col("__source"))).drop("__source")


def _ranked(rows: DataFrame) -> DataFrame:
    """The rank of each row between 0 and 1, and its bins: null where no copy beside the whole ones is drawn."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    mean = F.col("source_size") / F.col("filled")
    part = F.col("__ratio") - F.col("__whole")
    odds = part / (F.lit(1.0) - part) * F.sqrt(mean / F.col("__size"))
    rank = (F.col("__u") / (F.lit(1.0) - F.col("__u"))) / odds
    return (
        rows.withColumn("__ratio", ratio)
        .withColumn("__whole", F.floor("__ratio"))
        .withColumn("__rank", F.when((F.col("__size") > 0) & (part > 0), rank))
        .withColumn("__rank", F.col("__rank") / (F.col("__rank") + 1))
        .withColumn("__bin", F.floor(F.col("__rank") * BINS))
        .withColumn("__bin_2", F.floor((F.col("__rank") * BINS - F.col("__bin")) * BINS))
        .withColumn("__key", F.struct("__rank", "doc_id", "__size", "__text"))
    )


def _cut(rows: DataFrame, bin_: str, rest: str) -> DataFrame:
    """For each source the bin in which its words reach ``rest``, and the words before it."""
    bins = rows.where(F.col(bin_).isNotNull()).groupBy("source", bin_).agg(
        F.sum("__size").alias("words"), F.first(rest).alias("rest")
    )
    running = Window.partitionBy("source").orderBy(bin_)
    return (
        bins.withColumn("words_to", F.sum("words").over(running))
        .where(F.col("words_to") >= F.col("rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct(bin_, (F.col("words_to") - F.col("words")).alias("before")), bin_).alias("cut"))
        .select("source", F.col(f"cut.{bin_}").alias(f"cut{bin_}"), F.col("cut.before").alias(f"before{bin_}"))
    )


def source_cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: its sizes, its target, and up to which row in the order of ranks one more copy is taken.

    No source is sorted as a whole: ranks are counted in bins, the bin in which the target falls
    in bins again, and only the rows of that one are put in order. Equal rows (id and text) are taken
    or left together.
    """
    rest = F.col("target") - F.col("__whole") * F.col("source_size")
    ranked = _ranked(_beside(sized, targets)).withColumn("__rest", rest)
    first = shared_table(_cut(ranked, "__bin", "__rest"), "cuts")
    inside = _beside(ranked, first).where("__bin = cut__bin").withColumn("__rest_2", F.col("__rest") - F.col("before__bin"))
    inside = shared_table(inside, "edge")
    second = shared_table(_cut(inside, "__bin_2", "__rest_2"), "cuts")
    edge = _beside(inside, second).where("__bin_2 = cut__bin_2")
    edge = edge.groupBy("source", "__key").agg(
        F.sum("__size").alias("words"), F.first(F.col("__rest_2") - F.col("before__bin_2")).alias("rest")
    )
    order = Window.partitionBy("source").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        edge.withColumn("to_here", F.sum("words").over(order))
        .where(F.col("to_here") - F.col("words") / 2 <= F.col("rest"))
        .groupBy("source")
        .agg(F.max("__key").alias("last"))
    )
    cuts = targets
    for part in (first.drop("before__bin"), second.drop("before__bin_2"), last):
        part = part.withColumnRenamed("source", "of_source")
        cuts = cuts.join(part, cuts["source"].eqNullSafe(part["of_source"]), "left").drop("of_source")
    return shared_table(cuts, "cuts")


def _taken(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    ranked = _ranked(_beside(sized, cuts))
    in_bin = (F.col("__bin_2") < F.col("cut__bin_2")) | (
        (F.col("__bin_2") == F.col("cut__bin_2")) & F.coalesce(F.col("__key") <= F.col("last"), F.lit(False))
    )
    # Without a cut the words of all bins do not reach the rest: everything is taken once more.
    more = F.col("cut__bin").isNull() | (F.col("__bin") < F.col("cut__bin")) | ((F.col("__bin") == F.col("cut__bin")) & in_bin)
    copies = F.col("__whole") + F.coalesce(F.col("__rank").isNotNull() & more, F.lit(False)).cast("long")
    return ranked.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("__size"))


MIX_COLUMNS = ["size", "source_size", "target", "copies", "taken"]


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED
) -> DataFrame:
    """How often each document goes into a mix of ``sum of all sizes`` words.

    A source whose target is r times its own words takes floor(r) certain copies of each of its
    documents. The rest of the target is a sample of one more copy, in the order of Pareto
    sampling: random odds u/(1-u) over inclusion odds, smallest first, until the words are
    reached. The inclusion odds follow the missing part of the source's copies, tilted by the
    square root of mean size over size, so that the last documents taken are rarely long ones and
    the words land near the target. Random numbers come from the id and the seed alone.

    Result: source, doc_id, size, source_size, target, copies, taken; one row per input row.
    Empty or null texts have size 0 and are taken 0 times. Rows that repeat an id rank by size and
    text; those that repeat the text as well are taken or left together. Other columns of ``docs``
    are ignored.
    """
    sized = shared_table(_sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "sized")
    targets = sized.select("source", F.col("__size").alias("size"))
    targets = shared_table(source_targets(targets, weights, most), "targets")
    rows = _taken(sized, source_cuts(sized, targets))
    return rows.select("source", "doc_id", F.col("__size").alias("size"), *MIX_COLUMNS[1:])


def mixed_documents(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED
) -> DataFrame:
    """The documents of the mix in their own columns, with size, source_size, target, copies and taken.

    Decided as in ``mix_sources``. Texts are not shuffled: each row is judged by the cut of its
    source. Documents that are not taken are left out. A column of ``docs`` with one of the five
    names gives way.
    """
    own = docs.drop(*MIX_COLUMNS)
    sized = shared_table(_sized(own.select("doc_id", "source", "text"), seed).drop("text"), "sized")
    targets = sized.select("source", F.col("__size").alias("size"))
    targets = shared_table(source_targets(targets, weights, most), "targets")
    rows = _taken(_sized(own, seed), source_cuts(sized, targets)).where("copies > 0")
    return rows.select(*own.columns, F.col("__size").alias("size"), *MIX_COLUMNS[1:])


def mix_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum((size > 0)::INT)::BIGINT AS filled FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM totals),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM totals)
      - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM weighed),
targets AS (
  SELECT source, source_size, filled,
    least((source_size * 3)::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target FROM levels),
parts AS (
  SELECT s.*, t.source_size, t.target, t.source_size::DOUBLE / t.filled::DOUBLE AS mean,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS ratio
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
odds AS (
  SELECT *, floor(ratio)::BIGINT AS whole, target - floor(ratio) * source_size::DOUBLE AS rest,
    ratio - floor(ratio) AS part FROM parts),
ranks AS (
  SELECT *, CASE WHEN size > 0 AND part > 0
    THEN (u / (1.0::DOUBLE - u)) / (part / (1.0::DOUBLE - part) * sqrt(mean / size::DOUBLE)) END AS q FROM odds),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, q IS NULL
    ORDER BY q / (q + 1), doc_id, size ROWS UNBOUNDED PRECEDING) AS to_here FROM ranks)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN q IS NOT NULL AND to_here - size / 2 <= rest THEN 1 ELSE 0 END)::BIGINT AS taken
FROM summed
"""
