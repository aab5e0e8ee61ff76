import pytest
from pyspark.sql import functions as F

from gridloom.operators import joins, places


@pytest.fixture(params=["4", "64"])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield int(request.param)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def sides(spark):
    """A city near most sites, and nineteen others near one each."""
    series = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 19)).alias("city"), F.col("id").alias("at")
    )
    members = spark.range(1000).select(
        F.when(F.col("id") >= 19, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("city"), F.col("id").alias("site")
    )
    return series, members


def test_a_hot_key_is_dealt_and_others_are_not(spark, partitions):
    series, members = sides(spark)
    found = joins.hot_keys(members, ["city"]).collect()
    (hot,) = found
    assert hot["__shares"] == -(-981 // joins.PER_SHARE)
    joined = joins.fan_out_join(series, members, ["city"], by=["at"])
    plain = series.join(members, "city")
    assert joined.columns == plain.columns
    assert joined.count() == plain.count()
    assert joined.exceptAll(plain).count() == 0
    # Only the members of the hot key are copied: the rows that the plan makes tell.
    copied = members.withColumn("__key", F.xxhash64("city")).join(joins.hot_keys(members, ["city"]), "__key", "left")
    rows = copied.select(F.explode(F.sequence(F.lit(0), F.coalesce("__shares", F.lit(1)) - 1))).count()
    assert rows == 981 * hot["__shares"] + 19


def test_the_hot_output_is_spread_over_tasks(spark, partitions):
    series, members = sides(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.fan_out_join(series, members, ["city"], by=["at"])
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total = sum(sizes)
    assert sizes[-1] < total / min(partitions, 16) * 2.5
    assert len(sizes) >= min(partitions, 10)


def test_keys_of_several_columns_and_nulls(spark):
    series = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (None, "a", 2), (2, "b", 3)], "k int, c string, at int")
    members = spark.createDataFrame([(1, "a", i) for i in range(200)] + [(None, "a", 900), (2, "b", 901)], "k int, c string, m int")
    joined = joins.fan_out_join(series, members, ["k", "c"], by=["at"])
    assert joined.count() == 401
    assert joins.fan_out_join(series.limit(0), members, ["k", "c"], by=["at"]).count() == 0
    assert joins.fan_out_join(series, members.limit(0), ["k", "c"], by=["at"]).count() == 0


def test_members_are_copied_no_more_often_than_they_meet_rows(spark):
    """Two rows near 4,000 members made 250 copies of each, and a key without rows as many."""
    members = spark.range(8000).select((F.col("id") % 2).alias("k"), F.col("id").alias("m"))
    series = spark.createDataFrame([(0, 1), (0, 2), (5, 3), (None, 4)], "k long, at int")
    hot = joins._with_rows(joins.hot_keys(members, ["k"]), series, ["k"])
    assert [r["__shares"] for r in hot.collect()] == [2]
    joined = joins.fan_out_join(series, members, ["k"], by=["at"], count_rows=True)
    assert joined.count() == 8000
    assert joined.exceptAll(series.join(members, "k")).count() == 0
    for rows, of in ((series.limit(0), members), (series, members.limit(0))):
        assert joins.fan_out_join(rows, of, ["k"], by=["at"], count_rows=True).count() == 0


def test_systems_near_a_site_are_copied_no_more_often_than_there_are_sites(spark, monkeypatch):
    seen = {}
    systems = spark.range(3000).selectExpr(
        "concat('s', id) as sid", "52.0D as lat", "5.0D as lon", "'R' as region", "0.9D as qual", "0 as freq"
    )
    site = spark.createDataFrame([(1, 52.0, 5.0)], "site long, lat double, lon double")

    def counted(series, members, keys, by, **options):
        hot = joins.hot_keys(members, keys)
        hot = joins._with_rows(hot, series, keys) if options.get("count_rows") else hot
        seen["copies"] = hot.agg(F.max("__shares")).first()[0]
        return joins.fan_out_join(series, members, keys, by, **options)

    monkeypatch.setattr(places, "fan_out_join", counted)
    assert places.systems_near_sites(site, systems).count() == 3000
    assert seen["copies"] == 1
