import itertools
import random
import time
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridloom.operators import quality
from gridloom.operators.quality import RejectedBatch
from gridloom.plans import forecasts
from gridloom.sources import sinks, snapshots, tables, writers
from gridloom.streaming import readings as streams

DAY = datetime(2022, 1, 1)
VALUES = [0.0, 0.1, 0.0, 0.1]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def batch(spark, shift=timedelta(0), values=VALUES, text=False):
    rows = []
    for i, v in enumerate(values):
        number = "a text" if text and i == 1 else v
        rows.append((DAY + shift + timedelta(minutes=15 * i), number, v, v, v, v, v, "actual", 308, "name", "TEST", "demand", "posted_by_api"))
    kind = "string" if text else "double"
    return spark.createDataFrame(
        rows,
        f"datetimeFC timestamp, forecast {kind}, stdev double, quantile_P50 double, forecast_wind_on_shore double, "
        "forecast_solar double, forecast_other double, quality string, pid bigint, customer string, "
        "description string, type string, algtype string",
    )


def write(spark, path, df, created=DAY):
    return writers.write_forecast(df, path, created)


def read_back(spark, path, days=5):
    found = forecasts.predicted_load(tables.read_series(spark, path), DAY, DAY + timedelta(days=days), 15)
    return [(r["datetime"], r["forecast"], r["stdev"]) for r in found.orderBy("datetime").collect()]


def quarters(*starts):
    return [s + timedelta(minutes=15 * i) for s in starts for i in range(4)]


def test_round_trip(spark, path):
    assert write(spark, path, batch(spark)) == 4
    assert read_back(spark, path) == [(t, v, v) for t, v in zip(quarters(DAY), VALUES)]


def test_overlapping_batches_leave_one_row_per_time(spark, path):
    write(spark, path, batch(spark))
    write(spark, path, batch(spark, timedelta(minutes=30)))
    assert [r[0] for r in read_back(spark, path)] == [DAY + timedelta(minutes=15 * i) for i in range(6)]


def test_the_newer_value_replaces(spark, path):
    write(spark, path, batch(spark), DAY)
    write(spark, path, batch(spark, values=[5.0] * 4), DAY + timedelta(hours=1))
    write(spark, path, batch(spark, values=[9.0] * 4), DAY - timedelta(hours=1))
    assert {r[1] for r in read_back(spark, path)} == {5.0}


def test_a_batch_with_a_missing_value_is_refused_whole(spark, path):
    later = batch(spark, timedelta(minutes=30))
    with pytest.raises(RejectedBatch, match="forecast"):
        write(spark, path, batch(spark, values=[0.0, None, 0.0, 0.1]))
    write(spark, path, later)
    assert [r[0] for r in read_back(spark, path)] == quarters(DAY + timedelta(minutes=30))


def test_a_batch_with_text_in_numbers_is_refused_whole(spark, path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write(spark, path, batch(spark, text=True))
    write(spark, path, batch(spark, timedelta(minutes=30)))
    assert [r[0] for r in read_back(spark, path)] == quarters(DAY + timedelta(minutes=30))


def test_days_apart_keep_both(spark, path):
    write(spark, path, batch(spark))
    write(spark, path, batch(spark, timedelta(days=2)))
    assert [r[0] for r in read_back(spark, path)] == quarters(DAY, DAY + timedelta(days=2))


def test_valid_invalid_valid(spark, path):
    write(spark, path, batch(spark))
    with pytest.raises(RejectedBatch):
        write(spark, path, batch(spark, timedelta(days=2), values=[0.0, float("inf"), 0.0, 0.1]))
    write(spark, path, batch(spark, timedelta(days=3)))
    assert [r[0] for r in read_back(spark, path)] == quarters(DAY, DAY + timedelta(days=3))


def test_unknown_column_is_refused(spark, path):
    with pytest.raises(RejectedBatch, match="surprise"):
        write(spark, path, batch(spark).withColumn("surprise", F.lit(1)))


def test_horizons_use_the_largest_option_below(spark, path):
    long = batch(spark, timedelta(hours=4))
    writers.write_forecast(long, path + "/latest", DAY, tahead_path=path + "/ahead")
    rows = tables.read_series(spark, path + "/ahead").orderBy("time").collect()
    # Exactly 4 hours ahead is not beyond 4 hours.
    assert [r["tAhead"] for r in rows] == [1.0, 4.0, 4.0, 4.0]
    assert "algtype" not in rows[0].asDict()


def test_quality_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, "substituted")], "a int, quality string")
    assert sorted(r["quality"] for r in quality.fill_quality(df).collect()) == ["actual", "substituted"]
    assert quality.fill_quality(df.drop("quality")).first()["quality"] == "actual"


def test_weather_goes_to_two_tables(spark, path):
    rows = [(datetime(2023, 1, 1, 10, 0), "x", 1.0, 2.0), (datetime(2023, 1, 1, 10, 15), "x", 1.5, 2.5)]
    data = spark.createDataFrame(rows, "datetime timestamp, input_city string, temp double, windspeed double")
    writers.write_weather(data, path, "harm_arome", datetime(2023, 1, 1, 9))
    assert tables.read_series(spark, path).count() == 2
    ahead = tables.read_series(spark, path + "_tAhead").collect()
    assert [(r["tAhead"], r["temp"]) for r in ahead] == [(1.0, 1.5)]


def test_guard_names_the_columns(spark):
    df = spark.createDataFrame([(1.0, 3, float("nan")), (2.0, 4, 6.0), (None, 5, 7.0)], "a double, b bigint, c double")
    with pytest.raises(RejectedBatch) as error:
        quality.guard_values(df)
    assert "'a'" in str(error.value) and "'c'" in str(error.value) and "'b'" not in str(error.value)


def test_tags_must_be_a_list(spark, path):
    df = spark.createDataFrame([(DAY, "a", 1.0)], "time timestamp, system string, output double")
    for tags in ("system", []):
        with pytest.raises(ValueError):
            sinks.append_series(df, path, tags)


def test_fields_are_decided_one_by_one(spark, path):
    one = spark.createDataFrame([(DAY, "a", 1.0, 1)], "time timestamp, system string, x double, created bigint")
    two = spark.createDataFrame([(DAY, "a", 2.0, 2)], "time timestamp, system string, y double, created bigint")
    sinks.append_series(one, path, ["system"])
    sinks.append_series(two, path, ["system"])
    row = tables.read_series(spark, path).first()
    assert (row["x"], row["y"], row["created"]) == (1.0, 2.0, 2)


def test_replay_changes_nothing_and_other_days_stay(spark, path):
    rows = [(DAY + timedelta(days=d), "a", float(d), d) for d in range(3)]
    df = spark.createDataFrame(rows, "time timestamp, system string, x double, created bigint")
    sinks.append_series(df, path, ["system"])
    for _ in range(2):
        sinks.append_series(df.where("x = 1"), path, ["system"])
    assert sorted(r["x"] for r in tables.read_series(spark, path).collect()) == [0.0, 1.0, 2.0]


def test_stored_ranges_prune_partitions_and_push_filters(spark, path):
    rows = [(DAY + timedelta(days=d), "a", float(d)) for d in range(3)]
    sinks.append_series(spark.createDataFrame(rows, "time timestamp, system string, x double"), path, ["system"])
    found = tables.scan_series(tables.read_series(spark, path), DAY + timedelta(days=1), DAY + timedelta(days=2), system="a")
    plan = found.select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(time" in plan
    assert [r["x"] for r in found.collect()] == [1.0]


def test_table_modes(spark, path):
    df = spark.createDataFrame([("a", 1)], "name string, v int")
    sinks.write_table(df, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(df, path)
    sinks.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 2
    sinks.write_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        sinks.write_table(df, path, "upsert")


def test_measurements(spark):
    texts = spark.createDataFrame(
        [("2019-10-16T20:00:00+0000",), ("2019-10-16 20:00:00",), ("2019-10-16T20:00:00",)], "datetime string"
    )
    assert quality.well_formed_measurements(texts).count() == 1
    assert quality.malformed_measurements(texts).count() == 2
    rows = [(datetime(2019, 10, 16, 20, 15 * i), "s1", v) for i, v in enumerate([-0.0, -1.0, -3.1])]
    readings = spark.createDataFrame(rows, "time timestamp, system string, output double")
    document = quality.measurement_documents(readings).first()["document"]
    assert document.startswith('{"sid":"s1","data":[{"datetime":"2019-10-16T22:00:00+0200","output":')
    assert document.count("datetime") == 3 and document.endswith('"output":-3.1}]}')


def test_kpis(spark):
    rows = [(7, "47.0h", DAY, k, v) for k, v in [("a", float("inf")), ("b", float("-inf")), ("c", float("nan")), ("d", 2.5)]]
    kpis = spark.createDataFrame(rows, "pid bigint, horizon string, date timestamp, kpi string, value double")
    jobs = spark.createDataFrame([(7, "s1+s2", "job")], "id bigint, description string, name string")
    row = quality.kpi_wide(kpis, jobs, ["a", "b", "c", "d", "e"]).first()
    assert [row[c] for c in "abcde"] == [9999.9, -9999.9, 0.0, 2.5, 0.0]
    assert (row["pid"], row["tAhead"], row["description"], row["customer"]) == (7, 47.0, "s1+s2", "job")


SCHEMA = "time timestamp, system string, type string, output double, created bigint"


def test_stream_takes_late_and_corrected_points(spark, tmp_path):
    feed, table, buckets, state = (str(tmp_path / n) for n in ("feed", "table", "buckets", "state"))
    first = [(DAY + timedelta(minutes=m), "a", "measurement", float(m), 1) for m in (0, 5, 10, 15)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(feed)
    run = lambda: streams.stream_corrected_buckets(streams.read_stream(spark, feed), 15, table, buckets, state).awaitTermination()
    run()
    means = {r["time"]: r["output"] for r in tables.read_series(spark, buckets).collect()}
    assert means == {DAY: 5.0, DAY + timedelta(minutes=15): 15.0}
    late = [(DAY, "a", "measurement", 30.0, 2), (DAY - timedelta(days=1), "a", "measurement", 1.0, 2)]
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    run()
    means = {r["time"]: r["output"] for r in tables.read_series(spark, buckets).collect()}
    assert means == {DAY: 15.0, DAY + timedelta(minutes=15): 15.0, DAY - timedelta(days=1): 1.0}
    assert tables.read_series(spark, table).count() == 5


def corrected(spark, feed, tmp_path, **options):
    table, buckets, state = (str(tmp_path / n) for n in ("table", "buckets", "state"))
    stream = streams.read_stream(spark, feed, files_per_batch=1)
    streams.stream_corrected_buckets(stream, 15, options.pop("table", table), buckets, state, **options).awaitTermination()
    return {(r["system"], r["time"]): r["output"] for r in tables.read_series(spark, buckets).collect()}


def feed_rows(spark, feed, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(feed)


def test_buckets_of_a_day_share_a_state(spark, tmp_path):
    feed, buckets, state = (str(tmp_path / n) for n in ("feed", "buckets", "state"))
    rows = [(DAY + timedelta(hours=h, minutes=m), f"s{k}", "t", float(h + m), 1) for h in range(24) for m in (0, 30) for k in range(2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(feed)
    query = streams.stream_corrected_buckets(streams.read_stream(spark, feed), 60, None, buckets, state)
    query.awaitTermination()
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress) <= 2
    found = {(r["system"], r["time"]): r["output"] for r in tables.read_series(spark, buckets).collect()}
    assert found == {(f"s{k}", DAY + timedelta(hours=h)): h + 15.0 for h in range(24) for k in range(2)}


def test_corrections_replace_in_state_without_a_table(spark, tmp_path):
    feed = str(tmp_path / "feed")
    at = lambda m: DAY + timedelta(minutes=m)
    feed_rows(spark, feed, [(at(m), s, "measurement", float(m), 5) for m in (0, 5, 10) for s in "ab"])
    assert corrected(spark, feed, tmp_path, table=None) == {("a", DAY): 5.0, ("b", DAY): 5.0}
    # An older value does not count, one of the same moment does, and a point may have several types.
    feed_rows(spark, feed, [(at(0), "a", "measurement", 99.0, 4), (at(5), "a", "measurement", 8.0, 5), (at(0), "b", "solar", 25.0, 1)])
    assert corrected(spark, feed, tmp_path, table=None) == {("a", DAY): 6.0, ("b", DAY): 10.0}
    feed_rows(spark, feed, [(at(10), "a", "measurement", None, 9), (at(10), "a", "measurement", float("inf"), 9), (at(20), "a", "measurement", 1.0, 9)])
    assert corrected(spark, feed, tmp_path, table=None) == {("a", DAY): 6.0, ("b", DAY): 10.0, ("a", at(15)): 1.0}
    refused = spark.read.parquet(str(tmp_path / "buckets" / "_rejected")).collect()
    assert len(refused) == 2 and all("output" in r["reason"] for r in refused)


def test_random_corrections_equal_the_table(spark, tmp_path):
    rng, feed, newest = random.Random(4), str(tmp_path / "feed"), {}
    for _ in range(2):
        rows = []
        for _ in range(60):
            key = DAY + timedelta(minutes=rng.randrange(0, 120, 5)), rng.choice("abc"), "measurement"
            row = (*key, float(rng.randrange(100)), rng.randrange(10_000))
            rows.append(row)
            newest[key] = max(newest.get(key, (0, 0.0)), row[:2:-1])
        feed_rows(spark, feed, rows)
    want = {}
    for (time, system, _), (_, output) in newest.items():
        want.setdefault((system, time - timedelta(minutes=time.minute % 15)), []).append(output)
    assert corrected(spark, feed, tmp_path) == {k: pytest.approx(sum(v) / len(v)) for k, v in want.items()}


def test_a_closed_bucket_is_read_from_the_table(spark, tmp_path):
    feed, table, buckets, state = (str(tmp_path / n) for n in ("feed", "table", "buckets", "state"))
    feed_rows(spark, feed, [(DAY, "a", "measurement", 1.0, 1)])
    stream = streams.read_stream(spark, feed, files_per_batch=1)
    with pytest.raises(ValueError):
        streams.stream_corrected_buckets(stream, 15, table, buckets, state, keep=timedelta(seconds=1))
    query = streams.stream_corrected_buckets(stream, 15, table, buckets, state, keep=timedelta(milliseconds=1), every="1 second")

    def wait_for(mean):
        until = time.time() + 90
        while time.time() < until:
            held = snapshots.load(spark, buckets)
            if held and [r["output"] for r in tables.read_series(spark, buckets).collect()] == [mean]:
                return (query.lastProgress or {"batchId": 0})["batchId"]
            time.sleep(0.5)
        raise AssertionError(query.exception() or query.lastProgress)

    try:
        batch = wait_for(1.0)
        until = time.time() + 60
        while (query.lastProgress or {"batchId": -1})["batchId"] < batch + 2 and time.time() < until:
            time.sleep(0.5)  # the timer runs off meanwhile
        feed_rows(spark, feed, [(DAY + timedelta(minutes=5), "a", "measurement", 4.0, 1)])
        wait_for(2.5)
    finally:
        query.stop()


def test_stream_sets_a_bad_batch_aside_and_goes_on(spark, tmp_path):
    feed, table, state = (str(tmp_path / n) for n in ("feed", "table", "state"))
    values = [1.0, float("nan"), 3.0]
    for i, value in enumerate(values):
        row = [(DAY + timedelta(minutes=i), "a", "measurement", value, 1)]
        spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    for _ in range(2):
        feed_stream = streams.read_stream(spark, feed, files_per_batch=1)
        streams.stream_realised(feed_stream, table, state).awaitTermination()
    assert sorted(r["output"] for r in tables.read_series(spark, table).collect()) == [1.0, 3.0]
    refused = spark.read.parquet(f"{table}/_rejected").collect()
    assert len(refused) == 1 and "missing values" in refused[0]["reason"]


def test_order_of_batches_does_not_count(spark, tmp_path):
    schema = "time timestamp, system string, a double, b double, created bigint"
    rows = [(DAY, "s", 10.0, None, 10), (DAY, "s", None, 5.0, 5), (DAY, "s", None, 7.0, 7)]
    for n, order in enumerate(itertools.permutations(rows)):
        path = str(tmp_path / str(n))
        for row in order:
            sinks.upsert_last_write_wins(spark.createDataFrame([row], schema), path, ["system"])
        (row,) = tables.read_series(spark, path).collect()
        assert (row["a"], row["b"], row["created"]) == (10.0, 7.0, 10)


def test_a_broken_day_does_not_stop_another(spark, path):
    schema = "time timestamp, system string, x double"
    rows = [(DAY + timedelta(days=d), "a", float(d)) for d in range(2)]
    sinks.append_series(spark.createDataFrame(rows, schema), path, ["system"])
    for file in Path(path).glob(f"write=*/date={DAY.date()}/*/*.parquet"):
        file.write_bytes(b"broken")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    sinks.append_series(spark.createDataFrame([(DAY + timedelta(days=1), "a", 9.0)], schema), path, ["system"])
    later = tables.scan_series(tables.read_series(spark, path), start=DAY + timedelta(days=1))
    assert [r["x"] for r in later.collect()] == [9.0]


def test_times_are_kept_to_the_second(spark, path):
    schema = "time timestamp, system string, x double, created bigint"
    for micro, created in ((100, 1), (900, 2)):
        row = [(DAY + timedelta(microseconds=micro), "a", float(created), created)]
        sinks.append_series(spark.createDataFrame(row, schema), path, ["system"])
    assert [(r["time"], r["x"]) for r in tables.read_series(spark, path).collect()] == [(DAY, 2.0)]


def test_a_new_field_is_read(spark, path):
    one = spark.createDataFrame([(DAY, "a", 1.0)], "time timestamp, system string, x double")
    two = spark.createDataFrame([(DAY + timedelta(days=1), "a", 2.0)], "time timestamp, system string, q double")
    sinks.append_series(one, path, ["system"])
    sinks.append_series(two, path, ["system"])
    assert sorted((r["x"], r["q"]) for r in tables.read_series(spark, path).collect() if r["x"]) == [(1.0, None)]
    assert {r["q"] for r in tables.read_series(spark, path).collect()} == {None, 2.0}


def test_exports_of_other_days_stay(spark, path):
    for day in (1, 2):
        sinks.write_documents(spark.createDataFrame([(f"2024-01-0{day}", f"text {day}")], "date string, document string"), path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["text 1", "text 2"]


def test_zones_of_measurement_times(spark):
    texts = ["2019-10-16T20:00:00+02:00", "2019-10-16T20:00:00Z", "2019-10-16T20:00:00-0130", "2019-10-16T20:00:00", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "datetime string")
    assert {r["datetime"] for r in quality.well_formed_measurements(df).collect()} == set(texts[:3])
    assert {r["datetime"] for r in quality.malformed_measurements(df).collect()} == set(texts[3:])


def test_texts_of_jobs_meet_kpis_that_are_brought_together(spark):
    """Texts are joined to the rows of the answer; equal texts of a job are one, others each have their row."""
    rows = [(1, "1h", "d", "a", 1.0), (1, "1h", "d", "b", 2.0), (None, "1h", "d", "a", 3.0), (9, None, None, "b", None)]
    kpis = spark.createDataFrame(rows, "pid long, horizon string, date string, kpi string, value double")
    jobs = spark.createDataFrame([(1, "x+y", "n"), (1, "x+y", "n"), (1, "z", None)], "id long, description string, name string")
    wide = quality.kpi_wide(kpis, jobs, ["a", "b"])
    found = {tuple(r) for r in wide.collect()}
    assert found == {
        (1, 1.0, "x+y", "n", "d", 1.0, 2.0), (1, 1.0, "z", None, "d", 1.0, 2.0),
        (None, 1.0, None, None, "d", 3.0, 0.0), (9, None, None, None, None, 0.0, 0.0),
    }
    assert wide.count() == 4
    grouped = [line for line in wide._jdf.queryExecution().optimizedPlan().toString().splitlines() if "tAhead" in line and "Aggregate" in line]
    assert grouped and not any("description" in line for line in grouped)


def test_texts_of_jobs_do_not_come_in_long_runs(spark):
    """KPIs that come in turns leave in turns; sorted by job, a writer of long texts gathered more than it could hold."""
    kpis = spark.range(0, 2000, 1, 2).selectExpr("id % 4 as pid", "'1.5h' as horizon", "'d' as date", "'a' as kpi", "1.0D as value")
    jobs = spark.createDataFrame([(i, f"{i}+" * 20, f"n{i}") for i in range(4)], "id long, description string, name string")
    # As where the texts are too long to be sent to all tasks.
    wanted = {"spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        found = [(r["pid"], r["description"], r["customer"]) for r in quality.kpi_rows(kpis, jobs).collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(found) == sorted((i % 4, f"{i % 4}+" * 20, f"n{i % 4}") for i in range(2000))
    assert max(len(list(run)) for _, run in itertools.groupby(found)) < 100


def test_kpis_of_unknown_jobs_are_reported(spark):
    kpis = spark.createDataFrame([(1, "47.0h", 1.0), (2, "47.0h", 2.0), (None, "47.0h", 3.0)], "pid int, horizon string, value double")
    known, unknown = writers.unknown_kpis(kpis, spark.createDataFrame([(1,), (1,)], "id int"))
    assert [r["pid"] for r in known.collect()] == [1]
    assert {r["pid"] for r in unknown.collect()} == {2, None}


POINT = "time timestamp, system string, x double, created bigint"


def point(spark, x, created=1, day=0, system="a"):
    return spark.createDataFrame([(DAY + timedelta(days=day), system, x, created)], POINT)


def values(spark, path):
    return sorted(r["x"] for r in tables.read_series(spark, path).collect())


def test_data_without_versions_is_refused(spark, path):
    sinks.append_series(point(spark, 1.0), path, ["system"])
    sinks.append_series(point(spark, 2.0, day=1), path, ["system"])
    for file in Path(path, "_versions").iterdir():
        file.unlink()
    for attempt in (lambda: sinks.append_series(point(spark, 3.0), path, ["system"]), lambda: tables.read_series(spark, path)):
        with pytest.raises(snapshots.DamagedTable):
            attempt()
    assert len(list(Path(path).glob("write=*/date=*/bucket=*/*.parquet"))) == 2


def test_a_lost_version_in_between_is_refused(spark, path):
    for n in range(4):
        sinks.append_series(point(spark, float(n), day=n), path, ["system"])
    Path(path, "_versions", "000000000002.json").unlink()
    with pytest.raises(snapshots.DamagedTable):
        tables.read_series(spark, path)


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["begin", "read", "write", "publish", "done"])
def test_a_writer_that_dies_leaves_the_old_or_the_new_table(spark, path, monkeypatch, step):
    sinks.append_series(point(spark, 1.0), path, ["system"])

    def dies(*args, **kwargs):
        raise Killed

    with monkeypatch.context() as m:
        if step == "begin":
            m.setattr(snapshots, "begin", dies)
        elif step == "read":
            m.setattr(snapshots, "read", dies)
        elif step == "write":
            m.setattr(snapshots, "commit", dies)  # all data files are there, no version names them
        elif step == "publish":
            m.setattr(snapshots._Files, "_publish", dies)  # the version is drafted, not yet there
        else:
            put = snapshots.commit
            m.setattr(snapshots, "commit", lambda *a: (put(*a), dies()))
        with pytest.raises(Killed):
            sinks.append_series(point(spark, 2.0, created=2), path, ["system"])
    assert values(spark, path) == [2.0 if step == "done" else 1.0]
    sinks.append_series(point(spark, 3.0, created=3), path, ["system"])
    assert values(spark, path) == [3.0]
    removed = snapshots.expire(spark, path, 0)
    assert removed >= 1 and values(spark, path) == [3.0]
    assert len(list(Path(path).glob("write=*"))) == 1


def test_a_first_writer_that_dies_leaves_an_empty_table(spark, path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            sinks.append_series(point(spark, 2.0), path, ["system"])
    assert tables.read_series(spark, path).count() == 0
    sinks.append_series(point(spark, 1.0), path, ["system"])
    assert values(spark, path) == [1.0]


def meanwhile(monkeypatch, action):
    """Run ``action`` once, as another writer, before the next commit."""
    put, todo = snapshots.commit, [action]

    def commit(*args):
        if todo:
            todo.pop()()
        return put(*args)

    monkeypatch.setattr(snapshots, "commit", commit)


def test_two_writers_of_one_partition(spark, path, monkeypatch):
    sinks.append_series(point(spark, 1.0), path, ["system"])
    meanwhile(monkeypatch, lambda: sinks.append_series(point(spark, 5.0, created=5), path, ["system"]))
    with pytest.raises(snapshots.WriteConflict, match="2022-01-01"):
        sinks.append_series(point(spark, 7.0, created=7), path, ["system"])
    assert values(spark, path) == [5.0]
    sinks.append_series(point(spark, 7.0, created=7), path, ["system"])
    assert values(spark, path) == [7.0]


def test_writers_of_different_days_do_not_disturb_each_other(spark, path, monkeypatch):
    other = point(spark, 5.0, day=1).withColumnRenamed("x", "y")
    meanwhile(monkeypatch, lambda: sinks.append_series(other, path, ["system"]))
    sinks.append_series(point(spark, 7.0), path, ["system"])
    rows = {r["date"].day: (r["x"], r["y"]) for r in tables.read_series(spark, path).collect()}
    assert rows == {1: (7.0, None), 2: (None, 5.0)}


def test_many_versions_and_older_ones(spark, path):
    for n in range(12):
        sinks.append_series(point(spark, float(n), created=n, day=n % 2), path, ["system"])
    held = snapshots.load(spark, path)
    assert held.version == 12 and len(held.folders) == 2
    assert values(spark, path) == [10.0, 11.0]
    assert sorted(r["x"] for r in tables.read_series(spark, path, version=3).collect()) == [1.0, 2.0]
    one = tables.read_series(spark, path, DAY + timedelta(days=1), DAY + timedelta(days=2))
    assert [r["x"] for r in one.collect()] == [11.0] and len(one.inputFiles()) == 1


def test_a_column_keeps_its_type(spark, path):
    sinks.append_series(point(spark, 1.0), path, ["system"])
    with pytest.raises(ValueError, match="x is double"):
        text = point(spark, 2.0, day=1).withColumn("x", F.lit("text"))
        sinks.upsert_last_write_wins(text, path, ["system"])
    assert values(spark, path) == [1.0]


def test_one_series_of_many_opens_few_row_groups(spark, path, monkeypatch):
    monkeypatch.setattr(sinks, "ROW_GROUP_BYTES", 1 << 20)
    spark.conf.set("spark.gridloom.buckets", "1")
    try:
        rows = spark.range(400_000).select(
            (F.lit(DAY).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 200).cast("decimal(18,6)"))).alias("time"),
            F.concat(F.lit("s"), F.floor(F.col("id") / 200)).alias("system"), F.rand(1).alias("x"),
        )
        sinks.append_series(rows, path, ["system"])
    finally:
        spark.conf.unset("spark.gridloom.buckets")
    (file,) = tables.read_series(spark, path).inputFiles()
    meta = pq.ParquetFile(file.removeprefix("file://").removeprefix("file:")).metadata
    names = [meta.row_group(g).column(c).path_in_schema for g in range(1) for c in range(meta.num_columns)]
    at = names.index("system")
    held = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    assert len(held) > 1 and all(a.max <= b.min for a, b in zip(held, held[1:]))
    found = tables.scan_series(tables.read_series(spark, path), system="s1234")
    assert found.count() == 200
    opened = found._jdf.queryExecution().executedPlan()
    read = sum(meta.row_group(g).num_rows for g, s in enumerate(held) if s.min <= "s1234" <= s.max)
    assert read <= meta.num_rows / 2, opened.toString()
