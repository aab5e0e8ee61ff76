from datetime import datetime

import pytest

from gridloom.plans import weather

FIELDS = ["clouds", "radiation", "rain", "temp"]
HOURS = [datetime(2019, 12, 1, h) for h in (1, 2, 3)]


def wide(spark, gaps=True):
    rows = []
    for i, t in enumerate(HOURS):
        rows.append((t, "De Bilt", "DSN", 10.0 + i, None, 0.1 * i, 1.0 + i))
        rows.append((t, "De Bilt", "harm_arome", 50.0 + i, 5.25e5, None if gaps else 9.0, None if gaps else 20.0 + i))
    return spark.createDataFrame(
        rows, "datetime timestamp, input_city string, source string, clouds double, radiation double, rain double, temp double"
    )


def blended(df, *args):
    found = weather.combine_sources(df, FIELDS, *args).orderBy("datetime")
    return [tuple(r[f] for f in FIELDS) for r in found.collect()]


def test_combine_fills_from_the_next_source(spark):
    assert blended(wide(spark)) == [(50.0 + i, 5.25e5, 0.1 * i, 1.0 + i) for i in range(3)]


def test_combine_without_gaps_keeps_the_first_source(spark):
    assert blended(wide(spark, gaps=False)) == [(50.0 + i, 5.25e5, 9.0, 20.0 + i) for i in range(3)]


def test_combine_in_a_given_order(spark):
    order = ["DSN", "harmonie", "harm_arome"]
    assert blended(wide(spark), order) == [(10.0 + i, 5.25e5, 0.1 * i, 1.0 + i) for i in range(3)]


def test_combine_one_source_leaves_it_unchanged(spark):
    one = wide(spark).where("source = 'harm_arome'")
    assert blended(one) == [(50.0 + i, 5.25e5, None, None) for i in range(3)]


def test_combine_works_on_text(spark):
    df = spark.createDataFrame(
        [(HOURS[0], "x", "DSN", "102.325.234"), (HOURS[0], "x", "harm_arome", None)],
        "datetime timestamp, input_city string, source string, pressure string",
    )
    assert weather.combine_sources(df, ["pressure"]).first()["pressure"] == "102.325.234"


@pytest.fixture
def places(spark):
    locations = spark.createDataFrame(
        [("Rotterdam", 51.926517, 4.462456), ("Amsterdam", 52.377956, 4.897070)], "city string, lat double, lon double"
    )
    return spark.createDataFrame([("s", 52.0, 4.7)], "site string, lat double, lon double"), locations


@pytest.fixture
def points(spark):
    rows = []
    for city, values in (("Amsterdam", [6.9, 1.2]), ("Rotterdam", [7.6, 1.5])):
        rows += [(datetime(2022, 1, 1, 1 + i), city, "harm_arome", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "time timestamp, input_city string, source string, windspeed double")


RANGE = (datetime(2022, 1, 1), datetime(2022, 1, 1, 8))


def test_two_locations_with_distance(spark, points, places):
    found = weather.weather_latest(
        points, *places, ["windspeed"], *RANGE, source="harm_arome", minutes=30, number_locations=2
    ).orderBy("input_city", "datetime")
    rows = [(r["input_city"], r["distance"], round(r["windspeed"], 2)) for r in found.collect()]
    assert rows == [
        ("Amsterdam", 44.2, 6.9), ("Amsterdam", 44.2, 4.05), ("Amsterdam", 44.2, 1.2),
        ("Rotterdam", 18.3, 7.6), ("Rotterdam", 18.3, 4.55), ("Rotterdam", 18.3, 1.5),
    ]


def test_one_location_blended(spark, points, places):
    found = weather.weather_latest(points, *places, ["windspeed"], *RANGE, minutes=30).orderBy("datetime")
    assert "input_city" not in found.columns and "distance" not in found.columns
    assert [(r["source"], round(r["windspeed"], 2)) for r in found.collect()] == [
        ("optimum", 7.6), ("optimum", 4.55), ("optimum", 1.5),
    ]


def test_no_weather_gives_an_empty_frame_of_the_same_form(spark, points, places):
    found = weather.weather_latest(points.where("false"), *places, ["windspeed"], *RANGE)
    assert found.count() == 0 and set(found.columns) == {"site", "source", "datetime", "windspeed"}


def test_runs_are_series_of_their_own(spark):
    runs = [(0, 0.0, 3.6), (1, 1.0, 3.6), (2, 2.0, 1.5), (1, 0.0, 0.6), (2, 1.0, 2.1)]
    rows = [(datetime(2022, 1, 1, h), "Amsterdam", "harm_arome", ahead, v) for h, ahead, v in runs]
    points = spark.createDataFrame(
        rows, "time timestamp, input_city string, source string, tAhead double, windspeed double"
    )
    found = weather.weather_by_run_city(points, ["windspeed"], *RANGE, source="harm_arome", minutes=30)
    got = {}
    for r in found.orderBy("created", "datetime").collect():
        got.setdefault(r["created"], []).append((round(r["windspeed"], 2), r["tAhead"]))
    assert got == {
        datetime(2022, 1, 1, 0): [(3.6, 0.0), (3.6, 0.5), (3.6, 1.0), (2.55, 1.5), (1.5, 2.0)],
        datetime(2022, 1, 1, 1): [(0.6, 0.0), (1.35, 0.5), (2.1, 1.0)],
    }


def test_latest_run_defaults_to_the_epoch(spark):
    df = spark.createDataFrame([(datetime(2022, 1, 1), "a", 86400)], "time timestamp, source string, source_run long")
    sources = spark.createDataFrame([("a",), ("b",)], "source string")
    found = weather.latest_weather_run(df, sources, datetime(2022, 1, 2)).collect()
    assert {r["source"]: r["last_stored_run"] for r in found} == {"a": datetime(1970, 1, 2), "b": datetime(1970, 1, 1)}


def test_missing_numbers_of_the_first_source_are_blended(spark):
    rows = [(HOURS[0], "A", "s1", float("nan"), "x"), (HOURS[0], "A", "s2", 3.0, "y")]
    df = spark.createDataFrame(rows, "datetime timestamp, input_city string, source string, temp double, note string")
    row = weather.combine_sources(df, ["temp", "note"], ["s1", "s2"]).first()
    assert (row["temp"], row["note"]) == (3.0, "x")


def test_a_list_of_sources_is_an_order():
    assert weather.preferred(["b", "a"], None) == ("optimum", ["b", "a"])
    assert weather.preferred(["b"], None) == (["b"], None)
    assert weather.preferred("b", None) == ("b", None)
