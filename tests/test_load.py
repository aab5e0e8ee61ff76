from datetime import datetime

import pytest

from gridloom.operators import load

SYSTEMS = ["V12", "V13", "V14"]
TIMES = [datetime(2019, 1, 1, 10, 0), datetime(2019, 1, 1, 10, 15)]
VALUES = {"V12": [15.0, 20.0], "V13": [11.0, 13.0], "V14": [9.0, 7.0]}


@pytest.fixture
def readings(spark):
    rows = [(t, s, v) for s in SYSTEMS for t, v in zip(TIMES, VALUES[s])]
    return spark.createDataFrame(rows, "time timestamp, system string, output double")


def members(spark, polarity=(1, 1, 1), factor=(1.0, 1.0, 1.0)):
    systems = spark.createDataFrame(list(zip(SYSTEMS, polarity)), "sid string, polarity int")
    links = spark.createDataFrame([(7, s, f) for s, f in zip(SYSTEMS, factor)], "prediction_id int, system_id string, factor double")
    return systems, links


@pytest.mark.parametrize(
    "polarity, factor, expected",
    [
        ((1, 1, 1), (1.0, 1.0, 1.0), [35.0, 40.0]),
        ((-1, -1, -1), (1.0, 1.0, 1.0), [-35.0, -40.0]),
        ((1, 1, 1), (-1.0, -1.0, -1.0), [-35.0, -40.0]),
        ((-1, 1, 1), (1.0, 1.0, 1.0), [5.0, 0.0]),
        ((1, 1, 1), (-0.5, 1.0, 1.0), [12.5, 10.0]),
        ((0, 0, 0), (0.0, 0.0, 0.0), [35.0, 40.0]),
    ],
)
def test_weighted_job_load(spark, readings, polarity, factor, expected):
    found = load.weighted_job_load(readings, *members(spark, polarity, factor), 15).orderBy("datetime").collect()
    assert [r["load"] for r in found] == expected
    assert {r["pid"] for r in found} == {7}


@pytest.mark.parametrize(
    "polarity, factor, sign",
    [((-1, -1, -1), (1.0, 1.0, 1.0), -1), ((1, 1, 1), (-1.0, -1.0, -1.0), -1), ((0, 0, 0), (1.0, 1.0, 1.0), 1)],
)
def test_job_load_per_system(spark, readings, polarity, factor, sign):
    found = load.job_load_per_system(readings, *members(spark, polarity, factor), 15).collect()
    assert {(r["system"], r["datetime"]): r["load"] for r in found} == {
        (s, t): sign * v for s in SYSTEMS for t, v in zip(TIMES, VALUES[s])
    }


def test_zero_factor_stays_zero_per_system(spark, readings):
    found = load.job_load_per_system(readings, *members(spark, factor=(0.0, 1.0, 1.0)), 15).collect()
    assert {r["load"] for r in found if r["system"] == "V12"} == {0.0}


def test_ignore_factor(spark, readings):
    found = load.weighted_job_load(readings, *members(spark, (-1, 1, 1), (5.0, 5.0, 5.0)), 15, ignore_factor=True)
    assert [r["load"] for r in found.orderBy("datetime").collect()] == [5.0, 0.0]


def test_missing_system_is_reported_not_fatal(spark, readings):
    few = readings.where("system <> 'V12'")
    systems, links = members(spark)
    found = load.job_load_per_system(few, systems, links, 15).collect()
    assert len(found) == 4 and {r["system"] for r in found} == {"V13", "V14"}
    assert [tuple(r) for r in load.missing_systems(few, links).select("pid", "system_id").collect()] == [(7, "V12")]


def test_a_busy_system_does_not_weigh_more(spark):
    rows = [(datetime(2022, 1, 1, 0, m), "a", 10.0 + m) for m in range(15)] + [(datetime(2022, 1, 1), "b", 3.0)]
    readings = spark.createDataFrame(rows, "time timestamp, system string, output double")
    total = load.load_by_systems(readings, 15).first()
    assert (total["load"], total["nEntries"]) == (20.0, 2)
    assert load.load_by_systems(readings, 15, average_output=True).first()["load"] == 10.0


def test_a_nan_reading_counts_as_missing(spark):
    rows = [(datetime(2022, 1, 1), "a", float("nan")), (datetime(2022, 1, 1, 0, 1), "a", 4.0), (datetime(2022, 1, 1), "b", None)]
    readings = spark.createDataFrame(rows, "time timestamp, system string, output double")
    total = load.load_by_systems(readings, 15).first()
    assert (total["load"], total["nEntries"]) == (4.0, 1)
