import pytest
from pyspark.sql import functions as F

from gridloom.functions.numeric import quantile_label, wind_at_height
from gridloom.operators import jobs
from gridloom.plans import forecasts, predictors

FIELDS = "id bigint, name string, forecast_type string, model string, horizon_minutes int, resolution_minutes int, train_horizons_minutes string, active int"


@pytest.fixture
def table(spark):
    rows = [
        (1, "ATO one", "demand", "xgb", 2880, 15, "[15, 2880, 15000]", 1),
        (2, "ATO HS", "wind", "lgb", 2880, 15, None, 1),
        (3, "other", None, "xgb", 2880, 15, "", 0),
    ]
    return spark.createDataFrame(rows, FIELDS)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_filters(table):
    assert ids(jobs.filter_jobs(table, pid=[1, "3"])) == [1, 3]
    assert ids(jobs.filter_jobs(table, model_type="xgb", is_active=5)) == [1]
    assert ids(jobs.filter_jobs(table, is_active=0)) == [3]
    assert ids(jobs.filter_jobs(table, only_ato=True)) == [1]
    assert ids(jobs.filter_jobs(table, limit=2)) == [1, 2]
    for bad in ({"pid": 1.5}, {"model_type": 3}, {"pid": [1, None]}):
        with pytest.raises(ValueError):
            jobs.filter_jobs(table, **bad)
    with pytest.raises(ValueError, match="99"):
        jobs.require_jobs(table, 99)


def test_records_and_rejects(table):
    found = {r["id"]: r["train_horizons_minutes"] for r in jobs.job_records(table).collect()}
    assert found == {1: [15, 2880, 15000], 2: None}
    assert ids(jobs.rejected_jobs(table)) == [3]
    assert ids(jobs.rejected_jobs(table.drop("forecast_type"))) == [1, 2, 3]


def test_quantiles_keep_duplicates(spark, table):
    sets = spark.createDataFrame([(1, "[0.9, 0.1]"), (2, "[0.5, 0.1]")], "id int, quantiles string")
    links = spark.createDataFrame([(1, 1), (1, 2), (2, 9)], "prediction_id bigint, quantile_set_id int")
    found = {r["id"]: r["quantiles"] for r in jobs.attach_quantiles(table, links, sets).collect()}
    assert found == {1: [0.1, 0.1, 0.5, 0.9], 2: [], 3: []}


def test_quantile_labels_round_half_to_even(spark):
    df = spark.createDataFrame([(q,) for q in (0.05, 0.5, 0.025, 0.035, 0.95, 1.0)], "q double")
    found = [r[0] for r in df.select(quantile_label(F.col("q"))).collect()]
    assert found == [f"quantile_P{q * 100:02.0f}" for q in (0.05, 0.5, 0.025, 0.035, 0.95, 1.0)]


def test_horizon_texts():
    assert forecasts.parse_horizons("4h") == [4.0]
    assert forecasts.parse_horizons(["24H", "47"]) == [24.0, 47.0]
    with pytest.raises(ValueError):
        forecasts.parse_horizons([4])


def test_predictors_need_sites_for_weather(spark):
    grid = spark.createDataFrame([], "datetime timestamp")
    with pytest.raises(ValueError):
        predictors.predictors(grid, None, None, groups=["weather_data"])
    with pytest.raises(ValueError):
        predictors.predictors(grid, None, None, groups=["moon_phase"])


def test_wind_at_height(spark):
    df = spark.createDataFrame([(3.0,)], "v double")
    assert df.select(wind_at_height(F.col("v"))).first()[0] == pytest.approx(3.0 * 10**0.143)
    with pytest.raises(Exception, match="negative"):
        spark.createDataFrame([(-1.0,)], "v double").select(wind_at_height(F.col("v"))).collect()
