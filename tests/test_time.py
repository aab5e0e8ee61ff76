from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.functions import timeops
from gridloom.operators import grids
from gridloom.plans import predictors
from gridloom.plans.weather import with_source_run

T0 = datetime(2022, 1, 1)


def values(df, order="datetime"):
    return [r[-1] for r in sorted(map(tuple, df.collect()), key=lambda r: str(r))]


@pytest.mark.parametrize(
    "options, given, expected",
    [
        ([0, 1, 24, 48], [0.25, 23, 47.4], [0, 1, 24]),
        ([0, 1, 24, 48], [50, 100], [48, 48]),
        ([60], [50, 100], [None, 60]),
        ([], [1.0], [None]),
        ([48, 0, 24, 1], [0.25, 23, 47.4], [0, 1, 24]),
        ([0, 1], [1.0, 0.0, -3.0, float("nan"), None], [0, None, None, None, None]),
    ],
)
def test_round_down_horizon(spark, options, given, expected):
    df = spark.createDataFrame([(i, None if g is None else float(g)) for i, g in enumerate(given)], "i int, h double")
    found = df.select("i", timeops.round_down_horizon(F.col("h"), options).alias("o")).orderBy("i").collect()
    assert [r["o"] for r in found] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2022-03-04 15:00:00", "2022-03-04 15:00:00"),
        ("2022-03-04 06:20:00", "2022-03-04 06:15:00"),
        ("2022-03-04 06:20:16.00003", "2022-03-04 06:15:00"),
    ],
)
def test_floor_within_hour(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    found = df.select(timeops.floor_within_hour(F.col("t"), 15).cast("string")).first()[0]
    assert found == expected


@pytest.mark.parametrize(
    "hours, expected",
    [
        (6.0, "2024-12-10 09:30:00"),
        (0.0, "2024-12-10 15:30:00"),
        (-3.0, "2024-12-10 18:30:00"),
        (1000.0, "2024-10-29 23:30:00"),
        (2.5, "2024-12-10 13:00:00"),
    ],
)
def test_source_run(spark, hours, expected):
    df = spark.createDataFrame([("2024-12-10 15:30:00", hours)], "s string, h double")
    df = df.select(F.col("s").cast("timestamp").alias("t"), "h")
    assert with_source_run(df, "t", "h").select(F.col("created").cast("string")).first()[0] == expected


def test_source_run_refuses_text(spark):
    df = spark.createDataFrame([("2024-12-10 15:30:00", "6")], "t string, h string")
    with pytest.raises(ValueError):
        with_source_run(df, "t", "h")
    with pytest.raises(ValueError):
        with_source_run(df.withColumn("t", F.col("t").cast("timestamp")), "t", "h")


def test_offset_text_follows_summer_time(spark):
    df = spark.createDataFrame([("2019-10-16 20:00:00",), ("2019-12-16 20:00:00",)], "s string")
    found = df.select(timeops.offset_text(F.col("s").cast("timestamp"))).collect()
    assert [r[0] for r in found] == ["2019-10-16T22:00:00+0200", "2019-12-16T21:00:00+0100"]


def test_bucket_before_the_epoch_and_by_column(spark):
    df = spark.createDataFrame([("1969-12-31 23:50:00", 15), ("2022-01-01 10:59:00", 60)], "s string, w int")
    found = df.select(timeops.bucket(F.col("s").cast("timestamp"), F.col("w")).cast("string")).collect()
    assert sorted(r[0] for r in found) == ["1969-12-31 23:45:00", "2022-01-01 10:00:00"]


def test_time_grid_is_floored_and_closed(spark):
    grid = grids.time_grid(spark, datetime(2022, 1, 1, 10, 8), datetime(2022, 1, 1, 10, 40), 15)
    assert [str(r[0])[11:16] for r in grid.orderBy("datetime").collect()] == ["10:00", "10:15", "10:30"]
    assert grids.time_grid(spark, T0, T0 + timedelta(days=1), 15).count() == 97


@pytest.mark.parametrize("minutes", [15, 60, 1440, 2880])
def test_key_grid_equals_time_grid(spark, minutes):
    keys = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    start, end = datetime(2022, 1, 1, 7, 20), datetime(2022, 1, 9, 3, 10)
    one = {r[0] for r in grids.time_grid(spark, start, end, minutes).collect()}
    many = grids.key_grid(keys, start, end, minutes).collect()
    assert len(many) == 2 * len(one)
    assert {r["datetime"] for r in many if r["k"] == "b"} == one


def random_series(seed, n=300, names=("a", "b", "c")):
    """Wide points with gaps of all lengths, missing rows, leading and trailing nulls."""
    rng = np.random.default_rng(seed)
    rows = []
    for name in names:
        keep = np.sort(rng.choice(n, size=n // 3, replace=False))
        for i in keep:
            x = rng.normal() if rng.random() < 0.6 else None
            y = rng.normal() if rng.random() < 0.3 else None
            rows.append((name, T0 + timedelta(minutes=15 * int(i)), x, y))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "series string, datetime timestamp, x double, y double")


def to_pandas(df):
    pdf = df.toPandas().sort_values(["series", "datetime"]).reset_index(drop=True)
    pdf["datetime"] = pdf["datetime"].astype("datetime64[ns]")
    return pdf


def by_pandas(rows, method, **kw):
    pdf = pd.DataFrame(rows, columns=["series", "datetime", "x", "y"])
    pdf[["x", "y"]] = pdf[["x", "y"]].astype("float64")
    pdf["datetime"] = pdf["datetime"].astype("datetime64[ns]")
    parts = []
    for name, part in pdf.groupby("series"):
        grid = part.set_index("datetime")[["x", "y"]].resample("15min").mean()
        grid = grid.ffill() if method == "ffill" else grid.interpolate(**kw)
        parts.append(grid.reset_index().assign(series=name))
    return pd.concat(parts)[["series", "datetime", "x", "y"]].reset_index(drop=True)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [None, 1, 3, 11])
@pytest.mark.parametrize("path", ["single", "chunked"])
def test_fill_gaps_equals_pandas(spark, seed, limit, path):
    rows = random_series(seed)
    options = {"span": (T0, T0 + timedelta(days=4))} if path == "single" else {"chunk_steps": 17}
    found = to_pandas(grids.fill_gaps(frame(spark, rows), ["series"], ["x", "y"], 15, limit, **options))
    pd.testing.assert_frame_equal(found, by_pandas(rows, "linear", limit=limit))


@pytest.mark.parametrize("options", [{"span": (T0, T0 + timedelta(days=4))}, {"chunk_steps": 17}])
def test_interpolate_inside_and_forward_fill_equal_pandas(spark, options):
    rows = random_series(5)
    inside = to_pandas(grids.interpolate_inside(frame(spark, rows), ["series"], ["x", "y"], 15, **options))
    pd.testing.assert_frame_equal(inside, by_pandas(rows, "linear", limit_area="inside"))
    forward = to_pandas(grids.forward_fill(frame(spark, rows), ["series"], ["x", "y"], 15, **options))
    pd.testing.assert_frame_equal(forward, by_pandas(rows, "ffill"))


def test_fill_without_series_and_by_columns(spark):
    rows = random_series(9, names=("a",))
    points = frame(spark, rows).drop("series")
    expected = by_pandas(rows, "linear", limit=3).drop(columns="series")
    for df in (
        grids.fill_gaps(points, [], ["x", "y"], 15, 3),
        grids.fill_columns(points, ["x", "y"], 15, 3, span=(T0, T0 + timedelta(days=4))),
    ):
        found = df.toPandas().sort_values("datetime").reset_index(drop=True)
        found["datetime"] = found["datetime"].astype("datetime64[ns]")
        pd.testing.assert_frame_equal(found, expected)


def spline_case(spark, f, n, gaps, **options):
    rows = [("s", T0 + timedelta(minutes=15 * i), None if gaps(i) else float(f(i)), None) for i in range(n)]
    points = frame(spark, rows).drop("y")
    found = grids.interpolate_cubic(points, ["series"], "x", 15, **options).orderBy("datetime").collect()
    assert len(found) == n
    return np.array([np.nan if r["x"] is None else r["x"] for r in found])


def test_cubic_reproduces_a_cubic(spark):
    f = lambda i: 0.001 * i**3 - 0.2 * i**2 + 3 * i - 7
    found = spline_case(spark, f, 120, lambda i: 40 < i < 47 or i % 5 == 2)
    np.testing.assert_allclose(found, [f(i) for i in range(120)], rtol=1e-9, atol=1e-8)


def dense_spline(x, y, at):
    """The not-a-knot spline by one dense system over the coefficients' second derivatives."""
    n, h = len(x), np.diff(x)
    a, b = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    a[0, :3] = h[1], -(h[0] + h[1]), h[0]
    a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    m = np.linalg.solve(a, b)
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    u, v = (x[k + 1] - at) / h[k], (at - x[k]) / h[k]
    return u * y[k] + v * y[k + 1] + ((u**3 - u) * m[k] + (v**3 - v) * m[k + 1]) * h[k] ** 2 / 6


@pytest.mark.parametrize("steps", [100_000, 100, 7, 3, 1])
def test_cubic_in_stretches_is_the_spline_of_the_whole_series(spark, steps):
    n = 300 if steps < 7 else 1400
    f = lambda i: np.sin(i / 3.0) * 10 + (i * 7919 % 13)
    gaps = lambda i: i < 4 or i > n - 10 or i % 4 == 1 or n // 2 < i < n // 2 + 30
    found = spline_case(spark, f, n, gaps, steps=steps)
    x = np.array([i for i in range(n) if not gaps(i)], float)
    at = np.arange(x[0], x[-1] + 1)
    np.testing.assert_allclose(found[~np.isnan(found)], dense_spline(x, f(x), at), rtol=1e-8, atol=1e-8)
    assert np.isnan(found[: int(x[0])]).all() and np.isnan(found[int(x[-1]) + 1 :]).all()


def test_cubic_of_every_number_of_knots(spark):
    rows, f = [], lambda i: 0.1 * i**3 - i
    for n in range(9):
        rows += [(f"s{n}", T0 + timedelta(minutes=15 * i), float(f(i)) if i % 3 == 0 and i < 3 * n else None, None) for i in range(30)]
    points = frame(spark, rows).drop("y")
    for steps in (1, 4, 1000):
        found = grids.interpolate_cubic(points, ["series"], "x", 15, steps=steps).toPandas().sort_values(["series", "datetime"])
        for n in range(9):
            got = found[found.series == f"s{n}"].x.to_numpy(float)
            known = np.arange(n) * 3
            want = np.full(30, np.nan)
            if n:
                inside = np.arange(known[-1] + 1)
                want[inside] = np.polynomial.Polynomial.fit(known, f(known), min(n - 1, 3))(inside) if n > 1 else f(0)
            np.testing.assert_allclose(got, want, atol=1e-7)


def test_cubic_with_few_knots(spark):
    line = spline_case(spark, lambda i: 2.0 * i, 5, lambda i: i in (1, 2, 3))
    np.testing.assert_allclose(line, [0, 2, 4, 6, 8])


def test_floor_value_and_size():
    assert timeops.floor_value(datetime(2022, 1, 1, 10, 44), 15) == datetime(2022, 1, 1, 10, 30, tzinfo=timezone.utc)
    assert timeops.grid_size(T0, T0 + timedelta(days=1), 15) == 97


@pytest.mark.parametrize("wider, limit", [(30, 3), (60, None), (5, 2), (40, 11)])
def test_refill_gaps_like_the_steps_one_by_one(spark, wider, limit, monkeypatch):
    def written(df):
        # Sums of more than two are added in another order.
        return sorted(str([f"{v:.9g}" if isinstance(v, float) else str(v) for v in row]) for row in df.collect())

    rng = np.random.default_rng(7)
    rows = []
    for name, step in [("a", 1), ("b", 9), ("c", 40), ("d", 300), (None, 2)]:
        for i in np.cumsum(rng.integers(1, step + 1, 60)).tolist():
            cells = [None if rng.random() < 0.4 else float(rng.normal()) for _ in range(3)]
            rows.append((name, T0 + timedelta(minutes=15 * i - 4000), *cells))
    rows += [("lone", T0, 1.0, None, float("nan")), ("e", None, 1.0, 2.0, 3.0), ("far", T0 + timedelta(days=200), 1.0, 2.0, None)]
    rows += [("far", T0, 5.0, None, float("inf")), ("far", T0 + timedelta(minutes=30), 7.0, None, 2.0)]
    points = spark.createDataFrame(rows, "key string, datetime timestamp, x double, y double, z double").repartition(3)
    span = T0 - timedelta(days=30), T0 + timedelta(days=300)
    columns = ["x", "y", "z"]
    monkeypatch.setattr(grids, "REFILL_POINTS", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        args = points, ["key"], columns, 15, wider, limit, span
        found = written(grids.refill_gaps(*args))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == written(grids.refill_gaps(*args, rows_per_series=10))
    fine = grids.fill_gaps(points, ["key"], columns, 15, limit, span=span)
    means = grids.bucket_mean(fine, ["key"], columns, wider, time="datetime")
    assert found == written(grids.fill_gaps(means, ["key"], columns, wider, limit, span=span))


def test_refill_gaps_makes_no_row_before_the_answer(spark):
    """The grids were rows that were aggregated and sorted, many for each point."""
    points = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + timedelta(days=9), 2.0)], "input_city string, time timestamp, temp double")
    found = predictors.weather_predictors(points.withColumn("source", F.lit("s")), T0, T0 + timedelta(days=30), 60, "s")
    assert found.count() == 9 * 24 + 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
