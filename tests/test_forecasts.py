"""Stored forecasts by horizon."""

from datetime import datetime, timedelta

from gridloom.plans import forecasts

T0 = datetime(2022, 1, 1)


def test_horizons_are_dealt_before_they_become_wide_rows(spark):
    """Twenty means were held for each job and bucket of a task that had hardly two rows of one."""
    rows = [
        (1, "demand", "x", T0 + timedelta(hours=h), ahead, float(h), 1.0)
        for h in range(48)
        for ahead in (1.0, 24.0)
    ]
    rows += [(1, None, "y", T0, 24.0, 100.0, None), (1, "est_wind", "x", T0, 24.0, 1e9, 1.0), (2, None, None, T0, 1.0, None, None)]
    rows += [(None, "demand", "x", T0, 1.0, 7.0, 2.0), (None, "demand", "x", T0, 2.0, 9.0, 9.0)]
    points = spark.createDataFrame(
        rows, "pid int, type string, customer string, time timestamp, tAhead double, forecast_solar double, stdev double"
    )
    found = forecasts.predicted_load_tahead(points, T0, T0 + timedelta(days=2), 1440, component=True)
    cells = {(r["pid"], r["datetime"].day): r.asDict() for r in found.collect()}
    assert set(cells) == {(1, 1), (1, 2), (None, 1)}
    first = cells[1, 1]
    assert first["forecast_solar_1.0h"] == 11.5 and first["forecast_solar_24.0h"] == (11.5 + 100.0) / 2
    assert first["stdev_24.0h"] == 1.0 and first["forecast_solar_4.0h"] is None
    assert cells[1, 2]["forecast_solar_24.0h"] == 35.5 and cells[None, 1]["forecast_solar_1.0h"] == 7.0
    lines = found._jdf.queryExecution().sparkPlan().toString().split("\n")
    wide = [i for i, line in enumerate(lines) if "avg(CASE" in line]
    dealt = [i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line]
    assert wide and dealt and max(wide) < min(dealt)
