"""Grid load, weather and forecast analytics as plain PySpark DataFrame functions."""
