"""Composed queries: weather, forecasts, model input and splitting input."""
