"""Operators put together: the daily pipeline, forecasts and the registered queries."""
