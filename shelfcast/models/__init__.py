"""Forecast models: a boosted panel model and a linear sequence model per product."""
