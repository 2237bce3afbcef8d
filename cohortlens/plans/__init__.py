"""Composed plans: feature pipeline, model fitting, tuning, query catalogue."""
