"""Assembled jobs: star model, indicators, measures, reports, migration, health."""
