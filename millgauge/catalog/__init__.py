"""Runnable queries over the given tables, each next to the SQL it must equal."""

from __future__ import annotations

from importlib import import_module

SECTIONS = ("versions", "expressions", "joins", "aggregates", "indicators", "report_queries", "dimensions_queries", "model_queries",
            "stream_queries")


def load():
    """(queries, comparison SQL) of all sections."""
    for name in SECTIONS:
        import_module(f"{__name__}.{name}")
    from . import registry

    return dict(registry.QUERIES), dict(registry.ORACLES)
