"""Query plans: the registered queries and their DuckDB twins."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLE, QUERIES

_MODULES = ["q_worklists", "q_merge", "q_ingest", "q_enrich", "q_refresh", "q_sinks", "q_profiles"]


def load_all() -> None:
    for m in _MODULES:
        import_module(f"{__name__}.{m}")


load_all()

__all__ = ["QUERIES", "ORACLE", "load_all"]
