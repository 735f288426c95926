"""Queries over the driver's tables, with the same results as SQL."""

from importlib import import_module

from .bindings import ORACLES, QUERIES, Tables, query

MODULES = ("ranking", "time", "aggregates", "matching", "structure", "space", "snapshots", "api", "derivations", "sources")
for _name in MODULES:
    import_module(f"{__name__}.{_name}")

__all__ = ["ORACLES", "QUERIES", "Tables", "query"]
