"""Each operator bound to the test tables, with the SQL that gives the same rows."""

from importlib import import_module

from bindings.registry import ORACLES, QUERIES

for _family in ("scalar", "aggregates", "trends", "language", "similarity", "models", "sources"):
    import_module(f"bindings.{_family}")
