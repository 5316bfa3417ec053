"""Registered queries: each runs one operator on the test tables, most with equivalent DuckDB SQL."""

from importlib import import_module

from registry.common import ORACLES, QUERIES

for _name in ("profile", "vocabulary", "cleaning", "features", "splits", "evaluation", "models", "io"):
    import_module(f"registry.{_name}")

__all__ = ["ORACLES", "QUERIES"]
