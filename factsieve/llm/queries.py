"""Queries of the training-data problems, one module a problem."""

from __future__ import annotations

import importlib

_MODULES = ["copy_queries", "survivor_queries", "lookalike_queries", "mapping_queries", "linkage_queries", "leakage_queries", "language_queries", "packing_queries"]

QUERIES: dict = {}
ORACLE: dict = {}
for _name in _MODULES:
    _module = importlib.import_module(f"factsieve.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(getattr(_module, "ORACLE", {}))
