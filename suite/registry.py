"""All registered queries and oracles."""

from __future__ import annotations

from importlib import import_module

MODULES = ["playbook", "warehouse", "quality", "history", "population", "features", "governance", "roundtrips", "streams", "topics"]

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = import_module(f"suite.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
