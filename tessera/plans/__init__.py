"""Queries over the star-schema tables, one module for each part of the operator inventory."""

from __future__ import annotations

import importlib

from . import registry

MODULES = ["relational", "social", "market", "text", "graph", "entity", "state", "campaign", "extras", "files"]
for _name in MODULES:
    importlib.import_module(f"{__name__}.{_name}")

QUERIES, ORACLE, COVERS = registry.QUERIES, registry.ORACLE, registry.COVERS
