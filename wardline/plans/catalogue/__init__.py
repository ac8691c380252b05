"""Registered queries by family; each maps a name to ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from importlib import import_module
from pkgutil import iter_modules


def all_queries() -> dict:
    found = {}
    for module in sorted(m.name for m in iter_modules(__path__)):
        found.update(import_module(f"{__name__}.{module}").QUERIES)
    return found
