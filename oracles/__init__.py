"""SQL equivalents of the registered queries, for the side-by-side check."""

from __future__ import annotations

from importlib import import_module
from pkgutil import iter_modules

ALL_SQL: dict[str, str] = {}
for _name in sorted(m.name for m in iter_modules(__path__)):
    ALL_SQL.update(getattr(import_module(f"{__name__}.{_name}"), "SQL", {}))
