"""Queries over the given tables: one per operator, each with its DuckDB counterpart."""

from __future__ import annotations

import importlib
import pkgutil
from types import ModuleType


def load() -> ModuleType:
    """Import every query module and return the filled registry."""
    for m in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        importlib.import_module(f"{__name__}.{m.name}")
    return importlib.import_module(f"{__name__}.registry")
