"""Registered queries over the test tables, each with its SQL check."""

from __future__ import annotations

import importlib
import pkgutil


def load():
    """Import every query module once and return the registry."""
    for mod in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{mod.name}")
    return importlib.import_module(f"{__name__}.registry")
