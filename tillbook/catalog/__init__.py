"""Runnable queries over the test tables, each with its oracle SQL."""

from __future__ import annotations

import importlib
import pkgutil


def load_all():
    """Import every catalog module and return the registry."""
    from tillbook.catalog import base

    for m in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{m.name}")
    return base
