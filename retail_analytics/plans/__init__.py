"""Registered queries, one module per operator family."""
from __future__ import annotations

import importlib
import pkgutil


def load_all():
    """Import every plan module once and return the registry."""
    from retail_analytics.plans.registry import REGISTRY

    for mod in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{mod.name}")
    return REGISTRY
