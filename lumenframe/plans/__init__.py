"""Queries over the base tables, one module per family."""

from __future__ import annotations

from importlib import import_module

MODULES = ("sales", "listings", "series", "scoring", "ratings", "texts", "vectors", "files", "training", "streams")


def load_all() -> None:
    """Imports every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"lumenframe.plans.{name}")
