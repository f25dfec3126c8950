"""Named queries over the test tables, each with an equivalent SQL text where there is one."""

from __future__ import annotations

from importlib import import_module

MODULES = ("features", "cleaning", "stocking", "modelling", "files")


def load() -> dict:
    """All cases, in the order of their modules."""
    for name in MODULES:
        import_module(f"registry.{name}")
    return import_module("registry.cases").CASES
