"""Registered queries: each operator run on the driver tables, with its SQL where one exists."""

from importlib import import_module, util


def load():
    """Import every query module once and return the registry."""
    for name in ("shaping", "filling", "statistics", "modelling", "storage"):
        if util.find_spec(f"catalog.{name}"):
            import_module(f"catalog.{name}")
    return import_module("catalog.registry")
