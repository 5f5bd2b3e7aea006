"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["profiling", "preparation", "modelling", "evaluation", "series"]


def _merged(name: str) -> dict:
    result: dict = {}
    for m in _MODULES:
        result.update(getattr(import_module(f"registry.{m}"), name))
    return result


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
