"""Registered queries: each binds operators to the stand-in inputs, with an oracle where SQL can say it."""

from __future__ import annotations

from importlib import import_module

from assetboard.plans import registry

_MODULES = ("scans", "cleaning", "identity", "profiles", "evaluation", "panels", "pricing", "boards", "leagues",
            "learning", "streams")


def load() -> None:
    for name in _MODULES:
        import_module(f"assetboard.plans.{name}")


def queries():
    load()
    return dict(registry.QUERIES)


def oracle_sql():
    load()
    return dict(registry.ORACLES)
