"""Registered queries of the library. Other modules of queries are handed in by whoever has them."""

from __future__ import annotations

import functools
import importlib

from sondar.plans.ship import ship


def _modules(more: tuple = ()) -> list:
    names = ["sondar.queries.general", "sondar.queries.engine", "sondar.queries.evidence"]
    found = []
    for n in names:
        try:
            found.append(importlib.import_module(n))
        except ModuleNotFoundError as e:
            if e.name != n:
                raise
    return [*found, *more]


def _shipped(f):
    @functools.wraps(f)
    def run(spark, sf_dir):
        ship(spark)
        return f(spark, sf_dir)

    return run


def queries(more: tuple = ()) -> dict:
    return {k: _shipped(f) for m in _modules(more) for k, f in m.QUERIES.items()}


def oracles(more: tuple = ()) -> dict:
    return {k: f for m in _modules(more) for k, f in m.ORACLES.items()}
