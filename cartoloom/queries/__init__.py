"""Registered queries of the core and their oracle SQL."""

from __future__ import annotations


def _modules() -> list:
    from cartoloom.queries import pipeline, problems, spatial

    return [problems, spatial, pipeline]


def queries() -> dict:
    return {name: run for m in _modules() for name, run in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
