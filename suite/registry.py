"""All registered queries."""

from __future__ import annotations

from suite import base, censored, diagrams, exchange, jobs, relations, rules, shapes, tables, landed  # noqa: F401


def queries():
    return dict(base.QUERIES)


def oracle_sql():
    return dict(base.ORACLES)
