"""Registered queries: one per operator of the inventory, each with the DuckDB
oracle SQL that checks it (``None`` where only a rows check is possible)."""

from . import contacts, process, relational, snapshots, sources, standardize  # noqa: F401  (registers queries)
from .common import REGISTRY


def queries():
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql():
    return {k: q.oracle for k, q in REGISTRY.items() if q.oracle}
