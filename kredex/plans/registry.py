"""Collects every registered query (importing the modules registers them)."""

from __future__ import annotations

from . import catalog, oracle
from . import extract_queries, report_queries  # noqa: F401  (register queries)


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    cased = oracle.statements(case_sensitive=True)
    ends = catalog.CASED
    return oracle.statements() | {n: cased[n.removesuffix(ends)] for n in catalog.QUERIES if n.endswith(ends)}
