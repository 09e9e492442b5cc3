"""Every registered query of the reference's operators with its DuckDB counterpart."""

from __future__ import annotations

from tenderspark.plans import catalog, classify, documents, files, ingest, matching, prices, runs

MODULES = (catalog, classify, documents, files, ingest, matching, prices, runs)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
