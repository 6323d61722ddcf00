"""The queries of this subpackage by key, with the SQL that checks them where SQL can."""

from __future__ import annotations

from ..catalog.registry import Query
from ..session import use_utc

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(build: Query) -> Query:
        QUERIES[key] = lambda spark, sf_dir: build(use_utc(spark), sf_dir)
        if sql is not None:
            ORACLES[key] = sql
        return build
    return add
