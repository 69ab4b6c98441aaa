"""Registered queries, each with an equal SQL text for another engine to check it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query under ``key`` with its check SQL."""

    def register(run: Run) -> Run:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return run

    return register


def load() -> tuple[dict[str, Run], dict[str, str]]:
    from larder.catalog import generator, layers, lineage, quality, reports, stores, streams, warehouse  # noqa: F401

    return dict(QUERIES), dict(ORACLES)
