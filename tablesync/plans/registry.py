"""Registry of named queries: a Spark builder and, where SQL can say the
same thing, a DuckDB oracle statement."""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: Optional[str] = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return wrap


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # importing the modules registers their queries
    from tablesync.plans import (  # noqa: F401
        q_copy,
        q_files,
        q_locate,
        q_metadata,
        q_reconcile,
        q_runs,
        q_selection,
    )
