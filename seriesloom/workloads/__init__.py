"""Named queries over the provided tables, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def with_(*parts: str) -> str:
    """Common table expressions followed by the final select.

    The last part may open with further tables of its own before its select.
    """
    *tables, body = parts
    joint = ",\n" if re.match(r"\s*\w+ AS \(", body) else "\n"
    return "WITH " + ",\n".join(tables) + joint + body


def load_all() -> None:
    from seriesloom.workloads import (  # noqa: F401
        history, instruments, positioning, prices, quality, series, storage)
    from seriesloom.workloads import archives, flows  # noqa: F401
