"""Queries of the text operators and the SQL that checks them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ["toxicity", "suffix_dedup", "packing", "near_dedup", "language", "quality_model", "quality_rules", "lattice_lm", "token_counts",
           "decontamination", "simhash", "filter_audit", "periodic_runs"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"seriesloom.llm.{module}")
