"""Every named query against its checking SQL on the same tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from seriesloom import workloads

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
DIGITS = int(os.environ.get("CHECK_DIGITS", "12"))  # 17 compares doubles exactly
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
workloads.load_all()
QUERIES, ORACLES = workloads.QUERIES, workloads.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else (0.0 if number == 0 else float(f"{number:.{DIGITS}g}"))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = frame.collect()
    assert got, "query returned no rows"
    if name not in ORACLES:
        return
    relation = duck.execute(ORACLES[name])
    want_names = [d[0] for d in relation.description]
    want = relation.fetchall()
    assert sorted(frame.columns) == sorted(want_names)
    left, right = canonical(frame.columns, got), canonical(want_names, want)
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    assert len(left) == len(right), (len(left), len(right), differing[:2])
    assert not differing, (len(differing), sorted(frame.columns), differing[:3])
