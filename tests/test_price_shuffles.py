"""Bars move once: landed rows are gathered by series while narrow, and nothing after that moves them again."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.operators import corporate
from seriesloom.workloads import prices

FIRST = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Three suppliers, up to three lines a day; holes where the adapter makes them."""
    rows = [(k, k % 3 + 1, k % 7 + 1, FIRST + dt.timedelta(days=k % 400), 100.0 + k % 89, (k % 11) / 100, (k % 9) / 100, float(k % 50 + 1))
            for k in range(1, 3000)]
    folder = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate date, l_extendedprice double, "
                                "l_discount double, l_tax double, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def moves(frame) -> int:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


@pytest.mark.parametrize("query, sides", [(prices.a5, 1), (prices.p11, 1), (prices.s3, 1), (prices.p10, 1), (prices.b14, 2), (prices.j6, 2)])
def test_each_side_moves_once(spark, lines, query, sides):
    # two sides are one exchange read twice, or one each
    assert 1 <= moves(query(spark, lines)) <= sides


def test_gathered_rows_are_the_landed_rows(spark, lines):
    plain, gathered = adapters.landed_bars(spark, lines), adapters.landed_bars(spark, lines, gathered=True)
    assert plain.count() == gathered.count() and plain.exceptAll(gathered).isEmpty()
    assert corporate.build_bars(plain).exceptAll(corporate.build_bars(gathered)).isEmpty()


def test_missing_factors_equal_the_plain_joins(spark, lines):
    stored, pulled = prices.stored_before_split(spark, lines), prices.repull(spark, lines)
    stored = stored.filter("as_of >= DATE '2020-02-01' OR series_id <> 'eq_2'")
    pulled = pulled.filter("series_id <> 'eq_3'").withColumn("split_factor", F.dayofyear("as_of").cast("double"))
    first = stored.groupBy("series_id").agg(F.min("as_of").alias("first_day"))
    covered = pulled.join(first, "series_id").filter(F.col("as_of") >= F.col("first_day"))
    missing = stored.join(covered, ["series_id", "as_of"], "left_anti").join(covered.select("series_id").distinct(), "series_id", "left_semi")
    want = {tuple(r) for r in corporate.factor_as_of(missing, covered).collect()}
    got = [tuple(r) for r in corporate.missing_factors(stored, pulled).collect()]
    assert want and len(got) == len(set(got)) and set(got) == want
