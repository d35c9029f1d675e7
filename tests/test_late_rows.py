"""A late batch is compared with the archive once; the ledger and the declarations share what changed."""

from __future__ import annotations

import datetime as dt

from seriesloom.operators import revisions
from seriesloom.streaming import incremental

SCHEMA = "series_id string, as_of date, recorded_on date, value double, value_tr double"


def test_changed_cells_are_found_once_a_batch(spark, tmp_path, monkeypatch):
    calls, plain = [], revisions.changed_cells

    def counted(*args, **kwargs):
        calls.append(1)
        return plain(*args, **kwargs)

    monkeypatch.setattr(revisions, "changed_cells", counted)
    landing, archive, face, journal, state, cells = (str(tmp_path / n) for n in ("landing", "archive", "face", "journal", "state", "cells"))
    for run, value in enumerate((1.0, 2.0)):
        day = dt.date(2024, 1, 10 + run)
        spark.createDataFrame([("a", dt.date(2024, 1, 1 + i), day, value, value) for i in range(9)], SCHEMA).write.mode("append").parquet(landing)
        stream = incremental.landing(spark, landing, spark.read.parquet(landing).schema)
        incremental.declare_and_append(stream, archive, face, journal, state, day, cells)
    assert len(calls) == 1
    assert spark.read.parquet(cells).count() == 18
    told = spark.read.parquet(journal).select("settled_n", "historical_value_n", "tr_rescale_n").collect()
    assert [tuple(r) for r in told] == [(16, 1, 1)]
