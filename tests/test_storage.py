"""Stored tables and incremental runs: imports, replays, partial replaces, hot keys."""

import datetime as dt
import json

from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators import bitemporal, registry
from seriesloom.sources import extracts, tables
from seriesloom.streaming import incremental


def day(value):
    return dt.date.fromisoformat(value)


def obs(spark, *data):
    return spark.createDataFrame([(s, day(d), float(v)) for s, d, v in data], "series_id string, as_of date, value double")


def values(frame):
    return {(r["series_id"], r["as_of"].isoformat()): r["value"] for r in frame.collect()}


def test_history_lines_import(spark, tmp_path):
    bar = {"series_id": "s", "as_of": "2026-01-02", "value": 1.5, "close": 1.5, "volume": 10, "recorded_on": "2026-01-03", "provisional": True}
    (tmp_path / "2026.jsonl").write_text(json.dumps(bar) + "\n" + json.dumps({**bar, "value": 2.0, "recorded_on": "2026-01-04"}) + "\n")
    log = tables.read_history_lines(spark, str(tmp_path))
    assert log.count() == 2 and bitemporal.current_view(log).first()["value"] == 2.0


def test_series_files_drop_missing_values(spark):
    path = session.scratch_path(spark, "test-files")
    rows = obs(spark, ("a", "2026-01-01", 1), ("a", "2026-01-02", 2), ("b", "2026-01-01", 3))
    tables.write_series_files(rows.withColumn("value", F.when(F.col("value") != 2, F.col("value"))), path)
    assert values(tables.read_series_files(spark, path)) == {("a", "2026-01-01"): 1.0, ("b", "2026-01-01"): 3.0}


def test_replace_touches_only_given_series(spark):
    path = session.scratch_path(spark, "test-replace")
    tables.replace_series(obs(spark, ("a", "2026-01-01", 1), ("a", "2026-01-02", 2), ("b", "2026-01-01", 3)), path, buckets=2)
    tables.replace_series(obs(spark, ("a", "2026-01-05", 9)), path, buckets=2)
    assert values(tables.read_series(spark, path)) == {("a", "2026-01-05"): 9.0, ("b", "2026-01-01"): 3.0}


def test_vintages_append_once(spark):
    path = session.scratch_path(spark, "test-vintages")
    records = obs(spark, ("a", "2026-01-31", 1), ("a", "2026-02-28", 2)).withColumn("recorded_on", F.lit(day("2026-03-05")))
    assert tables.append_vintages(records, path).first().asDict() == {"appended": 2, "skipped": 0}
    assert tables.append_vintages(records, path).first().asDict() == {"appended": 0, "skipped": 2}
    later = records.withColumn("recorded_on", F.lit(day("2026-04-05")))
    assert tables.append_vintages(later, path).first()["appended"] == 2
    assert spark.read.parquet(path).count() == 4


def log_rows(spark, *data):
    return spark.createDataFrame([(s, day(d), day(r), float(v)) for s, d, r, v in data],
                                 "series_id string, as_of date, recorded_on date, value double")


def test_incremental_runs_and_replay(spark):
    landing, archive = session.scratch_path(spark, "landing"), session.scratch_path(spark, "archive")
    state = session.scratch_path(spark, "state")
    first = log_rows(spark, ("a", "2026-01-01", "2026-01-01", 1), ("a", "2026-01-02", "2026-01-02", 2))
    first.write.mode("append").parquet(landing)
    incremental.daily_append(incremental.landing(spark, landing, first.schema), archive, state, day("2026-01-02"))
    second = log_rows(spark, ("a", "2026-01-01", "2026-01-03", 5), ("a", "2026-01-03", "2026-01-03", 3))
    second.write.mode("append").parquet(landing)
    incremental.daily_append(incremental.landing(spark, landing, first.schema), archive, state, day("2026-01-03"))
    stored = tables.read_history(spark, archive)
    lines = stored.count()
    assert lines == 4 and values(bitemporal.current_view(stored)) == {
        ("a", "2026-01-01"): 5.0, ("a", "2026-01-02"): 2.0, ("a", "2026-01-03"): 3.0}
    # The same landing processed again from scratch, as after a lost checkpoint, adds no value.
    fresh = session.scratch_path(spark, "state")
    incremental.daily_append(incremental.landing(spark, landing, first.schema), archive, fresh, day("2026-01-03"))
    assert tables.read_history(spark, archive).count() == lines


def test_monthly_parts_replay_counts_nothing_twice(spark):
    landing, parts = session.scratch_path(spark, "landing"), session.scratch_path(spark, "parts")
    rows = obs(spark, ("a", "2026-01-01", 1), ("a", "2026-01-03", 3), ("a", "2026-02-01", 9))
    rows.write.parquet(landing)
    for _ in range(2):
        incremental.monthly_parts(incremental.landing(spark, landing, rows.schema), parts, session.scratch_path(spark, "state"))
    assert values(incremental.completed_months(spark, parts, day("2026-02-10"))) == {("a", "2026-01-31"): 2.0}


def test_one_bad_row_turns_a_slot_series_away(spark):
    rows = spark.createDataFrame([("a", "2026-01-31", "1.5"), ("a", "2026-02-28", "2"), ("b", "2026-01-31", "x"), ("b", "2026-02-28", "2")],
                                 "series_id string, as_of string, value string")
    good, status = extracts.manual_slot(rows)
    assert {(r["series_id"], r["value"], r["provisional"]) for r in good.collect()} == {("a", 1.5, False), ("a", 2.0, True)}
    assert {r["series_id"]: r["ok"] for r in status.collect()} == {"a": True, "b": False}


def test_base_first_prefers_the_archive_and_drops_dead_symbols(spark):
    schema = "as_of date, open double, high double, low double, close double, volume long"
    bar = (day("2026-01-02"), 1.0, 1.0, 1.0, 1.0, 5)
    instruments = spark.createDataFrame([("s1", "AAA"), ("s2", "BBB"), ("s3", "CCC")], "series_id string, symbol string")
    base = spark.createDataFrame([("s1", *bar), ("s2", bar[0], 1.0, 1.0, 1.0, None, 5)], "series_id string, " + schema)
    fallback = spark.createDataFrame([("AAA", *bar), ("BBB", *bar), ("zzz", *bar), ("other", *bar)], "symbol string, " + schema)
    wanted = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",), ("zzz",)], "symbol string")
    bars, provenance = registry.base_first(wanted, instruments, base, fallback)
    assert {(r["symbol"], r["provenance"]) for r in provenance.collect()} == {("AAA", "base"), ("BBB", "fetch"), ("zzz", "fetch")}
    assert bars.count() == 3
    named = registry.sources_of(registry.resolve_symbols(wanted, instruments), provenance)
    assert {r["symbol"]: r["provenance"] for r in named.collect()} == {"AAA": "base", "BBB": "fetch", "CCC": "dead", "zzz": "fetch"}


def test_hot_day_folds_before_ordering(spark):
    """A third of all raw rows fall on one series and day; the view still has one row per key."""
    raw = spark.range(90000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 900)).alias("series_id"),
        F.when(F.col("id") % 3 == 0, F.lit(day("2026-01-01"))).otherwise(F.date_add(F.lit(day("2025-01-01")), (F.col("id") % 300).cast("int"))).alias("as_of"),
        F.date_add(F.lit(day("2020-01-01")), F.col("id").cast("int") % 100000).alias("recorded_on"), F.col("id").cast("double").alias("value"))
    view = bitemporal.current_view(raw)
    assert view.filter("series_id = 'hot'").collect()[0]["value"] == 89997.0
    assert view.count() == raw.select("series_id", "as_of").distinct().count()
