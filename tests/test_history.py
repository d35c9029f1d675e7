"""Append rules on small histories: every action, refusals, freezes, idempotent re-runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators import bitemporal as bt
from seriesloom.operators import revisions as rev
from seriesloom.sources import tables

SCHEMA = ("series_id string, as_of date, value double, value_tr double, provisional boolean, "
          "recorded_on date, stable_id string")
R0, R1, R2 = dt.date(2026, 6, 23), dt.date(2026, 6, 24), dt.date(2026, 6, 25)


def day(text):
    return dt.date.fromisoformat(text)


def rows(spark, recorded_on, *bars, sid="s1", stable="SEC-000001"):
    data = [(sid, day(b[0]), float(b[1]), float(b[2]) if len(b) > 2 and b[2] is not None else float(b[1]),
             len(b) > 3 and b[3] == "tip", recorded_on, stable) for b in bars]
    return spark.createDataFrame(data, SCHEMA)


def tip(date, value):
    return (date, value, None, "tip")


def summary(plan):
    row = bt.append_summary(plan).first()
    return {k: row[k] for k in ("ok", "appended", "restated", "revised", "frozen", "skipped")}


def view(log, vintage=None):
    return {r["as_of"].isoformat(): (r["value"], r["provisional"]) for r in bt.current_view(log, vintage).collect()}


def lines(spark, log):
    """Small logs are materialised so that chained appends stay cheap in tests."""
    return spark.createDataFrame(log.collect(), log.schema)


def test_sliding_windows_append_one_bar_each(spark):
    log = rows(spark, R0, ("2026-06-20", 100), ("2026-06-22", 101), tip("2026-06-23", 102))
    for recorded, bars in [(R1, [("2026-06-22", 101), ("2026-06-23", 102), tip("2026-06-24", 103)]),
                           (R2, [("2026-06-23", 102), ("2026-06-24", 103), tip("2026-06-25", 104)])]:
        plan = bt.append_plan(log, rows(spark, recorded, *bars))
        assert summary(plan)["appended"] == 1
        log = lines(spark, bt.apply_plan(log, plan))
    again = bt.append_plan(log, rows(spark, R2, ("2026-06-23", 102), ("2026-06-24", 103), tip("2026-06-25", 104)))
    assert summary(again) == {"ok": True, "appended": 0, "restated": 0, "revised": 0, "frozen": 0, "skipped": 3}
    assert [d for d, (_, open_) in view(log).items() if open_] == ["2026-06-25"]


def test_tip_left_behind_is_frozen(spark):
    log = rows(spark, R0, ("2026-06-10", 90), tip("2026-06-11", 91))
    plan = bt.append_plan(log, rows(spark, R1, ("2026-06-15", 95), tip("2026-06-16", 96)))
    assert summary(plan)["frozen"] == 1 and summary(plan)["appended"] == 2
    after = view(bt.apply_plan(log, plan))
    assert after["2026-06-11"] == (91.0, False) and after["2026-06-16"] == (96.0, True)


def test_truncated_pull_lands_final(spark):
    log = rows(spark, R0, ("2026-06-24", 100), ("2026-06-25", 101), ("2026-06-26", 102), tip("2026-06-29", 103))
    plan = bt.append_plan(log, rows(spark, dt.date(2026, 7, 1), ("2026-06-25", 101), tip("2026-06-26", 102.5)))
    assert summary(plan)["restated"] == 1
    after = view(bt.apply_plan(log, plan))
    assert after["2026-06-26"] == (102.5, False)
    assert [d for d, (_, open_) in after.items() if open_] == ["2026-06-29"]


def test_restatement_keeps_the_old_line_and_needs_a_later_vintage(spark):
    log = rows(spark, R0, ("2026-06-22", 100), ("2026-06-23", 101))
    log = lines(spark, bt.append(log, rows(spark, R2, ("2026-06-22", 999))))
    assert log.filter("as_of = '2026-06-22'").count() == 2
    assert view(log)["2026-06-22"][0] == 999 and view(log, R0)["2026-06-22"][0] == 100
    batch = rows(spark, R2, ("2026-06-22", 555), tip("2026-06-26", 1))
    plan = bt.append_plan(log, batch)
    assert summary(plan) == {"ok": False, "appended": 0, "restated": 0, "revised": 0, "frozen": 0, "skipped": 0}
    assert view(bt.apply_plan(log, plan)) == view(log)


def test_refusal_stays_inside_its_series(spark):
    log = rows(spark, R1, ("2026-06-22", 100)).unionByName(rows(spark, R1, ("2026-06-22", 7), sid="s2"))
    batch = rows(spark, R1, ("2026-06-22", 5)).unionByName(rows(spark, R1, ("2026-06-23", 8), sid="s2"))
    ok = {r["series_id"]: r["ok"] for r in bt.append_summary(bt.append_plan(log, batch)).collect()}
    assert ok == {"s1": False, "s2": True}


def test_dividend_shift_restates_the_window_only(spark):
    days = [(dt.date(2025, 3, 3) + dt.timedelta(days=i)).isoformat() for i in range(30)]
    log = rows(spark, R0, *[(d, 100 + i, 100 + i, "tip" if i == 29 else "") for i, d in enumerate(days)])
    shifted = [(days[i], 100 + i, round((100 + i) * 0.999, 6)) for i in range(26, 30)]
    plan = bt.append_plan(log, rows(spark, R1, *shifted, tip("2025-04-02", 130)))
    got = summary(plan)
    assert got["restated"] == 3 and got["revised"] == 1 and got["appended"] == 1


def test_identity_change_alone_is_skipped(spark):
    log = rows(spark, R0, ("2026-06-22", 100))
    batch = rows(spark, R0, ("2026-06-22", 100), stable="SEC-000002")
    plan = bt.append_plan(log, batch)
    assert summary(plan)["skipped"] == 1
    assert bt.apply_plan(log, plan).first()["stable_id"] == "SEC-000001"


def test_tolerance_edge(spark):
    log = rows(spark, R0, ("2026-06-22", 100))
    assert summary(bt.append_plan(log, rows(spark, R1, ("2026-06-22", 100 + 9e-7))))["skipped"] == 1
    assert summary(bt.append_plan(log, rows(spark, R1, ("2026-06-22", 100 + 2e-6))))["restated"] == 1


def test_only_touched_years_are_rewritten(spark):
    path = session.scratch_path(spark, "test-archive")
    tables.append_history(rows(spark, R0, ("2024-12-30", 100), ("2024-12-31", 101), tip("2025-01-02", 102)), path)
    old_files = {r["f"] for r in spark.read.parquet(path).filter("year = 2024").select(F.input_file_name().alias("f")).distinct().collect()}
    got = tables.append_history(rows(spark, R1, ("2025-01-02", 102), tip("2025-01-03", 103)), path).first()
    assert got["years_touched"] == "2025" and got["appended"] == 1 and got["revised"] == 1
    new_files = {r["f"] for r in spark.read.parquet(path).filter("year = 2024").select(F.input_file_name().alias("f")).distinct().collect()}
    assert old_files == new_files
    again = tables.append_history(rows(spark, R1, ("2025-01-02", 102), tip("2025-01-03", 103)), path).first()
    assert again["years_touched"] == "" and again["skipped"] == 2


def test_tip_of_an_older_year_is_frozen_in_place(spark):
    path = session.scratch_path(spark, "test-archive")
    tables.append_history(rows(spark, R0, tip("2024-12-31", 101)), path)
    got = tables.append_history(rows(spark, R1, tip("2025-01-03", 103)), path).first()
    assert got["frozen"] == 1 and got["years_touched"] == "2024,2025"
    assert view(tables.read_history(spark, path).drop("year")) == {"2024-12-31": (101.0, False), "2025-01-03": (103.0, True)}


# --- revision rules ---------------------------------------------------------------------------

OBS = "series_id string, as_of date, value double, value_tr double"


def obs(spark, *data):
    return spark.createDataFrame([("s", day(d), float(v), None if t is None else float(t)) for d, v, t in data], OBS)


@pytest.mark.parametrize("old, new, kept", [(21.399103, 21.399094, 21.3991), (100.81, 98.69, 98.69), (0.01, 0.02, 0.02),
                                            (1.0, 1.00009, 1.0), (1.0, 1.0002, 1.0002)])
def test_deadband(spark, old, new, kept):
    got = rev.deadband(obs(spark, ("2026-07-24", old, None)), rev.round_values(obs(spark, ("2026-07-24", new, None)))).first()
    assert got["value"] == kept


def test_unchanged_rows_declare_nothing(spark):
    same = obs(spark, ("2026-07-24", 1.00004, 2))
    assert rev.declarations(same, rev.round_values(same)).count() == 0


@pytest.mark.parametrize("n, suspect", [(19, False), (20, True)])
def test_split_suspicion_edge(spark, n, suspect):
    days = [(dt.date(2026, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(60)]
    stored = obs(spark, *[(d, 100, None) for d in days])
    fresh = obs(spark, *[(d, 50 if i < n else 100, None) for i, d in enumerate(days)])
    got = rev.declarations(stored, fresh).first()
    assert got["historical_value_n"] == n and got["split_suspect"] is suspect and len(got["historical_value"]) == n


def test_settle_window_and_rescale(spark):
    stored = obs(spark, ("2026-07-01", 10, 9), ("2026-07-17", 10, 9), ("2026-07-24", 10, 9))
    fresh = obs(spark, ("2026-07-01", 10, 8.91), ("2026-07-17", 11, 9), ("2026-07-24", 10, 9))
    got = rev.summary_line(rev.declarations(stored, fresh)).first()
    assert got["settled_n"] == 1 and got["tr_rescale_n"] == 1 and got["tr_rescale_max_rel"] == 0.01
    assert got["summary"] == "settled 1 · tr-rescale n=1 max_rel=0.01"


def test_value_to_null_counts_as_a_change(spark):
    got = rev.declarations(obs(spark, ("2026-01-01", 1, 2), ("2026-07-24", 1, 1)),
                           obs(spark, ("2026-01-01", 1, None), ("2026-07-24", 1, 1))).first()
    assert got["tr_rescale_n"] == 1 and got["tr_rescale_max_rel"] is None


@pytest.mark.parametrize("rows_kept, refused", [(9, False), (8, True)])
def test_truncation_floor_edge(spark, rows_kept, refused):
    days = [f"2026-01-{i + 1:02d}" for i in range(10)]
    stored = obs(spark, *[(d, 1, None) for d in days])
    assert rev.truncation_check(stored, obs(spark, *[(d, 1, None) for d in days[:rows_kept]])).first()["refused"] is refused
