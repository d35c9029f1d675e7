"""Landing runs, mixed documents, market tables, session bitmaps, bounded lists, sliding ranks, vintage sweep."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.functions.frames import first_of_each
from seriesloom.operators import names, quality, resample, windows
from seriesloom.operators import positioning as pos
from seriesloom.plans.landing import LandingRefused, landing_run
from seriesloom.sources import commits, deltas, extracts


def day(number):
    return dt.date(2024, 1, 1) + dt.timedelta(days=number)


TYPED = "series_id string, as_of date, value double, reason string"


def landing(spark):
    rows = [("ok", day(k), float(k), None) for k in range(4)] + [("short", day(0), 1.0, None)]
    rows += [("bad", day(0), 2.0, None), ("bad", day(1), None, "unreadable value 1x"), ("empty", day(0), None, None)]
    expected = spark.createDataFrame([(s,) for s in ("ok", "short", "bad", "empty", "dead")], "series_id string")
    manifest = spark.createDataFrame([("ok", 4), ("short", 2), ("bad", 2), ("empty", 1)], "series_id string, announced long")
    return spark.createDataFrame(rows, TYPED), expected, manifest


def test_landing_turns_away_each_bad_extract_and_stores_the_rest(spark):
    path = session.scratch_path(spark, "landed")
    run = landing_run(*landing(spark), path)
    assert {r.series_id: r.status for r in run.status.collect()} == {
        "ok": "ok", "short": "short", "bad": "malformed", "empty": "empty", "dead": "dead"}
    assert {r.series_id: r.reason for r in run.status.collect() if r.reason} == {
        "short": "announced 2, received 1", "bad": "unreadable value 1x"}
    assert (run.landed, run.rejected, run.values) == (8, 1, 6)
    assert [(r.series_id, r.value) for r in deltas.read_series(spark, path).orderBy("as_of").collect()] == [("ok", float(k)) for k in range(4)]


def test_landing_without_readable_rows_stores_nothing(spark):
    typed, expected, manifest = landing(spark)
    for bad in (typed.limit(0), typed.withColumn("reason", F.lit("garbage"))):
        path = session.scratch_path(spark, "landed")
        with pytest.raises(LandingRefused):
            landing_run(bad, expected, manifest, path)
        assert commits.snapshot(spark, path) is None


def test_mixed_documents_are_resolved_per_row(spark):
    documents = {
        "a": '{"date": "2024-01-02", "value": 1.5}', "b": '{"PERIOD": "2024-01-03T10:00", "obs": "2,500"}',
        "c": '{"attributes": {"Date_": 1704153600000, "n": 3}}', "d": '{"date": "2024-13-40", "value": 1}',
        "e": '{"date": "2024-01-02", "value": "."}', "f": "not json", "g": '{"value": 2}', "h": '{"date": "2024-01-02"}', "i": None}
    rows = spark.createDataFrame(list(documents.items()), "series_id string, document string")
    got = {r.series_id: (r.as_of, r.value, r.reason) for r in extracts.mixed_rows(
        rows, ["date", "period", "attributes.Date_"], ["value", "obs", "attributes.n"]).collect()}
    assert got["a"] == (day(1), 1.5, None) and got["b"] == (day(2), 2500.0, None) and got["c"] == (day(1), 3.0, None)
    assert got["d"][2] == "unreadable date 2024-13-40" and got["e"] == (day(1), None, None)
    assert got["f"][2] == "not a document" and got["g"][2] == "no date column" and got["h"][2] == "no value column"
    assert got["i"][2] == "no date column"


def test_status_names_the_reason(spark):
    rows = spark.createDataFrame([("a", "2024-01-02", "1"), ("a", "2024-01-03", "."), ("b", "2024-01-02", "x"), ("c", "soon", "1")],
                                 "series_id string, period string, value string")
    got = {r.series_id: (r.ok, r.n_landed, r.n_rejected, r.reason) for r in extracts.row_status(extracts.period_rows(rows)).collect()}
    assert got == {"a": (True, 2, 0, None), "b": (False, 1, 1, "unreadable value x"), "c": (False, 1, 1, "unreadable date soon")}
    assert extracts.period_values(rows).count() == 1


def reports(spark):
    found = ["WHEAT SRW - CBT", "WHEAT HRW - KCBT", "Wheat-Spring", "MICRO WHEAT", "CORN", "OATS AND CORN", "É CORN"]
    return spark.createDataFrame([(n, f"{k:03d}") for k, n in enumerate(found)], "contract_name string, contract_code string")


MARKETS = [
    pos.Market("wheat", query_name="WHEAT", must_contain=["SRW", "CBT"], must_not_contain=["MICRO"]),
    pos.Market("any_wheat", query_name="wheat", must_contain=["NOWHERE"], must_not_contain=["MICRO", "KCBT"]),
    pos.Market("corn", query_name="CORN"), pos.Market("short", query_name="É"), pos.Market("none", query_name="RYE"),
    pos.Market("pinned", code="004", must_contain=["RYE"])]


def test_market_table_equals_configured_markets(spark):
    table = pos.market_table(spark, MARKETS).withColumnRenamed("key", "market")
    got = names.assign_market_table(reports(spark), table).select("market", "contract_name").collect()
    want = pos.pin_configured_names(pos.assign_markets(reports(spark), MARKETS), MARKETS).select("market", "contract_name").collect()
    assert sorted(got) == sorted(want) and len(want) == 8


def test_plan_does_not_grow_with_the_markets(spark):
    def size(count):
        table = pos.market_table(spark, [pos.Market(f"m{k}", query_name=f"NAME{k}") for k in range(count)])
        plan = names.assign_market_table(reports(spark), table.withColumnRenamed("key", "market"))
        return plan._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(3) == size(300)


def test_session_bitmaps_against_plain_sets(spark):
    pick = random.Random(4)
    rows = [(f"s{k}", f"S{k}.{'XY'[k % 2]}", day(d)) for k in range(14) for d in range(-70, 130) if pick.random() < 0.93 and (d + 70) % 7 < 5]
    view = spark.createDataFrame(rows, "series_id string, symbol string, as_of date")
    calendar = quality.venue_calendar(view, window=90)
    held = {}
    for s, symbol, d in rows:
        held.setdefault((symbol[-1], s), set()).add(d)
    want, holes = set(), set()
    for venue in "XY":
        mine = {s: days for (v, s), days in held.items() if v == venue}
        sessions = sorted(d for d in set().union(*mine.values()) if sum(d in x for x in mine.values()) >= 0.6 * len(mine))[-90:]
        want |= {(venue, d, sum(d in x for x in mine.values()), len(mine)) for d in sessions}
        holes |= {(s, venue, d) for s, days in mine.items() for d in sessions if min(days) <= d <= max(days) and d not in days}
    assert {tuple(r) for r in calendar.collect()} == want
    got = quality.missing_sessions(view, calendar).collect()
    assert {tuple(r) for r in got} == holes and len(got) == len(holes) > 20


def test_first_rows_are_limited_before_the_shuffle(spark, capsys):
    rows = spark.range(1000).select((F.col("id") % 2).alias("key"), F.col("id").alias("x"))
    few = first_of_each(rows, ["key"], ["x"], 3)
    assert sorted(r.x for r in few.collect()) == [0, 1, 2, 3, 4, 5]
    few.explain("formatted")
    assert capsys.readouterr().out.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("window", [1, 2, 7, 8, 52, 500])
def test_sliding_ranks_against_plain_windows(spark, window):
    pick = random.Random(window)
    rows = [(s, day(d), float(pick.randrange(9))) for s in "ab" for d in range(70)]
    obs = spark.createDataFrame(rows, "series_id string, as_of date, value double")
    counted = windows.counted_in_window(obs, window)
    got = {(r.series_id, r.as_of): (r.value, r.at_most) for r in counted.collect()}
    for s in "ab":
        values = [v for t, _, v in rows if t == s]
        for k, v in enumerate(values):
            assert got[s, day(k)] == (v, sum(x <= v for x in values[max(0, k - window + 1):k + 1]))
    assert "collect_list" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_vintage_sweep_against_all_pairs(spark):
    pick = random.Random(2)
    rows = []
    for _ in range(300):
        start = pick.randrange(60)
        end = None if pick.random() < 0.2 else day(start + pick.randrange(-1, 40))
        rows.append((pick.choice("ab"), day(pick.randrange(90)), day(start), end, None if pick.random() < 0.1 else pick.randrange(10**6) / 100))
    vintages = spark.createDataFrame(rows, "series_id string, date date, realtime_start date, realtime_end date, value double")
    live = [r for r in rows if r[3] is None or r[3] >= r[2]]
    want = {}
    for s, d, t, _, _ in live:
        seen = [r[4] for r in live if r[0] == s and r[1].month == d.month and r[2] <= t and (r[3] is None or t <= r[3]) and r[4] is not None]
        want[s, d.month, t] = round(sum(seen) / len(seen), 4) if seen else None
    got = resample.vintage_monthly_as_known(vintages)
    assert {(r.series_id, r.as_of.month, r.recorded_on): None if r.value is None else round(r.value, 4) for r in got.collect()} == want
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_means_of_tenths_round_half_up(spark):
    rows = [("a", 106.3), ("a", 106.4), ("b", -0.1), ("b", -0.2), ("c", 0.1), ("c", None), ("d", None)]
    frame = spark.createDataFrame(rows, "series_id string, value double").groupBy("series_id").agg(
        resample.half_up_mean_of_tenths("value").alias("mean"))
    assert {r.series_id: r["mean"] for r in frame.collect()} == {"a": 106.4, "b": -0.2, "c": 0.1, "d": None}
