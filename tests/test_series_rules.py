"""Exact small cases for calendars, bars, text, gates and numbering."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seriesloom.functions import dates, text
from seriesloom.operators import corporate, numbering, positioning, quality, resample, windows
from seriesloom.sources import extracts


def day(value):
    return dt.date.fromisoformat(value)


def obs(spark, pairs, sid="s"):
    return spark.createDataFrame([(sid, day(d), None if v is None else float(v)) for d, v in pairs],
                                 "series_id string, as_of date, value double")


def series(spark, values, start="2020-01-01", sid="s"):
    first = day(start)
    return obs(spark, [((first + dt.timedelta(days=i)).isoformat(), v) for i, v in enumerate(values)], sid)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# --- weeks and months ---------------------------------------------------------------------------

@pytest.mark.parametrize("run_date, labels", [
    ("2026-06-17", ["2026-06-12"]), ("2026-06-19", ["2026-06-12"]),
    ("2026-06-20", ["2026-06-12", "2026-06-19"]), ("2026-06-12", [])])
def test_only_completed_weeks(spark, run_date, labels):
    rows = obs(spark, [("2026-06-08", 1), ("2026-06-12", 2), ("2026-06-15", 3), ("2026-06-18", 4)])
    got = resample.weekly_last(rows, completed_before=day(run_date)).orderBy("as_of").collect()
    assert [r["as_of"].isoformat() for r in got] == labels
    if "2026-06-19" in labels:
        assert got[-1]["value"] == 4  # the Friday was a holiday: Thursday's close stands for the week


def test_week_skips_missing_values(spark):
    got = resample.weekly_last(obs(spark, [("2026-06-10", 1), ("2026-06-11", None)])).collect()
    assert [(r["as_of"], r["value"]) for r in got] == [(day("2026-06-12"), 1.0)]


def test_month_labels_are_leap_correct(spark):
    got = resample.monthly_last(obs(spark, [("2024-02-03", 1), ("2024-02-20", 5), ("2023-02-01", 2)])).collect()
    assert {(r["as_of"], r["value"]) for r in got} == {(day("2024-02-29"), 5.0), (day("2023-02-28"), 2.0)}


@pytest.mark.parametrize("period, expected", [("2y", "2024-08-31"), ("6mo", "2026-02-28"), ("30d", "2026-08-01"), ("max", None), ("xx", None)])
def test_lookback(spark, period, expected):
    edge = dates.lookback_start(period, day("2026-08-31"))
    assert (None if edge is None else one(spark, edge).isoformat()) == expected


# --- percentiles, streaks, fills -------------------------------------------------------------------

def test_short_and_flat_histories_have_no_percentile(spark):
    short = windows.percentile_window(series(spark, range(7)), 52).first()
    flat = windows.percentile_window(series(spark, [0.1] * 20), 52).first()
    full = windows.percentile_window(series(spark, range(8)), 52).first()
    assert (short["percentile"], short["zscore"], short["n_obs"]) == (None, None, 7)
    assert (flat["percentile"], flat["zscore"]) == (None, None)
    assert full["percentile"] == 100.0 and full["zscore"] == 1.5275


def test_average_rank_with_ties(spark):
    got = windows.average_rank_percent(series(spark, [1, 2, 2, 4])).orderBy("as_of").collect()
    assert [r["percentile"] for r in got] == [25.0, 62.5, 62.5, 100.0]


@pytest.mark.parametrize("values, streak", [([1, 9, 1, 1], 2), ([1, 1], 2), ([1, 9], 0)])
def test_trailing_streak(spark, values, streak):
    assert windows.trailing_streak(series(spark, values), F.col("value") < 5).first()["streak"] == streak


def test_carry_forward_fills_holes_but_never_past_the_frontier(spark):
    rows = obs(spark, [("2025-08-31", 1), ("2025-10-31", 3)]).unionByName(obs(spark, [("2025-08-31", 5), ("2026-01-31", 6)], "lead"))
    got = {(r["series_id"], r["as_of"].isoformat()): (r["value"], r["filled"]) for r in windows.carry_forward(rows, day("2025-11-30")).collect()}
    assert got == {
        ("s", "2025-08-31"): (1.0, None), ("s", "2025-09-30"): (1.0, "carry_forward"), ("s", "2025-10-31"): (3.0, None),
        ("s", "2025-11-30"): (3.0, "carry_forward"), ("lead", "2025-08-31"): (5.0, None), ("lead", "2025-09-30"): (5.0, "carry_forward"),
        ("lead", "2025-10-31"): (5.0, "carry_forward"), ("lead", "2025-11-30"): (5.0, "carry_forward"), ("lead", "2026-01-31"): (6.0, None)}


def test_chained_nowcast_rounds_every_step(spark):
    levels = obs(spark, [("2025-03-31", 100.0)])
    rates = obs(spark, [("2025-03-31", 9), ("2025-04-30", 0.333333), ("2025-05-31", 0.333333)])
    got = [r["value"] for r in windows.chained_nowcast(levels, rates).orderBy("as_of").collect()]
    first = round(100 * (1 + 0.333333 / 100), 6)
    assert got == [first, round(first * (1 + 0.333333 / 100), 6)]


def test_gap_over_the_limit_only(spark):
    rows = obs(spark, [("2008-09-16", 1), ("2017-08-15", 1), ("2017-08-22", 1)])
    assert windows.largest_gap(rows).first()["gap_days"] == 3255
    assert windows.largest_gap(obs(spark, [("2020-01-01", 1), ("2020-03-01", 1)])).count() == 0


# --- bars --------------------------------------------------------------------------------------------

def test_split_factors(spark):
    rows = series(spark, range(6)).withColumn("split_ratio", F.expr("element_at(array(0D, 0D, 10D, 0D, 2D, 0D), cast(value as int) + 1)"))
    got = corporate.split_factors(rows).orderBy("as_of").collect()
    assert [r["split_factor"] for r in got] == [20.0, 20.0, 2.0, 2.0, 1.0, 1.0]


def dividend_bars(spark, value_tr):
    paid = {1: 4.0, 9: 6.0}
    data = [("s", dt.date(2026, 1, 1 + i), 100.0, 100.0, 100.0, 100.0, float(value_tr[i]), paid.get(i, 0.0), 1000, dt.date(2026, 2, 1))
            for i in range(12)]
    return spark.createDataFrame(data, "series_id string, as_of date, open double, high double, low double, close double, "
                                       "value_tr double, dividend double, volume long, recorded_on date")


def test_total_return_is_rebuilt_from_dividends(spark):
    adjusted = [90.24] + [94.0] * 8 + [100.0] * 3
    got = corporate.total_return(dividend_bars(spark, adjusted)).orderBy("as_of").collect()
    assert [round(r["tr_close"], 6) for r in got] == adjusted and got[0]["basis"] == "rebuilt"


def test_price_only_and_pinned_series_keep_the_stored_value(spark):
    flat = corporate.total_return(dividend_bars(spark, [100.0] * 12)).first()
    assert (flat["basis"], flat["tr_close"]) == ("stored:price_only", 100.0)
    pinned = corporate.total_return(dividend_bars(spark, [90.24] + [94.0] * 8 + [100.0] * 3), pinned=["s"]).first()
    assert pinned["basis"] == "stored:pinned"
    broken = corporate.total_return(dividend_bars(spark, [50.0] + [94.0] * 8 + [100.0] * 3)).first()
    assert broken["basis"] == "stored:diverges"


def test_heal_rescales_an_omitted_day_next_to_the_split(spark):
    names = ["value", "open", "high", "low", "close", "value_tr"]

    def bars(prices, factors, skip=()):
        data = [("s", dt.date(2026, 1, 1 + i), *[float(p)] * 6, 1000, float(f), False)
                for i, (p, f) in enumerate(zip(prices, factors)) if i not in skip]
        return spark.createDataFrame(data, "series_id string, as_of date, " + ", ".join(f"{n} double" for n in names)
                                     + ", volume long, split_factor double, provisional boolean")

    stored = bars([1000] * 5, [1] * 5)
    pulled = bars([100] * 7, [10, 10, 10, 10, 10, 1, 1], skip=(4,))
    got = {r["as_of"].day: r for r in corporate.heal_batch(stored, pulled).collect()}
    assert {r["close"] for r in got.values()} == {100.0}
    assert got[5]["rescaled"] and got[5]["split_factor"] == 10.0 and got[5]["volume"] == 1000


# --- text ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("code, label", [("GBp", "GBX"), ("gbx", "GBX"), ("GBP", "GBP"), ("eur", "EUR"), (None, None)])
def test_currency_labels(spark, code, label):
    assert one(spark, text.canonical_currency(F.lit(code).cast("string"))) == label


@pytest.mark.parametrize("symbol, code, venue", [("BRK-B", "US", "US"), ("SAP.DE", "GR", "DE"), ("X.Y.L", "LN", "L"), ("A.ZZ", "ZZ", "ZZ"), ("A.", "", "")])
def test_exchange_codes(spark, symbol, code, venue):
    if symbol == "A.":
        assert one(spark, text.exchange_code(F.lit(symbol))) == "US"
        return
    assert (one(spark, text.exchange_code(F.lit(symbol))), one(spark, text.venue_group(F.lit(symbol)))) == (code, venue)


@pytest.mark.parametrize("name, key", [("Acme Holdings plc", "ACME"), ("Foo-Bar, Inc.", "FOO BAR"), (None, "")])
def test_name_keys(spark, name, key):
    assert one(spark, text.name_key(F.lit(name).cast("string"))) == key


@pytest.mark.parametrize("raw, number", [("1,234", 1234.0), ("", None), ("x", None), ("NaN", None), ("-5.5", -5.5)])
def test_loose_numbers(spark, raw, number):
    assert one(spark, text.loose_number(F.lit(raw))) == number


def test_invisible_marks_are_stripped(spark):
    assert one(spark, text.strip_invisible(F.lit(" \ufeffkey\u200b "))) == "key"


def test_column_resolution():
    assert extracts.resolve_column(["PortName", "Date_"], ["date", "DATE_"]) == "Date_"
    with pytest.raises(ValueError, match="available columns"):
        extracts.resolve_column(["a"], ["b"])


def test_epoch_and_text_dates(spark):
    millis = spark.createDataFrame([("p", 1767225600000, "5"), ("p", 1767312000000, "x")], "series_id string, Date long, n_tankers string")
    texts = spark.createDataFrame([("p", "2026-01-01T00:00", "5"), ("p", "soon", "6")], "series_id string, Date string, n_tankers string")
    for frame in (millis, texts):
        got = extracts.feature_counts(frame, ["date"], ["n_tankers"]).collect()
        assert [(r["as_of"], r["value"]) for r in got] == [(day("2026-01-01"), 5.0)]


def test_contract_codes_cross_the_year(spark):
    got = resample.contracts_ahead(obs(spark, [("2026-11-30", 1)]).select("as_of"), "BZ", ".NYM", 3).orderBy("ahead").collect()
    assert [r["contract"] for r in got] == ["BZZ26.NYM", "BZF27.NYM", "BZG27.NYM"]


# --- gates -------------------------------------------------------------------------------------------------

def pack(spark, lag=0, holes=0):
    """Six series over 40 days; the victim ends early or lacks interior days."""
    last = dt.date(2026, 7, 10)
    days = [last - dt.timedelta(days=i) for i in range(40)]
    gone = set(days[5:5 + holes])
    data = [(f"s{k}", f"S{k}.L", d) for k in range(5) for d in days]
    data += [("victim", "V.L", d) for d in days[lag:] if d not in gone]
    return spark.createDataFrame(data, "series_id string, symbol string, as_of date")


def exempt(spark, review_by=None):
    data = [] if review_by is None else [("victim", "known outage", day(review_by))]
    return spark.createDataFrame(data, "series_id string, reason string, review_by date")


@pytest.mark.parametrize("lag, tier", [(4, None), (5, "warn"), (10, "warn"), (11, "fail")])
def test_recency_edges(spark, lag, tier):
    got = quality.stale_series(pack(spark, lag=lag), exempt(spark), day("2026-07-11")).collect()
    assert [r["tier"] for r in got] == ([] if tier is None else [tier])


@pytest.mark.parametrize("holes, tier", [(1, None), (2, "warn"), (4, "warn"), (5, "fail")])
def test_density_edges(spark, holes, tier):
    got = quality.sparse_series(pack(spark, holes=holes), exempt(spark), day("2026-07-11")).collect()
    assert [(r["missing"], r["tier"]) for r in got] == ([] if tier is None else [(holes, tier)])


@pytest.mark.parametrize("review_by, sections", [
    ("2026-07-11", {("stale", "exempt"), ("exempt", "exempt"), ("verdict", "pass")}),
    ("2026-07-10", {("stale", "fail"), ("expired_exempt", "fail"), ("verdict", "fail")})])
def test_exemptions_expire(spark, review_by, sections):
    view, today = pack(spark, lag=12), day("2026-07-11")
    excuses = exempt(spark, review_by)
    report = quality.freshness_report(quality.stale_series(view, excuses, today), quality.sparse_series(view, excuses, today), excuses, today)
    assert {(r["section"], r["tier"]) for r in report.collect()} == sections


def test_small_venues_have_no_calendar(spark):
    assert quality.venue_calendar(pack(spark).filter("series_id < 's3'")).count() == 0


# --- identity seams -----------------------------------------------------------------------------------------

def test_first_and_latest_seam(spark):
    rows = spark.createDataFrame(
        [("m", dt.date(2020, 1, 1 + i), n, float(i)) for i, n in enumerate(["A", "A", "", "B", "B", "C"])],
        "series_id string, as_of date, market_name string, value double")
    first, latest = positioning.seam(rows).first(), positioning.seam(rows, "latest").first()
    assert (first["from_identity"], first["to_identity"], first["seam_date"], first["last_clean_date"]) == ("A", "B", day("2020-01-04"), day("2020-01-02"))
    assert latest["to_identity"] == "C"
    assert positioning.clean_segment(rows, positioning.seam(rows)).count() == 2


# --- numbering and skew ---------------------------------------------------------------------------------------

def test_numbering_is_dense_and_ordered(spark):
    values = random.Random(1).sample(range(10 ** 6), 5000)
    frame = spark.createDataFrame([(f"k{v:07d}",) for v in values], "k string").repartition(16)
    got = numbering.number_in_order(frame, ["k"], start_after=10).collect()
    assert sorted((r["position"], r["k"]) for r in got) == [(i + 11, f"k{v:07d}") for i, v in enumerate(sorted(values))]


def test_hot_market_keeps_every_row(spark):
    """Half of all rows in one market: the keep-all fallback neither drops nor doubles rows."""
    rows = spark.range(60000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 500)).alias("market"),
        F.concat(F.lit("NAME "), F.when(F.col("id") % 10 == 0, "MICRO").otherwise("FULL")).alias("contract_name"))
    kept = positioning.exclude_small_contracts(rows)
    assert kept.count() == 54000 and kept.filter("market = 'hot'").count() == 24000
    assert positioning.pin_names(rows, ["nowhere"]).count() == 60000
