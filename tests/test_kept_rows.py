"""Rows and values that must not get lost, and writes that must be refused."""

import datetime as dt

import pytest

from seriesloom.operators import bitemporal, identity, positioning, resample, windows
from seriesloom.session import scratch_path
from seriesloom.sources import extracts, tables


def obs(spark, *rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d), v) for s, d, v in rows],
                                 "series_id string, as_of date, value double")


def test_means_are_of_raw_values(spark):
    rows = obs(spark, ("fx", "2024-01-03", 1.0049), ("fx", "2024-01-04", 1.0049))
    assert resample.monthly_mean(rows).first().value == 1.0049
    assert windows.tail_mean(rows, 2, 6).first().tail_mean == 1.0049


def test_date_form_is_decided_per_extract(spark):
    rows = spark.createDataFrame([("a", "1704067200000", "5"), ("b", "2024-01-02", "6"), ("a", "86400000", "7")],
                                 "series_id string, date string, n string")
    got = {(r.series_id, str(r.as_of)): r.value for r in extracts.feature_counts(rows, ["date"], ["n"]).collect()}
    assert got == {("a", "2024-01-01"): 5.0, ("b", "2024-01-02"): 6.0, ("a", "1970-01-02"): 7.0}


def test_dates_with_a_tail_are_rejected(spark):
    rows = spark.createDataFrame([("a", "2024-01-01x", "1"), ("b", "2024-01-01T00:00", "1"), ("c", "2024-01-01", "x1"),
                                  ("d", "2024-01-01", ".")], "series_id string, date string, value string")
    good, status = extracts.macro_extracts(rows)
    assert {r.series_id for r in good.collect()} == {"b"}
    assert {r.series_id: r.ok for r in status.collect()} == {"a": False, "b": True, "c": False, "d": True}


def test_pin_comes_before_exclude(spark):
    market = positioning.Market(key="x", query_name="X", must_contain=("promo",), must_not_contain=("standard",))
    rows = spark.createDataFrame([("X PROMO STANDARD", "1"), ("X OTHER", "2")], "contract_name string, contract_code string")
    assert positioning.pin_configured_names(positioning.assign_markets(rows, [market]), [market]).isEmpty()


def test_carry_forward_keeps_the_last_row_of_a_month_and_other_series(spark):
    rows = obs(spark, ("w", "2024-01-05", 1.0), ("w", "2024-01-19", 2.0), ("o", "2024-01-05", 5.0), ("o", "2024-01-12", 6.0))
    cohort = rows.filter("series_id = 'w'").select("series_id")
    got = sorted((r.series_id, str(r.as_of), r.value, r.filled)
                 for r in windows.carry_forward(rows, dt.date(2024, 2, 29), cohort).collect())
    assert got == [("o", "2024-01-05", 5.0, None), ("o", "2024-01-12", 6.0, None), ("w", "2024-01-31", 2.0, None),
                   ("w", "2024-02-29", 2.0, "carry_forward")]


def test_second_bucket_count_is_refused(spark):
    path = scratch_path(spark, "buckets")
    tables.replace_series(obs(spark, ("a", "2024-01-01", 1.0)), path, buckets=4)
    tables.replace_series(obs(spark, ("a", "2024-01-02", 2.0)), path)
    assert [(str(r.as_of), r.value) for r in tables.read_series(spark, path).collect()] == [("2024-01-02", 2.0)]
    with pytest.raises(ValueError, match="4 buckets"):
        tables.replace_series(obs(spark, ("a", "2024-01-03", 3.0)), path, buckets=64)


def test_empty_identifiers_name_nothing(spark):
    schema = ("internal_id string, ticker string, exch_code string, first_seen date, effective_to date, name string, "
              "isin string, share_class_figi string, continuation_of string, review_flag string, source_note string")
    epochs = spark.createDataFrame([("1", "T", "US", dt.date(2024, 1, 1), None, "N", None, "FG1", None, None, None)], schema)
    snapshot = spark.createDataFrame([("T", "US", "N", " ", "")],
                                     "ticker string, exch_code string, name string, isin string, share_class_figi string")
    assert identity.recycled(identity.snapshot_diff(epochs, snapshot)).isEmpty()


def test_one_line_is_taken_whole_and_empty_source_refused(spark):
    log = spark.createDataFrame([("s", dt.date(2024, 1, 1), 1.0, 9.0, dt.date(2024, 1, 2)),
                                 ("s", dt.date(2024, 1, 1), 2.0, 3.0, dt.date(2024, 1, 2))],
                                "series_id string, as_of date, value double, value_tr double, recorded_on date")
    assert [(r.value, r.value_tr) for r in bitemporal.current_view(log).collect()] == [(2.0, 3.0)]
    with pytest.raises(ValueError, match="empty"):
        bitemporal.promote(log.limit(0), log)


def test_daily_run_heals_a_split(spark):
    from seriesloom.plans import runs

    day = dt.date(2024, 1, 2)
    columns = ("series_id string, as_of date, value double, open double, high double, low double, close double, "
               "value_tr double, volume double, split_factor double, dividend double")
    bar = lambda s, d, price, factor: (s, dt.date(2024, 1, d), price, price, price, price, price, price, 1.0, factor, 0.0)
    log = spark.createDataFrame([(*bar("eq_1", 2, 100.0, 1.0), False, day), (*bar("eq_1", 3, 102.0, 1.0), False, day)],
                                columns + ", provisional boolean, recorded_on date")
    landed = spark.createDataFrame(
        [("eq_1", dt.date(2024, 1, 3), 1, 51.0, 51.0, 51.0, 51.0, 51.0, 1.0, 1.0, 0.0),
         ("eq_1", dt.date(2024, 1, 4), 2, 52.0, 52.0, 52.0, 52.0, 52.0, 1.0, 2.0, 0.0)],
        "series_id string, as_of date, arrival long, open double, high double, low double, close double, adj_close double, "
        "volume double, split_ratio double, dividend double")
    repull = spark.createDataFrame([bar("eq_1", 3, 51.0, 2.0), bar("eq_1", 4, 52.0, 1.0)], columns)
    instruments = spark.createDataFrame([("eq_1", "T", "stock", None)],
                                        "series_id string, symbol string, family string, quote_basis string")
    catalog = spark.createDataFrame([("eq_1", "stock", "id1")], "series_id string, family string, stable_id string")
    live = spark.createDataFrame([], "symbol string, live_currency string")
    run = runs.daily_price_run(landed, log, instruments, catalog, live, dt.date(2024, 1, 5), repull=repull)
    after = bitemporal.current_view(bitemporal.apply_plan(log, run.plan))
    got = {str(r.as_of): (r.close, r.split_factor) for r in after.collect()}
    assert got == {"2024-01-02": (50.0, 2.0), "2024-01-03": (51.0, 2.0), "2024-01-04": (52.0, 1.0)}
    assert run.unhealed.isEmpty()
