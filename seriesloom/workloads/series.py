"""Calendars, resampling and ordered-series functions over order values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.operators import resample, windows
from seriesloom.workloads import query, with_
from seriesloom.workloads.sqltext import MONTHLY, ORDER_VALUE, ORDER_VALUE_TOTAL, WEEKLY, friday

RUN_DATE = dt.date(2001, 7, 13)


def weekly(spark, sf):
    return resample.weekly_last(adapters.order_value(spark, sf))


def monthly(spark, sf):
    return resample.monthly_mean(adapters.order_value(spark, sf))


def with_gaps(frame):
    """A release calendar without values for March and October, and late for the two slowest series."""
    late = F.col("series_id").isin("1-URGENT", "2-HIGH") & (F.col("as_of") > F.lit("2001-03-31").cast("date"))
    return frame.withColumn("value", F.when(~F.month("as_of").isin(3, 10) & ~late, F.col("value")))


GAPPY = """gappy AS (
  SELECT * FROM monthly6 WHERE month(as_of) NOT IN (3, 10)
    AND NOT (series_id IN ('1-URGENT', '2-HIGH') AND as_of > DATE '2001-03-31'))"""
MONTHLY6 = "monthly6 AS (SELECT series_id, as_of, round(value, 6) AS value FROM monthly)"


@query("a1_mean_of_month", with_(ORDER_VALUE, MONTHLY, "SELECT series_id, as_of, round(value, 6) AS value FROM monthly"))
def a1(spark, sf):
    return monthly(spark, sf)


@query("a1_last_of_month", with_(ORDER_VALUE, """
SELECT series_id, last_day(as_of) AS as_of, round(arg_max(value, as_of), 6) AS value FROM obs GROUP BY 1, 2"""))
def a1_last(spark, sf):
    return resample.monthly_last(adapters.order_value(spark, sf))


VINTAGES = f"""vintages AS (
  SELECT o_orderpriority AS series_id, {friday('CAST(o_orderdate AS DATE)')} AS date,
         CASE o_orderstatus WHEN 'F' THEN 10 WHEN 'O' THEN 40 ELSE 70 END AS lag,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2, 3),
vint AS (SELECT series_id, date, value, CAST(last_day(date) + lag AS DATE) AS realtime_start,
         CAST(last_day(date) + lag + 29 AS DATE) AS realtime_end FROM vintages)"""
VINT_MONTH = """vmonth AS (
  SELECT series_id, realtime_start AS recorded_on, last_day(date) AS as_of,
         round(AVG(value), 6) AS value,
         MAX(realtime_end) AS realtime_end
  FROM vint GROUP BY 1, 2, 3)"""


@query("a2_vintage_mean_of_month", with_(VINTAGES, VINT_MONTH, "SELECT * FROM vmonth"))
def a2(spark, sf):
    return resample.vintage_monthly_mean(adapters.order_vintages(spark, sf))


@query("a2_vintage_as_known", with_(VINTAGES, """
SELECT m.series_id, m.as_of, m.recorded_on,
       round(AVG(v.value), 6) AS value
FROM (SELECT DISTINCT series_id, last_day(date) AS as_of, realtime_start AS recorded_on FROM vint) m
JOIN vint v ON v.series_id = m.series_id AND last_day(v.date) = m.as_of
  AND m.recorded_on BETWEEN v.realtime_start AND v.realtime_end
GROUP BY 1, 2, 3"""))
def a2_as_known(spark, sf):
    return resample.vintage_monthly_as_known(adapters.order_vintages(spark, sf))


@query("a3_week_ending_friday_last", with_(ORDER_VALUE, WEEKLY, "SELECT * FROM weekly"))
def a3(spark, sf):
    return weekly(spark, sf)


@query("r2_completed_weeks", with_(ORDER_VALUE, WEEKLY, "SELECT * FROM weekly WHERE as_of < DATE '2001-07-13'"))
def r2(spark, sf):
    return resample.weekly_last(adapters.order_value(spark, sf), completed_before=RUN_DATE)


@query("r3_completed_months", with_(ORDER_VALUE, MONTHLY, """
SELECT series_id, as_of, round(value, 6) AS value FROM monthly WHERE as_of < date_trunc('month', DATE '2001-07-13')"""))
def r3(spark, sf):
    return resample.drop_open_month(monthly(spark, sf), RUN_DATE)


@query("p16_month_end_label", with_(ORDER_VALUE, "SELECT *, last_day(as_of) AS month_end FROM obs"))
def p16(spark, sf):
    return resample.label_month_end(adapters.order_value(spark, sf))


@query("p17_provenance_flag", with_(ORDER_VALUE, WEEKLY, """
SELECT *, as_of <= DATE '1998-12-31' AND series_id <> '5-LOW' AS earlier_source FROM weekly"""))
def p17(spark, sf):
    return resample.spread_provenance(weekly(spark, sf), dt.date(1998, 12, 31), F.col("series_id") == "5-LOW")


@query("p18_provisional_tip", with_(ORDER_VALUE, WEEKLY, """
SELECT *, as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional FROM weekly"""))
def p18(spark, sf):
    return windows.flag_newest(weekly(spark, sf))


@query("p24_contracts_ahead", """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders),
ahead AS (SELECT as_of, a AS ahead, CAST(date_trunc('month', as_of) + to_months(CAST(a AS INTEGER)) AS DATE) AS delivery
          FROM days, range(1, 7) t(a))
SELECT as_of, ahead, delivery,
       'BZ' || substr('FGHJKMNQUVXZ', CAST(month(delivery) AS INTEGER), 1) || strftime(delivery, '%y') || '.NYM' AS contract
FROM ahead""")
def p24(spark, sf):
    days = adapters.order_value_total(spark, sf).select("as_of")
    return resample.contracts_ahead(days, "BZ", ".NYM")


BASE = """base AS (
  SELECT series_id, AVG(value) AS base, COUNT(value) AS days,
         CAST(365 AS BIGINT) AS expected_days, COUNT(value) >= 0.9 * 365 AS covered
  FROM total WHERE as_of BETWEEN DATE '1996-01-01' AND DATE '1996-12-30' GROUP BY 1)"""
PERCENT = """pct AS (
  SELECT series_id, as_of, round(value / base * 100, 1) AS value FROM total JOIN base USING (series_id)
  WHERE covered AND base <> 0)"""
PERCENT_WEEK = f"""pctweek AS (
  SELECT series_id, week AS as_of, value FROM (
    SELECT series_id, {friday('as_of')} AS week,
           sign(SUM(CAST(CAST(value AS DECIMAL(18,1)) * 10 AS BIGINT)))
             * ((2 * abs(SUM(CAST(CAST(value AS DECIMAL(18,1)) * 10 AS BIGINT))) + COUNT(value)) // (2 * COUNT(value))) / 10 AS value,
           MAX(MAX(as_of)) OVER (PARTITION BY series_id) AS newest
    FROM pct GROUP BY 1, 2) WHERE week <= newest)"""


def baseline(spark, sf):
    return resample.baseline(adapters.order_value_total(spark, sf), dt.date(1996, 1, 1), dt.date(1996, 12, 30))


def percent_daily(spark, sf):
    return resample.percent_of_baseline(adapters.order_value_total(spark, sf), baseline(spark, sf))


def percent_weekly(spark, sf):
    return resample.weekly_mean_completed(percent_daily(spark, sf))


@query("a1_mean_six_decimals", """
SELECT o_orderpriority AS series_id, last_day(CAST(o_orderdate AS DATE)) AS as_of, round(round(AVG(o_totalprice / 1e7), 9), 6) AS value
FROM orders GROUP BY 1, 2""")
def a1_six(spark, sf):
    """Rates carry more than two decimals; the mean is taken of the values as they are."""
    rates = adapters.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").alias("as_of"),
        (F.col("o_totalprice") / 1e7).alias("value"))
    return resample.monthly_mean(rates, digits=9).withColumn("value", F.round("value", 6))


@query("w18_no_anchor", with_(ORDER_VALUE, MONTHLY, MONTHLY6, """
SELECT series_id, as_of, value, CAST(NULL AS VARCHAR) AS filled, false AS provisional FROM monthly6"""))
def w18_no_anchor(spark, sf):
    """Without a row of an anchor series there is no frontier, and nothing is filled."""
    obs = monthly(spark, sf)
    frontier = windows.cohort_frontier(obs, obs.filter("series_id = 'none'")).scalar()
    return windows.carry_forward(obs, frontier)


@query("a7_baseline_mean", with_(ORDER_VALUE_TOTAL, BASE, "SELECT * REPLACE (round(base, 6) AS base) FROM base"))
def a7(spark, sf):
    return baseline(spark, sf).withColumn("base", F.round("base", 6))


@query("a8_percent_of_baseline_weekly", with_(ORDER_VALUE_TOTAL, BASE, PERCENT, PERCENT_WEEK, "SELECT * FROM pctweek"))
def a8(spark, sf):
    return percent_weekly(spark, sf)


CHANGES = """changes AS (
  SELECT * FROM (SELECT series_id, as_of, value - LAG(value) OVER (PARTITION BY series_id ORDER BY as_of) AS change
                 FROM weekly) WHERE change IS NOT NULL)"""
DEVIATION = """norm AS (
  SELECT series_id, week(as_of) AS wk, AVG(change) AS norm
  FROM changes c JOIN (SELECT series_id, MAX(year(as_of)) AS top FROM changes GROUP BY 1) USING (series_id)
  WHERE year(as_of) >= top - 5 GROUP BY 1, 2),
deviation AS (
  SELECT c.series_id, c.as_of, round((change - norm) / 1000.0, 2) AS value
  FROM changes c LEFT JOIN norm n ON n.series_id = c.series_id AND n.wk = week(c.as_of))"""


@query("a9_seasonal_deviation", with_(ORDER_VALUE, WEEKLY, CHANGES, DEVIATION, "SELECT * FROM deviation"))
def a9(spark, sf):
    return resample.seasonal_deviation(weekly(spark, sf))


@query("w21_latest_level_and_change", with_(ORDER_VALUE, WEEKLY, """
SELECT w.series_id, round(arg_max(w.value, w.as_of) / 1000.0, 1) AS last_level,
       round(arg_max(d.change, d.as_of) FILTER (d.change IS NOT NULL) / 1000.0, 2) AS last_change
FROM weekly w JOIN (SELECT series_id, as_of, value - LAG(value) OVER (PARTITION BY series_id ORDER BY as_of) AS change
                    FROM weekly) d USING (series_id, as_of) GROUP BY 1"""))
def w21(spark, sf):
    return resample.latest_level_and_change(weekly(spark, sf))


@query("j1_two_leg_spread", with_(ORDER_VALUE, """
SELECT a.as_of, round(a.value - b.value, 3) AS value FROM obs a JOIN obs b USING (as_of)
WHERE a.series_id = '1-URGENT' AND b.series_id = '2-HIGH'"""))
def j1(spark, sf):
    obs = adapters.order_value(spark, sf)
    return resample.two_leg_spread(obs.filter("series_id = '1-URGENT'"), obs.filter("series_id = '2-HIGH'"))


@query("j2_first_two_legs", with_(ORDER_VALUE, """
SELECT series_id, rows, leg, COUNT(*) OVER () = 2 AS usable FROM (
  SELECT series_id, COUNT(value) AS rows, row_number() OVER (ORDER BY series_id) AS leg FROM obs GROUP BY 1)
WHERE leg <= 2"""))
def j2(spark, sf):
    return resample.first_two_legs(adapters.order_value(spark, sf))


@query("j2_front_spread", with_(ORDER_VALUE, """
SELECT a.as_of, round(a.value - b.value, 3) AS value FROM obs a JOIN obs b USING (as_of)
WHERE a.series_id = (SELECT MIN(series_id) FROM obs) AND b.series_id = (SELECT MIN(series_id) FROM obs WHERE series_id > (SELECT MIN(series_id) FROM obs))"""))
def j2_spread(spark, sf):
    return resample.front_spread(adapters.order_value(spark, sf))


@query("j3_dual_basis", with_(ORDER_VALUE, WEEKLY, f"""tr AS (
  SELECT series_id, {friday('as_of')} AS as_of, arg_max(value * 0.97, as_of) AS value
  FROM obs WHERE as_of >= DATE '1997-01-01' GROUP BY 1, 2)
SELECT w.series_id, w.as_of, round(w.value, 6) AS value, round(tr.value, 6) AS value_tr
FROM weekly w JOIN tr USING (series_id, as_of)"""))
def j3(spark, sf):
    obs = adapters.order_value(spark, sf)
    later = F.col("as_of") >= F.lit("1997-01-01").cast("date")  # the adjusted basis begins later
    adjusted = obs.withColumn("value", F.when(later, F.col("value") * 0.97))
    return resample.dual_basis(weekly(spark, sf), resample.weekly_last(adjusted))


@query("w1_trailing_percentile", with_(ORDER_VALUE, WEEKLY, """n AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of) AS rn FROM weekly)
SELECT a.series_id, a.as_of, a.value, COUNT(*) AS n_obs,
       CASE WHEN COUNT(*) >= 8 AND MIN(b.value) <> MAX(b.value)
            THEN round(100.0 * CAST(COUNT(*) FILTER (b.value <= a.value) AS DOUBLE) / COUNT(*), 2) END AS percentile
FROM n a JOIN n b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn - 51 AND a.rn
GROUP BY 1, 2, 3"""))
def w1(spark, sf):
    return windows.trailing_percentile(weekly(spark, sf), 52)


@query("w2_trailing_zscore", with_(ORDER_VALUE, WEEKLY, """
SELECT series_id, as_of, value, COUNT(*) OVER f AS n_obs,
       CASE WHEN COUNT(*) OVER f >= 8 AND MIN(value) OVER f <> MAX(value) OVER f
            THEN round((value - AVG(value) OVER f) / stddev_pop(value) OVER f, 4) END AS zscore
FROM weekly WINDOW f AS (PARTITION BY series_id ORDER BY as_of ROWS BETWEEN 51 PRECEDING AND CURRENT ROW)"""))
def w2(spark, sf):
    return windows.trailing_zscore(weekly(spark, sf), 52)


def percentile_sql(window: str, rows: str) -> str:
    return f"""tail AS (
  SELECT *, MAX(CASE WHEN rn = 1 THEN value END) OVER (PARTITION BY series_id) AS cur FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS rn FROM weekly) WHERE {rows}),
pw AS (
  SELECT series_id, {window} AS "window",
         CASE WHEN COUNT(*) >= 8 AND MIN(value) <> MAX(value)
              THEN round(100.0 * CAST(COUNT(*) FILTER (value <= cur) AS DOUBLE) / COUNT(*), 2) END AS percentile,
         CASE WHEN COUNT(*) >= 8 AND MIN(value) <> MAX(value)
              THEN round((arg_max(value, as_of) - AVG(value)) / stddev_pop(value), 4) END AS zscore,
         COUNT(*) AS n_obs, MAX(as_of) AS asof, 'single-contract' AS segment, arg_max(value, as_of) AS net
  FROM tail GROUP BY 1)"""


@query("w3_percentile_window", with_(ORDER_VALUE, WEEKLY, percentile_sql("CAST(156 AS BIGINT)", "rn <= 156"), "SELECT * FROM pw"))
def w3(spark, sf):
    return windows.percentile_window(weekly(spark, sf), 156)


DELTA = """delta AS (
  SELECT series_id, arg_max(d, as_of) AS delta_4w FROM (
    SELECT series_id, as_of, value - LAG(value, 4) OVER (PARTITION BY series_id ORDER BY as_of) AS d FROM weekly)
  GROUP BY 1)"""


@query("w4_positioning_view", with_(ORDER_VALUE, WEEKLY, percentile_sql("CAST(52 AS BIGINT)", "rn <= 52"), DELTA,
       "SELECT pw.* EXCLUDE (segment), delta_4w FROM pw JOIN delta USING (series_id)"))
def w4(spark, sf):
    return windows.positioning_view(weekly(spark, sf), 52)


@query("w4_positioning_full_history", with_(ORDER_VALUE, WEEKLY, percentile_sql("COUNT(*)", "true"), DELTA,
       "SELECT pw.* EXCLUDE (segment), delta_4w FROM pw JOIN delta USING (series_id)"))
def w4_full(spark, sf):
    return windows.positioning_view(weekly(spark, sf), None)


RANKED = """ranked AS (
  SELECT series_id, as_of, value, round((rank() OVER (PARTITION BY series_id ORDER BY value)
           + (COUNT(*) OVER (PARTITION BY series_id, value) - 1) / 2.0) / COUNT(*) OVER (PARTITION BY series_id) * 100, 1) AS percentile,
         row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS recency FROM weekly)"""


@query("w5_average_rank_percent", with_(ORDER_VALUE, WEEKLY, RANKED, "SELECT * FROM ranked"))
def w5(spark, sf):
    return windows.average_rank_percent(weekly(spark, sf))


RANK_SUMMARY = """ranksum AS (
  SELECT series_id, MAX(percentile) FILTER (recency = 1) AS pctile_last, MAX(percentile) FILTER (recency = 3) AS pctile_2_back,
         MAX(percentile) FILTER (recency = 5) AS pctile_4_back, arg_max(value, as_of) AS net_last, MAX(as_of) AS report_date
  FROM ranked GROUP BY 1)"""


@query("w5_average_rank_summary", with_(ORDER_VALUE, WEEKLY, RANKED, RANK_SUMMARY, "SELECT * FROM ranksum"))
def w5_summary(spark, sf):
    return windows.average_rank_summary(weekly(spark, sf))


YOY = """yoy AS (
  SELECT series_id, as_of, round((value / base - 1.0) * 100.0, 6) AS value FROM (
    SELECT *, LAG(value, 12) OVER (PARTITION BY series_id ORDER BY as_of) AS base FROM monthly6)
  WHERE base IS NOT NULL AND base <> 0)"""
NOWCAST = """nowcast AS (
  SELECT series_id, as_of,
         round(CAST(0.1252 AS DOUBLE) + CAST(0.5632 AS DOUBLE) * ((value / base - CAST(1.0 AS DOUBLE)) * CAST(100.0 AS DOUBLE)), 6) AS value,
         true AS provisional FROM (
    SELECT *, LAG(value, 1) OVER (PARTITION BY series_id ORDER BY as_of) AS base FROM monthly6)
  WHERE base IS NOT NULL AND base <> 0)"""


@query("w6_change_over_12_rows", with_(ORDER_VALUE, MONTHLY, MONTHLY6, YOY, "SELECT * FROM yoy"))
def w6(spark, sf):
    return windows.change_over_rows(monthly(spark, sf), 12)


@query("w7_nowcast", with_(ORDER_VALUE, MONTHLY, MONTHLY6, NOWCAST, "SELECT * FROM nowcast"))
def w7(spark, sf):
    return windows.nowcast(monthly(spark, sf))


@query("w15_largest_gap", with_(ORDER_VALUE, """steps AS (
  SELECT series_id, as_of AS to_date, LAG(as_of) OVER (PARTITION BY series_id ORDER BY as_of) AS from_date
  FROM obs WHERE value > 600000)
, top AS (SELECT series_id, MAX(struct_pack(gap_days := to_date - from_date, from_date := from_date, to_date := to_date)) AS g
        FROM steps WHERE from_date IS NOT NULL GROUP BY 1)
SELECT series_id, g.gap_days AS gap_days, g.from_date AS from_date, g.to_date AS to_date FROM top WHERE g.gap_days > 3"""))
def w15(spark, sf):
    """Dates of low days are unreadable; a gap runs over them."""
    obs = adapters.order_value(spark, sf).withColumn("as_of", F.when(F.col("value") > 600000, F.col("as_of")))
    return windows.largest_gap(obs, max_gap_days=3)


@query("w16_trailing_streak", with_(ORDER_VALUE, """
SELECT series_id, COALESCE(MIN(rn) FILTER (NOT value < 3000000) - 1, COUNT(*)) AS below FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS rn FROM obs) GROUP BY 1"""))
def w16(spark, sf):
    return windows.trailing_streak(adapters.order_value(spark, sf), F.col("value") < 3000000, "below")


@query("w17_persistence", with_(ORDER_VALUE, """
SELECT series_id, COUNT(*) >= 5 AND MIN(value) >= 50000 AS held_high, COUNT(*) >= 5 AND MAX(value) <= 900000 AS held_low,
       arg_max(value, as_of) AS last_value FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS rn FROM obs) WHERE rn <= 5 GROUP BY 1"""))
def w17(spark, sf):
    return windows.persistence(adapters.order_value(spark, sf), 5, high=50000, low=900000)


FRONTIER = "frontier AS (SELECT MAX(last_day(as_of)) AS frontier FROM gappy WHERE series_id IN ('1-URGENT', '3-MEDIUM'))"


@query("a16_cohort_frontier", with_(ORDER_VALUE, MONTHLY, MONTHLY6, GAPPY, FRONTIER, "SELECT * FROM frontier"))
def a16(spark, sf):
    obs = with_gaps(monthly(spark, sf))
    anchor = F.col("series_id").isin("1-URGENT", "3-MEDIUM")
    return windows.cohort_frontier(obs, obs.select(F.when(anchor, F.col("series_id")).alias("series_id")))


@query("w18_carry_forward", with_(ORDER_VALUE, MONTHLY, MONTHLY6, GAPPY, """spine AS (
  SELECT series_id, last_day(CAST(m AS DATE)) AS as_of FROM (
    SELECT series_id, unnest(generate_series(date_trunc('month', MIN(as_of)),
             date_trunc('month', GREATEST(MAX(as_of), DATE '2001-05-31')), INTERVAL 1 MONTH)) AS m
    FROM gappy GROUP BY 1)),
walked AS (
  SELECT s.series_id, s.as_of, g.value IS NOT NULL AS real,
         last_value(g.value IGNORE NULLS) OVER (PARTITION BY s.series_id ORDER BY s.as_of) AS value
  FROM spine s LEFT JOIN gappy g USING (series_id, as_of))
SELECT series_id, as_of, value, CASE WHEN NOT real THEN 'carry_forward' END AS filled, NOT real AS provisional
FROM walked WHERE real OR as_of <= DATE '2001-05-31'"""))
def w18(spark, sf):
    return windows.carry_forward(with_gaps(monthly(spark, sf)), dt.date(2001, 5, 31))


@query("w19_chained_nowcast", with_(ORDER_VALUE, MONTHLY, MONTHLY6, NOWCAST, """lastreal AS (
  SELECT series_id, MAX(as_of) AS last_month, arg_max(value, as_of) AS level FROM monthly6
  WHERE as_of <= DATE '2001-01-31' GROUP BY 1),
steps AS (SELECT n.series_id, n.as_of, n.value AS rate, level,
            row_number() OVER (PARTITION BY n.series_id ORDER BY n.as_of) AS rn
          FROM nowcast n JOIN lastreal l USING (series_id) WHERE n.as_of > last_month),
walk AS (SELECT series_id, as_of, rn, round(level * (1 + rate / 100.0), 6) AS value FROM steps WHERE rn = 1
         UNION ALL
         SELECT s.series_id, s.as_of, s.rn, round(w.value * (1 + s.rate / 100.0), 6)
         FROM walk w JOIN steps s ON s.series_id = w.series_id AND s.rn = w.rn + 1)
SELECT series_id, as_of, value, 'nowcast' AS filled, true AS provisional FROM walk""").replace("WITH ", "WITH RECURSIVE ", 1))
def w19(spark, sf):
    levels = monthly(spark, sf)
    real = F.when(F.col("as_of") <= F.lit("2001-01-31").cast("date"), F.col("value"))
    return windows.chained_nowcast(levels.withColumn("value", real), windows.nowcast(levels))


@query("w20_tail_mean", with_(ORDER_VALUE, """
SELECT series_id, round(AVG(value), 1) AS tail_mean, COUNT(value) AS n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS rn FROM obs) WHERE rn <= 7 GROUP BY 1"""))
def w20(spark, sf):
    return windows.tail_mean(adapters.order_value(spark, sf), 7, 1)
