"""Revision control and bitemporal history over event readings and order vintages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.functions.frames import whole
from seriesloom.operators import bitemporal as bt
from seriesloom.operators import resample
from seriesloom.operators import revisions as rev
from seriesloom.workloads import query, with_
from seriesloom.workloads.series import VINT_MONTH, VINTAGES

CUTOFF = adapters.LOG_CUTOFF
PULL = adapters.PULL_DATE

LOG = """log AS (
  SELECT series_id, as_of, recorded_on, value, value / ((10000 + 7 * (e % 5)) / 10000) AS value_tr FROM (
    SELECT 'ev_' || user_id AS series_id, CAST(ts AS DATE) AS as_of,
           CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS recorded_on,
           arg_max(value, event_id) AS value, MAX(event_id) AS e
    FROM events GROUP BY 1, 2, 3))"""
FULL_VIEW = """fullview AS (SELECT series_id, as_of, MAX(recorded_on) AS recorded_on, arg_max(value, recorded_on) AS value,
  arg_max(value_tr, recorded_on) AS value_tr FROM log GROUP BY 1, 2)"""
STORED = """lines AS (SELECT * FROM log WHERE recorded_on <= DATE '2024-01-20'),
sview AS (SELECT series_id, as_of, MAX(recorded_on) AS recorded_on, arg_max(value, recorded_on) AS value,
  arg_max(value_tr, recorded_on) AS value_tr FROM lines GROUP BY 1, 2),
stored AS (SELECT *, as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional FROM sview),
slog AS (SELECT l.*, COALESCE(s.provisional, false) AS provisional
         FROM lines l LEFT JOIN stored s USING (series_id, as_of, recorded_on))"""


def batch_sql(recorded: str = "DATE '2024-02-05'") -> str:
    return f"""batch AS (
  SELECT series_id, as_of, value, value_tr, {recorded} AS recorded_on,
         as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional
  FROM fullview WHERE as_of >= DATE '2024-01-15')"""


PLAN = """tips AS (SELECT series_id, MAX(as_of) AS stip FROM stored GROUP BY 1),
btips AS (SELECT series_id, MAX(as_of) AS btip FROM batch GROUP BY 1),
paired AS (
  SELECT b.series_id, b.as_of, b.value, b.value_tr, b.recorded_on, s.recorded_on AS old_recorded_on,
    b.provisional AND b.as_of >= COALESCE(GREATEST(stip, btip), btip) AS provisional,
    s.series_id IS NOT NULL AS known, COALESCE(s.provisional, false) AS old_prov,
    (b.value IS NOT DISTINCT FROM s.value OR COALESCE(abs(b.value - s.value) <= 1e-6, false))
      AND (b.value_tr IS NOT DISTINCT FROM s.value_tr OR COALESCE(abs(b.value_tr - s.value_tr) <= 1e-6, false)) AS equal
  FROM batch b JOIN btips USING (series_id) LEFT JOIN tips USING (series_id)
  LEFT JOIN stored s ON s.series_id = b.series_id AND s.as_of = b.as_of),
acted AS (SELECT *, CASE WHEN NOT known THEN 'append'
    WHEN old_prov THEN CASE WHEN equal AND provisional THEN 'skip' ELSE 'revise' END
    WHEN equal THEN 'skip' ELSE 'restate' END AS action FROM paired),
judged AS (SELECT *, bool_or(action = 'restate' AND recorded_on <= old_recorded_on) OVER (PARTITION BY series_id) AS refused FROM acted),
plan AS (
  SELECT series_id, as_of, value, value_tr, recorded_on, provisional, action, refused, old_recorded_on FROM judged
  UNION ALL
  SELECT s.series_id, s.as_of, s.value, s.value_tr, s.recorded_on, false, 'freeze', false, s.recorded_on
  FROM stored s JOIN btips USING (series_id)
  WHERE s.provisional AND s.as_of < btip AND NOT EXISTS (SELECT 1 FROM batch b WHERE b.series_id = s.series_id AND b.as_of = s.as_of)
    AND s.series_id NOT IN (SELECT series_id FROM judged WHERE refused))"""
SUMMARY = """SELECT series_id, NOT bool_or(refused) AS ok,
  COUNT(*) FILTER (action = 'append' AND NOT refused) AS appended, COUNT(*) FILTER (action = 'restate' AND NOT refused) AS restated,
  COUNT(*) FILTER (action = 'revise' AND NOT refused) AS revised, COUNT(*) FILTER (action = 'freeze' AND NOT refused) AS frozen,
  COUNT(*) FILTER (action = 'skip' AND NOT refused) AS skipped,
  COALESCE(string_agg(DISTINCT CAST(year(as_of) AS VARCHAR), ',') FILTER (action <> 'skip' AND NOT refused), '') AS years_touched
FROM plan GROUP BY 1"""
APPLIED = """applied AS (
  SELECT series_id, as_of, recorded_on, value, value_tr, provisional FROM slog l WHERE NOT EXISTS (
    SELECT 1 FROM plan p WHERE NOT refused AND action IN ('revise', 'freeze')
      AND p.series_id = l.series_id AND p.as_of = l.as_of AND p.old_recorded_on = l.recorded_on)
  UNION ALL
  SELECT series_id, as_of, recorded_on, value, value_tr, provisional FROM plan WHERE NOT refused AND action <> 'skip')"""
CHAIN = [LOG, FULL_VIEW, STORED]


def stored_log(spark, sf):
    """Lines recorded up to the cutoff; the newest line of each series tip is provisional."""
    lines = adapters.reading_log(spark, sf).filter(F.col("recorded_on") <= F.lit(CUTOFF))
    mark = F.struct("as_of", "recorded_on")
    return lines.withColumn("provisional", mark == F.max(mark).over(whole()))


def pulled_batch(spark, sf, recorded_on=PULL):
    """The refresh pull: every reading since five days before the cutoff."""
    view = bt.current_view(adapters.reading_log(spark, sf))
    window = view.filter(F.col("as_of") >= F.date_sub(F.lit(CUTOFF), 5))
    return window.select(
        "series_id", "as_of", "value", "value_tr", F.lit(recorded_on).alias("recorded_on"),
        (F.col("as_of") == F.max("as_of").over(whole())).alias("provisional"))


def plan(spark, sf, recorded_on=PULL):
    return bt.append_plan(stored_log(spark, sf), pulled_batch(spark, sf, recorded_on))


@query("b1_append_plan", with_(*CHAIN, batch_sql(), PLAN, "SELECT * FROM plan"))
def b1(spark, sf):
    return plan(spark, sf)


@query("b1_append_summary", with_(*CHAIN, batch_sql(), PLAN, SUMMARY))
def b1_summary(spark, sf):
    return bt.append_summary(plan(spark, sf))


@query("b1_history_after_append", with_(*CHAIN, batch_sql(), PLAN, APPLIED, "SELECT * FROM applied"))
def b1_after(spark, sf):
    return bt.append(stored_log(spark, sf), pulled_batch(spark, sf))


@query("b2_vintage_must_advance", with_(*CHAIN, batch_sql("DATE '2024-01-19'"), PLAN, SUMMARY))
def b2(spark, sf):
    return bt.append_summary(plan(spark, sf, dt.date(2024, 1, 19)))


JUMPED = """batch AS (
  SELECT series_id, as_of, value, value_tr, DATE '2024-02-05' AS recorded_on,
         as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional
  FROM fullview WHERE as_of > DATE '2024-01-22')"""


def jumped_batch(spark, sf):
    """A pull that starts after the stored tips."""
    return pulled_batch(spark, sf).filter(F.col("as_of") > F.lit(dt.date(2024, 1, 22)))


@query("b3_tip_freeze", with_(*CHAIN, JUMPED, PLAN, "SELECT * FROM plan WHERE action = 'freeze'"))
def b3(spark, sf):
    return bt.append_plan(stored_log(spark, sf), jumped_batch(spark, sf)).filter("action = 'freeze'")


TRUNCATED = """batch AS (
  SELECT series_id, as_of, value, value_tr, DATE '2024-02-05' AS recorded_on,
         as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional
  FROM fullview WHERE as_of <= DATE '2024-01-17')"""


@query("b4_provisional_strip", with_(*CHAIN, TRUNCATED, PLAN, APPLIED, """
SELECT series_id, COUNT(*) FILTER (provisional) AS provisional_lines, MAX(as_of) FILTER (provisional) AS provisional_day,
       MAX(as_of) AS tip FROM applied GROUP BY 1"""))
def b4(spark, sf):
    view = bt.current_view(adapters.reading_log(spark, sf)).filter(F.col("as_of") <= F.lit(dt.date(2024, 1, 17)))
    tips = view.groupBy("series_id").agg(F.max("as_of").alias("tip"))
    batch = view.join(tips, "series_id").withColumn("provisional", F.col("as_of") == F.col("tip")).drop("tip").withColumn(
        "recorded_on", F.lit(PULL))
    after = bt.append(stored_log(spark, sf), batch)
    return after.groupBy("series_id").agg(
        F.count_if("provisional").alias("provisional_lines"),
        F.max(F.when(F.col("provisional"), F.col("as_of"))).alias("provisional_day"), F.max("as_of").alias("tip"))


@query("b5_current_view", with_(LOG, FULL_VIEW, "SELECT * FROM fullview"))
def b5(spark, sf):
    return bt.current_view(adapters.reading_log(spark, sf))


@query("b5_point_in_time", with_(LOG, """
SELECT series_id, as_of, MAX(recorded_on) AS recorded_on, arg_max(value, recorded_on) AS value, arg_max(value_tr, recorded_on) AS value_tr
FROM log WHERE recorded_on <= DATE '2024-01-12' GROUP BY 1, 2"""))
def b5_pit(spark, sf):
    return bt.current_view(adapters.reading_log(spark, sf), dt.date(2024, 1, 12))


@query("b6_identity_only_change", with_(*CHAIN, """
SELECT series_id, true AS ok, CAST(0 AS BIGINT) AS restated, COUNT(*) AS skipped, MIN('SEC-000001') AS kept_id FROM sview GROUP BY 1"""))
def b6(spark, sf):
    log = stored_log(spark, sf).withColumn("stable_id", F.lit("SEC-000001"))
    again = bt.current_view(log).withColumn("stable_id", F.lit("SEC-000002")).withColumn("recorded_on", F.lit(PULL))
    plan_ = bt.append_plan(log, again)
    after = bt.current_view(bt.apply_plan(log, plan_)).groupBy("series_id").agg(F.max("stable_id").alias("kept_id"))
    return bt.append_summary(plan_).join(after, "series_id").select("series_id", "ok", "restated", "skipped", "kept_id")


@query("b16_promote", with_(*CHAIN, """
SELECT series_id, NOT bool_or(n > 1 AND changed) AS ok FROM (
  SELECT series_id, as_of, COUNT(*) AS n, MIN(value) <> MAX(value) OR MIN(value_tr) <> MAX(value_tr) AS changed FROM lines GROUP BY 1, 2) GROUP BY 1"""))
def b16(spark, sf):
    log = stored_log(spark, sf).withColumn("provisional", F.lit(False))
    first_lines = log.groupBy("series_id", "as_of").agg(F.min("recorded_on").alias("recorded_on"))
    target = log.join(first_lines, ["series_id", "as_of", "recorded_on"], "left_semi")
    return bt.append_summary(bt.promote(log, target)).select("series_id", "ok")


@query("b17_idempotent_rerun", with_(*CHAIN, batch_sql(), """
SELECT series_id, true AS ok, CAST(0 AS BIGINT) AS appended, CAST(0 AS BIGINT) AS restated, CAST(0 AS BIGINT) AS revised,
       CAST(0 AS BIGINT) AS frozen, COUNT(*) AS skipped, '' AS years_touched FROM batch GROUP BY 1"""))
def b17(spark, sf):
    log, batch = stored_log(spark, sf), pulled_batch(spark, sf)
    return bt.append_summary(bt.append_plan(bt.append(log, batch), batch))


@query("b18_vintage_records", with_(VINTAGES, VINT_MONTH, """
SELECT series_id, as_of, MAX(recorded_on) AS recorded_on, arg_max(value, recorded_on) AS value, arg_max(realtime_end, recorded_on) AS realtime_end
FROM vmonth WHERE recorded_on <= DATE '1999-06-30' GROUP BY 1, 2"""))
def b18(spark, sf):
    return bt.current_view(resample.vintage_monthly_mean(adapters.order_vintages(spark, sf)), dt.date(1999, 6, 30))


@query("a14_vintage_coverage", with_(VINTAGES, VINT_MONTH, """
SELECT series_id, COUNT(*) AS n_rows, COUNT(DISTINCT recorded_on) AS n_vintages, MIN(recorded_on) AS earliest_vintage,
       MAX(recorded_on) AS latest_vintage, MIN(as_of) AS earliest_obs, MAX(as_of) AS latest_obs FROM vmonth GROUP BY 1"""))
def a14(spark, sf):
    return resample.vintage_monthly_mean(adapters.order_vintages(spark, sf)).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("recorded_on").alias("n_vintages"),
        F.min("recorded_on").alias("earliest_vintage"), F.max("recorded_on").alias("latest_vintage"),
        F.min("as_of").alias("earliest_obs"), F.max("as_of").alias("latest_obs"))


# --- revisions --------------------------------------------------------------------------

ROUNDED = """incoming AS (SELECT series_id, as_of, round(value, 4) AS value, round(value_tr, 4) AS value_tr FROM fullview)"""


def stored_view(spark, sf):
    return bt.current_view(adapters.reading_log(spark, sf), CUTOFF).select("series_id", "as_of", "value", "value_tr")


def incoming(spark, sf):
    return rev.round_values(b5(spark, sf).select("series_id", "as_of", "value", "value_tr"))


@query("p8_write_rounding", with_(LOG, FULL_VIEW, ROUNDED, "SELECT * FROM incoming"))
def p8(spark, sf):
    return incoming(spark, sf)


BANDED = """banded AS (
  SELECT i.series_id, i.as_of,
    CASE WHEN abs(i.value - s.value) <= GREATEST(1e-4, abs(s.value) * 1e-4) THEN round(s.value, 4) ELSE i.value END AS value,
    CASE WHEN abs(i.value_tr - s.value_tr) <= GREATEST(1e-4, abs(s.value_tr) * 1e-4) THEN round(s.value_tr, 4) ELSE i.value_tr END AS value_tr
  FROM jitter i LEFT JOIN sview s USING (series_id, as_of))"""
JITTER = """jitter AS (SELECT series_id, as_of, round(value * CAST(1.0000473 AS DOUBLE), 4) AS value, round(value_tr * CAST(1.0003019 AS DOUBLE), 4) AS value_tr FROM fullview)"""


@query("j4_epsilon_deadband", with_(*CHAIN, JITTER, BANDED, "SELECT * FROM banded"))
def j4(spark, sf):
    moved = b5(spark, sf).select("series_id", "as_of", (F.col("value") * 1.0000473).alias("value"),
                                 (F.col("value_tr") * 1.0003019).alias("value_tr"))
    return rev.deadband(stored_view(spark, sf), rev.round_values(moved))


CELLS = """cells AS (
  SELECT i.series_id, i.as_of, place, field, old, new, tip, i.as_of >= tip - 7 AS settled FROM (
    SELECT series_id, as_of, 0 AS place, 'value' AS field, round(s.value, 4) AS old, i.value AS new FROM incoming i JOIN sview s USING (series_id, as_of)
    UNION ALL
    SELECT series_id, as_of, 1, 'value_tr', round(s.value_tr, 4), i.value_tr FROM incoming i JOIN sview s USING (series_id, as_of)) i
  JOIN (SELECT series_id, MAX(as_of) AS tip FROM incoming GROUP BY 1) USING (series_id) WHERE old IS DISTINCT FROM new),
kinds AS (SELECT *, CASE WHEN settled THEN 'settled'
    WHEN field = 'value' AND CAST(substr(series_id, 4) AS BIGINT) % 5 = 0 THEN 'value_recomputed'
    WHEN field = 'value' THEN 'historical_value' ELSE 'value_tr_rescale' END AS kind FROM cells),
decl AS (SELECT series_id, MAX(tip) AS tip, MAX(tip) - 7 AS settle_window_from,
    COUNT(*) FILTER (kind = 'settled') AS settled_n, COUNT(*) FILTER (kind = 'historical_value') AS historical_value_n,
    COUNT(*) FILTER (kind = 'value_recomputed') AS recomputed_n, COUNT(*) FILTER (kind = 'value_tr_rescale') AS tr_rescale_n,
    round(MAX(abs(new - old)) FILTER (kind = 'value_recomputed'), 8) AS recomputed_max_abs,
    round(MAX(CASE WHEN old = 0 THEN 0 ELSE abs(new - old) / abs(old) END) FILTER (kind = 'value_tr_rescale'), 8) AS tr_rescale_max_rel,
    COUNT(*) FILTER (kind = 'historical_value') >= 2 AS split_suspect FROM kinds GROUP BY 1)"""


def recomputed(spark, sf):
    return stored_view(spark, sf).select("series_id").distinct().filter(
        F.substring("series_id", 4, 10).cast("long") % 5 == 0)


def declared(spark, sf):
    return rev.declarations(stored_view(spark, sf), incoming(spark, sf), recomputed(spark, sf), split_rows=2)


COUNTS = ["series_id", "tip", "settle_window_from", "settled_n", "historical_value_n", "recomputed_n",
          "tr_rescale_n", "recomputed_max_abs", "tr_rescale_max_rel", "split_suspect"]


@query("b7_revision_declaration", with_(*CHAIN, ROUNDED, CELLS, "SELECT * FROM decl"))
def b7(spark, sf):
    return declared(spark, sf).select(*COUNTS)


@query("b8_split_suspicion", with_(*CHAIN, ROUNDED, CELLS, "SELECT series_id, historical_value_n FROM decl WHERE split_suspect"))
def b8(spark, sf):
    return declared(spark, sf).filter("split_suspect").select("series_id", "historical_value_n")


@query("t1_named_items", with_(*CHAIN, ROUNDED, CELLS, """
SELECT series_id, kind, position, as_of, field, old, new FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, kind ORDER BY as_of, place) AS position FROM kinds
  WHERE kind IN ('settled', 'historical_value')) WHERE position <= 3"""))
def t1(spark, sf):
    cells = rev.classified_cells(rev.changed_cells(stored_view(spark, sf), incoming(spark, sf)), recomputed(spark, sf))
    return rev.named_items(cells, 3)


@query("b9_declaration_summary", with_(*CHAIN, ROUNDED, CELLS, """
SELECT series_id, concat_ws(' · ',
  CASE WHEN settled_n > 0 THEN 'settled ' || settled_n END,
  CASE WHEN historical_value_n > 0 THEN 'HISTORICAL value ' || historical_value_n || CASE WHEN split_suspect THEN ' SPLIT-SUSPECT' ELSE '' END END,
  CASE WHEN recomputed_n > 0 THEN 'recomputed n=' || recomputed_n || ' max_abs=' || regexp_replace(printf('%.8f', recomputed_max_abs), '(\\.\\d+?)0+$', '\\1') END,
  CASE WHEN tr_rescale_n > 0 THEN 'tr-rescale n=' || tr_rescale_n || ' max_rel=' || regexp_replace(printf('%.8f', tr_rescale_max_rel), '(\\.\\d+?)0+$', '\\1') END) AS summary
FROM decl"""))
def b9(spark, sf):
    return rev.summary_line(declared(spark, sf)).select("series_id", "summary")


LATE_START = "sview2 AS (SELECT * FROM sview WHERE as_of >= DATE '2024-01-05')"


@query("b10_window_preservation", with_(*CHAIN, LATE_START, ROUNDED, """
SELECT i.* FROM incoming i LEFT JOIN (SELECT series_id, MIN(as_of) AS first_day FROM sview2 GROUP BY 1) USING (series_id)
WHERE first_day IS NULL OR as_of >= first_day"""))
def b10(spark, sf):
    late = stored_view(spark, sf).filter(F.col("as_of") >= F.lit(dt.date(2024, 1, 5)))
    return rev.keep_window(late, incoming(spark, sf))


SHORT = "short AS (SELECT * FROM incoming WHERE as_of BETWEEN DATE '2024-01-03' AND DATE '2024-01-18' AND day(as_of) <> 9)"


def short_pull(spark, sf):
    """An incoming pull that lost its head, its tail and one interior day."""
    return incoming(spark, sf).filter(
        F.col("as_of").between(F.lit(dt.date(2024, 1, 3)), F.lit(dt.date(2024, 1, 18))) & (F.dayofmonth("as_of") != 9))


@query("b11_truncation_floor", with_(*CHAIN, ROUNDED, SHORT, """c AS (
  SELECT series_id, stored_rows, incoming_rows, COALESCE(incoming_rows < stored_rows * 0.9, false) AS refused FROM
    (SELECT series_id, COUNT(*) AS incoming_rows FROM short GROUP BY 1) LEFT JOIN
    (SELECT series_id, COUNT(*) AS stored_rows FROM sview GROUP BY 1) USING (series_id))
SELECT *, CASE WHEN refused THEN 'refused: would truncate ' || stored_rows || '->' || incoming_rows || ' rows' END AS reason FROM c"""))
def b11(spark, sf):
    return rev.truncation_check(stored_view(spark, sf), short_pull(spark, sf))


@query("b12_edge_warnings", with_(*CHAIN, ROUNDED, SHORT, """o AS (SELECT series_id, MIN(as_of) AS a, MAX(as_of) AS b FROM sview GROUP BY 1),
n AS (SELECT series_id, MIN(as_of) AS c, MAX(as_of) AS d FROM short GROUP BY 1),
holes AS (SELECT s.series_id, s.as_of, row_number() OVER (PARTITION BY s.series_id ORDER BY s.as_of) AS rn FROM sview s JOIN n USING (series_id)
  WHERE s.as_of BETWEEN c AND d AND NOT EXISTS (SELECT 1 FROM short x WHERE x.series_id = s.series_id AND x.as_of = s.as_of))
SELECT series_id, c > a AS head_shorter, d < b AS tail_regressed, COALESCE(g, 0) AS interior_gaps, COALESCE(f, '') AS first_gaps
FROM o JOIN n USING (series_id) LEFT JOIN (
  SELECT series_id, COUNT(*) AS g, string_agg(CAST(as_of AS VARCHAR), ',' ORDER BY as_of) FILTER (rn <= 3) AS f FROM holes GROUP BY 1) USING (series_id)"""))
def b12(spark, sf):
    return rev.edge_warnings(stored_view(spark, sf), short_pull(spark, sf))


@query("u1_keyed_upsert", with_(*CHAIN, """
SELECT series_id, as_of, COALESCE(f.value, s.value) AS value FROM sview s FULL JOIN (SELECT * FROM fullview WHERE as_of >= DATE '2024-01-15') f USING (series_id, as_of)"""))
def u1(spark, sf):
    history = stored_view(spark, sf).select("series_id", "as_of", "value")
    readings = b5(spark, sf).filter(F.col("as_of") >= F.lit(dt.date(2024, 1, 15)))
    return bt.upsert(history, readings)
