"""Quality gates and signal states."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.operators import corporate
from seriesloom.operators import quality as dq
from seriesloom.operators import resample, signals, windows
from seriesloom.session import cut_lineage
from seriesloom.workloads import ORACLES, history, prices, query, series, with_
from seriesloom.workloads.sqltext import ORDER_VALUE, WEEKLY

TODAY = dt.date(2001, 11, 10)

VENUE = """venue AS (
  SELECT 'vx_' || lower(l_returnflag) || (l_linenumber % 2) || '_' || lower(l_linestatus) AS series_id,
         upper(lower(l_returnflag) || (l_linenumber % 2)) || '.' || l_linestatus AS symbol, l_linestatus AS venue,
         CAST(l_shipdate AS DATE) AS as_of, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS close
  FROM lineitem GROUP BY 1, 2, 3, 4)"""
CALENDAR = """members AS (SELECT venue, COUNT(DISTINCT series_id) AS members FROM venue GROUP BY 1),
calendar AS (SELECT venue, as_of, present, members FROM (
  SELECT venue, as_of, present, members, row_number() OVER (PARTITION BY venue ORDER BY as_of DESC) AS rn
  FROM (SELECT venue, as_of, COUNT(*) AS present FROM venue GROUP BY 1, 2) JOIN members USING (venue)
  WHERE members >= 5 AND present >= CAST(0.6 AS DOUBLE) * members) WHERE rn <= 30)"""
HOLES = """bounds AS (SELECT series_id, venue, MIN(as_of) AS lo, MAX(as_of) AS hi FROM venue GROUP BY 1, 2),
holes AS (SELECT b.series_id, b.venue, c.as_of FROM bounds b JOIN calendar c USING (venue)
  WHERE c.as_of BETWEEN lo AND hi AND NOT EXISTS (SELECT 1 FROM venue v WHERE v.series_id = b.series_id AND v.as_of = c.as_of))"""
EXEMPT = """exemptions AS (
  SELECT DISTINCT series_id, CASE WHEN symbol LIKE 'A%' THEN DATE '2001-12-31' ELSE DATE '2001-06-30' END AS review_by
  FROM venue WHERE symbol NOT LIKE 'R%')"""


def venue(spark, sf):
    return adapters.venue_bars(spark, sf)


def exemptions(spark, sf):
    late = F.when(F.col("symbol").startswith("A"), F.lit(dt.date(2001, 12, 31))).otherwise(F.lit(dt.date(2001, 6, 30)))
    return (venue(spark, sf).filter(~F.col("symbol").startswith("R"))
            .select("series_id", F.lit("venue outage").alias("reason"), late.alias("review_by")).distinct())


@query("a10_venue_calendar", with_(VENUE, CALENDAR, "SELECT * FROM calendar"))
def a10(spark, sf):
    return dq.venue_calendar(venue(spark, sf))


@query("j11_missing_sessions", with_(VENUE, CALENDAR, HOLES, "SELECT * FROM holes"))
def j11(spark, sf):
    rows = venue(spark, sf)
    return dq.missing_sessions(rows, dq.venue_calendar(rows))


SESSION = """latest AS (SELECT series_id, MAX(as_of) AS latest FROM bars GROUP BY 1),
session AS (SELECT latest AS session, COUNT(*) AS n_series FROM latest GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1)"""


@query("a11_universe_session", with_(*prices.CHAIN, SESSION, "SELECT * FROM session"))
def a11(spark, sf):
    return dq.universe_session(prices.bars(spark, sf))


PROFILE = """profile AS (
  SELECT r.series_id, MIN(as_of) AS first_day, MAX(as_of) AS last_day, COUNT(as_of) AS n_rows, COUNT(as_of) > 0 AS live
  FROM registry r LEFT JOIN pbars b USING (series_id) GROUP BY 1)"""
FBARS = """fbars AS (
  SELECT b.* REPLACE (CASE WHEN priced THEN close END AS close, CASE WHEN priced THEN value END AS value)
  FROM (SELECT b.*, balance >= 0 AND (category <> 'nation_5' OR as_of > DATE '2001-10-25') AS priced FROM bars b JOIN registry USING (series_id)) b)"""
PBARS = FBARS.replace("SELECT b.* REPLACE", "SELECT b.* EXCLUDE (priced) REPLACE") + """,
pbars AS (SELECT * FROM fbars WHERE COALESCE(close, value) > 0)"""


def flawed_bars(spark, sf):
    """All bars; those of suppliers in debt, and the early ones of one nation, have no price."""
    state = adapters.registry(spark, sf).select("series_id", "category", "balance")
    priced = (F.col("balance") >= 0) & ((F.col("category") != "nation_5") | (F.col("as_of") > F.lit(dt.date(2001, 10, 25))))
    return (prices.bars(spark, sf).join(state, "series_id")
            .withColumns({c: F.when(priced, F.col(c)) for c in ("close", "value")}).drop("category", "balance"))


def held_bars(spark, sf):
    """What of the bars is an archive's view: those with a price."""
    return corporate.positive_close(flawed_bars(spark, sf))


def profile(spark, sf):
    return dq.series_profile(adapters.registry(spark, sf), held_bars(spark, sf))


PCHAIN = [*prices.CHAIN, prices.REGISTRY, PBARS, PROFILE]


@query("a12_series_profile", with_(*PCHAIN, "SELECT * FROM profile"))
def a12(spark, sf):
    return profile(spark, sf)


LINES = "plines AS (SELECT series_id, as_of, COUNT(*) AS n_lines, COUNT(DISTINCT recorded_on) AS n_vintages FROM log GROUP BY 1, 2)"


@query("a13_lines_per_day", with_(history.LOG, LINES, "SELECT * FROM plines"))
def a13(spark, sf):
    return dq.lines_per_day(adapters.reading_log(spark, sf))


@query("a13_view_against_log", with_(history.LOG, LINES, "SELECT series_id, COUNT(*) AS view_rows, CAST(SUM(n_lines) AS BIGINT) AS raw_lines FROM plines GROUP BY 1"))
def a13_view(spark, sf):
    return dq.view_against_log(adapters.reading_log(spark, sf))


BASELINES = """baselines AS (SELECT series_id, CASE WHEN number % 3 = 0 THEN DATE '1995-01-20' ELSE DATE '1995-03-01' END AS reach_back_to,
  CASE WHEN number % 2 = 0 THEN 540 ELSE 400 END AS min_rows FROM registry)"""


def baselines(spark, sf):
    return adapters.registry(spark, sf).select(
        "series_id", F.when(F.col("number") % 3 == 0, F.lit(dt.date(1995, 1, 20))).otherwise(F.lit(dt.date(1995, 3, 1))).alias("reach_back_to"),
        F.when(F.col("number") % 2 == 0, 540).otherwise(400).alias("min_rows"))


@query("d1_depth", with_(*PCHAIN, BASELINES, """
SELECT series_id, first_day, n_rows FROM baselines JOIN profile USING (series_id)
WHERE first_day IS NULL OR first_day > reach_back_to OR n_rows < min_rows"""))
def d1(spark, sf):
    return dq.depth_violations(held_bars(spark, sf), baselines(spark, sf))


def quarantine(spark, sf):
    return adapters.registry(spark, sf).filter("balance < -500").select("series_id")


@query("d2_coverage", with_(*PCHAIN, """
SELECT series_id, balance < -500 AS quarantined FROM profile JOIN registry USING (series_id) WHERE NOT live AND NOT retired"""))
def d2(spark, sf):
    return dq.coverage_report(profile(spark, sf), adapters.registry(spark, sf), quarantine(spark, sf))


STALE = """stale AS (
  SELECT series_id, latest, session - latest AS days,
    CASE WHEN session - latest <= 10 THEN 'warn' ELSE 'fail' END AS tier
  FROM latest, session WHERE latest < session AND session - latest > 4)"""


@query("d3_recency", with_(*prices.CHAIN, SESSION, STALE, "SELECT * FROM stale"))
def d3(spark, sf):
    return dq.stale_series(prices.bars(spark, sf), exemptions(spark, sf), TODAY)


SPARSE = """sparse AS (
  SELECT series_id, missing, dates, CASE WHEN missing <= 4 THEN 'warn' WHEN exempted THEN 'exempt' ELSE 'fail' END AS tier FROM (
    SELECT series_id, COUNT(*) AS missing, string_agg(CAST(as_of AS VARCHAR), ',' ORDER BY as_of) FILTER (rn <= 12) AS dates,
           series_id IN (SELECT series_id FROM exemptions WHERE review_by >= DATE '2001-11-10') AS exempted
    FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of) AS rn FROM holes) GROUP BY 1) WHERE missing > 1)"""
VCHAIN = [VENUE, CALENDAR, HOLES, EXEMPT, SPARSE]


def sparse(spark, sf):
    return dq.sparse_series(venue(spark, sf), exemptions(spark, sf), TODAY)


@query("d4_density", with_(*VCHAIN, "SELECT * FROM sparse"))
def d4(spark, sf):
    return sparse(spark, sf)


@query("t2_ranked_sparse", with_(*VCHAIN, "SELECT series_id, missing FROM sparse ORDER BY missing DESC, series_id"))
def t2(spark, sf):
    return sparse(spark, sf).select("series_id", "missing")


@query("t2_ranked_depth", with_(*PCHAIN, "SELECT * FROM profile ORDER BY first_day, last_day, n_rows, series_id"))
def t2_depth(spark, sf):
    return dq.ranked_depth(profile(spark, sf))


VSTALE = """vlatest AS (SELECT series_id, MAX(as_of) AS latest FROM venue GROUP BY 1),
vsession AS (SELECT latest AS session, COUNT(*) AS n FROM vlatest GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1),
vstale AS (SELECT series_id, session - latest AS days, CASE WHEN session - latest <= 10 THEN 'warn'
    WHEN series_id IN (SELECT series_id FROM exemptions WHERE review_by >= DATE '2001-11-10') THEN 'exempt' ELSE 'fail' END AS tier
  FROM vlatest, vsession WHERE latest < session AND session - latest > 4),
report AS (
  SELECT 'stale' AS section, series_id, days AS amount, tier FROM vstale
  UNION ALL SELECT 'sparse', series_id, missing, tier FROM sparse
  UNION ALL SELECT 'expired_exempt', series_id, NULL, 'fail' FROM exemptions WHERE review_by < DATE '2001-11-10'
  UNION ALL SELECT 'exempt', series_id, NULL, 'exempt' FROM exemptions WHERE review_by >= DATE '2001-11-10'
    AND series_id IN (SELECT series_id FROM vstale UNION ALL SELECT series_id FROM sparse))"""


@query("d5_expiring_exemptions", with_(*VCHAIN, VSTALE, "SELECT * FROM report UNION ALL SELECT 'verdict', NULL, NULL, CASE WHEN bool_or(tier = 'fail') THEN 'fail' ELSE 'pass' END FROM report"))
def d5(spark, sf):
    stale = dq.stale_series(venue(spark, sf), exemptions(spark, sf), TODAY)
    return dq.freshness_report(stale, sparse(spark, sf), exemptions(spark, sf), TODAY)


@query("d6_split_soundness", with_(*prices.CHAIN, """
SELECT series_id, COUNT(DISTINCT round(split_factor, 6)) AS levels, MIN(close * split_factor) > 0 AS traded_positive, MIN(split_factor) > 0 AS factor_positive,
  abs(arg_max(split_factor, as_of) - 1.0) <= 1e-9 AS anchored, COUNT(DISTINCT round(split_factor, 6)) <= 20 AS piecewise,
  MAX(split_factor) > 1.0 + 1e-9 AS has_forward, MIN(split_factor) < 1.0 - 1e-9 AS has_reverse
FROM bars GROUP BY 1 HAVING MAX(abs(split_factor - 1)) > 1e-9"""))
def d6(spark, sf):
    return dq.split_soundness(prices.bars(spark, sf))


@query("d7_seed_conflict", with_(history.LOG, LINES, "SELECT series_id, as_of, n_lines FROM plines WHERE n_lines > 1"))
def d7(spark, sf):
    return dq.seed_conflicts(adapters.reading_log(spark, sf))


def unfolded_log(spark, sf):
    """Every event as its own line, so that lines of one day can share a vintage."""
    day = F.col("ts").cast("date")
    return adapters.table(spark, sf, "events").select(
        adapters.keyed("ev_", "user_id").alias("series_id"), day.alias("as_of"),
        F.date_add(day, (F.col("event_id") % 3).cast("int")).alias("recorded_on"), "value")


@query("d8_vintage_conflict", """
SELECT 'ev_' || user_id AS series_id, CAST(ts AS DATE) AS as_of, COUNT(*) AS n_lines, COUNT(DISTINCT event_id % 3) AS n_vintages
FROM events GROUP BY 1, 2 HAVING COUNT(*) <> COUNT(DISTINCT event_id % 3)""")
def d8(spark, sf):
    return dq.vintage_conflicts(unfolded_log(spark, sf))


@query("d8_provisional_tip", with_(history.LOG, history.FULL_VIEW, """marked AS (
  SELECT *, day(as_of) IN (11, 28) AS provisional FROM fullview)
SELECT * FROM (SELECT series_id, COUNT(*) FILTER (provisional) AS n_provisional, MAX(as_of) FILTER (provisional) AS provisional_day, MAX(as_of) AS tip
  FROM marked GROUP BY 1) WHERE n_provisional > 1 OR provisional_day <> tip"""))
def d8_tip(spark, sf):
    view = history.b5(spark, sf).withColumn("provisional", F.dayofmonth("as_of").isin(11, 28))
    return dq.provisional_violations(view)


SHAPE = ["as_of", "open", "high", "low", "close", "adj_close", "volume", "dividend"]


@query("d9_record_shape", with_(prices.LANDED, prices.DAYS, "c AS (SELECT series_id, " + ", ".join(
    f"COUNT(*) FILTER ({c} IS NULL) AS {c}" for c in SHAPE) + " FROM days GROUP BY 1) SELECT *, " + " + ".join(SHAPE)
    + " AS missing_values FROM c WHERE " + " + ".join(SHAPE) + " > 0"))
def d9(spark, sf):
    from seriesloom.operators import corporate
    return dq.shape_violations(corporate.collapse_days(adapters.landed_bars(spark, sf, gathered=True)), SHAPE)


@query("d10_thin_series", with_(*PCHAIN, "SELECT series_id, n_rows FROM profile WHERE live AND n_rows < 5"))
def d10(spark, sf):
    return dq.thin_series(profile(spark, sf))


@query("d11_batch_freshness", with_(ORDER_VALUE, WEEKLY, """
SELECT MAX(as_of) AS frontier, DATE '2001-08-10' - MAX(as_of) AS age_days, DATE '2001-08-10' - MAX(as_of) <= 11 AS fresh FROM weekly"""))
def d11(spark, sf):
    return dq.batch_freshness(series.weekly(spark, sf), dt.date(2001, 8, 10))


@query("d12_gate_tally", with_(*PCHAIN, BASELINES, """gates AS (
  SELECT true AS hard, (SELECT COUNT(*) FROM baselines JOIN profile USING (series_id) WHERE first_day IS NULL OR first_day > reach_back_to OR n_rows < min_rows) AS n
  UNION ALL SELECT true, (SELECT COUNT(*) FROM profile JOIN registry USING (series_id) WHERE NOT live AND NOT retired AND balance >= -500)
  UNION ALL SELECT false, (SELECT COUNT(*) FROM profile WHERE live AND n_rows < 5)
  UNION ALL SELECT true, (SELECT COUNT(*) FROM (SELECT series_id, as_of FROM pbars GROUP BY 1, 2 HAVING COUNT(*) > 1))
  UNION ALL SELECT true, 0)
SELECT COUNT(*) AS total, COUNT(*) FILTER (n = 0) AS passes, COUNT(*) FILTER (n > 0 AND hard) AS hard_fails,
  COUNT(*) FILTER (n > 0 AND NOT hard) AS warnings, bool_and(n = 0 OR NOT hard) AS verdict FROM gates"""))
def d12(spark, sf):
    registry, held = adapters.registry(spark, sf), held_bars(spark, sf)
    log = held.withColumn("recorded_on", F.date_add("as_of", 1))
    summary = dq.series_profile(registry, held)
    gates = [
        dq.gate("depth", dq.depth_violations(held, baselines(spark, sf))),
        dq.gate("coverage", dq.coverage_report(summary, registry, quarantine(spark, sf)).filter(~F.col("quarantined"))),
        dq.gate("thin", dq.thin_series(summary), hard=False),
        dq.gate("seed_conflict", dq.seed_conflicts(log)),
        dq.gate("provisional_tip", dq.provisional_violations(held)),
    ]
    return dq.tally(reduce(lambda a, b: a.unionByName(b), gates))


@query("d13_history_start", with_(ORDER_VALUE, """
SELECT series_id, MIN(as_of) AS first_day, DATE '1995-01-01' AS expected_start, MIN(as_of) = DATE '1995-01-01' AS ok FROM obs GROUP BY 1"""))
def d13(spark, sf):
    obs = adapters.order_value(spark, sf)
    starts = obs.select("series_id").distinct().withColumn("expected_start", F.lit(dt.date(1995, 1, 1)))
    return dq.history_start(obs, starts)


@query("d14_single_entity", """
SELECT p_type, COUNT(DISTINCT p_brand) AS n_entities, COUNT(DISTINCT p_brand) = 1 AS ok FROM part GROUP BY 1""")
def d14(spark, sf):
    return dq.single_entity(adapters.table(spark, sf, "part"), "p_type", "p_brand")


# --- signals --------------------------------------------------------------------------------

def states_sql(bull: str, bear: str) -> str:
    return f"CASE WHEN {bull} THEN 'BULL' WHEN {bear} THEN 'BEAR' ELSE 'NEUTRAL' END"


RN = """rn AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS rn FROM obs)"""
S1 = f"""s1 AS (SELECT series_id, arg_max(value, as_of) AS last_value,
  {states_sql('COUNT(*) >= 5 AND MIN(value) >= 60000', 'COUNT(*) >= 5 AND MAX(value) <= 600000')} AS state FROM rn WHERE rn <= 5 GROUP BY 1)"""
PCT = """nw AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of) AS r FROM weekly),
pctl AS (SELECT a.series_id, a.as_of, CASE WHEN COUNT(*) >= 8 AND MIN(b.value) <> MAX(b.value)
    THEN round(100.0 * CAST(COUNT(*) FILTER (b.value <= a.value) AS DOUBLE) / COUNT(*), 2) END AS value
  FROM nw a JOIN nw b ON a.series_id = b.series_id AND b.r BETWEEN a.r - 51 AND a.r GROUP BY 1, 2)"""
S2 = f"""s2 AS (SELECT series_id, {states_sql('COUNT(*) FILTER (r <= 2 AND value < 60) = 2', 'COUNT(*) FILTER (r <= 2 AND value > 40) = 2')} AS state
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS r FROM pctl WHERE value IS NOT NULL) GROUP BY 1)"""
S3 = f"""d4 AS (SELECT series_id, COUNT(value) AS n, AVG(value) AS mean FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS r FROM deviation) WHERE r <= 4 GROUP BY 1),
builds AS (SELECT series_id, COALESCE(MIN(r) FILTER (NOT COALESCE(value > 0, false)) - 1, COUNT(*)) AS builds FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS r FROM deviation) GROUP BY 1),
s3 AS (SELECT series_id, CASE WHEN n >= 4 THEN round(mean, 4) ELSE 0 END AS mean_deviation, builds,
  {states_sql('n >= 4 AND mean <= -3', 'builds >= 2')} AS state FROM d4 JOIN builds USING (series_id))"""
S5 = f"""tight AS (SELECT series_id, bool_or(state = 'BULL') AS others_tight FROM (
  SELECT series_id, state FROM s1 UNION ALL SELECT series_id, state FROM s3) GROUP BY 1),
s5 AS (SELECT series_id, {states_sql('COALESCE(pctile_2_back < 40 AND pctile_last - pctile_2_back >= 20, false)', 'COALESCE(others_tight AND abs(pctile_last - pctile_4_back) < 25, false)')} AS state
  FROM ranksum LEFT JOIN tight USING (series_id))"""
S6 = f"""chg AS (SELECT series_id, as_of, change, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS r FROM changes),
s6 AS (SELECT series_id, arg_max(change, as_of) AS last_value, {states_sql('COUNT(*) >= 2 AND MIN(change) >= 0', 'COUNT(*) >= 2 AND MAX(change) <= 200000')} AS state FROM chg WHERE r <= 2 GROUP BY 1)"""
FALS = """fals AS (SELECT series_id, below, above, below >= 3 AS dead, above >= 1 AS confirm FROM (
  SELECT series_id, COALESCE(MIN(rn) FILTER (NOT value < 200000) - 1, COUNT(*)) AS below,
         COALESCE(MIN(rn) FILTER (NOT value > 250000) - 1, COUNT(*)) AS above FROM rn GROUP BY 1))"""
SIGNALS = [ORDER_VALUE, WEEKLY, RN, S1, PCT, S2, series.CHANGES, series.DEVIATION, S3, series.RANKED, series.RANK_SUMMARY, S5, S6, FALS]


# The steps below take the daily values where a run has them already; it folds the raw rows once.

def daily_values(spark, sf, daily=None):
    return adapters.order_value(spark, sf) if daily is None else daily


def weekly_values(spark, sf, daily=None):
    return resample.weekly_last(daily_values(spark, sf, daily))


def g1_state(spark, sf, daily=None):
    return signals.threshold_state(daily_values(spark, sf, daily), bull_at=60000, bear_at=600000)


def g2_state(spark, sf, daily=None):
    percentiles = windows.trailing_percentile(weekly_values(spark, sf, daily), 52).select(
        "series_id", "as_of", F.col("percentile").alias("value"))
    return signals.consecutive_state(percentiles, bull_below=60, bull_rows=2, bear_above=40, bear_rows=2)


def g3_state(spark, sf, daily=None):
    return signals.seasonal_state(resample.seasonal_deviation(weekly_values(spark, sf, daily)))


def g6_spread(spark, sf, daily=None):
    changes = resample.weekly_change(weekly_values(spark, sf, daily)).withColumnRenamed("change", "value")
    return signals.threshold_state(changes, bull_at=0, bear_at=200000, rows=2)


def _voters(frames):
    named = [f.select("series_id", F.lit(voter).alias("voter"), "state") for voter, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def g4_state(spark, sf, daily=None):
    tight = signals.tightness(_voters({"S1": g1_state(spark, sf, daily), "S3": g3_state(spark, sf, daily)}), ["S1", "S3"])
    summary = windows.average_rank_summary(weekly_values(spark, sf, daily))
    return signals.percentile_state(summary, tight, flat_band=25)


def g5_falsifier(spark, sf, daily=None):
    return signals.price_falsifier(daily_values(spark, sf, daily), dead_below=200000, dead_rows=3,
                                   confirm_above=250000, confirm_rows=1)


@query("g1_threshold_state", with_(*SIGNALS, "SELECT * FROM s1"))
def g1(spark, sf):
    return g1_state(spark, sf)


@query("g1_spread_state", with_(*SIGNALS, "SELECT * FROM s6"))
def g1_second(spark, sf):
    return g6_spread(spark, sf)


@query("g2_consecutive_state", with_(*SIGNALS, "SELECT * FROM s2"))
def g2(spark, sf):
    return g2_state(spark, sf)


@query("g3_seasonal_state", with_(*SIGNALS, "SELECT * FROM s3"))
def g3(spark, sf):
    return g3_state(spark, sf)


@query("g4_percentile_jump_state", with_(*SIGNALS, "SELECT * FROM s5"))
def g4(spark, sf):
    return g4_state(spark, sf)


@query("g5_price_falsifier", with_(*SIGNALS, "SELECT * FROM fals"))
def g5(spark, sf):
    return g5_falsifier(spark, sf)


@query("g6_composite_vote", with_(*SIGNALS, """votes AS (
  SELECT series_id, 'S1' AS voter, state FROM s1 UNION ALL SELECT series_id, 'S2', state FROM s2 UNION ALL SELECT series_id, 'S3', state FROM s3
  UNION ALL SELECT series_id, 'S5', state FROM s5 UNION ALL SELECT series_id, 'S6', state FROM s6),
c AS (SELECT series_id, COUNT(*) FILTER (voter <> 'S5' AND state = 'BULL') AS bulls, COUNT(*) FILTER (voter <> 'S5' AND state = 'BEAR') AS bears,
  COUNT(*) FILTER (state <> 'NODATA') AS active, COUNT(*) FILTER (state = 'NODATA') AS nodata,
  bool_or(state = 'BULL' AND voter IN ('S1', 'S2')) AS lead FROM votes GROUP BY 1),
v AS (SELECT c.*, confirm, CASE WHEN dead THEN 'DEAD' WHEN bulls >= 3 AND lead THEN 'PROVEN' WHEN bears >= 3 THEN 'DEAD' ELSE 'WAIT' END AS verdict
      FROM c LEFT JOIN fals USING (series_id))
SELECT series_id, verdict, bulls, bears, active, nodata, confirm AND verdict = 'WAIT' AS price_confirms FROM v"""))
def g6(spark, sf):
    return composite_run(spark, sf)


def composite_run(spark, sf, missing=None):
    """The raw rows are folded to days once and written; the voters read that small table."""
    daily = cut_lineage(adapters.order_value(spark, sf))
    states = {"S1": g1_state(spark, sf, daily), "S2": g2_state(spark, sf, daily), "S3": g3_state(spark, sf, daily),
              "S5": g4_state(spark, sf, daily), "S6": g6_spread(spark, sf, daily)}
    if missing is not None:
        voter, absent = missing
        states[voter] = signals.with_no_data(daily.select("series_id").distinct(), states[voter].filter(~absent))
    return signals.composite(_voters(states), g5_falsifier(spark, sf, daily))


@query("g6_missing_feed", ORACLES["g6_composite_vote"].replace(
    "SELECT series_id, 'S3', state FROM s3", "SELECT series_id, 'S3', CASE WHEN series_id = '5-LOW' THEN 'NODATA' ELSE state END FROM s3"))
def g6_missing(spark, sf):
    """One feed did not arrive: its voter reads NODATA and is counted as such."""
    return composite_run(spark, sf, missing=("S3", F.col("series_id") == "5-LOW"))


@query("g7_dials", with_(ORDER_VALUE, WEEKLY, series.CHANGES, series.DEVIATION, """d4 AS (
  SELECT series_id, AVG(value) AS mean4 FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS r FROM deviation) WHERE r <= 4 GROUP BY 1),
f7 AS (SELECT series_id, round(AVG(value), 1) AS pct7 FROM (
    SELECT series_id, round(value / 1000000 * 100, 1) AS value, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS r FROM obs) WHERE r <= 7 GROUP BY 1)
SELECT series_id, round(GREATEST(0, LEAST(1, (2.0 - COALESCE(mean4, 0)) / 8.0)), 6) AS stock_dial,
       round(GREATEST(0, LEAST(1, COALESCE(1.0 - pct7 / 100.0, 0.5))), 6) AS flow_dial
FROM (SELECT DISTINCT series_id FROM obs) LEFT JOIN d4 USING (series_id) LEFT JOIN f7 USING (series_id)"""))
def g7(spark, sf):
    obs = adapters.order_value(spark, sf)
    percent = obs.withColumn("value", F.round(F.col("value") / 1000000 * 100, 1))
    return signals.dials(obs.select("series_id").distinct(), series.a9(spark, sf), percent)
