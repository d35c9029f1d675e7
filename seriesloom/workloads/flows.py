"""End-to-end runs over the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.plans import runs, signals
from seriesloom.workloads import ORACLES, history, instruments, positioning, prices, quality, query, series, with_
from seriesloom.workloads.sqltext import MONTHLY, ORDER_VALUE

PRICE_FIELDS = ["value", "open", "high", "low", "close", "value_tr", "volume", "split_factor", "dividend"]
DIFFERS = " OR ".join(f"abs(b.{c} - s.{c}) > 1e-6" for c in PRICE_FIELDS)


@query("run_daily_prices", with_(*prices.CHAIN, prices.OLD_BARS, prices.REGISTRY, instruments.LIVE, instruments.STAMPED, f"""
allowed AS (SELECT b.* FROM bars b LEFT JOIN stampcat c USING (series_id)
  WHERE NOT COALESCE(c.family = 'stock' AND c.stable_id IS NULL, false) AND series_id NOT IN (
    SELECT series_id FROM registry JOIN live USING (symbol) WHERE quote_basis IS NOT NULL AND live_currency IS NOT NULL
      AND {instruments.CANON.format('live_currency')} <> {instruments.CANON.format('quote_basis')})),
{prices.HEAL}, {prices.HEALED},
healing AS (SELECT DISTINCT series_id FROM allowed JOIN registry USING (series_id)
  WHERE abs(split_factor - 1.0) > 1e-9 AND family = 'stock' AND series_id IN (SELECT series_id FROM pulled)),
batch AS (
  SELECT series_id, as_of, {', '.join(PRICE_FIELDS)}, provisional, false AS healed FROM allowed WHERE series_id NOT IN (SELECT series_id FROM healing)
  UNION ALL SELECT series_id, as_of, {', '.join(PRICE_FIELDS)}, as_of = MAX(as_of) OVER (PARTITION BY series_id), true FROM healed
  WHERE series_id IN (SELECT series_id FROM healing)),
ends AS (SELECT series_id, MAX(as_of) AS tip FROM stored GROUP BY 1),
acts AS (SELECT b.series_id, healed, CASE WHEN s.series_id IS NULL THEN 'append'
    WHEN s.provisional THEN CASE WHEN NOT ({DIFFERS}) AND b.provisional AND b.as_of >= tip THEN 'skip' ELSE 'revise' END
    WHEN {DIFFERS} THEN 'restate' ELSE 'skip' END AS action
  FROM batch b LEFT JOIN ends USING (series_id) LEFT JOIN stored s ON s.series_id = b.series_id AND s.as_of = b.as_of)
SELECT series_id, true AS ok, COUNT(*) FILTER (action = 'append') AS appended, COUNT(*) FILTER (action = 'restate') AS restated,
  COUNT(*) FILTER (action = 'revise') AS revised, COUNT(*) FILTER (action = 'skip') AS skipped, bool_or(healed) AS healed,
  CAST(0 AS BIGINT) AS unhealed FROM acts GROUP BY 1"""))
def daily_prices(spark, sf):
    """One run from landed rows to an append plan; every split series is healed from its re-pull."""
    log = prices.stored_before_split(spark, sf).withColumn("recorded_on", F.lit(prices.SPLIT_DAY))
    run = runs.daily_price_run(
        adapters.landed_bars(spark, sf, gathered=True), log, adapters.registry(spark, sf), instruments.stamp_catalog(spark, sf),
        instruments.live_currency(spark, sf), dt.date(2001, 11, 10), repull=prices.repull(spark, sf))
    healed = run.split.join(run.unhealed, "series_id", "left_anti").withColumn("healed", F.lit(True))
    unhealed = run.unhealed.agg(F.count(F.lit(1)).alias("unhealed"))
    return run.summary.join(healed, "series_id", "left").select(
        "series_id", "ok", "appended", "restated", "revised", "skipped", F.coalesce("healed", F.lit(False)).alias("healed"),
        unhealed.scalar().alias("unhealed"))


@query("run_base_first_read", with_(*prices.TR_CHAIN, prices.ADJUSTED, prices.REGISTRY, """
held AS (SELECT a.* FROM adjusted a JOIN registry USING (series_id) WHERE balance >= 0 AND as_of BETWEEN DATE '2000-03-15' AND DATE '2001-03-15'),
mine AS (SELECT symbol, quote_basis, close, volume, 'base' AS provenance FROM held JOIN registry USING (series_id)),
theirs AS (SELECT symbol, quote_basis, close, volume, 'fetch' AS provenance FROM bars JOIN registry USING (series_id)
  WHERE category <> 'nation_7' AND as_of BETWEEN DATE '2000-03-15' AND DATE '2001-03-15' AND symbol NOT IN (SELECT symbol FROM mine))
SELECT symbol, provenance, COUNT(*) AS n_rows, CAST(SUM(volume) AS BIGINT) AS volume,
  round(SUM(close / CASE WHEN upper(quote_basis) = 'GBX' THEN 100 ELSE 1 END), 2) AS close_sum
FROM (SELECT * FROM mine UNION ALL SELECT * FROM theirs) GROUP BY 1, 2"""))
def base_first(spark, sf):
    solvent = adapters.registry(spark, sf).select("series_id", (F.col("balance") >= 0).alias("solvent"))
    log = prices.recorded_bars(spark, sf).join(solvent, "series_id").withColumns(
        {c: F.when(F.col("solvent"), F.col(c)) for c in ("close", "value")}).drop("solvent")  # debtors have no price
    bars = runs.base_first_read(
        log, instruments.wanted_symbols(spark, sf), adapters.registry(spark, sf), instruments.fallback_bars(spark, sf),
        "1y", prices.WINDOW_END, pinned=prices.PINNED, fresh_days=400, tolerance=0.2)
    return bars.groupBy("symbol", "provenance").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("volume").alias("volume"), F.round(F.sum("close"), 2).alias("close_sum"))


@query("run_macro", with_(ORDER_VALUE, MONTHLY, series.MONTHLY6, f"""
base AS (SELECT series_id, as_of, value * CAST(1.0000173 AS DOUBLE) AS value FROM monthly6 WHERE as_of BETWEEN DATE '1995-06-30' AND DATE '2000-12-31' AND day(as_of) <> 30),
walked AS (SELECT series_id, as_of, value, filled, provisional FROM ({ORACLES['w18_carry_forward'].replace('2001-05-31', '2001-07-31')}))
SELECT w.series_id, w.as_of, CASE WHEN abs(round(w.value, 4) - b.value) <= GREATEST(1e-4, abs(b.value) * 1e-4) THEN round(b.value, 4) ELSE round(w.value, 4) END AS value,
  filled, provisional FROM walked w LEFT JOIN base b USING (series_id, as_of) WHERE w.as_of >= DATE '1995-07-31'"""))
def macro(spark, sf):
    monthly = series.monthly(spark, sf)
    gappy = series.with_gaps(monthly)
    known = F.col("as_of").between(F.lit(dt.date(1995, 6, 30)), F.lit(dt.date(2000, 12, 31))) & (F.dayofmonth("as_of") != 30)
    stored = monthly.withColumn("value", F.when(known, F.col("value") * 1.0000173))
    anchor = F.col("series_id") == "3-MEDIUM"
    feeds = [gappy, gappy.withColumn("value", F.when(anchor, F.col("value")))]
    return runs.macro_run(feeds, stored, gappy.select(F.when(anchor, F.col("series_id")).alias("series_id"))).ready


@query("run_macro_nowcast", with_(ORDER_VALUE, MONTHLY, series.MONTHLY6, f"""
walked AS (SELECT series_id, as_of, value, CAST(NULL AS VARCHAR) AS filled, false AS provisional FROM monthly6
  WHERE as_of <= DATE '2001-01-31' OR series_id = '3-MEDIUM'
  UNION ALL SELECT series_id, as_of, value, filled, provisional FROM ({ORACLES['w19_chained_nowcast']}) WHERE series_id <> '3-MEDIUM')
SELECT w.series_id, w.as_of, CASE WHEN abs(round(w.value, 4) - s.value) <= GREATEST(1e-4, abs(s.value) * 1e-4) THEN round(s.value, 4) ELSE round(w.value, 4) END AS value,
  filled, provisional FROM walked w JOIN monthly6 s USING (series_id, as_of)"""))
def macro_nowcast(spark, sf):
    """Series that stop early are extended by the nowcast inside the run."""
    monthly = series.monthly(spark, sf)
    anchor = F.col("series_id") == "3-MEDIUM"
    real = monthly.withColumn("value", F.when(anchor | (F.col("as_of") <= F.lit(dt.date(2001, 1, 31))), F.col("value")))
    rates = series.windows.nowcast(monthly)
    return runs.macro_run([real], monthly, monthly.select(F.when(anchor, F.col("series_id")).alias("series_id")), rates=rates).ready


SIGNAL_RULES = signals.Rules(
    spread={"bull_at": 60000, "bear_at": 600000}, percentile={"bull_below": 60, "bull_rows": 2, "bear_above": 40, "bear_rows": 2},
    change={"bull_at": 0, "bear_at": 200000, "rows": 2}, jump={"flat_band": 25},
    falsifier={"dead_below": 200000, "dead_rows": 3, "confirm_above": 250000, "confirm_rows": 1}, flow_unit=1000000)


@query("run_signals", f"""
SELECT v.*, d.stock_dial, d.flow_dial, DATE '2001-08-10' - (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) <= 11 AS fresh
FROM ({ORACLES['g6_composite_vote']}) v JOIN ({ORACLES['g7_dials']}) d USING (series_id)
UNION ALL SELECT 'no_feed', 'WAIT', 0, 0, 0, 5, false, 0.25, 0.5, DATE '2001-08-10' - (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) <= 11""")
def signal_run(spark, sf):
    """From feeds to verdict in one run; one expected series has no feed."""
    daily = adapters.order_value(spark, sf)
    expected = daily.select("series_id").union(daily.limit(1).select(F.lit("no_feed")))
    run = signals.signal_run(daily, expected, SIGNAL_RULES, dt.date(2001, 8, 10))
    return run.verdict.join(run.dials, "series_id").select("*", run.freshness.select("fresh").scalar().alias("fresh"))


@query("run_macro_absent", "SELECT DISTINCT o_orderpriority AS series_id FROM orders WHERE o_orderpriority = '5-LOW'")
def macro_absent(spark, sf):
    """A series no feed delivered is named, and the others go on."""
    monthly = series.monthly(spark, sf)
    delivered = monthly.withColumn("value", F.when(F.col("series_id") != "5-LOW", F.col("value")))
    return runs.macro_run([delivered], monthly, monthly.select(F.when(F.col("series_id") == "3-MEDIUM", F.col("series_id")).alias("series_id"))).absent


MARKET_ROWS = """coded AS (SELECT *, substr(market, 7) AS contract_code FROM landed),
assigned AS (
  SELECT * REPLACE ('brand_3' AS market) FROM coded WHERE contains(contract_name, 'BRAND#3 ')
  UNION ALL SELECT * REPLACE ('brand_1x' AS market) FROM coded
    WHERE contains(contract_name, 'BRAND#1') AND contains(contract_name, 'PROMO') AND NOT contains(contract_name, 'STANDARD')
  UNION ALL SELECT * REPLACE ('brand_2x' AS market) FROM coded WHERE contains(contract_name, 'BRAND#2')
  UNION ALL SELECT * REPLACE ('pinned_7' AS market) FROM coded WHERE contract_code = '7'
  UNION ALL SELECT * REPLACE ('pinned_9' AS market) FROM coded WHERE contract_code = '9')"""


@query("run_positioning_markets", with_(
    positioning.LANDED, MARKET_ROWS, positioning.NO_SMALL.replace("landed", "assigned"), positioning.TOP,
    f"""positions AS (SELECT {positioning.FINANCIAL_COLUMNS} FROM top WHERE market <> 'pinned_9'
  UNION ALL SELECT {positioning.COMMODITY_COLUMNS} FROM top WHERE market = 'pinned_9')""", positioning.STORED, """
SELECT series_id, COUNT(primary_net) AS n_obs, COUNT(DISTINCT market_name) AS n_names,
       COUNT(DISTINCT market_name) = 1 OR series_id LIKE '%pinned%' AS accepted, round(SUM(value), 2) AS total
FROM stored GROUP BY 1"""))
def positioning_markets(spark, sf):
    """Both report families in one run; name-found markets that mix contracts are refused."""
    reports = positioning.landed(spark, sf).withColumn("contract_code", F.substring("market", 7, 10)).drop("market")
    written, report, _ = runs.configured_positioning_run(reports, positioning.MARKETS, dt.date(2001, 11, 10))
    chosen = positioning.pos.pin_configured_names(positioning.pos.assign_markets(reports, positioning.MARKETS), positioning.MARKETS)
    totals = None
    for family in (positioning.pos.FINANCIAL, positioning.pos.COMMODITY):
        keys = [m.key for m in positioning.MARKETS if m.family == family]
        part = positioning.pos.stored_rows(positioning.pos.normalized(chosen.filter(F.col("market").isin(keys)), family))
        totals = part if totals is None else totals.unionByName(part)
    sums = totals.groupBy("series_id").agg(F.round(F.sum("value"), 2).alias("total"))
    return report.join(sums, "series_id").select("series_id", "n_obs", "n_names", "accepted", "total")


@query("run_positioning", f"""SELECT g.series_id, g.n_obs, i.n_names, i.accepted FROM ({ORACLES['g8_quality_flags']}) g
JOIN ({ORACLES['i12_identity_guard'].replace('% 2 = 0 AS declared', '% 2 = 0 OR true AS declared')}) i USING (series_id)""")
def weekly_positioning(spark, sf):
    landed = positioning.landed(spark, sf)
    markets = positioning.stored(spark, sf).select("series_id").distinct().withColumns({
        "declared": F.lit(True), "pinned": F.lit(True), "declared_break": F.lit(False), "satellite": F.lit(None).cast("string")})
    _, report, _ = runs.positioning_run(landed, markets, dt.date(2001, 11, 10))
    return report.select("series_id", "n_obs", "n_names", "accepted")


GATE_FIELDS = ["open", "high", "low", "close", "volume"]
ON_HELD = [part.replace("FROM bars", "FROM pbars") for part in (quality.SESSION, quality.STALE)]


@query("run_gates", with_(*quality.PCHAIN, quality.BASELINES, *ON_HELD, *quality.VCHAIN, history.LOG, quality.LINES, f"""
gates AS (
  SELECT 'depth' AS gate, true AS hard, (SELECT COUNT(*) FROM baselines JOIN profile USING (series_id)
    WHERE first_day IS NULL OR first_day > reach_back_to OR n_rows < min_rows) AS n
  UNION ALL SELECT 'coverage', true, (SELECT COUNT(*) FROM profile JOIN registry USING (series_id) WHERE NOT live AND NOT retired AND balance >= -500)
  UNION ALL SELECT 'recency', true, (SELECT COUNT(*) FROM stale WHERE tier = 'fail')
  UNION ALL SELECT 'density', true, (SELECT COUNT(*) FROM sparse WHERE tier = 'fail')
  UNION ALL SELECT 'split_soundness', true, (SELECT COUNT(*) FROM (SELECT series_id FROM pbars GROUP BY 1
    HAVING MAX(abs(split_factor - 1)) > 1e-9 AND NOT (MIN(close * split_factor) > 0 AND MIN(split_factor) > 0
      AND abs(arg_max(split_factor, as_of) - 1.0) <= 1e-9 AND COUNT(DISTINCT round(split_factor, 6)) <= 20)))
  UNION ALL SELECT 'seed_conflict', true, (SELECT COUNT(*) FROM plines WHERE n_lines > 1)
  UNION ALL SELECT 'vintage_conflict', true, (SELECT COUNT(*) FROM plines WHERE n_lines <> n_vintages)
  UNION ALL SELECT 'provisional_tip', true, 0
  UNION ALL SELECT 'record_shape', true, (SELECT COUNT(DISTINCT series_id) FROM pbars WHERE {' OR '.join(f'{c} IS NULL' for c in GATE_FIELDS)})
  UNION ALL SELECT 'thin', false, (SELECT COUNT(*) FROM profile WHERE live AND n_rows < 5))
SELECT gate, hard, n = 0 AS passed, n AS n_violations FROM gates"""))
def gates(spark, sf):
    found, _ = runs.verification_run(
        quality.held_bars(spark, sf), adapters.reading_log(spark, sf), adapters.registry(spark, sf),
        quality.baselines(spark, sf), quality.quarantine(spark, sf), quality.exemptions(spark, sf), GATE_FIELDS,
        quality.TODAY, quality.venue(spark, sf))
    return found.select("gate", "hard", "passed", "n_violations")
