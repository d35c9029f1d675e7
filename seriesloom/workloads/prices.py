"""Daily bar queries over line items, one series per supplier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.operators import corporate
from seriesloom.workloads import query, with_

LANDED = """lb AS (
  SELECT 'eq_' || l_suppkey AS series_id, CAST(l_shipdate AS DATE) AS as_of,
    CAST(l_orderkey * 8 + l_linenumber AS HUGEINT) * 1000000000000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS arrival,
    CASE WHEN l_tax < CAST(0.08 AS DOUBLE) THEN l_extendedprice * (1 - l_discount) END AS open,
    l_extendedprice * (1 + l_tax) AS high,
    CASE WHEN l_linenumber < 6 THEN l_extendedprice * (1 - l_tax) END AS low,
    CASE WHEN NOT (l_linenumber = 7 AND l_discount > CAST(0.08 AS DOUBLE)) THEN l_extendedprice END AS close,
    CASE WHEN l_tax > 0 THEN l_extendedprice * (1 - l_discount / 10) END AS adj_close,
    l_quantity AS volume,
    CASE WHEN l_orderkey % 997 = 0 THEN CAST(2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS split_ratio,
    CASE WHEN day(l_shipdate) >= 28 THEN l_extendedprice * l_discount / 100 ELSE CAST(0 AS DOUBLE) END AS dividend
  FROM lineitem)"""
DAYS = """days AS (
  SELECT series_id, as_of, """ + ", ".join(
    f"arg_max({c}, arrival) FILTER ({c} IS NOT NULL) AS {c}" for c in ["open", "high", "low", "close", "adj_close", "volume"]
) + """, MAX(split_ratio) AS split_ratio, MAX(dividend) AS dividend FROM lb GROUP BY 1, 2)"""
FACTORS = """factors AS (
  SELECT *, round(COALESCE(product(CASE WHEN split_ratio > 0 THEN split_ratio ELSE 1 END) OVER (
      PARTITION BY series_id ORDER BY as_of DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1), 8) AS split_factor
  FROM days)"""
FILLED_COLUMNS = """series_id, as_of, round(close, 6) AS value, round(COALESCE(open, close), 6) AS open,
    round(COALESCE(high, close), 6) AS high, round(COALESCE(low, close), 6) AS low, round(close, 6) AS close,
    round(COALESCE(adj_close, close), 6) AS value_tr, CAST(COALESCE(volume, 0) AS BIGINT) AS volume,
    round(COALESCE(dividend, 0), 6) AS dividend"""
BARS = f"""bars AS (
  SELECT {FILLED_COLUMNS}, split_factor, 'vendor' AS source,
         as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional
  FROM factors WHERE close IS NOT NULL)"""
CHAIN = [LANDED, DAYS, FACTORS, BARS]
RECORDED = "rbars AS (SELECT *, as_of + 1 AS recorded_on FROM bars)"

REGISTRY = """registry AS (
  SELECT 'eq_' || s_suppkey AS series_id,
    'Q' || s_suppkey || ['', '', '.L', '.PA', '.DE', '.XY'][1 + s_nationkey % 6] AS symbol, s_name AS name,
    'nation_' || s_nationkey AS category, CASE WHEN s_suppkey % 4 <> 0 THEN 'stock' END AS family,
    CASE WHEN s_suppkey % 4 <> 0 THEN [NULL, NULL, 'GBP', 'EUR', 'EUR', 'CHF'][1 + s_nationkey % 6] END AS currency,
    CASE WHEN s_suppkey % 4 <> 0 THEN [NULL, NULL, 'GBX', 'EUR', 'EUR', 'CHF'][1 + s_nationkey % 6] END AS quote_basis,
    s_suppkey % 31 = 30 AS retired, s_suppkey AS number, s_acctbal AS balance
  FROM supplier)"""


def bars(spark, sf):
    return corporate.build_bars(adapters.landed_bars(spark, sf, gathered=True))


def recorded_bars(spark, sf):
    return bars(spark, sf).withColumn("recorded_on", F.date_add("as_of", 1))


@query("a5_duplicate_day_collapse", with_(LANDED, DAYS, "SELECT * FROM days"))
def a5(spark, sf):
    return corporate.collapse_days(adapters.landed_bars(spark, sf, gathered=True))


CONFLICT_ROWS = """crows AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'eq_' || l_suppkey ELSE 'pt_' || l_partkey END AS series_id,
         CAST(l_shipdate AS DATE) AS as_of, CASE WHEN l_suppkey % 2 = 0 THEN l_quantity ELSE l_partkey END AS value
  FROM lineitem)"""


def conflict_rows(spark, sf):
    even = F.col("l_suppkey") % 2 == 0
    return adapters.table(spark, sf, "lineitem").select(
        F.when(even, adapters.keyed("eq_", "l_suppkey")).otherwise(adapters.keyed("pt_", "l_partkey")).alias("series_id"),
        F.col("l_shipdate").cast("date").alias("as_of"),
        F.when(even, F.col("l_quantity")).otherwise(F.col("l_partkey").cast("double")).alias("value"))


@query("a6_conflicting_days", with_(CONFLICT_ROWS, """clash AS (
  SELECT series_id, as_of, row_number() OVER (PARTITION BY series_id ORDER BY as_of) AS rn
  FROM crows GROUP BY 1, 2 HAVING MIN(value) <> MAX(value))
SELECT series_id, COUNT(*) AS n_conflicts,
       string_agg(CAST(as_of AS VARCHAR), ',' ORDER BY as_of) FILTER (rn <= 5) AS days FROM clash GROUP BY 1"""))
def a6(spark, sf):
    return corporate.conflicting_days(conflict_rows(spark, sf))


@query("a6_collapsed_duplicates", with_(CONFLICT_ROWS, """
SELECT series_id, as_of, MIN(value) AS value FROM crows WHERE series_id NOT IN (
  SELECT series_id FROM (SELECT series_id FROM crows GROUP BY series_id, as_of HAVING MIN(value) <> MAX(value)))
GROUP BY 1, 2"""))
def a6_collapsed(spark, sf):
    return corporate.without_conflicts(conflict_rows(spark, sf))


@query("w8_split_factor", with_(LANDED, DAYS, FACTORS, "SELECT series_id, as_of, split_ratio, split_factor FROM factors"))
def w8(spark, sf):
    days = corporate.collapse_days(adapters.landed_bars(spark, sf, gathered=True))
    return corporate.split_factors(days).select("series_id", "as_of", "split_ratio", "split_factor")


@query("p11_bar_field_fallback", with_(LANDED, DAYS, f"SELECT {FILLED_COLUMNS} FROM days WHERE close IS NOT NULL"))
def p11(spark, sf):
    return corporate.fill_bars(corporate.collapse_days(adapters.landed_bars(spark, sf, gathered=True)))


@query("s3_daily_bar_extract", with_(*CHAIN, "SELECT * FROM bars"))
def s3(spark, sf):
    return bars(spark, sf)


@query("b15_as_traded", with_(*CHAIN, "SELECT series_id, as_of, close, split_factor, close * split_factor AS as_traded FROM bars"))
def b15(spark, sf):
    return corporate.as_traded(bars(spark, sf)).select("series_id", "as_of", "close", "split_factor", "as_traded")


@query("p9_positive_close", with_(LANDED, """
SELECT series_id, as_of, COALESCE(close, adj_close) AS close FROM lb WHERE COALESCE(close, adj_close) > 0"""))
def p9(spark, sf):
    rows = adapters.landed_bars(spark, sf).withColumn("value", F.col("adj_close"))
    return corporate.positive_close(rows).select("series_id", "as_of", "close")


STEPS = """steps AS (
  SELECT *, LAG(close) OVER w AS prev_close, LAG(value_tr) OVER w AS prev_tr
  FROM rbars WINDOW w AS (PARTITION BY series_id ORDER BY as_of)),
rebuilt AS (
  SELECT *, close * COALESCE(product(CASE WHEN dividend > 0 AND prev_close > 0 THEN 1.0 - dividend / prev_close ELSE 1.0 END) OVER (
      PARTITION BY series_id ORDER BY as_of DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS rebuilt
  FROM steps)"""
PROBE = """probes AS (
  SELECT series_id, as_of, ((prev_tr / prev_close) / (value_tr / close) - 1.0) / ((1.0 - dividend / prev_close) - 1.0) AS score
  FROM steps WHERE dividend > 0 AND prev_close > 0 AND close > 0 AND prev_tr > 0 AND value_tr > 0 AND dividend / prev_close >= CAST(0.001 AS DOUBLE)),
probe AS (SELECT series_id, MAX(as_of) AS probe_date, arg_max(score, as_of) AS score FROM probes GROUP BY 1)"""
BELT = """offs AS (
  SELECT series_id, COALESCE(newest - recorded_on <= 400 AND value_tr > 0 AND abs(rebuilt - value_tr) / abs(value_tr) > CAST(0.2 AS DOUBLE), false) AS off
  FROM (SELECT *, MAX(recorded_on) OVER (PARTITION BY series_id) AS newest FROM rebuilt)),
belt AS (SELECT series_id, bool_or(off) AS diverges, COUNT(*) FILTER (off) AS n_off FROM offs GROUP BY 1)"""
TOTAL_RETURN = """tr AS (
  SELECT r.*, CASE WHEN NOT COALESCE(score >= CAST(0.7 AS DOUBLE), false) THEN 'stored:price_only'
                   WHEN r.series_id IN ('eq_3', 'eq_10') THEN 'stored:pinned'
                   WHEN diverges THEN 'stored:diverges' ELSE 'rebuilt' END AS basis
  FROM rebuilt r LEFT JOIN probe USING (series_id) JOIN belt USING (series_id)),
trc AS (SELECT *, CASE WHEN basis = 'rebuilt' THEN rebuilt ELSE value_tr END AS tr_close FROM tr)"""
PINNED = ["eq_3", "eq_10"]
TR_CHAIN = [*CHAIN, RECORDED, STEPS, PROBE, BELT, TOTAL_RETURN]


@query("w9_forward_dividend_product", with_(*CHAIN, RECORDED, STEPS, "SELECT series_id, as_of, close, round(rebuilt / close, 8) AS rebuilt_ratio FROM rebuilt"))
def w9(spark, sf):
    return corporate.rebuilt_total_return(recorded_bars(spark, sf)).select(
        "series_id", "as_of", "close", F.round(F.col("rebuilt") / F.col("close"), 8).alias("rebuilt_ratio"))


@query("w10_dividend_adjusted_probe", with_(*CHAIN, RECORDED, STEPS, PROBE, """
SELECT series_id, probe_date, round(score, 6) AS score, COALESCE(score >= CAST(0.7 AS DOUBLE), false) AS adjusted
FROM (SELECT DISTINCT series_id FROM bars) LEFT JOIN probe USING (series_id)"""))
def w10(spark, sf):
    return corporate.dividend_adjusted(recorded_bars(spark, sf))


@query("w11_fresh_cohort_belt", with_(*CHAIN, RECORDED, STEPS, BELT, "SELECT * FROM belt"))
def w11(spark, sf):
    return corporate.fresh_divergence(recorded_bars(spark, sf), fresh_days=400, tolerance=0.2)


def total_return(spark, sf):
    return corporate.total_return(recorded_bars(spark, sf), PINNED, fresh_days=400, tolerance=0.2)


# Steps several others read; the checking engine keeps each instead of running it again.
TR_STEPS = [part.replace(" AS (", " AS MATERIALIZED (", 1) for part in TR_CHAIN]


@query("w12_total_return_close", with_(*TR_STEPS, "SELECT series_id, as_of, basis, close, round(tr_close / close, 8) AS tr_ratio FROM trc"))
def w12(spark, sf):
    return total_return(spark, sf).select("series_id", "as_of", "basis", "close", F.round(F.col("tr_close") / F.col("close"), 8).alias("tr_ratio"))


ADJUSTED = """adjusted AS (
  SELECT series_id, as_of, open * (tr_close / close) AS open, high * (tr_close / close) AS high,
         low * (tr_close / close) AS low, tr_close AS close, volume, close AS raw_close FROM trc)"""


def per_raw_close(frame):
    """Adjusted prices as shares of the raw close, so that checks do not hang on the last digit."""
    return frame.withColumns({c: F.round(F.col(c) / F.col("raw_close"), 8) for c in ("open", "high", "low", "close")})


PER_RAW_CLOSE = "series_id, as_of, volume, raw_close, " + ", ".join(
    f"round({c} / raw_close, 8) AS {c}" for c in ("open", "high", "low", "close"))


@query("p10_auto_adjust", with_(*TR_STEPS, ADJUSTED, f"SELECT {PER_RAW_CLOSE} FROM adjusted"))
def p10(spark, sf):
    return per_raw_close(corporate.auto_adjust(total_return(spark, sf)))


MAJOR = """major AS (
  SELECT b.series_id, as_of, open / d AS open, high / d AS high, low / d AS low, close / d AS close, volume
  FROM (SELECT b.*, CASE WHEN upper(quote_basis) = 'GBX' THEN CAST(100 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS d
        FROM bars b LEFT JOIN registry USING (series_id)) b)"""


@query("p13_quote_basis", with_(*CHAIN, REGISTRY, MAJOR, "SELECT * FROM major"))
def p13(spark, sf):
    plain = bars(spark, sf).select("series_id", "as_of", "open", "high", "low", "close", "volume")
    return corporate.to_major_units(plain, adapters.registry(spark, sf))


WINDOW_END = dt.date(2001, 3, 15)


@query("p19_lookback_window", with_(*CHAIN, """
SELECT series_id, as_of, close FROM bars WHERE as_of >= DATE '2000-09-15' AND as_of <= DATE '2001-03-15'"""))
def p19(spark, sf):
    return corporate.clip_window(bars(spark, sf), "6mo", WINDOW_END).select("series_id", "as_of", "close")


@query("p19_served_series", with_(*CHAIN, """
SELECT DISTINCT series_id FROM bars WHERE as_of >= DATE '2001-03-15' - 3 AND as_of <= DATE '2001-03-15' AND close IS NOT NULL"""))
def p19_served(spark, sf):
    return corporate.served_series(corporate.clip_window(bars(spark, sf), "3d", WINDOW_END))


SPLIT_DAY = dt.date(2000, 1, 1)
OLD_BARS = f"""odays AS (SELECT * REPLACE (CASE WHEN as_of < DATE '2000-01-01' THEN split_ratio ELSE 0 END AS split_ratio) FROM days),
ofactors AS ({FACTORS.split('(', 1)[1].rsplit(')', 1)[0].replace('FROM days', 'FROM odays')}),
stored AS ({BARS.split('(', 1)[1].rsplit(')', 1)[0].replace('FROM factors', 'FROM ofactors')}),
repull AS (SELECT * FROM bars WHERE day(as_of) <> 13)"""


def stored_before_split(spark, sf):
    """All days on the scale of the splits known before ``SPLIT_DAY``."""
    landed = adapters.landed_bars(spark, sf, gathered=True)
    known = F.when(F.col("as_of") < F.lit(SPLIT_DAY), F.col("split_ratio")).otherwise(F.lit(0.0))
    return corporate.build_bars(landed.withColumn("split_ratio", known))


def repull(spark, sf):
    """A later full pull that has no close for any 13th of a month; such days make no bar."""
    close = F.when(F.dayofmonth("as_of") != 13, F.col("close"))
    return corporate.build_bars(adapters.landed_bars(spark, sf, gathered=True).withColumn("close", close))


@query("b13_split_detection", with_(*CHAIN, REGISTRY, """
SELECT DISTINCT series_id FROM bars JOIN registry USING (series_id)
WHERE abs(split_factor - 1.0) > 1e-9 AND family = 'stock'"""))
def b13(spark, sf):
    return corporate.split_series(bars(spark, sf), adapters.registry(spark, sf))


HEAL = """first_days AS (SELECT series_id, MIN(as_of) AS first_day FROM stored GROUP BY 1),
pulled AS (SELECT r.* FROM repull r JOIN first_days USING (series_id) WHERE as_of >= first_day),
missing AS (SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM pulled p WHERE p.series_id = s.series_id AND p.as_of = s.as_of)
            AND s.series_id IN (SELECT series_id FROM pulled)),
firsts AS (SELECT series_id, arg_min(split_factor, as_of) AS f FROM pulled GROUP BY 1),
asked AS (SELECT m.*, COALESCE(p.split_factor, f.f, 1.0) AS new_factor
          FROM missing m ASOF LEFT JOIN pulled p ON m.series_id = p.series_id AND m.as_of >= p.as_of
          LEFT JOIN firsts f ON f.series_id = m.series_id)"""


@query("j6_factor_as_of", with_(*CHAIN, OLD_BARS, HEAL, "SELECT series_id, as_of, new_factor FROM asked"))
def j6(spark, sf):
    return corporate.missing_factors(stored_before_split(spark, sf), repull(spark, sf))


HEALED = """healed AS (
  SELECT series_id, as_of, value, open, high, low, close, value_tr, volume, split_factor, dividend, false AS rescaled FROM pulled
  UNION ALL
  SELECT series_id, as_of, round(value * k, 6), round(open * k, 6), round(high * k, 6), round(low * k, 6), round(close * k, 6),
         round(value_tr * k, 6), volume, round(new_factor, 8), dividend, true
  FROM (SELECT *, split_factor / new_factor AS k FROM asked WHERE abs(new_factor - split_factor) > 1e-9))"""
HEAL_COLUMNS = ["series_id", "as_of", "value", "open", "high", "low", "close", "value_tr", "volume",
                "split_factor", "dividend", "rescaled"]


@query("b14_split_heal_batch", with_(*CHAIN, OLD_BARS, HEAL, HEALED, "SELECT * FROM healed"))
def b14(spark, sf):
    return corporate.heal_batch(stored_before_split(spark, sf), repull(spark, sf)).select(*HEAL_COLUMNS)
