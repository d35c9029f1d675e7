"""Weekly positioning queries over line items and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.operators import names
from seriesloom.operators import positioning as pos
from seriesloom.operators import windows
from seriesloom.workloads import query, with_
from seriesloom.workloads.sqltext import friday

MARKETS = [
    pos.Market("brand_3", query_name="BRAND#3 "),
    pos.Market("brand_1x", query_name="BRAND#1", must_contain=["PROMO"], must_not_contain=["STANDARD"]),
    pos.Market("brand_2x", query_name="BRAND#2", must_contain=["NOWHERE"]),
    pos.Market("pinned_7", code="7"),
    pos.Market("pinned_9", code="9", family=pos.COMMODITY),
]


def leg_sql(name: str, flag: str, odd: int) -> str:
    return (f"NULLIF(SUM(CASE WHEN l_returnflag = '{flag}' AND l_linenumber % 2 = {odd} "
            f"THEN l_quantity ELSE 0 END) * 100, 0) AS {name}")


LANDED = f"""landed AS (
  SELECT p_brand AS market, {friday('CAST(l_shipdate AS DATE)')} AS report_date,
         upper(p_brand) || ' ' || p_type || CASE WHEN l_linestatus = 'O' AND p_type = 'SMALL' THEN ' MICRO' ELSE '' END AS contract_name,
         SUM(l_quantity) * 100 AS oi,
         {leg_sql('r1', 'R', 1)}, {leg_sql('r0', 'R', 0)}, {leg_sql('a1', 'A', 1)},
         {leg_sql('a0', 'A', 0)}, {leg_sql('n1', 'N', 1)}, {leg_sql('n0', 'N', 0)}
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""

FINANCIAL_COLUMNS = """market, report_date AS date, contract_name AS market_name, oi AS open_interest,
  r1 AS primary_long, r0 AS primary_short, r1 - r0 AS primary_net,
  a1 AS secondary_long, a0 AS secondary_short, a1 - a0 AS secondary_net,
  n1 AS tertiary_long, n0 AS tertiary_short, n1 - n0 AS tertiary_net"""
COMMODITY_COLUMNS = """market, report_date AS date, contract_name AS market_name, oi AS open_interest,
  r0 AS primary_long, r1 AS primary_short, r0 - r1 AS primary_net,
  a0 AS secondary_long, a1 AS secondary_short, a0 - a1 AS secondary_net,
  n0 AS tertiary_long, n1 AS tertiary_short, n0 - n1 AS tertiary_net"""

NO_SMALL = """nosmall AS (
  SELECT l.* FROM landed l JOIN (SELECT market, bool_or(NOT contains(contract_name, 'MICRO')) AS hit_any FROM landed GROUP BY 1) USING (market)
  WHERE NOT contains(contract_name, 'MICRO') OR NOT hit_any)"""
TOP = """top AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY market, report_date ORDER BY oi DESC, contract_name) AS rn FROM nosmall) WHERE rn = 1)"""
POSITIONS = f"positions AS (SELECT {FINANCIAL_COLUMNS} FROM top)"
STORED = """stored AS (
  SELECT 'pos_' || lower(replace(market, '#', '_')) AS series_id, date AS as_of, primary_net AS value, 'weekly_report' AS source,
         * EXCLUDE (market, date) FROM positions WHERE primary_net IS NOT NULL)"""
CHAIN = [LANDED, NO_SMALL, TOP, POSITIONS, STORED]


def landed(spark, sf):
    return adapters.landed_positions(spark, sf)


def stored(spark, sf):
    return pos.stored_rows(pos.normalized(landed(spark, sf)))


@query("p1_lenient_numbers", with_(LANDED, """
SELECT market, report_date, contract_name, oi AS open_interest, oi AS open_interest_or_zero, r1 AS primary_long FROM landed"""))
def p1(spark, sf):
    return pos.parsed_interest(landed(spark, sf))


@query("p2_financial_cohorts", with_(LANDED, f"SELECT {FINANCIAL_COLUMNS} FROM landed"))
def p2(spark, sf):
    return pos.cohorts(landed(spark, sf), pos.FINANCIAL)


@query("p3_commodity_cohorts", with_(LANDED, f"SELECT {COMMODITY_COLUMNS} FROM landed"))
def p3(spark, sf):
    return pos.cohorts(landed(spark, sf), pos.COMMODITY)


@query("p4_pin_names", with_(LANDED, """
SELECT market, report_date, contract_name FROM landed JOIN (
  SELECT market, bool_or(contains(contract_name, 'BRAND#1') AND contains(contract_name, 'PROMO')) AS hit_any FROM landed GROUP BY 1) USING (market)
WHERE (contains(contract_name, 'BRAND#1') AND contains(contract_name, 'PROMO')) OR NOT hit_any"""))
def p4(spark, sf):
    return pos.pin_names(landed(spark, sf), ["brand#1", "promo"]).select("market", "report_date", "contract_name")


@query("p5_exclude_names", with_(LANDED, """
SELECT market, report_date, contract_name FROM landed
WHERE NOT (contains(contract_name, 'MEDIUM') OR contains(contract_name, 'LARGE'))"""))
def p5(spark, sf):
    return pos.exclude_names(landed(spark, sf), ["medium", "large"]).select("market", "report_date", "contract_name")


@query("p6_exclude_small_contracts", with_(LANDED, NO_SMALL, "SELECT market, report_date, contract_name FROM nosmall"))
def p6(spark, sf):
    return pos.exclude_small_contracts(landed(spark, sf)).select("market", "report_date", "contract_name")


ASSIGNED = """coded AS (SELECT *, substr(market, 7) AS contract_code FROM landed),
assigned AS (
  SELECT 'brand_3' AS market, report_date, contract_name FROM coded WHERE contains(contract_name, 'BRAND#3 ')
  UNION ALL SELECT 'brand_1x', report_date, contract_name FROM coded
    WHERE contains(contract_name, 'BRAND#1') AND NOT contains(contract_name, 'STANDARD') AND contains(contract_name, 'PROMO')
  UNION ALL SELECT 'brand_2x', report_date, contract_name FROM coded WHERE contains(contract_name, 'BRAND#2')
  UNION ALL SELECT 'pinned_7', report_date, contract_name FROM coded WHERE contract_code = '7'
  UNION ALL SELECT 'pinned_9', report_date, contract_name FROM coded WHERE contract_code = '9')"""


@query("p7_source_predicate", with_(LANDED, ASSIGNED, "SELECT * FROM assigned"))
def p7(spark, sf):
    reports = landed(spark, sf).withColumn("contract_code", F.substring("market", 7, 10)).drop("market")
    chosen = pos.pin_configured_names(pos.assign_markets(reports, MARKETS), MARKETS)
    return chosen.select("market", "report_date", "contract_name")


@query("a4_largest_per_date", with_(LANDED, """
SELECT market, report_date, contract_name, oi AS open_interest FROM (
  SELECT *, row_number() OVER (PARTITION BY market, report_date ORDER BY oi DESC, contract_name) AS rn FROM landed) WHERE rn = 1"""))
def a4(spark, sf):
    best = pos.largest_per_date(landed(spark, sf))
    return best.select("market", "report_date", "contract_name",
                       F.replace("open_interest_all", F.lit(","), F.lit("")).cast("double").alias("open_interest"))


@query("s4_positioning_extract", with_(*CHAIN[:4], "SELECT * FROM positions"))
def s4(spark, sf):
    return pos.normalized(landed(spark, sf))


@query("p22_stored_rows", with_(*CHAIN, "SELECT * FROM stored"))
def p22(spark, sf):
    return stored(spark, sf)


@query("p22_report_rows", with_(*CHAIN, """
SELECT * EXCLUDE (value, source, as_of), as_of AS date, 'financial' AS report_family FROM stored"""))
def p22_back(spark, sf):
    return pos.report_rows(stored(spark, sf), pos.FINANCIAL)


MANY = """markets AS (SELECT DISTINCT p_brand, p_type, CAST(substr(p_brand, 7) AS BIGINT) AS k FROM part),
wanted AS (
  SELECT p_brand || '/' || p_type AS market, landed.*, contains(contract_name, p_type) AS required, p_type = 'SMALL' AND contains(contract_name, 'MICRO') AS barred
  FROM (SELECT * EXCLUDE (market) FROM landed) landed JOIN markets ON contains(contract_name, upper(p_brand) || ' ') WHERE k % 10 <> 9),
kept AS (
  SELECT market, contract_name FROM (SELECT *, bool_or(required) OVER (PARTITION BY market) AS hit FROM wanted) WHERE (required OR NOT hit) AND NOT barred
  UNION ALL SELECT p_brand || '/' || p_type, contract_name FROM landed JOIN markets ON substr(market, 7) = CAST(k AS VARCHAR) WHERE k % 10 = 9)"""


@query("p7_many_markets", with_(LANDED, MANY, "SELECT market, COUNT(*) AS n_rows, COUNT(DISTINCT contract_name) AS n_names FROM kept GROUP BY 1"))
def p7_many(spark, sf):
    """A market per brand and type, as a table: matched through a term index."""
    k = F.substring("p_brand", 7, 5).cast("long")
    markets = adapters.table(spark, sf, "part").select("p_brand", "p_type").distinct().select(
        F.concat_ws("/", "p_brand", "p_type").alias("market"), F.when(k % 10 == 9, k.cast("string")).alias("code"),
        F.concat("p_brand", F.lit(" ")).alias("query_name"), F.array("p_type").alias("must_contain"),
        F.when(F.col("p_type") == "SMALL", F.array(F.lit("MICRO"))).alias("must_not_contain"))
    reports = landed(spark, sf).withColumn("contract_code", F.substring("market", 7, 10))
    return names.assign_market_table(reports, markets).groupBy("market").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("contract_name").alias("n_names"))


CAPACITY = """capacity AS (
  SELECT 'pos_' || lower(replace(p_brand, '#', '_')) AS series_id,
    CAST(SUM(CASE WHEN p_brand NOT LIKE '%3' THEN CAST(p_retailprice AS DECIMAL(18,2)) END) AS DOUBLE) * 100000 AS capacity
  FROM part GROUP BY 1)"""


@query("p23_capacity", with_(*CHAIN, CAPACITY, """
SELECT s.series_id, COUNT(*) AS n_rows, MAX(round(capacity / 1e9, 1)) AS capacity_bn
FROM stored s LEFT JOIN capacity USING (series_id) GROUP BY 1"""))
def p23(spark, sf):
    view = stored(spark, sf).groupBy("series_id").agg(F.count("value").alias("n_rows"))
    known = F.when(~F.col("p_brand").endswith("3"), F.col("p_retailprice"))  # some markets have no capacity
    capacity = (adapters.table(spark, sf, "part").withColumn("known", known)
                .groupBy(F.concat(F.lit("pos_"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))).alias("series_id"))
                .agg((adapters.exact_sum("known") * 100000).alias("capacity")))
    return pos.with_capacity(view, capacity)


FIRST_SEEN = """seen AS (SELECT series_id, market_name, MIN(as_of) AS first_seen FROM stored GROUP BY 1, 2)"""


@query("a17_identities", with_(*CHAIN, FIRST_SEEN, """
SELECT series_id, string_agg(market_name, '|' ORDER BY first_seen, market_name) AS names, COUNT(*) AS n_names FROM seen GROUP BY 1"""))
def a17(spark, sf):
    return pos.identities(stored(spark, sf)).select(
        "series_id", F.array_join("names", "|").alias("names"), F.size("names").cast("long").alias("n_names"))


SEAM = """steps AS (
  SELECT series_id, as_of AS seam_date, market_name AS to_identity,
         LAG(market_name) OVER w AS from_identity, LAG(as_of) OVER w AS last_clean_date
  FROM stored WINDOW w AS (PARTITION BY series_id ORDER BY as_of)),
seam AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY seam_date) AS rn FROM steps
  WHERE from_identity IS NOT NULL AND from_identity <> to_identity) WHERE rn = 1)"""


@query("w13_splice_seam", with_(*CHAIN, SEAM, "SELECT * FROM seam"))
def w13(spark, sf):
    return pos.seam(stored(spark, sf))


@query("w13_latest_seam", with_(*CHAIN, SEAM, """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY seam_date DESC) AS rn FROM steps
  WHERE from_identity IS NOT NULL AND from_identity <> to_identity) WHERE rn = 1"""))
def w13_latest(spark, sf):
    return pos.seam(stored(spark, sf), which="latest")


SEGMENT = """segment AS (
  SELECT s.series_id, s.as_of, s.value, s.market_name, COALESCE(to_identity, 'single-contract') AS segment
  FROM stored s LEFT JOIN seam USING (series_id) WHERE to_identity IS NULL OR market_name = to_identity)"""


@query("w14_clean_segment", with_(*CHAIN, SEAM, SEGMENT, "SELECT * FROM segment"))
def w14(spark, sf):
    rows = stored(spark, sf).select("series_id", "as_of", "value", "market_name")
    return pos.clean_segment(rows, pos.seam(rows))


@query("w14_segment_percentile", with_(*CHAIN, SEAM, SEGMENT, """tail AS (
  SELECT *, MAX(CASE WHEN rn = 1 THEN value END) OVER (PARTITION BY series_id) AS cur FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY as_of DESC) AS rn FROM segment) WHERE rn <= 52)
SELECT series_id, CAST(52 AS BIGINT) AS "window",
  CASE WHEN COUNT(*) >= 8 AND MIN(value) <> MAX(value) THEN round(100.0 * CAST(COUNT(*) FILTER (value <= cur) AS DOUBLE) / COUNT(*), 2) END AS percentile,
  CASE WHEN COUNT(*) >= 8 AND MIN(value) <> MAX(value) THEN round((arg_max(value, as_of) - AVG(value)) / stddev_pop(value), 4) END AS zscore,
  COUNT(*) AS n_obs, MAX(as_of) AS asof, MAX(segment) AS segment, arg_max(value, as_of) AS net
FROM tail GROUP BY 1"""))
def w14_percentile(spark, sf):
    rows = stored(spark, sf).select("series_id", "as_of", "value", "market_name")
    return windows.percentile_window(pos.clean_segment(rows, pos.seam(rows)), 52)


DECLARED = """declared AS (
  SELECT DISTINCT series_id, CAST(regexp_extract(series_id, '[0-9]+$') AS BIGINT) % 2 = 0 AS declared FROM stored)"""


def _number(series):
    return F.regexp_extract(series, "[0-9]+$", 0).cast("long")


@query("i12_identity_guard", with_(*CHAIN, FIRST_SEEN, DECLARED, """
SELECT series_id, COUNT(*) AS n_names, NOT (COUNT(*) > 1 AND NOT any_value(declared)) AS accepted,
  CASE WHEN COUNT(*) > 1 AND NOT any_value(declared) THEN 'identity_rejected: ' || COUNT(*) || ' contracts under one key' END AS reason
FROM seen JOIN declared USING (series_id) GROUP BY 1"""))
def i12(spark, sf):
    rows = stored(spark, sf)
    declared = rows.select("series_id").distinct().withColumn("declared", _number(F.col("series_id")) % 2 == 0)
    return pos.identity_guard(rows, declared)


@query("g8_quality_flags", with_(*CHAIN, SEAM, """allrows AS (
  SELECT 'pos_' || lower(replace(market, '#', '_')) AS series_id, date AS as_of, primary_net FROM positions),
steps2 AS (
  SELECT 'pos_' || lower(replace(market, '#', '_')) AS series_id, date AS seam_date, market_name, LAG(market_name) OVER (PARTITION BY market ORDER BY date) AS before FROM positions),
seam2 AS (SELECT series_id, MIN(seam_date) AS seam_date FROM steps2 WHERE before IS NOT NULL AND before <> market_name GROUP BY 1),
facts AS (SELECT series_id, COUNT(primary_net) AS n_obs, MIN(primary_net) AS low, MAX(primary_net) AS high,
            bool_or(primary_net IS NULL AND as_of = newest) AS latest_missing
          FROM (SELECT *, MAX(as_of) OVER (PARTITION BY series_id) AS newest FROM allrows) GROUP BY 1),
gaps AS (SELECT series_id, MAX(gap) AS gap_days FROM (
  SELECT series_id, as_of - LAG(as_of) OVER (PARTITION BY series_id ORDER BY as_of) AS gap FROM allrows) GROUP BY 1 HAVING MAX(gap) > 7),
full_ AS (SELECT f.*, seam_date, gap_days, CAST(regexp_extract(series_id, '[0-9]+$') AS BIGINT) AS k
          FROM facts f LEFT JOIN seam2 USING (series_id) LEFT JOIN gaps USING (series_id))
SELECT series_id, n_obs, seam_date, gap_days, concat_ws(',',
  CASE WHEN seam_date IS NOT NULL THEN CASE WHEN k % 2 = 0 THEN 'name_rebrand' ELSE 'contract_splice' END END,
  CASE WHEN gap_days IS NOT NULL THEN 'history_gap' END,
  CASE WHEN k % 5 = 0 THEN 'name_break' END,
  CASE WHEN k % 7 = 0 THEN 'satellite' END,
  CASE WHEN n_obs < 8 THEN 'insufficient_history' WHEN low = high THEN 'zero_dispersion' END,
  CASE WHEN latest_missing THEN 'missing_latest_net' END) AS flags FROM full_"""))
def g8(spark, sf):
    rows = pos.normalized(landed(spark, sf)).select(
        F.concat(F.lit("pos_"), F.lower(F.replace("market", F.lit("#"), F.lit("_")))).alias("series_id"),
        F.col("date").alias("as_of"), "market_name", "primary_net")
    number = _number(F.col("series_id"))
    markets = rows.select("series_id").distinct().select(
        "series_id", (number % 2 == 0).alias("pinned"), (number % 5 == 0).alias("declared_break"),
        F.when(number % 7 == 0, F.lit("proxy contract")).alias("satellite"))
    return pos.quality_flags(rows, markets, max_gap_days=7)
