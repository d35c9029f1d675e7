"""Extracts, stored tables and incremental runs. Everything written is derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from seriesloom import adapters
from seriesloom.functions.dates import week_ending_friday
from seriesloom.operators import registry, resample, revisions
from seriesloom.plans.landing import landing_run
from seriesloom.sources import deltas, extracts, tables
from seriesloom.session import scratch_path
from seriesloom.streaming import incremental
from seriesloom.workloads import history, instruments, prices, query, series, with_
from seriesloom.workloads.sqltext import MONTHLY, ORDER_VALUE, WEEKLY, friday

# --- extracts -------------------------------------------------------------------------------

TEXT_RULE = """CASE WHEN o_orderkey % 50 = 3 THEN '.' WHEN o_orderkey % 50 = 4 THEN '' WHEN o_orderkey % 50 = 5 THEN 'NaN'
  WHEN o_orderkey % 50 = 6 THEN NULL"""
KEPT = "o_orderkey % 50 NOT IN (3, 4, 5, 6)"


def landed_text(spark, sf):
    """Order values as landed text with missing marks, one row per order."""
    key = F.col("o_orderkey") % 50
    text = (F.when(key == 3, ".").when(key == 4, "").when(key == 5, "NaN").when(key == 6, F.lit(None))
            .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    return adapters.table(spark, sf, "orders").select(
        F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string")).alias("series_id"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T00:00")).alias("date"), text.alias("value"))


@query("s5_macro_observations", f"""
SELECT 'ord_' || o_orderkey AS series_id, CAST(o_orderdate AS DATE) AS as_of, o_totalprice AS value FROM orders WHERE {KEPT}""")
def s5(spark, sf):
    return extracts.macro_observations(landed_text(spark, sf))


@query("s6_macro_vintages", f"""
SELECT 'ord_' || o_orderkey AS series_id, CAST(o_orderdate AS DATE) AS date, CAST(o_orderdate AS DATE) + 7 AS realtime_start,
       DATE '9999-12-31' AS realtime_end, o_totalprice AS value FROM orders WHERE {KEPT}""")
def s6(spark, sf):
    landed = landed_text(spark, sf).withColumn("realtime_start", F.date_add(F.substring("date", 1, 10).cast("date"), 7).cast("string"))
    return extracts.macro_vintages(landed.withColumn("realtime_end", F.lit("9999-12-31")))


@query("s7_feature_counts", """
SELECT 'supp_' || l_suppkey AS series_id, CAST(l_shipdate AS DATE) AS as_of, l_quantity AS value FROM lineitem WHERE l_linenumber <> 7""")
def s7(spark, sf):
    features = adapters.table(spark, sf, "lineitem").select(
        F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string")).alias("series_id"),
        (F.datediff(F.col("l_shipdate").cast("date"), F.lit(dt.date(1970, 1, 1))).cast("long") * 86400000).alias("Date_"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("string")).otherwise(F.lit("n/a")).alias("N_Tankers"))
    return extracts.feature_counts(features, ["date", "date_"], ["n_tankers", "tankers"])


@query("s7_mixed_date_forms", """
SELECT 'supp_' || l_suppkey AS series_id, CAST(l_shipdate AS DATE) AS as_of, l_quantity AS value FROM lineitem""")
def s7_mixed(spark, sf):
    """Some extracts hold epoch milliseconds, the others date text; each keeps its rows."""
    day = F.col("l_shipdate").cast("date")
    millis = (F.datediff(day, F.lit(dt.date(1970, 1, 1))).cast("long") * 86400000).cast("string")
    features = adapters.table(spark, sf, "lineitem").select(
        F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string")).alias("series_id"),
        F.when(F.col("l_suppkey") % 2 == 0, millis).otherwise(day.cast("string")).alias("date"),
        F.col("l_quantity").cast("string").alias("n"))
    return extracts.feature_counts(features, ["date"], ["n"])


@query("s6_vintage_status", """
SELECT o_orderpriority AS series_id, COUNT(*) FILTER (o_orderkey % 100 = 7) = 0 AS ok, COUNT(*) AS n_landed,
       COUNT(*) FILTER (o_orderkey % 100 = 7) AS n_rejected, CASE WHEN COUNT(*) FILTER (o_orderkey % 100 = 7) > 0 THEN 'unreadable value 4..2' END AS reason
FROM (SELECT * REPLACE (CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey END AS o_orderkey) FROM orders) GROUP BY 1""")
def s6_status(spark, sf):
    """One series has numbers that cannot be read; marks for a missing value are no fault."""
    bad = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderkey") % 100 == 7)
    day = F.col("o_orderdate").cast("date")
    landed = adapters.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), day.cast("string").alias("date"), F.date_add(day, 7).cast("string").alias("realtime_start"),
        F.lit("9999-12-31").alias("realtime_end"),
        F.when(bad, F.lit("4..2")).when(F.col("o_orderkey") % 50 == 3, F.lit(".")).otherwise(F.col("o_totalprice").cast("string")).alias("value"))
    return extracts.row_status(extracts.vintage_rows(landed))


@query("s7_feature_status", """
SELECT 'supp_' || l_suppkey AS series_id, COUNT(*) FILTER (l_linenumber = 7) = 0 AS ok, COUNT(*) AS n_landed, COUNT(*) FILTER (l_linenumber = 7) AS n_rejected,
       CASE WHEN COUNT(*) FILTER (l_linenumber = 7) > 0 THEN 'unreadable value n/a' END AS reason FROM lineitem GROUP BY 1""")
def s7_status(spark, sf):
    features = adapters.table(spark, sf, "lineitem").select(
        F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string")).alias("series_id"),
        F.col("l_shipdate").cast("date").cast("string").alias("date"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("string")).otherwise(F.lit("n/a")).alias("n_tankers"))
    return extracts.row_status(extracts.feature_rows(features, ["date"], ["tankers", "n_tankers"]))


@query("s8_period_status", """
SELECT o_orderpriority AS series_id, COUNT(*) FILTER (o_orderstatus = 'P') = 0 AS ok, COUNT(*) AS n_landed, COUNT(*) FILTER (o_orderstatus = 'P') AS n_rejected,
       CASE WHEN COUNT(*) FILTER (o_orderstatus = 'P') > 0 THEN 'unreadable value withheld' END AS reason FROM orders GROUP BY 1""")
def s8_status(spark, sf):
    landed = adapters.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").cast("string").alias("period"),
        F.when(F.col("o_orderstatus") == "P", F.lit("withheld")).otherwise(F.col("o_totalprice").cast("string")).alias("value"))
    return extracts.row_status(extracts.period_rows(landed))


def mixed_documents(spark, sf):
    """Orders as JSON documents of four shapes, one of them cut off."""
    key, day = F.col("o_orderkey") % 5, F.col("o_orderdate").cast("date")
    value = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    millis = (F.unix_date(day).cast("long") * 86400000).cast("string")
    text = (F.when(key == 0, F.concat(F.lit('{"date": "'), day.cast("string"), F.lit('", "value": '), value, F.lit("}")))
            .when(key == 1, F.concat(F.lit('{"PERIOD": "'), day.cast("string"), F.lit('", "obs": "'), value, F.lit('"}')))
            .when(key == 2, F.concat(F.lit('{"attributes": {"Date_": '), millis, F.lit(', "n": '), value, F.lit("}}")))
            .when(key == 3, F.concat(F.lit('{"date": "'), day.cast("string"), F.lit('", "value": "withheld"}')))
            .otherwise(F.concat(F.lit('{"date": "'), day.cast("string"), F.lit('", "val'))))
    return adapters.table(spark, sf, "orders").select(
        F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string")).alias("series_id"), text.alias("document"))


@query("s11_mixed_shapes", """
SELECT 'ord_' || o_orderkey AS series_id, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderdate AS DATE) END AS as_of,
       CASE WHEN o_orderkey % 5 < 3 THEN o_totalprice END AS value,
       CASE o_orderkey % 5 WHEN 3 THEN 'unreadable value withheld' WHEN 4 THEN 'not a document' END AS reason FROM orders""")
def s11_mixed(spark, sf):
    """Extracts of different shapes in one frame; columns are found per row."""
    return extracts.mixed_rows(mixed_documents(spark, sf), ["date", "period", "attributes.Date_"], ["value", "obs", "attributes.n"])


GATED = """arrived AS (
  SELECT 'eq_' || l_suppkey AS series_id, s_nationkey, s_suppkey, l_quantity = 50 AND l_discount = 0 AND s_suppkey % 2 = 0 AS broken
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
states AS (
  SELECT w.series_id, COUNT(a.series_id) AS received, CASE WHEN COUNT(a.series_id) = 0 THEN 'dead' WHEN bool_or(broken) THEN 'malformed'
    WHEN MAX(s_nationkey) = 3 THEN 'empty' WHEN MAX(s_suppkey) % 7 = 1 THEN 'short' ELSE 'ok' END AS status, MAX(s_suppkey) % 7 = 1 AS more
  FROM wide w LEFT JOIN arrived a USING (series_id) GROUP BY 1)"""


@query("run_landing_gated", with_(prices.REGISTRY, instruments.STAMPED, GATED, """
SELECT series_id, status, CASE WHEN received > 0 THEN received + CASE WHEN more THEN 1 ELSE 0 END END AS announced, received,
       CASE WHEN status = 'ok' THEN received ELSE 0 END AS stored,
       (SELECT COUNT(*) FROM arrived) AS landed, (SELECT COUNT(*) FROM arrived WHERE broken) AS rejected FROM states"""))
def landing_gated(spark, sf):
    """Dead, malformed, empty and short extracts are turned away by name; the rest is stored."""
    suppliers = adapters.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    rows = adapters.table(spark, sf, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    broken = F.expr("l_quantity = 50 AND l_discount = 0 AND s_suppkey % 2 = 0")
    landed = rows.select(
        adapters.keyed("eq_", "l_suppkey").alias("series_id"), F.col("l_shipdate").cast("date").cast("string").alias("period"), F.col("s_suppkey"),
        F.when(broken, F.lit("5O")).when(F.col("s_nationkey") != 3, F.col("l_quantity").cast("string")).alias("value"))
    more = F.max(F.when(F.col("s_suppkey") % 7 == 1, 1).otherwise(0))
    manifest = landed.groupBy("series_id").agg((F.count(F.lit(1)) + more).alias("announced"))
    path = scratch_path(spark, "landed")
    run = landing_run(extracts.period_rows(landed), instruments.wide_registry(spark, sf), manifest, path)
    stored = deltas.read_series(spark, path).groupBy("series_id").agg(F.count(F.lit(1)).alias("stored"))
    return run.status.join(stored, "series_id", "left").select(
        "series_id", "status", "announced", "received", F.coalesce("stored", F.lit(0)).cast("long").alias("stored"),
        F.lit(run.landed).cast("long").alias("landed"), F.lit(run.rejected).cast("long").alias("rejected"))


S5_STATUS = """landed AS (
  SELECT o_orderpriority AS series_id, o_orderpriority = '5-LOW' AND o_orderkey % 100 = 1 AS bad, o_orderpriority = '1-URGENT' AND o_orderkey % 50 = 2 AS hole
  FROM orders)"""


@query("s5_extract_status", with_(S5_STATUS, """
SELECT series_id, NOT bool_or(bad) AS ok, COUNT(*) AS n_landed, COUNT(*) FILTER (bad) AS n_rejected,
       CASE WHEN bool_or(bad) THEN 'unreadable value 12x' END AS reason FROM landed GROUP BY 1"""))
def s5_status(spark, sf):
    """Garbage fails its own extract with a reason; marks for a missing value do not."""
    bad = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 100 == 1)
    hole = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 50 == 2)
    landed = adapters.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").cast("string").alias("date"),
        F.when(bad, F.lit("12x")).when(hole, F.lit(".")).otherwise(F.col("o_totalprice").cast("string")).alias("value"))
    return extracts.macro_extracts(landed)[1]


@query("s8_period_values", "SELECT 'ord_' || o_orderkey AS series_id, CAST(o_orderdate AS DATE) AS as_of, o_totalprice AS value FROM orders WHERE o_orderstatus <> 'P'")
def s8(spark, sf):
    landed = adapters.table(spark, sf, "orders").select(
        F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string")).alias("series_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("period"),
        F.when(F.col("o_orderstatus") == "P", F.lit("withheld")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("value"))
    return extracts.period_values(landed)


INDICATORS = {"1-URGENT": "mkt_urgent", "2-HIGH": "mkt_high", "4-NOT SPECIFIED": "mkt_other", "5-LOW": "mkt_low"}
FEED = """feed AS (
  SELECT as_of, series_id AS indicator, CASE series_id WHEN '1-URGENT' THEN 'mkt_urgent' WHEN '2-HIGH' THEN 'mkt_high'
    WHEN '4-NOT SPECIFIED' THEN 'mkt_other' WHEN '5-LOW' THEN 'mkt_low' END AS sid,
    CASE WHEN series_id = '4-NOT SPECIFIED' AND day(as_of) > 20 THEN 'n/a' WHEN series_id = '5-LOW' AND day(as_of) < 5 THEN '0' END AS bad, value FROM obs)"""


def feed(spark, sf):
    """One snapshot per day with a reading per indicator, some of them unusable."""
    day = F.dayofmonth("as_of")
    text = (F.when((F.col("series_id") == "4-NOT SPECIFIED") & (day > 20), "n/a")
            .when((F.col("series_id") == "5-LOW") & (day < 5), "0")
            .otherwise(F.col("value").cast("decimal(18,2)").cast("string")))
    return adapters.order_value(spark, sf).groupBy("as_of").agg(
        F.collect_list(F.struct(F.col("series_id").alias("indicator"), text.alias("value"))).alias("snapshot"))


@query("s9_snapshot_readings", with_(ORDER_VALUE, FEED, "SELECT sid AS series_id, as_of, round(value, 6) AS value FROM feed WHERE sid IS NOT NULL AND bad IS NULL"))
def s9(spark, sf):
    return extracts.snapshot_readings(feed(spark, sf), INDICATORS)[0]


@query("s9_rejected_readings", with_(ORDER_VALUE, FEED, "SELECT sid AS series_id, as_of, indicator || ': missing or non-positive value ' || bad AS reason FROM feed WHERE sid IS NOT NULL AND bad IS NOT NULL"))
def s9_rejected(spark, sf):
    return extracts.snapshot_readings(feed(spark, sf), INDICATORS)[1]


def slot_rows(spark, sf):
    """Monthly values as hand-entered text; one series holds a single typo."""
    typo = (F.col("series_id") == "2-HIGH") & (F.col("as_of") == F.lit(dt.date(1999, 6, 30)))
    return series.monthly(spark, sf).select(
        "series_id", F.col("as_of").cast("string").alias("as_of"),
        F.when(typo, F.lit("12o.5")).otherwise(F.col("value").cast("string")).alias("value"))


@query("s10_manual_slot", with_(ORDER_VALUE, MONTHLY, """
SELECT series_id, as_of, round(value, 6) AS value, as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional, as_of <= DATE '1998-12-31' AS earlier_source
FROM monthly WHERE series_id <> '2-HIGH'"""))
def s10(spark, sf):
    return extracts.manual_slot(slot_rows(spark, sf), dt.date(1998, 12, 31))[0]


@query("s10_slot_status", with_(ORDER_VALUE, MONTHLY, """
SELECT series_id, COUNT(*) AS n_rows, COUNT(*) FILTER (series_id = '2-HIGH' AND as_of = DATE '1999-06-30') AS n_bad,
       COUNT(*) FILTER (series_id = '2-HIGH' AND as_of = DATE '1999-06-30') = 0 AS ok FROM monthly GROUP BY 1"""))
def s10_status(spark, sf):
    return extracts.manual_slot(slot_rows(spark, sf))[1]


@query("s11_column_resolution", "SELECT CAST(o_orderdate AS DATE) AS as_of, COUNT(*) AS n FROM orders GROUP BY 1")
def s11(spark, sf):
    orders = adapters.table(spark, sf, "orders")
    day = extracts.resolve_column(orders.columns, ["orderDate", "O_ORDERDATE", "date"])
    return orders.groupBy(F.col(day).cast("date").alias("as_of")).agg(F.count(F.lit(1)).alias("n"))


@query("s12_landing_completeness", """
SELECT o_orderpriority AS series_id, COUNT(*) + CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS announced, COUNT(*) AS received,
       o_orderpriority <> '2-HIGH' AS complete FROM orders GROUP BY o_orderpriority""")
def s12(spark, sf):
    rows = adapters.table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "series_id")
    manifest = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).select(
        "series_id", (F.col("n") + F.when(F.col("series_id") == "2-HIGH", 1).otherwise(0)).alias("announced"))
    return extracts.completeness(rows, manifest)


@query("s19_extract_status", with_(prices.REGISTRY, instruments.STAMPED, """arrived AS (
  SELECT 'eq_' || l_suppkey AS series_id, CASE WHEN s_nationkey <> 3 THEN l_quantity END AS value, l_quantity = 50 AND l_discount = 0 AND l_tax = 0 AS broken
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT r.series_id, CASE WHEN COUNT(a.series_id) = 0 THEN 'dead' WHEN bool_or(broken) THEN 'malformed' WHEN COUNT(value) = 0 THEN 'empty' ELSE 'ok' END AS status,
       COUNT(value) AS n_rows FROM wide r LEFT JOIN arrived a USING (series_id) GROUP BY 1"""))
def s19(spark, sf):
    senders = adapters.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    arrived = adapters.table(spark, sf, "lineitem").join(senders, F.col("l_suppkey") == F.col("s_suppkey")).select(
        adapters.keyed("eq_", "l_suppkey").alias("series_id"), F.when(F.col("s_nationkey") != 3, F.col("l_quantity")).alias("value"),
        F.expr("l_quantity = 50 AND l_discount = 0 AND l_tax = 0").alias("broken"))
    return extracts.extract_status(instruments.wide_registry(spark, sf), arrived, F.col("broken"))


# --- stored tables ------------------------------------------------------------------------------

@query("s1_series_scan", with_(ORDER_VALUE, WEEKLY, "SELECT series_id, as_of, value, 'vendor' AS source FROM weekly WHERE day(as_of) <> 13"))
def s1(spark, sf):
    path = scratch_path(spark, "series-files")
    holed = series.weekly(spark, sf).withColumn("value", F.when(F.dayofmonth("as_of") != 13, F.col("value")))
    tables.write_series_files(holed, path)
    return tables.read_series_files(spark, path)


@query("s1_series_lines", with_(ORDER_VALUE, WEEKLY, "SELECT series_id, as_of, value, 'vendor' AS source FROM weekly WHERE day(as_of) <> 13"))
def s1_lines(spark, sf):
    path = scratch_path(spark, "series-lines")
    holed = series.weekly(spark, sf).withColumn("value", F.when(F.dayofmonth("as_of") != 13, F.col("value")))
    tables.write_series_lines(holed, path)
    return tables.read_series_lines(spark, path)


@query("s2_raw_archive_scan", with_(history.LOG, "SELECT *, CAST(year(as_of) AS INTEGER) AS year FROM log"))
def s2(spark, sf):
    path = scratch_path(spark, "history")
    tables.write_history(adapters.reading_log(spark, sf), path)
    return tables.read_history(spark, path)


@query("s13_full_replace", with_(ORDER_VALUE, WEEKLY, MONTHLY, """
SELECT series_id, as_of, value FROM weekly WHERE series_id NOT IN ('1-URGENT', '5-LOW')
UNION ALL SELECT series_id, as_of, round(value, 6) FROM monthly WHERE series_id IN ('1-URGENT', '5-LOW')"""))
def s13(spark, sf):
    path = scratch_path(spark, "replace")
    tables.replace_series(series.weekly(spark, sf), path, buckets=4)
    tables.replace_series(series.monthly(spark, sf).filter(F.col("series_id").isin("1-URGENT", "5-LOW")), path, buckets=4)
    return tables.read_series(spark, path)


@query("s14_history_append", with_(*history.CHAIN, history.batch_sql(), history.PLAN, history.APPLIED, "SELECT * FROM applied"))
def s14(spark, sf):
    path = scratch_path(spark, "archive")
    tables.write_history(history.stored_log(spark, sf), path)
    tables.append_history(history.pulled_batch(spark, sf), path)
    return tables.read_history(spark, path).drop("year")


@query("s15_vintage_append", with_(series.VINTAGES, series.VINT_MONTH, """
SELECT COUNT(*) FILTER (recorded_on > DATE '1999-06-30') AS appended, COUNT(*) FILTER (recorded_on <= DATE '1999-06-30') AS skipped FROM vmonth"""))
def s15(spark, sf):
    path = scratch_path(spark, "vintages")
    records = resample.vintage_monthly_mean(adapters.order_vintages(spark, sf))
    tables.append_vintages(records.filter(F.col("recorded_on") <= F.lit(dt.date(1999, 6, 30))), path)
    return tables.append_vintages(records, path)


@query("s16_ledger_and_journal", with_(*history.CHAIN, history.ROUNDED, history.CELLS, """
SELECT 'face' AS part, COUNT(*) AS n_rows, CAST(NULL AS VARCHAR) AS run_at FROM decl
UNION ALL SELECT 'journal', COUNT(*), '2024-02-05T00-00-00Z' FROM decl UNION ALL SELECT 'journal', 2 * COUNT(*), '2024-02-06T00-00-00Z' FROM decl"""))
def s16(spark, sf):
    face, journal = scratch_path(spark, "face"), scratch_path(spark, "journal")
    declared = history.declared(spark, sf)
    same = history.stored_view(spark, sf)
    quiet = revisions.declarations(same, revisions.round_values(same))
    for day, batch in ((5, 0), (6, 1), (6, 2), (6, 2)):  # two batches of one day, the second of them twice
        tables.write_ledger(declared, face, journal, dt.datetime(2024, 2, day), batch)
    tables.write_ledger(quiet, face, journal, dt.datetime(2024, 2, 7))
    shown = spark.read.parquet(face).agg(F.lit("face").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("string").alias("run_at"))
    kept = spark.read.parquet(journal).groupBy("run_at").agg(F.count(F.lit(1)).alias("n_rows"))
    return shown.unionByName(kept.select(F.lit("journal").alias("part"), "n_rows", F.col("run_at").cast("string").alias("run_at")))


@query("s16_all_changed_cells", with_(*history.CHAIN, history.ROUNDED, history.CELLS, """
SELECT series_id, as_of, field, old, new FROM cells"""))
def s16_cells(spark, sf):
    """Every changed cell reaches the ledger, however many a series has."""
    face, journal, cells = (scratch_path(spark, n) for n in ("face", "journal", "cells"))
    stored, fresh = history.stored_view(spark, sf), history.incoming(spark, sf)
    tables.write_ledger(revisions.declarations(stored, fresh, limit=1), face, journal, dt.datetime(2024, 2, 5),
                        cells=revisions.all_changed_cells(stored, fresh), cells_path=cells)
    return spark.read.parquet(cells).select("series_id", "as_of", "field", "old", "new")


@query("s17_catalog_write", with_(prices.REGISTRY, instruments.ODD, instruments.CATALOG, instruments.MERGED, "SELECT series_id, symbol, description FROM merged"))
def s17_write(spark, sf):
    path = scratch_path(spark, "catalog")
    instruments.old_catalog(spark, sf).write.parquet(path)
    fresh = registry.catalog_rows(instruments.odd_registry(spark, sf)).filter("reject_reason IS NULL")
    merged = registry.merge_catalog(spark.read.parquet(path), fresh, "eq_", adapters.registry(spark, sf).filter("retired"))
    tables.write_catalog(merged, path)
    return spark.read.parquet(path)


@query("s18_slot_export", with_(ORDER_VALUE, MONTHLY, "SELECT series_id, as_of, round(value, 6) AS value, as_of = MAX(as_of) OVER (PARTITION BY series_id) AS provisional, false AS earlier_source FROM monthly"))
def s18(spark, sf):
    from seriesloom import schemas
    path = scratch_path(spark, "slot")
    tables.export_slot(series.monthly(spark, sf), path)
    return extracts.manual_slot(spark.read.schema(schemas.SLOT_FILE).json(path))[0]


# --- incremental runs -----------------------------------------------------------------------------

RUNS = [dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 2, 5)]


def _land(frame, path, after, upto):
    """Files of one run: everything recorded since the run before."""
    day = F.col("recorded_on")
    window = frame.filter(day <= F.lit(upto)) if after is None else frame.filter((day > F.lit(after)) & (day <= F.lit(upto)))
    window.write.mode("append").parquet(path)


def incremental_runs(spark, sf, step):
    """Land and process the readings run by run."""
    log, landing = adapters.reading_log(spark, sf), scratch_path(spark, "landing")
    before = None
    for run_date in RUNS:
        _land(log, landing, before, run_date)
        step(incremental.landing(spark, landing, log.schema), run_date)
        before = run_date


@query("r1_incremental_append", with_(history.LOG, history.FULL_VIEW, "SELECT series_id, as_of, value, value_tr FROM fullview"))
def r1(spark, sf):
    archive, state = scratch_path(spark, "archive"), scratch_path(spark, "state")
    incremental_runs(spark, sf, lambda stream, day: incremental.daily_append(stream, archive, state, day, deltas.append_history))
    return deltas.view(spark, archive).select("series_id", "as_of", "value", "value_tr")


WEEK_LAST = f"""SELECT o_orderpriority AS series_id, {friday('CAST(o_orderdate AS DATE)')} AS as_of,
  MAX(struct_pack(a := o_orderdate, b := o_orderkey, c := o_totalprice)).c AS value
FROM orders GROUP BY 1, 2 HAVING {friday('CAST(o_orderdate AS DATE)')} < (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"""


def order_stream(spark, sf):
    schema = adapters.table(spark, sf, "orders").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/order[s].parquet")
    return stream.select(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp").alias("ts"),
                         F.col("o_orderkey").alias("arrival"), F.col("o_totalprice").alias("value"))


@query("r2_stream_completed_weeks", WEEK_LAST)
def r2_stream(spark, sf):
    path, state = scratch_path(spark, "weeks"), scratch_path(spark, "state")
    incremental.weekly_parts(order_stream(spark, sf), "ts", path, state)
    return incremental.completed_weeks(spark, path)


@query("r2_late_rows_kept", WEEK_LAST)
def r2_late(spark, sf):
    """Two runs, the later half of the days first; the early days come late and are kept."""
    landing, path, state = (scratch_path(spark, n) for n in ("late-landing", "late-weeks", "late-state"))
    orders = adapters.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("arrival"), F.col("o_totalprice").alias("value"))
    for half in (F.col("ts") >= "1998-01-01", F.col("ts") < "1998-01-01"):
        orders.filter(half).write.mode("append").parquet(landing)
        incremental.weekly_parts(incremental.landing(spark, landing, orders.schema), "ts", path, state)
    return incremental.completed_weeks(spark, path)


@query("r2_batch_completed_weeks", WEEK_LAST)
def r2_batch(spark, sf):
    """The same weeks without a stream."""
    orders = adapters.table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    last = F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice"))["o_totalprice"]
    weeks = orders.groupBy(F.col("o_orderpriority").alias("series_id"), week_ending_friday(day).alias("as_of")).agg(last.alias("value"))
    return weeks.filter(F.col("as_of") < orders.agg(F.max(day)).scalar())


@query("r3_stream_completed_months", """
SELECT o_orderpriority AS series_id, last_day(CAST(o_orderdate AS DATE)) AS as_of,
  round(round(AVG(o_totalprice), 9), 6) AS value
FROM orders GROUP BY 1, 2 HAVING last_day(CAST(o_orderdate AS DATE)) < DATE '2001-07-01'""")
def r3_stream(spark, sf):
    parts, state = scratch_path(spark, "parts"), scratch_path(spark, "state")
    stream = order_stream(spark, sf).withColumn("as_of", F.col("ts").cast("date"))
    incremental.monthly_parts(stream, parts, state)
    return incremental.completed_months(spark, parts, series.RUN_DATE)


@query("r4_snapshot_accumulation", """
SELECT 'ev_' || user_id AS series_id, CAST(ts AS DATE) AS as_of, arg_max(value, struct_pack(a := CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER), b := event_id)) AS value
FROM events GROUP BY 1, 2""")
def r4(spark, sf):
    path, state = scratch_path(spark, "snapshots"), scratch_path(spark, "state")

    def step(stream, _):
        incremental.accumulate_snapshots(stream.withColumn("arrival", F.col("recorded_on")), path, state)

    incremental_runs(spark, sf, step)
    return tables.read_series(spark, path)


@query("r4_readings_as_deltas", """
SELECT 'ev_' || user_id AS series_id, CAST(ts AS DATE) AS as_of, arg_max(value, struct_pack(a := CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER), b := event_id)) AS value
FROM events GROUP BY 1, 2""")
def r4_deltas(spark, sf):
    path, state = scratch_path(spark, "readings"), scratch_path(spark, "state")
    incremental_runs(spark, sf, lambda stream, _: incremental.accumulate_readings(
        stream.withColumn("arrival", F.col("recorded_on")), path, state))
    deltas.compact(spark, path, fan=2)
    return deltas.read_series(spark, path)


def late_sql(after: str, upto: str) -> str:
    return f"""SELECT '{upto}T00-00-00Z' AS run_at, series_id, COUNT(*) FILTER (as_of >= tip - 7) AS settled_n, COUNT(*) FILTER (as_of < tip - 7 AND field = 'value') AS historical_value_n, COUNT(*) AS stored_cells FROM (
  SELECT i.series_id, i.as_of, tip, 'value' AS field, round(s.value, 4) AS old, round(i.value, 4) AS new FROM i{after} i JOIN s{after} s USING (series_id, as_of) JOIN t{after} USING (series_id)
  UNION ALL SELECT i.series_id, i.as_of, tip, 'value_tr', round(s.value_tr, 4), round(i.value_tr, 4) FROM i{after} i JOIN s{after} s USING (series_id, as_of) JOIN t{after} USING (series_id))
WHERE old IS DISTINCT FROM new GROUP BY series_id"""


def late_views(after: str, upto: str) -> str:
    newest = "SELECT series_id, as_of, arg_max(value, recorded_on) AS value, arg_max(value_tr, recorded_on) AS value_tr FROM log"
    low = after.replace("d", "2024-01-")
    return f"""s{after} AS ({newest} WHERE recorded_on <= DATE '{low}' GROUP BY 1, 2),
i{after} AS ({newest} WHERE recorded_on > DATE '{low}' AND recorded_on <= DATE '{upto}' GROUP BY 1, 2),
t{after} AS (SELECT series_id, MAX(as_of) AS tip FROM i{after} GROUP BY 1)"""


@query("r5_late_rows_declared", with_(history.LOG, late_views("d10", "2024-01-20"), late_views("d20", "2024-02-05"),
       late_sql("d10", "2024-01-20") + " UNION ALL " + late_sql("d20", "2024-02-05")))
def r5(spark, sf):
    archive, face, journal, cells, state = (scratch_path(spark, n) for n in ("archive", "face", "journal", "cells", "state"))
    incremental_runs(spark, sf, lambda stream, day: incremental.declare_and_append(stream, archive, face, journal, state, day, cells))
    run = F.col("run_at").cast("string").alias("run_at")
    kept = spark.read.parquet(cells).groupBy(run, "series_id").agg(F.count(F.lit(1)).alias("stored_cells"))
    declared = spark.read.parquet(journal).select(run, "series_id", "settled_n", "historical_value_n")
    return declared.join(kept, ["run_at", "series_id"], "left")
