"""The provided tables, read as time-series inputs.

Each adapter folds raw rows with a partial aggregate before anything is ordered, so a
key that holds a large share of the raw rows is reduced on the map side; ``landed_bars``
says where it does otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.dates import month_end, week_ending_friday


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(column) -> Column:
    """Order-independent sum of a money-like double."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def keyed(prefix: str, number: str) -> Column:
    """Series id from a numeric key; plain concatenation keeps wide scans cheap."""
    return F.concat(F.lit(prefix), F.col(number).cast("string"))


# --- observations ---------------------------------------------------------------

def order_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value per priority: ``series_id, as_of, value``."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("series_id"),
                 F.col("o_orderdate").cast("date").alias("as_of"))
        .agg(exact_sum("o_totalprice").alias("value"))
    )


def order_value_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series over all orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("as_of"))
        .agg(exact_sum("o_totalprice").alias("value"))
        .select(F.lit("orders_total").alias("series_id"), "as_of", "value")
    )


def order_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly order value as known at three publication dates, one per order status.

    ``series_id, date, realtime_start, realtime_end, value``.
    """
    lag = F.when(F.col("o_orderstatus") == "F", 10).when(F.col("o_orderstatus") == "O", 40).otherwise(70)
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderpriority").alias("series_id"),
                week_ending_friday(day).alias("date"), lag.alias("lag"), "o_totalprice")
        .groupBy("series_id", "date", "lag")
        .agg(exact_sum("o_totalprice").alias("value"))
        .select("series_id", "date",
                F.date_add(month_end("date"), F.col("lag")).alias("realtime_start"),
                F.date_add(month_end("date"), F.col("lag") + 29).alias("realtime_end"),
                "value")
    )


# --- daily bars -----------------------------------------------------------------

#: Room for any price in cents below an order line's own number.
TIE_SPACE = 10 ** 15


def landed_bars(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """Raw bar rows per supplier, several per day, with holes in the price columns.

    ``gathered`` brings the rows of a series into one partition while they are narrow, before any column is derived:
    the fold by day and every window or join by series then need no shuffle of their own. All rows of a hot series
    pass through one task, which folds them as they stream in and holds one row per day.
    """
    price = F.col("l_extendedprice")
    day = F.col("as_of")
    series = keyed("eq_", "l_suppkey")
    raw = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("as_of"),
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    return (raw.repartition(series) if gathered else raw).select(
        series.alias("series_id"),
        "as_of",
        # One number that tells all rows apart, whatever the keys and prices; a decimal keeps the fold a hash aggregate.
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(20,0)") * F.lit(TIE_SPACE).cast("decimal(16,0)")
         + F.round(price * 100).cast("decimal(15,0)")).cast("decimal(38,0)").alias("arrival"),
        F.when(F.col("l_tax") < 0.08, price * (1 - F.col("l_discount"))).alias("open"),
        (price * (1 + F.col("l_tax"))).alias("high"),
        F.when(F.col("l_linenumber") < 6, price * (1 - F.col("l_tax"))).alias("low"),
        F.when(~((F.col("l_linenumber") == 7) & (F.col("l_discount") > 0.08)), price).alias("close"),
        F.when(F.col("l_tax") > 0, price * (1 - F.col("l_discount") / 10)).alias("adj_close"),
        F.col("l_quantity").alias("volume"),
        F.when(F.col("l_orderkey") % 997 == 0, 2.0).otherwise(0.0).alias("split_ratio"),
        F.when(F.dayofmonth(day) >= 28, price * F.col("l_discount") / 100).otherwise(0.0).alias("dividend"),
    )


def venue_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve dense daily series on two venues: ``series_id, symbol, as_of, close``."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.concat(F.lower("l_returnflag"), (F.col("l_linenumber") % 2).cast("string")).alias("code"),
                F.col("l_linestatus").alias("venue"), F.col("l_shipdate").cast("date").alias("as_of"),
                "l_extendedprice")
        .groupBy("code", "venue", "as_of")
        .agg(exact_sum("l_extendedprice").alias("close"))
        .select(F.concat(F.lit("vx_"), "code", F.lit("_"), F.lower("venue")).alias("series_id"),
                F.concat(F.upper("code"), F.lit("."), "venue").alias("symbol"), "as_of", "close")
    )


# --- bitemporal log ---------------------------------------------------------------

LOG_CUTOFF = dt.date(2024, 1, 20)
PULL_DATE = dt.date(2024, 2, 5)


def reading_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per user and day, each with the day it was recorded.

    ``series_id, as_of, recorded_on, value, value_tr``; the newest event wins inside a key.
    """
    day = F.col("ts").cast("date")
    return (
        table(spark, sf_dir, "events")
        .select(keyed("ev_", "user_id").alias("series_id"), day.alias("as_of"),
                F.date_add(day, (F.col("event_id") % 3).cast("int")).alias("recorded_on"),
                "event_id", "value")
        .groupBy("series_id", "as_of", "recorded_on")
        .agg(F.max(F.struct("event_id", "value")).alias("newest"))
        .select("series_id", "as_of", "recorded_on", F.col("newest.value").alias("value"),
                (F.col("newest.value") / ((10000 + 7 * (F.col("newest.event_id") % 5)) / 10000)).alias("value_tr"))
    )


# --- weekly positioning -------------------------------------------------------------

def landed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly report rows per brand and contract name, numbers as text with commas."""
    def leg(flag: str, odd: int) -> Column:
        wanted = (F.col("l_returnflag") == flag) & (F.col("l_linenumber") % 2 == odd)
        total = F.sum(F.when(wanted, F.col("l_quantity")).otherwise(0.0))
        return F.when(total > 0, F.format_number(total * 100, 0)).otherwise(F.lit(""))

    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("report_date", week_ending_friday(F.col("l_shipdate").cast("date")))
        .withColumn("contract_name", F.concat(
            F.upper("p_brand"), F.lit(" "), "p_type",
            F.when((F.col("l_linestatus") == "O") & (F.col("p_type") == "SMALL"), F.lit(" MICRO")).otherwise(F.lit(""))))
        .groupBy(F.col("p_brand").alias("market"), "report_date", "contract_name")
        .agg(
            F.format_number(F.sum("l_quantity") * 100, 0).alias("open_interest_all"),
            leg("R", 1).alias("lev_money_positions_long"),
            leg("R", 0).alias("lev_money_positions_short"),
            leg("A", 1).alias("asset_mgr_positions_long"),
            leg("A", 0).alias("asset_mgr_positions_short"),
            leg("N", 1).alias("dealer_positions_long_all"),
            leg("N", 0).alias("dealer_positions_short_all"),
            leg("R", 0).alias("m_money_positions_long_all"),
            leg("R", 1).alias("m_money_positions_short_all"),
            leg("A", 0).alias("prod_merc_positions_long"),
            leg("A", 1).alias("prod_merc_positions_short"),
            leg("N", 0).alias("swap_positions_long_all"),
            leg("N", 1).alias("swap__positions_short_all"),
        )
    )


# --- instrument registry and identity snapshots --------------------------------------

SUFFIXES = ["", "", ".L", ".PA", ".DE", ".XY"]
CURRENCIES = [None, None, "GBP", "EUR", "EUR", "CHF"]
BASES = [None, None, "GBX", "EUR", "EUR", "CHF"]


def pick(options: list, index) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured price series, one per supplier."""
    place = F.col("s_nationkey") % 6
    stock = F.col("s_suppkey") % 4 != 0
    return table(spark, sf_dir, "supplier").select(
        keyed("eq_", "s_suppkey").alias("series_id"),
        F.concat(F.format_string("Q%d", "s_suppkey"), pick(SUFFIXES, place)).alias("symbol"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("category"),
        F.when(stock, F.lit("stock")).alias("family"),
        F.when(stock, pick(CURRENCIES, place)).alias("currency"),
        F.when(stock, pick(BASES, place)).alias("quote_basis"),
        (F.col("s_suppkey") % 31 == 30).alias("retired"),
        F.col("s_suppkey").alias("number"),
        F.col("s_acctbal").alias("balance"),
    )


FIRST_SNAPSHOT = dt.date(2024, 1, 2)
SECOND_SNAPSHOT = dt.date(2024, 2, 1)


def _member(prefix: str, number) -> Column:
    return F.format_string(prefix + "%07d", number)


def first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe snapshot over customers: ``ticker, exch_code, name, isin, share_class_figi``."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _member("A", k).alias("ticker"), F.lit("US").alias("exch_code"), F.col("c_name").alias("name"),
        F.when(k % 3 != 0, _member("IS", k)).alias("isin"),
        F.when(k % 23 != 0, _member("FG", k - k % 37 % 2)).alias("share_class_figi"),
    )


def second_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next snapshot: members in debt are gone, some are renamed, recycled or doubled."""
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer")
    figi = F.when(k % 23 != 0, _member("FG", k - k % 37 % 2))
    renamed = k % 11 == 0
    kept = base.filter(F.col("c_acctbal") >= 0).select(
        F.when(renamed, _member("Z", k)).otherwise(_member("A", k)).alias("ticker"),
        F.lit("US").alias("exch_code"),
        F.when(k % 29 == 7, F.concat("c_name", F.lit(" NEW PLC"))).otherwise(F.col("c_name")).alias("name"),
        F.when((k % 3 != 0) & (k % 41 != 3), _member("IS", k)).alias("isin"),
        F.when(k % 17 == 4, _member("FX", k)).when(k % 19 == 6, F.lit(None)).otherwise(figi)
        .alias("share_class_figi"),
    )
    doubled = base.filter(renamed & F.col("c_mktsegment").isin("MACHINERY", "FURNITURE")).select(
        _member("ZB", k).alias("ticker"), F.lit("US").alias("exch_code"),
        F.concat("c_name", F.lit(" CLASS B")).alias("name"),
        F.lit(None).cast("string").alias("isin"), figi.alias("share_class_figi"),
    )
    return kept.unionByName(doubled)
