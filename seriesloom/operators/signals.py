"""Threshold states per series, their composite vote and dial readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.frames import recency
from seriesloom.operators.resample import half_up_mean_of_tenths
from seriesloom.operators.windows import persistence, tail_rows, trailing_streak

BULL, BEAR, NEUTRAL, NODATA = "BULL", "BEAR", "NEUTRAL", "NODATA"


def _state(bull: Column, bear: Column) -> Column:
    return F.when(bull, F.lit(BULL)).when(bear, F.lit(BEAR)).otherwise(F.lit(NEUTRAL))


def with_no_data(expected: DataFrame, states: DataFrame) -> DataFrame:
    """Every expected series has a state; those without rows read NODATA."""
    return expected.select("series_id").join(states, "series_id", "left").withColumn(
        "state", F.coalesce("state", F.lit(NODATA)))


def threshold_state(spread: DataFrame, bull_at: float, bear_at: float, rows: int = 5) -> DataFrame:
    """BULL (BEAR) when the last rows all sit at or above (below) a threshold."""
    return persistence(spread, rows, high=bull_at, low=bear_at).select(
        "series_id", "last_value", _state(F.col("held_high"), F.col("held_low")).alias("state"))


def consecutive_state(weekly: DataFrame, bull_below: float = 50, bull_rows: int = 4, bear_above: float = 75,
                      bear_rows: int = 3) -> DataFrame:
    """BULL when the last readings all lie under one level, BEAR when over the other."""
    ranked = weekly.filter(F.col("value").isNotNull()).withColumn("recency", recency())
    tight = F.count_if((F.col("recency") <= bull_rows) & (F.col("value") < bull_below)) == bull_rows
    loose = F.count_if((F.col("recency") <= bear_rows) & (F.col("value") > bear_above)) == bear_rows
    return ranked.groupBy("series_id").agg(_state(tight, loose).alias("state"))


def seasonal_state(deviation: DataFrame, window: int = 4, bull_mean: float = -3.0, bear_builds: int = 2) -> DataFrame:
    """BULL on a low trailing mean deviation, BEAR on consecutive positive ones."""
    recent = tail_rows(deviation, window).groupBy("series_id").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"))
    builds = trailing_streak(deviation, F.col("value") > 0, "builds")
    full = F.col("n") >= window
    return recent.join(builds, "series_id").select(
        "series_id", F.when(full, F.round("mean", 4)).otherwise(0.0).alias("mean_deviation"), "builds",
        _state(full & (F.col("mean") <= bull_mean), F.col("builds") >= bear_builds).alias("state"))


def percentile_state(summary: DataFrame, others_tight: DataFrame, from_below: float = 40, jump: float = 20,
                     flat_band: float = 5) -> DataFrame:
    """BULL on a jump from a low percentile; BEAR when flat while the other series are tight.

    ``others_tight`` holds ``series_id, others_tight``.
    """
    now, two, four = F.col("pctile_last"), F.col("pctile_2_back"), F.col("pctile_4_back")
    bull = F.coalesce((two < from_below) & (now - two >= jump), F.lit(False))
    bear = F.coalesce(F.col("others_tight") & (F.abs(now - four) < flat_band), F.lit(False))
    return summary.join(others_tight, "series_id", "left").select("series_id", _state(bull, bear).alias("state"))


def price_falsifier(closes: DataFrame, dead_below: float = 80, dead_rows: int = 15, confirm_above: float = 95,
                    confirm_rows: int = 5) -> DataFrame:
    """Trailing streaks under and over two price levels, and what they imply."""
    below = trailing_streak(closes, F.col("value") < dead_below, "below")
    above = trailing_streak(closes, F.col("value") > confirm_above, "above")
    return below.join(above, "series_id").select(
        "series_id", "below", "above", (F.col("below") >= dead_rows).alias("dead"),
        (F.col("above") >= confirm_rows).alias("confirm"))


def tightness(states: DataFrame, voters: list[str]) -> DataFrame:
    """Whether any of the given voters reads BULL, per series."""
    tight = F.max((F.col("state") == BULL) & F.col("voter").isin(voters))
    return states.groupBy("series_id").agg(tight.alias("others_tight"))


def composite(states: DataFrame, falsifier: DataFrame, silent: str = "S5", must_include: tuple[str, ...] = ("S1", "S2"),
              bull_needed: int = 3, bear_needed: int = 3) -> DataFrame:
    """Vote over ``series_id, voter, state``. One voter is shown but not counted."""
    votes = F.col("voter") != silent
    counts = states.groupBy("series_id").agg(
        F.count_if(votes & (F.col("state") == BULL)).alias("bulls"),
        F.count_if(votes & (F.col("state") == BEAR)).alias("bears"),
        F.count_if(F.col("state") != NODATA).alias("active"), F.count_if(F.col("state") == NODATA).alias("nodata"),
        F.coalesce(F.max((F.col("state") == BULL) & F.col("voter").isin(*must_include)), F.lit(False)).alias("lead"))
    dead, confirm = F.coalesce("dead", F.lit(False)), F.coalesce("confirm", F.lit(False))
    verdict = (F.when(dead, F.lit("DEAD")).when((F.col("bulls") >= bull_needed) & F.col("lead"), F.lit("PROVEN"))
               .when(F.col("bears") >= bear_needed, F.lit("DEAD")).otherwise(F.lit("WAIT")))
    return counts.join(falsifier.select("series_id", "dead", "confirm"), "series_id", "left").select(
        "series_id", verdict.alias("verdict"), "bulls", "bears", "active", "nodata",
        (confirm & (verdict == "WAIT")).alias("price_confirms"))


def dials(series: DataFrame, deviation: DataFrame, percent: DataFrame) -> DataFrame:
    """Stock and flow readings between 0 and 1; 0.5 for a flow without data."""
    stock = tail_rows(deviation, 4).groupBy("series_id").agg(F.avg("value").alias("mean4"))
    flow = tail_rows(percent, 7).groupBy("series_id").agg(half_up_mean_of_tenths("value").alias("pct7"))

    def clamp(x: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))

    joined = series.select("series_id").join(stock, "series_id", "left").join(flow, "series_id", "left")
    return joined.select(
        "series_id", F.round(clamp((2.0 - F.coalesce("mean4", F.lit(0.0))) / 8.0), 6).alias("stock_dial"),
        F.round(clamp(F.coalesce(1.0 - F.col("pct7") / 100.0, F.lit(0.5))), 6).alias("flow_dial"))
