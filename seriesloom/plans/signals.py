"""The signal run: daily and weekly feeds to voter states, a verdict, dials and a freshness report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import quality, resample, signals, windows
from seriesloom.session import cut_lineage


@dataclass(frozen=True)
class Rules:
    """Thresholds of the voters; the defaults are those of a spread in currency units and inventories in millions."""

    spread: dict = field(default_factory=lambda: {"bull_at": 1.5, "bear_at": 0.5})
    percentile: dict = field(default_factory=lambda: {"bull_below": 50, "bull_rows": 4, "bear_above": 75, "bear_rows": 3})
    percentile_window: int = 52
    change: dict = field(default_factory=lambda: {"bull_at": 8, "bear_at": 2})
    jump: dict = field(default_factory=dict)
    falsifier: dict = field(default_factory=dict)
    flow_unit: float = 1.0


@dataclass
class SignalRun:
    states: DataFrame
    verdict: DataFrame
    dials: DataFrame
    freshness: DataFrame


def voter_states(daily: DataFrame, expected: DataFrame, rules: Rules) -> DataFrame:
    """``series_id, voter, state`` of the five voters over one table of daily values, NODATA where a series has none."""
    weekly = resample.weekly_last(daily)
    percentiles = windows.trailing_percentile(weekly, rules.percentile_window).select(
        "series_id", "as_of", F.col("percentile").alias("value"))
    changes = resample.weekly_change(weekly).withColumnRenamed("change", "value")
    found = {
        "S1": signals.threshold_state(daily, **rules.spread),
        "S2": signals.consecutive_state(percentiles, **rules.percentile),
        "S3": signals.seasonal_state(resample.seasonal_deviation(weekly)),
        "S6": signals.threshold_state(changes, **rules.change)}
    # Written once: one row per series and voter, read by the last voter and by the vote. (An aggregate straight
    # over a union of frames that share a partitioning gave rows twice inside a larger plan.)
    states = cut_lineage(_named({voter: signals.with_no_data(expected, state) for voter, state in found.items()}))
    jump = signals.percentile_state(windows.average_rank_summary(weekly), signals.tightness(states, ["S1", "S3"]), **rules.jump)
    return states.unionByName(_named({"S5": signals.with_no_data(expected, jump)}))


def _named(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [frame.select("series_id", F.lit(voter).alias("voter"), "state") for voter, frame in frames.items()])


def signal_run(daily: DataFrame, expected: DataFrame, rules: Rules, today: dt.date, stale_days: int = 11) -> SignalRun:
    """All voters over one written table of daily values; a series without a feed reads NODATA everywhere.

    ``daily``: series_id, as_of, value. ``expected`` names the series a verdict is due for.
    """
    held = cut_lineage(daily.filter(F.col("value").isNotNull()))
    wanted = expected.select("series_id").distinct()
    states = voter_states(held, wanted, rules)
    verdict = signals.composite(states, signals.price_falsifier(held, **rules.falsifier))
    percent = held.withColumn("value", F.round(F.col("value") / rules.flow_unit * 100, 1))
    dials = signals.dials(wanted, resample.seasonal_deviation(resample.weekly_last(held)), percent)
    return SignalRun(states, verdict, dials, quality.batch_freshness(held, today, stale_days))
