"""Ordered-series functions: percentiles, scores, streaks, fills."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.dates import month_end
from seriesloom.functions.frames import in_order, newest_first, recency, trailing, whole

MIN_OBS = 8
NOWCAST_INTERCEPT = 0.1252
NOWCAST_SLOPE = 0.5632


def _spread_ok(n: Column, low: Column, high: Column, min_obs: int) -> Column:
    """Enough values and not all equal; the equality test is exact."""
    return (n >= min_obs) & (low != high)


def counted_in_window(obs: DataFrame, window: int) -> DataFrame:
    """Adds ``at_most``: how many of each row's trailing ``window`` rows hold no larger value.

    A merge-sort tree by rows instead of a window kept on each row: the places of a series are grouped in
    blocks of 1, 2, 4 ... rows, and a window is at most two blocks of each size. Inside a block one
    ordered pass counts the values up to each one asked for. Rows grow by the logarithm of the
    window, and work is dealt by block, not by series. ``obs`` has one row per (series, day), without NULLs.
    """
    levels = range(window.bit_length())
    placed = obs.withColumn("_place", F.row_number().over(in_order()) - 1)
    first, end = F.greatest(F.col("_place") - (window - 1), F.lit(0)), F.col("_place") + 1

    def block(level: int, number: Column, asked: bool) -> Column:
        return F.struct(F.lit(level).alias("_level"), number.cast("long").alias("_block"), F.lit(asked).alias("_asked"))

    blocks = [block(level, F.floor(F.col("_place") / 2 ** level), False) for level in levels]
    for level in levels:
        left, right = F.ceil(first / 2 ** level), F.floor(end / 2 ** level)
        blocks += [F.when((left < right) & (left % 2 == 1), block(level, left, True)),
                   F.when((left < right) & (right % 2 == 1), block(level, right - 1, True))]
    kept = [c for c in obs.columns if c not in ("series_id", "as_of", "value")]
    carried = F.struct("value", *kept).alias("_row")
    rows = placed.select("series_id", "as_of", F.col("value").alias("_value"), carried, F.inline(F.array_compact(F.array(*blocks))))
    up_to = Window.partitionBy("series_id", "_level", "_block").orderBy("_value")  # equal values count
    counted = rows.withColumn("_count", F.count_if(~F.col("_asked")).over(up_to)).filter("_asked")
    return counted.groupBy("series_id", "as_of").agg(F.max("_row").alias("_row"), F.sum("_count").alias("at_most")).select(
        "series_id", "as_of", "_row.*", "at_most")


def trailing_percentile(obs: DataFrame, window: int, min_obs: int = MIN_OBS) -> DataFrame:
    """Inclusive rank percentile of each row within its trailing ``window`` rows."""
    frame = trailing(window)
    framed = obs.filter(F.col("value").isNotNull()).select(
        "series_id", "as_of", "value", F.count("value").over(frame).alias("n_obs"),
        F.min("value").over(frame).alias("low"), F.max("value").over(frame).alias("high"))
    scored = counted_in_window(framed, window)
    return scored.select(
        "series_id", "as_of", "value", "n_obs",
        F.when(_spread_ok(F.col("n_obs"), F.col("low"), F.col("high"), min_obs),
               F.round(100.0 * F.col("at_most") / F.col("n_obs"), 2)).alias("percentile"))


def trailing_zscore(obs: DataFrame, window: int, min_obs: int = MIN_OBS) -> DataFrame:
    """Z-score of each row within its trailing rows, population sigma."""
    frame = trailing(window)
    kept = obs.filter(F.col("value").isNotNull())
    n = F.count("value").over(frame)
    ok = _spread_ok(n, F.min("value").over(frame), F.max("value").over(frame), min_obs)
    z = (F.col("value") - F.avg("value").over(frame)) / F.stddev_pop("value").over(frame)
    return kept.select("series_id", "as_of", "value", n.alias("n_obs"),
                       F.when(ok, F.round(z, 4)).alias("zscore"))


def _newest_against_history(obs: DataFrame, window: int | None, min_obs: int, segment: Column, delta_rows: int) -> DataFrame:
    """The newest value ranked and scored among the last rows, in one ordered pass."""
    backwards = newest_first()
    ranked = obs.filter(F.col("value").isNotNull()).withColumns({
        "recency": F.row_number().over(backwards), "current": F.first("value").over(backwards),
        "delta": F.col("value") - F.lead("value", delta_rows).over(backwards)})
    if window is not None:
        ranked = ranked.filter(F.col("recency") <= window)
    summary = ranked.groupBy("series_id").agg(
        F.count("value").alias("n_obs"), F.max("as_of").alias("asof"), F.max("current").alias("net"),
        segment.alias("segment"), F.max(F.when(F.col("recency") == 1, F.col("delta"))).alias("delta"),
        F.count_if(F.col("value") <= F.col("current")).alias("at_most"),
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("sigma"),
        F.min("value").alias("low"), F.max("value").alias("high"))
    ok = _spread_ok(F.col("n_obs"), F.col("low"), F.col("high"), min_obs)
    return summary.select(
        "series_id", (F.lit(window) if window is not None else F.col("n_obs")).cast("long").alias("window"),
        F.when(ok, F.round(100.0 * F.col("at_most") / F.col("n_obs"), 2)).alias("percentile"),
        F.when(ok, F.round((F.col("net") - F.col("mean")) / F.col("sigma"), 4)).alias("zscore"),
        "n_obs", "asof", "segment", "net", "delta")


def percentile_window(obs: DataFrame, window: int | None, min_obs: int = MIN_OBS) -> DataFrame:
    """Percentile and z-score of the newest value among the last ``window`` rows.

    ``window=None`` ranks against the full history. ``obs`` may carry ``segment``, the
    name of the clean segment it was restricted to.
    """
    segment = F.max("segment") if "segment" in obs.columns else F.lit("single-contract")
    return _newest_against_history(obs, window, min_obs, segment, 1).drop("delta")


def positioning_view(obs: DataFrame, window: int | None = None, delta_rows: int = 4) -> DataFrame:
    """Newest net with percentile, z-score and change against four rows earlier."""
    view = _newest_against_history(obs, window, MIN_OBS, F.lit("single-contract"), delta_rows)
    return view.withColumnRenamed("delta", "delta_4w").drop("segment")


def average_rank_percent(obs: DataFrame) -> DataFrame:
    """Average-rank percentile over the full history, with the reading 0, 2 and 4 rows back."""
    by_value = Window.partitionBy("series_id").orderBy("value")
    ties = F.count("value").over(Window.partitionBy("series_id", "value"))
    ranked = obs.filter(F.col("value").isNotNull()).select(
        "series_id", "as_of", "value",
        ((F.rank().over(by_value) + (ties - 1) / 2) / F.count("value").over(whole()) * 100).alias("pct"))
    return ranked.select("series_id", "as_of", "value", F.round("pct", 1).alias("percentile"),
                         recency().cast("long").alias("recency"))


def average_rank_summary(obs: DataFrame) -> DataFrame:
    ranked = average_rank_percent(obs)

    def back(rows: int) -> Column:
        return F.max(F.when(F.col("recency") == rows + 1, F.col("percentile")))

    return ranked.groupBy("series_id").agg(
        back(0).alias("pctile_last"), back(2).alias("pctile_2_back"), back(4).alias("pctile_4_back"),
        F.max_by("value", "as_of").alias("net_last"), F.max("as_of").alias("report_date"))


def tail_rows(obs: DataFrame, rows: int) -> DataFrame:
    """The newest ``rows`` rows of each series."""
    return obs.withColumn("recency", recency()).filter(F.col("recency") <= rows).drop("recency")


def tail_mean(obs: DataFrame, rows: int, digits: int) -> DataFrame:
    return tail_rows(obs, rows).groupBy("series_id").agg(
        F.round(F.avg("value"), digits).alias("tail_mean"), F.count("value").alias("n_rows"))


def change_over_rows(obs: DataFrame, rows: int, digits: int = 6) -> DataFrame:
    """Percent change against the row ``rows`` earlier, by position; zero bases are skipped."""
    base = F.lag("value", rows).over(in_order())
    return (
        obs.withColumn("base", base)
        .filter(F.col("base").isNotNull() & (F.col("base") != 0))
        .select("series_id", "as_of",
                F.round((F.col("value") / F.col("base") - 1.0) * 100.0, digits).alias("value"))
    )


def nowcast(levels: DataFrame, digits: int = 6) -> DataFrame:
    """Linear nowcast from the month-on-month change; every reading is provisional."""
    base = F.lag("value", 1).over(in_order())
    return (
        levels.withColumn("base", base)
        .filter(F.col("base").isNotNull() & (F.col("base") != 0))
        .select("series_id", "as_of",
                F.round(NOWCAST_INTERCEPT + NOWCAST_SLOPE * ((F.col("value") / F.col("base") - 1.0) * 100.0),
                        digits).alias("value"),
                F.lit(True).alias("provisional"))
    )


def trailing_streak(obs: DataFrame, holds: Column, name: str = "streak") -> DataFrame:
    """Length of the newest run of rows for which ``holds`` is true."""
    return (
        obs.withColumn("recency", recency())
        .groupBy("series_id")
        .agg(F.coalesce(F.min(F.when(~F.coalesce(holds, F.lit(False)), F.col("recency"))) - 1,
                        F.count(F.lit(1))).cast("long").alias(name))
    )


def persistence(obs: DataFrame, rows: int, high: float, low: float) -> DataFrame:
    """Whether the last ``rows`` rows all sit at or above ``high``, or at or below ``low``."""
    recent = tail_rows(obs.filter(F.col("value").isNotNull()), rows)
    return recent.groupBy("series_id").agg(
        ((F.count("value") >= rows) & (F.min("value") >= high)).alias("held_high"),
        ((F.count("value") >= rows) & (F.max("value") <= low)).alias("held_low"),
        F.max_by("value", "as_of").alias("last_value"))


def largest_gap(obs: DataFrame, max_gap_days: int = 60) -> DataFrame:
    """Longest hole between neighbouring dates, reported when it exceeds the limit."""
    steps = obs.filter(F.col("as_of").isNotNull()).select(
        "series_id", F.col("as_of").alias("to_date"), F.lag("as_of").over(in_order()).alias("from_date"))
    return (
        steps.filter(F.col("from_date").isNotNull())
        .groupBy("series_id")
        .agg(F.max(F.struct(F.datediff("to_date", "from_date").alias("gap_days"), "from_date", "to_date"))
             .alias("gap"))
        .select("series_id", F.col("gap.gap_days").cast("long").alias("gap_days"),
                F.col("gap.from_date").alias("from_date"), F.col("gap.to_date").alias("to_date"))
        .filter(F.col("gap_days") > max_gap_days)
    )


def cohort_frontier(monthly: DataFrame, anchors: DataFrame) -> DataFrame:
    """Latest month reached by any anchor series, as a one-row frame ``frontier``."""
    reached = monthly.filter(F.col("value").isNotNull())
    return reached.join(anchors.select("series_id").distinct(), "series_id", "left_semi").agg(
        F.max(month_end("as_of")).alias("frontier"))


def last_of_month(monthly: DataFrame) -> DataFrame:
    """One row per series and month, labelled at the month end: the last row of the month."""
    payload = [c for c in monthly.columns if c not in ("series_id", "as_of")]
    return monthly.groupBy("series_id", month_end("as_of").alias("month")).agg(
        F.max_by(F.struct(*payload), "as_of").alias("last")).select("series_id", F.col("month").alias("as_of"), "last.*")


def carry_forward(monthly: DataFrame, frontier: dt.date | Column, cohort: DataFrame | None = None) -> DataFrame:
    """Fill missing months with the last record, up to the frontier and never past it.

    Later real months are kept. A fill repeats the whole last record and is flagged. Only series of
    ``cohort`` (all without one) are touched; others keep their rows and days as they are. Without a
    frontier (no anchor has a row) nothing is filled. A row without a value is a missing month.
    """
    monthly = monthly.filter(F.col("value").isNotNull())
    if cohort is not None:
        names = cohort.select("series_id").distinct()
        rest = monthly.join(names, "series_id", "left_anti")
        return carry_forward(monthly.join(names, "series_id", "left_semi"), frontier).unionByName(
            rest, allowMissingColumns=True)
    edge = F.lit(frontier) if isinstance(frontier, dt.date) else frontier
    by_month = last_of_month(monthly)
    following = F.lead("as_of").over(in_order())
    before_next = F.coalesce(F.last_day(F.add_months(F.trunc(following, "month"), -1)), edge)
    reach = F.when(edge.isNull(), F.col("as_of")).otherwise(F.least(before_next, edge))
    months = F.sequence(F.trunc("as_of", "month"), F.trunc(F.greatest("as_of", reach), "month"), F.expr("INTERVAL 1 MONTH"))
    walked = by_month.withColumn("months", months).withColumn("first_day", F.explode("months"))
    real = month_end("first_day") == F.col("as_of")
    payload = [c for c in monthly.columns if c not in ("series_id", "as_of", "filled", "provisional")]
    old_fill = F.col("filled") if "filled" in monthly.columns else F.lit(None).cast("string")
    old_mark = F.col("provisional") if "provisional" in monthly.columns else F.lit(False)
    return walked.select(
        "series_id", month_end("first_day").alias("as_of"), *payload,
        F.when(real, old_fill).otherwise(F.lit("carry_forward")).alias("filled"),
        F.when(real, old_mark).otherwise(F.lit(True)).alias("provisional"))


def chained_nowcast(levels: DataFrame, rates: DataFrame, digits: int = 6) -> DataFrame:
    """Extend each series past its last real month by compounding later monthly rates.

    Every step is rounded, so the walk is a fold over the months of one series.
    """
    last = levels.filter(F.col("value").isNotNull()).groupBy("series_id").agg(
        F.max(month_end("as_of")).alias("last_month"), F.max_by("value", "as_of").alias("level"))
    ahead = (
        rates.select("series_id", month_end("as_of").alias("as_of"), F.col("value").alias("rate"))
        .join(last, "series_id").filter(F.col("as_of") > F.col("last_month"))
        .groupBy("series_id", "level")
        .agg(F.array_sort(F.collect_list(F.struct("as_of", "rate"))).alias("steps"))
    )
    empty = F.array().cast("array<struct<as_of:date,value:double>>")

    def step(walked, month):
        before = F.coalesce(F.element_at(walked, -1)["value"], F.col("level"))
        grown = F.round(before * (1 + month["rate"] / 100.0), digits)
        return F.concat(walked, F.array(F.struct(month["as_of"].alias("as_of"), grown.alias("value"))))

    walked = F.aggregate("steps", empty, lambda acc, m: F.when(F.size(acc) == 0, F.array(F.struct(
        m["as_of"].alias("as_of"),
        F.round(F.col("level") * (1 + m["rate"] / 100.0), digits).alias("value")))).otherwise(step(acc, m)))
    return (
        ahead.select("series_id", F.inline(walked))
        .withColumn("filled", F.lit("nowcast"))
        .withColumn("provisional", F.lit(True))
    )


def flag_newest(obs: DataFrame) -> DataFrame:
    """Mark the newest row of each series as provisional, all others as final."""
    return obs.withColumn("provisional", F.col("as_of") == F.max("as_of").over(whole()))
