"""Calendar resampling of observations: weeks ending Friday, months, seasonal norms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.dates import contract_code, iso_week, month_end, week_ending_friday
from seriesloom.functions.frames import in_order, whole


def weekly_last(obs: DataFrame, columns: list[str] | None = None,
                completed_before: dt.date | None = None) -> DataFrame:
    """Last value of each week ending Friday, per column, skipping NULLs.

    With ``completed_before`` only weeks whose Friday lies strictly before that day are kept.
    """
    columns = columns or ["value"]
    weekly = (
        obs.filter(F.coalesce(*columns).isNotNull())
        .groupBy("series_id", week_ending_friday("as_of").alias("week"))
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("as_of"))).alias(c) for c in columns])
        .withColumnRenamed("week", "as_of")
    )
    if completed_before is not None:
        weekly = weekly.filter(F.col("as_of") < F.lit(completed_before))
    return weekly


def monthly_mean(obs: DataFrame, digits: int = 6) -> DataFrame:
    """Mean of each calendar month, labelled at the month end."""
    return (
        obs.groupBy("series_id", month_end("as_of").alias("month"))
        .agg(F.round(F.avg("value"), digits).alias("value"))
        .withColumnRenamed("month", "as_of")
    )


def monthly_last(obs: DataFrame, digits: int = 6) -> DataFrame:
    """One value per month: the last row of a month wins."""
    return (
        obs.groupBy("series_id", month_end("as_of").alias("month"))
        .agg(F.round(F.max_by("value", "as_of"), digits).alias("value"))
        .withColumnRenamed("month", "as_of")
    )


def drop_open_month(monthly: DataFrame, run_date: dt.date) -> DataFrame:
    """Keep months that ended before the month of ``run_date``."""
    return monthly.filter(F.col("as_of") < F.trunc(F.lit(run_date), "month"))


def label_month_end(obs: DataFrame) -> DataFrame:
    return obs.withColumn("month_end", month_end("as_of"))


def vintage_monthly_mean(vintages: DataFrame, digits: int = 6) -> DataFrame:
    """Month mean inside each vintage: only rows published with that vintage count."""
    return (
        vintages.groupBy("series_id", "realtime_start", month_end("date").alias("as_of"))
        .agg(F.round(F.avg("value"), digits).alias("value"),
             F.max("realtime_end").alias("realtime_end"))
        .withColumnRenamed("realtime_start", "recorded_on")
    )


#: Values are summed exactly at this scale; a row's value is read at ten decimals.
EXACT = "decimal(28,10)"


def vintage_monthly_as_known(vintages: DataFrame, digits: int = 6) -> DataFrame:
    """Month mean over every row known at each vintage of the same series and month.

    A sweep over publication events: a row adds its value on the day it is published and takes it back
    the day after it expires, and one running sum per series and month gives the mean at every
    vintage. Sums are decimals, so what is taken back leaves nothing. A row without an end stays known.
    """
    month, value = month_end("date").alias("as_of"), F.col("value").cast(EXACT)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    events = F.array(
        F.struct(F.col("realtime_start").alias("recorded_on"), value.alias("moved"),
                 F.when(value.isNull(), none).otherwise(one).alias("n"), F.lit(True).alias("vintage")),
        F.struct(F.date_add("realtime_end", 1).alias("recorded_on"), (-value).cast(EXACT).alias("moved"),
                 F.when(value.isNull(), none).otherwise(-one).alias("n"), F.lit(False).alias("vintage")))
    known = F.col("realtime_end").isNull() | (F.col("realtime_end") >= F.col("realtime_start"))
    days = (vintages.filter(known).select("series_id", month, F.inline(F.filter(events, lambda e: e["recorded_on"].isNotNull())))
            .groupBy("series_id", "as_of", "recorded_on")
            .agg(F.sum("moved").alias("moved"), F.sum("n").alias("n"), F.max("vintage").alias("vintage")))
    so_far = Window.partitionBy("series_id", "as_of").orderBy("recorded_on").rowsBetween(Window.unboundedPreceding, 0)
    running = days.select("series_id", "as_of", "recorded_on", "vintage", F.sum("moved").over(so_far).alias("total"),
                          F.sum("n").over(so_far).alias("count"))
    mean = F.col("total").cast("double") / F.when(F.col("count") > 0, F.col("count"))
    return running.filter("vintage").select("series_id", "as_of", "recorded_on", F.round(mean, digits).alias("value"))


def baseline(obs: DataFrame, start: dt.date, end: dt.date, min_coverage: float = 0.9) -> DataFrame:
    """Mean over a date window; ``covered`` is false when too many days are missing."""
    expected = (end - start).days + 1
    return (
        obs.filter(F.col("as_of").between(F.lit(start), F.lit(end)) & F.col("value").isNotNull())
        .groupBy("series_id")
        .agg(F.avg("value").alias("base"), F.count("value").alias("days"))
        .withColumn("expected_days", F.lit(expected).cast("long"))
        .withColumn("covered", F.col("days") >= min_coverage * F.col("expected_days"))
    )


def percent_of_baseline(obs: DataFrame, base: DataFrame) -> DataFrame:
    """Daily percent of the baseline, one decimal; uncovered series are left out."""
    usable = base.filter(F.col("covered") & (F.col("base") != 0)).select("series_id", "base")
    return obs.join(usable, "series_id").select(
        "series_id", "as_of", F.round(F.col("value") / F.col("base") * 100, 1).alias("value"))


def half_up_mean_of_tenths(value: Column) -> Column:
    """Mean of values with one decimal, rounded half up to one decimal on the exact quotient.

    Such means tie often (x.x5), so sums are kept in whole tenths.
    """
    tenths = (F.col(value) if isinstance(value, str) else value).cast("decimal(18,1)") * 10
    total, n = F.sum(tenths.cast("long")), F.count(value)
    rounded = F.call_function("div", 2 * F.abs(total) + n, 2 * n)
    return F.signum(total.cast("double")) * rounded / 10


def weekly_mean_completed(daily: DataFrame) -> DataFrame:
    """Mean of each week ending Friday, one decimal; the unfinished last week is dropped."""
    weeks = (
        daily.groupBy("series_id", week_ending_friday("as_of").alias("week"))
        .agg(half_up_mean_of_tenths("value").alias("value"), F.max("as_of").alias("newest"))
    )
    return (
        weeks.withColumn("newest", F.max("newest").over(whole()))
        .filter(F.col("value").isNotNull() & (F.col("week") <= F.col("newest")))
        .select("series_id", F.col("week").alias("as_of"), "value")
    )


def weekly_change(weekly: DataFrame) -> DataFrame:
    """Difference to the row before; the first row has none and is dropped."""
    return (
        weekly.withColumn("change", F.col("value") - F.lag("value").over(in_order()))
        .filter(F.col("change").isNotNull())
        .select("series_id", "as_of", "change")
    )


def seasonal_deviation(weekly: DataFrame, seasonal_years: int = 5, unit: float = 1000.0) -> DataFrame:
    """Weekly change minus the mean change of the same ISO week.

    The norm covers calendar years from the newest year minus ``seasonal_years`` on.
    """
    dated = weekly_change(weekly).withColumns({
        "week": iso_week("as_of"), "newest_year": F.max(F.year("as_of")).over(whole())})
    recent = F.when(F.year("as_of") >= F.col("newest_year") - seasonal_years, F.col("change"))
    same_week = Window.partitionBy("series_id", "week")
    norm = F.avg(recent).over(same_week)
    return dated.select("series_id", "as_of", F.round((F.col("change") - norm) / unit, 2).alias("value"))


def latest_level_and_change(weekly: DataFrame, unit: float = 1000.0) -> DataFrame:
    """Newest level and newest weekly change per series, scaled down by ``unit``."""
    changed = weekly.withColumn("change", F.col("value") - F.lag("value").over(in_order()))
    return changed.groupBy("series_id").agg(
        F.round(F.max_by("value", "as_of") / unit, 1).alias("last_level"),
        F.round(F.max_by("change", F.when(F.col("change").isNotNull(), F.col("as_of"))) / unit, 2)
        .alias("last_change"),
    )


def contracts_ahead(days: DataFrame, prefix: str, suffix: str, count: int = 6) -> DataFrame:
    """The next ``count`` monthly contract codes for every day in ``as_of``."""
    return (
        days.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(count))))
        .withColumn("delivery", F.add_months(F.trunc("as_of", "month"), F.col("ahead")))
        .select("as_of", F.col("ahead").cast("long").alias("ahead"), "delivery",
                contract_code(prefix, suffix, F.col("delivery")).alias("contract"))
    )


def two_leg_spread(first: DataFrame, second: DataFrame, digits: int = 3) -> DataFrame:
    """``first - second`` on the days both have a value."""
    legs = first.select("as_of", F.col("value").alias("a")).join(
        second.select("as_of", F.col("value").alias("b")), "as_of")
    return legs.dropna().select("as_of", F.round(F.col("a") - F.col("b"), digits).alias("value"))


def first_two_legs(contracts: DataFrame) -> DataFrame:
    """Rank contracts with data by code; ``usable`` is false when fewer than two have any."""
    present = contracts.filter(F.col("value").isNotNull()).groupBy("series_id").agg(
        F.count("value").alias("rows"))
    first_two = present.orderBy("series_id").limit(2)
    numbered = F.row_number().over(Window.orderBy("series_id"))  # two rows at most
    return first_two.withColumn("leg", numbered).withColumn(
        "usable", F.count("series_id").over(Window.partitionBy()) == 2).select(
        "series_id", "rows", F.col("leg").cast("long").alias("leg"), "usable")


def front_spread(contracts: DataFrame, digits: int = 3) -> DataFrame:
    """Spread of the first two contracts that have data; empty when there are fewer."""
    legs = first_two_legs(contracts).filter("usable").select("series_id", "leg")
    chosen = contracts.join(legs, "series_id").filter(F.col("value").isNotNull())
    return two_leg_spread(chosen.filter("leg = 1"), chosen.filter("leg = 2"), digits)


def dual_basis(price: DataFrame, adjusted: DataFrame | None, digits: int = 6) -> DataFrame:
    """Price and adjusted series on their common dates; a single basis mirrors itself."""
    left = price.filter(F.col("value").isNotNull()).select(
        "series_id", "as_of", F.round("value", digits).alias("value"))
    if adjusted is None:
        return left.withColumn("value_tr", F.col("value"))
    right = adjusted.filter(F.col("value").isNotNull()).select(
        "series_id", "as_of", F.round("value", digits).alias("value_tr"))
    return left.join(right, ["series_id", "as_of"])


def spread_provenance(weekly: DataFrame, cut: dt.date, forward_only: Column | None = None) -> DataFrame:
    """Mark weekly rows up to ``cut`` as the earlier source, unless the series is forward-only."""
    open_ended = F.lit(False) if forward_only is None else forward_only
    return weekly.withColumn("earlier_source", (F.col("as_of") <= F.lit(cut)) & ~open_ended)
