"""Daily bars: duplicate days, splits, dividends, total return and split healing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.dates import lookback_start
from seriesloom.functions.frames import first_of_each, in_order, later_rows, newest_first, whole
from seriesloom.schemas import BAR_PRICES

SPLIT_EPS = 1e-9
ADJUSTED_SCORE = 0.7
MIN_DIVIDEND_SHARE = 0.001
FRESH_DAYS = 60
FRESH_TOLERANCE = 0.02

LAST_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]
EVENT_COLUMNS = ["split_ratio", "dividend"]


# --- from landed rows to bars -------------------------------------------------------

def collapse_days(landed: DataFrame) -> DataFrame:
    """One row per series and day: last non-null price columns, largest event columns.

    ``arrival`` is the landing sequence number of a row; being one number it keeps the
    whole step a hash aggregate with a map-side part.
    """
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("arrival"))).alias(c) for c in LAST_COLUMNS]
    events = [F.max(c).alias(c) for c in EVENT_COLUMNS]
    return landed.groupBy("series_id", "as_of").agg(*last, *events)


def clashing_days(rows: DataFrame) -> DataFrame:
    """Every day that carries different values: ``series_id, as_of, low, high``."""
    days = rows.filter(F.col("value").isNotNull()).groupBy("series_id", "as_of").agg(
        F.min("value").alias("low"), F.max("value").alias("high"))
    return days.filter(F.col("low") != F.col("high"))


def conflicting_days(rows: DataFrame, named: int = 5) -> DataFrame:
    """Series with a day that carries different values, and their first few such days (all: ``clashing_days``)."""
    clashes = clashing_days(rows)
    total = clashes.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_conflicts"))
    first = (first_of_each(clashes, ["series_id"], ["as_of"], named)
             .groupBy("series_id").agg(F.array_sort(F.collect_list(F.col("as_of").cast("string"))).alias("days")))
    return total.join(first, "series_id").select("series_id", "n_conflicts", F.array_join("days", ",").alias("days"))


def without_conflicts(rows: DataFrame) -> DataFrame:
    """Identical duplicates collapse to one row; series with a conflicting day are left out."""
    days = rows.filter(F.col("value").isNotNull()).groupBy("series_id", "as_of").agg(
        F.min("value").alias("value"), F.max("value").alias("high"))
    clean = days.groupBy("series_id").agg(F.max(F.col("value") != F.col("high")).alias("clash"))
    return days.join(clean.filter(~F.col("clash")), "series_id", "left_semi").drop("high")


def split_factors(days: DataFrame) -> DataFrame:
    """Product of the split ratios strictly after each day; missing or non-positive ratios count as 1."""
    ratio = F.when(F.col("split_ratio") > 0, F.col("split_ratio")).otherwise(1.0)
    return days.withColumn(
        "split_factor", F.round(F.coalesce(F.product(ratio).over(later_rows()), F.lit(1.0)), 8))


def fill_bars(days: DataFrame, digits: int = 6) -> DataFrame:
    """Missing prices fall back to the close; a day without a close is dropped."""
    close = F.col("close")

    def price(name: str) -> Column:
        return F.round(F.coalesce(F.col(name), close), digits)

    kept = [c for c in ("split_factor",) if c in days.columns]
    return days.filter(close.isNotNull()).select(
        "series_id", "as_of", price("close").alias("value"), price("open").alias("open"),
        price("high").alias("high"), price("low").alias("low"), price("close").alias("close"),
        price("adj_close").alias("value_tr"), F.coalesce("volume", F.lit(0)).cast("long").alias("volume"),
        F.round(F.coalesce("dividend", F.lit(0.0)), digits).alias("dividend"), *kept)


def build_bars(landed: DataFrame, source: str = "vendor") -> DataFrame:
    """Landed rows to daily bars, with the newest bar of each series provisional."""
    bars = fill_bars(split_factors(collapse_days(landed)))
    return bars.withColumn("source", F.lit(source)).withColumn(
        "provisional", F.col("as_of") == F.max("as_of").over(whole()))


# --- total return ----------------------------------------------------------------------

def positive_close(bars: DataFrame) -> DataFrame:
    close = F.coalesce("close", "value")
    return bars.filter(close > 0).withColumn("close", close)


def _previous(column: str) -> Column:
    return F.lead(column).over(newest_first())


def rebuilt_total_return(bars: DataFrame) -> DataFrame:
    """Adds ``rebuilt``: the close carried back through every later dividend."""
    step = F.when((F.col("dividend") > 0) & (F.col("prev_close") > 0),
                  1.0 - F.col("dividend") / F.col("prev_close")).otherwise(1.0)
    return (
        bars.withColumn("prev_close", _previous("close"))
        .withColumn("rebuilt", F.col("close") * F.coalesce(F.product(step).over(later_rows()), F.lit(1.0)))
    )


def dividend_probe(bars: DataFrame) -> DataFrame:
    """Adds the usable ex-date score of each row: near 1 when the stored series adds dividends back."""
    steps = bars.withColumn("prev_close", _previous("close")).withColumn("prev_tr", _previous("value_tr"))
    usable = ((F.col("dividend") > 0) & (F.col("prev_close") > 0) & (F.col("close") > 0)
              & (F.col("prev_tr") > 0) & (F.col("value_tr") > 0)
              & (F.col("dividend") / F.col("prev_close") >= MIN_DIVIDEND_SHARE))
    measured = (F.col("prev_tr") / F.col("prev_close")) / (F.col("value_tr") / F.col("close"))
    theory = 1.0 - F.col("dividend") / F.col("prev_close")
    score = F.try_divide(measured - 1.0, theory - 1.0)
    return steps.withColumn("probe", F.when(usable, F.struct("as_of", score.alias("score"))))


def dividend_adjusted(bars: DataFrame) -> DataFrame:
    """Per series: the score on the most recent usable ex-date and the verdict."""
    return dividend_probe(bars).groupBy("series_id").agg(F.max("probe").alias("probe")).select(
        "series_id", F.col("probe.as_of").alias("probe_date"), F.round("probe.score", 6).alias("score"),
        F.coalesce(F.col("probe.score") >= ADJUSTED_SCORE, F.lit(False)).alias("adjusted"))


def _diverges(fresh_days: int, tolerance: float) -> Column:
    fresh = F.datediff(F.max("recorded_on").over(whole()), "recorded_on") <= fresh_days
    off = F.abs(F.col("rebuilt") - F.col("value_tr")) / F.abs("value_tr") > tolerance
    return F.coalesce(fresh & (F.col("value_tr") > 0) & off, F.lit(False))


def fresh_divergence(bars: DataFrame, fresh_days: int = FRESH_DAYS, tolerance: float = FRESH_TOLERANCE) -> DataFrame:
    """Per series: whether the rebuild strays from the stored value on recently recorded bars."""
    judged = rebuilt_total_return(bars).withColumn("off", _diverges(fresh_days, tolerance))
    return judged.groupBy("series_id").agg(F.max("off").alias("diverges"), F.count_if("off").alias("n_off"))


def total_return(bars: DataFrame, pinned: Sequence[str] = (), fresh_days: int = FRESH_DAYS,
                 tolerance: float = FRESH_TOLERANCE) -> DataFrame:
    """Adds ``tr_close``: the rebuild where it can be trusted, the stored value elsewhere."""
    filled = bars.withColumn("value_tr", F.coalesce("value_tr", "close")).withColumn(
        "dividend", F.coalesce("dividend", F.lit(0.0)))
    judged = dividend_probe(rebuilt_total_return(filled)).withColumn("off", _diverges(fresh_days, tolerance))
    adjusted = F.coalesce(F.max("probe").over(whole())["score"] >= ADJUSTED_SCORE, F.lit(False))
    listed = F.col("series_id").isin(list(pinned)) if pinned else F.lit(False)
    choice = (F.when(~adjusted, F.lit("stored:price_only")).when(listed, F.lit("stored:pinned"))
              .when(F.max("off").over(whole()), F.lit("stored:diverges")).otherwise(F.lit("rebuilt")))
    return judged.withColumn("basis", choice).withColumn(
        "tr_close", F.when(F.col("basis") == "rebuilt", F.col("rebuilt")).otherwise(F.col("value_tr"))
    ).drop("probe", "off", "prev_close", "prev_tr", "rebuilt")


def auto_adjust(bars: DataFrame) -> DataFrame:
    """Scale open, high and low by total-return close over close; volume stays raw."""
    factor = F.col("tr_close") / F.col("close")
    return bars.select("series_id", "as_of", (F.col("open") * factor).alias("open"),
                       (F.col("high") * factor).alias("high"), (F.col("low") * factor).alias("low"),
                       F.col("tr_close").alias("close"), "volume",
                       F.col("close").alias("raw_close"))


# Divisor of a minor-unit quote basis.
MINOR_UNITS = {"GBX": 100.0}


def to_major_units(bars: DataFrame, registry: DataFrame, fields: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    """Prices of minor-unit series in major units; volume is a count and stays."""
    basis = F.upper(F.coalesce("quote_basis", F.lit("")))
    divisor = F.lit(1.0)
    for code, unit in MINOR_UNITS.items():
        divisor = F.when(basis == code, F.lit(unit)).otherwise(divisor)
    joined = bars.join(registry.select("series_id", "quote_basis"), "series_id", "left").withColumn("divisor", divisor)
    for name in fields:
        joined = joined.withColumn(name, F.col(name) / F.col("divisor"))
    return joined.drop("divisor", "quote_basis")


def clip_window(bars: DataFrame, period: str | None, end: dt.date, start: dt.date | None = None,
                end_given: bool = True) -> DataFrame:
    """Rows inside the look-back window; an explicit ``start`` overrides the period."""
    edge = F.lit(start) if start is not None else lookback_start(period, end)
    clipped = bars if edge is None else bars.filter(F.col("as_of") >= edge)
    return clipped.filter(F.col("as_of") <= F.lit(end)) if end_given else clipped


def served_series(clipped: DataFrame) -> DataFrame:
    """Series with at least one close inside the window."""
    return clipped.filter(F.col("close").isNotNull()).select("series_id").distinct()


# --- splits ----------------------------------------------------------------------------

def as_traded(bars: DataFrame) -> DataFrame:
    return bars.withColumn("as_traded", F.col("close") * F.col("split_factor"))


def split_series(batch: DataFrame, registry: DataFrame) -> DataFrame:
    """Stock series whose pulled window carries any split factor other than 1."""
    moved = batch.filter(F.abs(F.coalesce("split_factor", F.lit(1.0)) - 1.0) > SPLIT_EPS).select("series_id").distinct()
    return moved.join(registry.filter(F.col("family") == "stock").select("series_id"), "series_id", "left_semi")


def factor_as_of(days: DataFrame, covered: DataFrame) -> DataFrame:
    """Split factor at each day: the last covered bar at or before it, else the first one, else 1."""
    marks = days.select("series_id", "as_of").withColumn("split_factor", F.lit(None).cast("double")).withColumn("asked", F.lit(True))
    known = covered.select("series_id", "as_of", "split_factor").withColumn("asked", F.lit(False))
    together = marks.unionByName(known).groupBy("series_id", "as_of").agg(
        F.max("split_factor").alias("split_factor"), F.max("asked").alias("asked"))
    before = F.last("split_factor", ignorenulls=True).over(in_order())
    earliest = F.min_by("split_factor", F.when(F.col("split_factor").isNotNull(), F.col("as_of"))).over(whole())
    return (together.withColumn("new_factor", F.coalesce(before, earliest, F.lit(1.0)))
            .filter("asked").select("series_id", "as_of", "new_factor"))


def _healing_days(stored: DataFrame, repull: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every day of either side from the stored first day on, with the re-pull's factor at it.

    Both sides meet in one aggregate by (series, day) and are walked once per series.
    """
    line = F.struct(*columns)
    rows = stored.select("series_id", "as_of", line.alias("old"), F.lit(None).alias("new")).unionByName(
        repull.select("series_id", "as_of", F.lit(None).alias("old"), line.alias("new")))
    days = rows.groupBy("series_id", "as_of").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    first_day = F.min(F.when(F.col("old").isNotNull(), F.col("as_of"))).over(whole())
    kept = days.withColumn("first_day", first_day).filter(F.col("as_of") >= F.col("first_day"))
    covered = F.col("new.split_factor")
    earliest = F.min_by(covered, F.when(covered.isNotNull(), F.col("as_of"))).over(whole())
    return kept.withColumns({
        "pulled": F.max(F.col("new").isNotNull()).over(whole()), "rescaled": F.col("new").isNull(),
        "new_factor": F.coalesce(F.last(covered, ignorenulls=True).over(in_order()), earliest, F.lit(1.0)),
        "old_factor": F.coalesce("old.split_factor", F.lit(1.0))})


def missing_factors(stored: DataFrame, repull: DataFrame) -> DataFrame:
    """``factor_as_of`` for the stored days that a re-pull of their series lacks, each side read once."""
    return (_healing_days(stored, repull, ["split_factor"]).filter(F.col("pulled") & F.col("rescaled"))
            .select("series_id", "as_of", "new_factor"))


def heal_batch(stored: DataFrame, repull: DataFrame, digits: int = 6) -> DataFrame:
    """Batch that brings whole stored series onto the scale of a full re-pull.

    The re-pull is cut at each stored first day; stored days it lacks are rescaled by
    old factor over new factor. Volume stays raw.
    """
    columns = [c for c in repull.columns if c in stored.columns and c not in ("series_id", "as_of")]
    judged = _healing_days(stored, repull, columns)
    moved = (F.col("pulled") & (F.col("new_factor") > 0) & (F.col("old_factor") > 0)
             & (F.abs(F.col("new_factor") - F.col("old_factor")) > SPLIT_EPS))
    scale = F.col("old_factor") / F.col("new_factor")

    def value(name: str) -> Column:
        old = F.col(f"old.{name}")
        if name in BAR_PRICES:
            old = F.round(old * scale, digits)
        elif name == "split_factor":
            old = F.round("new_factor", 8)
        elif name == "provisional":
            old = F.lit(False)
        return F.when(F.col("rescaled"), old).otherwise(F.col(f"new.{name}")).alias(name)

    return judged.filter(~F.col("rescaled") | moved).select(
        "series_id", "as_of", *[value(c) for c in columns], "rescaled")
