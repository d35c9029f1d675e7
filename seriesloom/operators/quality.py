"""Data-quality gates: depth, coverage, recency, density, conflicts and the tally."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.frames import first_of_each
from seriesloom.functions.text import venue_group

# Limits of the gates.
STALE_WARN_DAYS, STALE_FAIL_DAYS = 4, 10
SPARSE_WINDOW, SPARSE_WARN, SPARSE_FAIL = 30, 1, 4
GROUP_QUORUM, GROUP_MIN = 0.60, 5
MAX_SPLIT_LEVELS = 20
NAMED_DATES = 12


# --- profiles ---------------------------------------------------------------------------

def series_profile(registry: DataFrame, view: DataFrame) -> DataFrame:
    """First day, last day and row count of every registered series, live or not."""
    seen = view.groupBy("series_id").agg(
        F.min("as_of").alias("first_day"), F.max("as_of").alias("last_day"), F.count(F.lit(1)).alias("n_rows"))
    return registry.select("series_id").join(seen, "series_id", "left").select(
        "series_id", "first_day", "last_day", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.col("n_rows").isNotNull().alias("live"))


def lines_per_day(log: DataFrame) -> DataFrame:
    """Stored lines per (series, day)."""
    return log.groupBy("series_id", "as_of").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("recorded_on").alias("n_vintages"))


def view_against_log(log: DataFrame) -> DataFrame:
    """Days in the current view and raw lines, per series."""
    return lines_per_day(log).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("view_rows"), F.sum("n_lines").alias("raw_lines"))


# --- calendars --------------------------------------------------------------------------

WORD = 64


def _bits(word: Column) -> Column:
    """Places of the set bits of a 64-bit word."""
    return F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda place: F.getbit(word, place) == 1)


def _set_of_days(day: Column) -> Column:
    """Bitmap of the days of one word, as a partial aggregate."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.unix_date(day), F.lit(WORD)).cast("int")))


def _word_of(day: Column) -> Column:
    return F.floor(F.unix_date(day) / WORD).cast("int")


def session_words(view: DataFrame) -> DataFrame:
    """The day set of every series as bitmaps: ``series_id, venue, word, days, lo, hi``, a row per 64 days.

    This is the only shuffle of the view; days are set on the map side. ``view`` holds ``symbol``.
    """
    return view.groupBy("series_id", venue_group(F.col("symbol")).alias("venue"), _word_of(F.col("as_of")).alias("word")).agg(
        _set_of_days(F.col("as_of")).alias("days"), F.min("as_of").alias("lo"), F.max("as_of").alias("hi"))


def calendar_of_words(words: DataFrame, window: int = SPARSE_WINDOW, quorum: float = GROUP_QUORUM,
                      group_min: int = GROUP_MIN) -> DataFrame:
    """The last sessions of each venue, from the bit counts of its series' day sets."""
    members = words.groupBy("venue", "series_id").agg(F.count(F.lit(1)).alias("words")).groupBy("venue").agg(
        F.count(F.lit(1)).alias("members")).filter(F.col("members") >= group_min)
    place = words.select("venue", "word", F.explode(_bits(F.col("days"))).alias("place"))
    days = place.groupBy("venue", "word", "place").agg(F.count(F.lit(1)).alias("present"))
    sessions = days.join(members, "venue").filter(F.col("present") >= quorum * F.col("members")).select(
        "venue", F.date_from_unix_date(F.col("word") * WORD + F.col("place")).alias("as_of"), "present", "members")
    newest = F.row_number().over(Window.partitionBy("venue").orderBy(F.col("as_of").desc()))
    return (sessions.withColumn("recency", newest).filter(F.col("recency") <= window)
            .select("venue", "as_of", "present", "members"))


def missing_of_words(words: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions inside a series' own first and last day that it lacks: calendar AND NOT days, word by word."""
    bounds = words.groupBy("series_id", "venue").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    sessions = calendar.groupBy("venue", _word_of(F.col("as_of")).alias("word")).agg(_set_of_days(F.col("as_of")).alias("sessions"))
    expected = bounds.join(sessions, "venue").filter(
        F.col("word").between(_word_of(F.col("lo")), _word_of(F.col("hi"))))
    lacking = expected.join(words.select("series_id", "venue", "word", "days"), ["series_id", "venue", "word"], "left").withColumn(
        "lacking", F.col("sessions").bitwiseAND(F.bitwise_not(F.coalesce("days", F.lit(0).cast("long")))))
    day = F.date_from_unix_date(F.col("word") * WORD + F.col("place"))
    return (lacking.filter("lacking <> 0").select("series_id", "venue", "word", "lo", "hi", F.explode(_bits(F.col("lacking"))).alias("place"))
            .select("series_id", "venue", day.alias("as_of"), "lo", "hi")
            .filter(F.col("as_of").between(F.col("lo"), F.col("hi"))).drop("lo", "hi"))


def venue_calendar(view: DataFrame, window: int = SPARSE_WINDOW, quorum: float = GROUP_QUORUM,
                   group_min: int = GROUP_MIN) -> DataFrame:
    """The last sessions of each venue: days on which enough of its series have a bar.

    ``view`` holds one row per (series, day) with ``symbol``. Small venues have no calendar.
    """
    return calendar_of_words(session_words(view), window, quorum, group_min)


def missing_sessions(view: DataFrame, calendar: DataFrame) -> DataFrame:
    """Venue sessions inside a series' own first and last day that the series lacks."""
    return missing_of_words(session_words(view), calendar)


def universe_session(view: DataFrame) -> DataFrame:
    """The day on which most series end; the later day wins a tie."""
    latest = view.groupBy("series_id").agg(F.max("as_of").alias("latest"))
    return latest.groupBy("latest").agg(F.count(F.lit(1)).alias("n_series")).agg(
        F.max(F.struct("n_series", "latest")).alias("top")).select(
        F.col("top.latest").alias("session"), F.col("top.n_series").alias("n_series"))


# --- freshness --------------------------------------------------------------------------

def _tier(hard: Column) -> Column:
    return (F.when(~hard, F.lit("warn")).when(F.col("exempted"), F.lit("exempt")).otherwise(F.lit("fail")))


def _with_exemptions(found: DataFrame, exemptions: DataFrame, today: dt.date) -> DataFrame:
    live = exemptions.filter(F.col("review_by") >= F.lit(today)).select("series_id").distinct().withColumn(
        "exempted", F.lit(True))
    return found.join(live, "series_id", "left").withColumn("exempted", F.coalesce("exempted", F.lit(False)))


def stale_series(view: DataFrame, exemptions: DataFrame, today: dt.date, warn_days: int = STALE_WARN_DAYS,
                 fail_days: int = STALE_FAIL_DAYS) -> DataFrame:
    """Series whose last bar lies behind the universe session."""
    latest = view.groupBy("series_id").agg(F.max("as_of").alias("latest"))
    session = universe_session(view).select("session").scalar()
    late = latest.withColumn("days", F.datediff(session, "latest").cast("long")).filter(F.col("days") > warn_days)
    return _with_exemptions(late, exemptions, today).select(
        "series_id", "latest", "days", _tier(F.col("days") > fail_days).alias("tier"))


def sparse_series(view: DataFrame, exemptions: DataFrame, today: dt.date, warn_max: int = SPARSE_WARN,
                  fail_max: int = SPARSE_FAIL, **calendar_options) -> DataFrame:
    """Series that miss interior sessions of their own venue, most missing first."""
    words = session_words(view)
    holes = missing_of_words(words, calendar_of_words(words, **calendar_options))
    total = holes.groupBy("series_id").agg(F.count(F.lit(1)).alias("missing")).filter(F.col("missing") > warn_max)
    first = first_of_each(holes, ["series_id"], ["as_of"], NAMED_DATES).groupBy("series_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.col("as_of").cast("string"))), ",").alias("dates"))
    counted = total.join(first, "series_id")
    return (_with_exemptions(counted, exemptions, today)
            .select("series_id", "missing", "dates", _tier(F.col("missing") > fail_max).alias("tier"))
            .orderBy(F.col("missing").desc(), "series_id"))


def freshness_report(stale: DataFrame, sparse: DataFrame, exemptions: DataFrame, today: dt.date) -> DataFrame:
    """All sections in one long table, with the overall verdict as a row of its own."""
    findings = stale.select(F.lit("stale").alias("section"), "series_id", F.col("days").alias("amount"), "tier").unionByName(
        sparse.select(F.lit("sparse").alias("section"), "series_id", F.col("missing").alias("amount"), "tier"))
    fired = findings.select("series_id").distinct()
    expired = exemptions.filter(F.col("review_by") < F.lit(today)).select(
        F.lit("expired_exempt").alias("section"), "series_id", F.lit(None).cast("long").alias("amount"), F.lit("fail").alias("tier"))
    used = exemptions.filter(F.col("review_by") >= F.lit(today)).join(fired, "series_id", "left_semi").select(
        F.lit("exempt").alias("section"), "series_id", F.lit(None).cast("long").alias("amount"), F.lit("exempt").alias("tier"))
    report = findings.unionByName(expired).unionByName(used)
    failed = F.coalesce(F.max(F.col("tier") == "fail"), F.lit(False))
    verdict = report.agg(F.when(failed, F.lit("fail")).otherwise(F.lit("pass")).alias("tier")).select(
        F.lit("verdict").alias("section"), F.lit(None).cast("string").alias("series_id"),
        F.lit(None).cast("long").alias("amount"), "tier")
    return report.unionByName(verdict)


# --- violations per gate ------------------------------------------------------------------

def depth_violations(view: DataFrame, baselines: DataFrame) -> DataFrame:
    """Baselined series that start too late or hold too few rows (or are gone)."""
    seen = view.groupBy("series_id").agg(F.min("as_of").alias("first_day"), F.count(F.lit(1)).alias("n_rows"))
    judged = baselines.join(seen, "series_id", "left")
    bad = (F.col("first_day").isNull() | (F.col("first_day") > F.col("reach_back_to")) | (F.col("n_rows") < F.col("min_rows")))
    return judged.filter(bad).select("series_id", "first_day", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def coverage_report(profile: DataFrame, registry: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Registered, not retired series without data, and whether quarantine excuses them."""
    active = registry.filter(~F.coalesce("retired", F.lit(False))).select("series_id")
    allowed = quarantine.select("series_id").distinct().withColumn("quarantined", F.lit(True))
    return (profile.join(active, "series_id", "left_semi").filter(~F.col("live"))
            .join(allowed, "series_id", "left")
            .select("series_id", F.coalesce("quarantined", F.lit(False)).alias("quarantined")))


def ranked_depth(profile: DataFrame) -> DataFrame:
    """Profiles with the deepest history first; empty series come last."""
    return profile.orderBy(F.col("first_day").asc_nulls_last(), "last_day", "n_rows", "series_id")


def thin_series(profile: DataFrame, min_rows: int = 5) -> DataFrame:
    return profile.filter(F.col("live") & (F.col("n_rows") < min_rows)).select("series_id", "n_rows")


def split_soundness(view: DataFrame, max_levels: int = MAX_SPLIT_LEVELS) -> DataFrame:
    """Checks on every series that has a split factor other than 1."""
    factor = F.col("split_factor")
    levels = view.groupBy("series_id").agg(
        F.min(factor).alias("low"), F.max(factor).alias("high"), F.max_by(factor, "as_of").alias("newest"),
        F.count_distinct(F.round(factor, 6)).alias("levels"), F.min(F.col("close") * factor).alias("lowest_traded"))
    split = levels.filter((F.abs(F.col("low") - 1) > 1e-9) | (F.abs(F.col("high") - 1) > 1e-9))
    return split.select(
        "series_id", "levels", (F.col("lowest_traded") > 0).alias("traded_positive"), (F.col("low") > 0).alias("factor_positive"),
        (F.abs(F.col("newest") - 1.0) <= 1e-9).alias("anchored"), (F.col("levels") <= max_levels).alias("piecewise"),
        (F.col("high") > 1.0 + 1e-9).alias("has_forward"), (F.col("low") < 1.0 - 1e-9).alias("has_reverse"))


def seed_conflicts(log: DataFrame) -> DataFrame:
    """Days with more than one stored line; a first seed must have none."""
    return lines_per_day(log).filter(F.col("n_lines") > 1).select("series_id", "as_of", "n_lines")


def vintage_conflicts(log: DataFrame) -> DataFrame:
    """Days on which two lines share a vintage, so that one of them cannot be reached."""
    return lines_per_day(log).filter(F.col("n_lines") != F.col("n_vintages")).select("series_id", "as_of", "n_lines", "n_vintages")


def provisional_violations(view: DataFrame) -> DataFrame:
    """Series with more than one provisional bar, or with one that is not the tip."""
    mark = F.coalesce("provisional", F.lit(False))
    marks = view.groupBy("series_id").agg(
        F.count_if(mark).alias("n_provisional"), F.max(F.when(mark, F.col("as_of"))).alias("provisional_day"), F.max("as_of").alias("tip"))
    return marks.filter((F.col("n_provisional") > 1) | (F.col("provisional_day") != F.col("tip")))


def shape_violations(rows: DataFrame, required: list[str]) -> DataFrame:
    """NULL counts per required column, per series that has any."""
    counts = rows.groupBy("series_id").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in required])
    return counts.withColumn("missing_values", total).filter(F.col("missing_values") > 0)


def batch_freshness(written: DataFrame, today: dt.date, stale_days: int = 11) -> DataFrame:
    """Whether the newest written day is recent enough; red as well when nothing was written."""
    newest = written.agg(F.max("as_of").alias("frontier"))
    age = F.datediff(F.lit(today), "frontier")
    return newest.select("frontier", age.cast("long").alias("age_days"),
                         F.coalesce(age <= stale_days, F.lit(False)).alias("fresh"))


def history_start(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Whether each series begins exactly on its configured first day."""
    first = rows.groupBy("series_id").agg(F.min("as_of").alias("first_day"))
    return starts.join(first, "series_id", "left").select(
        "series_id", "first_day", "expected_start",
        F.coalesce(F.col("first_day") == F.col("expected_start"), F.lit(False)).alias("ok"))


def single_entity(rows: DataFrame, filter_key: str, entity: str) -> DataFrame:
    """Whether a name filter caught exactly one entity."""
    return rows.groupBy(filter_key).agg(F.count_distinct(entity).alias("n_entities")).withColumn(
        "ok", F.col("n_entities") == 1)


# --- gate rows and tally --------------------------------------------------------------------

def gate(name: str, violations: DataFrame, hard: bool = True) -> DataFrame:
    """One row: passed when nothing violates; the detail names the first violating series."""
    return violations.agg(F.count(F.lit(1)).alias("n_violations"), F.min("series_id").alias("detail")).select(
        F.lit(name).alias("gate"), F.lit(hard).alias("hard"), (F.col("n_violations") == 0).alias("passed"),
        "n_violations", "detail")


def tally(gates: DataFrame) -> DataFrame:
    """Totals over gate rows; a soft gate that fired is a warning, not a pass."""
    return gates.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passes"),
        F.count_if(~F.col("passed") & F.col("hard")).alias("hard_fails"),
        F.count_if(~F.col("passed") & ~F.col("hard")).alias("warnings"),
        F.min(F.col("passed") | ~F.col("hard")).alias("verdict"))
