"""Landed extracts to typed rows, with a reason for everything that is turned away."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.dates import epoch_or_text_date, lenient_date
from seriesloom.functions.frames import whole
from seriesloom.functions.text import loose_number, observed_number

EPOCH_MILLIS_FLOOR = 1e11


def resolve_column(fields: Sequence[str], candidates: Sequence[str]) -> str:
    """The first candidate present among ``fields``, ignoring case."""
    by_lower = {f.lower(): f for f in fields}
    for candidate in candidates:
        if candidate.lower() in by_lower:
            return by_lower[candidate.lower()]
    raise ValueError(f"none of {list(candidates)} found; available columns: {list(fields)}")


def no_observation(text: Column) -> Column:
    """The marks a source writes for a day without a value; they are not errors."""
    return F.coalesce(F.trim(text), F.lit("")).isin("", ".", "NaN", "nan")


def macro_rejects(landed: DataFrame, dates: Sequence[str] = ("date",)) -> DataFrame:
    """``series_id, reason`` of every text row whose date or number cannot be read."""
    raw = F.col("value").cast("string")
    bad_date = F.lit(False)
    for name in dates:
        bad_date = bad_date | lenient_date(F.col(name)).isNull()
    bad_number = ~no_observation(raw) & observed_number(raw).isNull()
    reason = (F.when(bad_date, F.concat(F.lit("unreadable date "), F.coalesce(F.col(dates[0]), F.lit("none"))))
              .when(bad_number, F.concat(F.lit("unreadable value "), raw)))
    return landed.select("series_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def macro_extracts(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations of the series whose extract can be read whole, and the status of every series.

    A row that cannot be read fails its series, and only that one.
    """
    rejects = macro_rejects(landed).groupBy("series_id").agg(F.min("reason").alias("reason"),
                                                            F.count(F.lit(1)).alias("n_rejected"))
    rows = macro_observations(landed)
    counted = landed.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_landed"))
    status = counted.join(rejects, "series_id", "left").select(
        "series_id", F.col("reason").isNull().alias("ok"), "n_landed",
        F.coalesce("n_rejected", F.lit(0)).cast("long").alias("n_rejected"), "reason")
    return rows.join(rejects, "series_id", "left_anti"), status


def _reason(date: Column, dates: Sequence[Column], number_text: Column, number: Column, missing: Column) -> Column:
    """Why a row cannot be read; NULL where it can. A marked missing value is no fault."""
    bad_date = F.lit(False)
    for read in dates:
        bad_date = bad_date | read.isNull()
    return (F.when(bad_date, F.concat(F.lit("unreadable date "), F.coalesce(date, F.lit("none"))))
            .when(~missing & number.isNull(), F.concat(F.lit("unreadable value "), F.coalesce(number_text, F.lit("none")))))


def vintage_rows(landed: DataFrame) -> DataFrame:
    """Every landed vintage row, typed, with the reason if it cannot be read."""
    days = {name: lenient_date(F.col(name)) for name in ("date", "realtime_start", "realtime_end")}
    text = F.col("value").cast("string")
    return landed.select(
        "series_id", *[day.alias(name) for name, day in days.items()], observed_number(text).alias("value"),
        _reason(F.col("date").cast("string"), list(days.values()), text, observed_number(text), no_observation(text)).alias("reason"))


def period_rows(landed: DataFrame) -> DataFrame:
    """Every landed period row, typed, with the reason if it cannot be read."""
    text, day = F.col("value").cast("string"), lenient_date(F.col("period"))
    return landed.select("series_id", day.alias("as_of"), loose_number(text).alias("value"),
                         _reason(F.col("period").cast("string"), [day], text, loose_number(text), no_observation(text)).alias("reason"))


def row_status(rows: DataFrame) -> DataFrame:
    """Per series whether its extract can be read whole, with counts and the first reason."""
    return rows.groupBy("series_id").agg(
        (F.count("reason") == 0).alias("ok"), F.count(F.lit(1)).alias("n_landed"), F.count("reason").alias("n_rejected"),
        F.min("reason").alias("reason"))


def macro_observations(landed: DataFrame) -> DataFrame:
    """``series_id, as_of, value`` of the readable rows that hold an observation."""
    return landed.select("series_id", lenient_date(F.col("date")).alias("as_of"),
                         observed_number(F.col("value")).alias("value")).dropna()


def macro_vintages(landed: DataFrame) -> DataFrame:
    """Readable vintage rows, keeping the interval each value was live; ``vintage_rows`` has the others too."""
    return vintage_rows(landed).drop("reason").dropna()


def period_values(landed: DataFrame) -> DataFrame:
    """Readable period rows; ``period_rows`` has the others too."""
    return period_rows(landed).drop("reason").dropna()


def feature_rows(landed: DataFrame, date_candidates: Sequence[str], count_candidates: Sequence[str],
                 key: str = "series_id") -> DataFrame:
    """Day and count of feature attributes whose column names and date form vary, with the reason of unreadable rows.

    An extract's dates are epoch milliseconds when its largest number is large enough; each
    extract is decided by itself.
    """
    date_name = resolve_column(landed.columns, date_candidates)
    count_name = resolve_column(landed.columns, count_candidates)
    as_number = loose_number(F.col(date_name).cast("string"))
    forms = landed.groupBy(F.col(key).alias("_extract")).agg((F.max(as_number) > EPOCH_MILLIS_FLOOR).alias("_is_epoch"))
    decided = landed.join(forms, F.col(key).eqNullSafe(F.col("_extract")), "left")
    text = F.col(count_name).cast("string")
    day = epoch_or_text_date(F.col(date_name).cast("string"), F.coalesce("_is_epoch", F.lit(False)))
    return decided.select(
        F.col(key), day.alias("as_of"), loose_number(text).alias("value"),
        _reason(F.col(date_name).cast("string"), [day], text, loose_number(text), no_observation(text)).alias("reason"))


def feature_counts(landed: DataFrame, date_candidates: Sequence[str], count_candidates: Sequence[str],
                   key: str = "series_id") -> DataFrame:
    """Readable feature rows; ``feature_rows`` has the others too."""
    return feature_rows(landed, date_candidates, count_candidates, key).drop("reason").dropna()


def _first_of(document: Column, candidates: Sequence[str]) -> Column:
    """Text of the first candidate path that a document has; every path is tried as given, lower and upper."""
    spellings = dict.fromkeys(s for c in candidates for s in (c, c.lower(), c.upper()))
    return F.coalesce(*[F.try_variant_get(document, f"$.{name}", "string") for name in spellings])


def mixed_rows(landed: DataFrame, date_candidates: Sequence[str], value_candidates: Sequence[str],
               key: str = "series_id", text: str = "document") -> DataFrame:
    """Rows of extracts whose documents differ in shape: ``series_id, as_of, value, reason``.

    Each landed row holds one JSON document as text. It is parsed once to a variant, and its columns are
    resolved per row: the first candidate path (dots lead into objects) that it has. A date is text or epoch
    milliseconds by its own size. A row that cannot be read keeps its key and a reason.
    """
    parsed = landed.select(F.col(key), F.col(text).alias("_text"), F.try_parse_json(F.col(text)).alias("_document")).select(
        key, "_text", "_document", _first_of(F.col("_document"), date_candidates).alias("_date"),
        _first_of(F.col("_document"), value_candidates).alias("_value"))
    number = loose_number(F.col("_value"))
    is_epoch = F.coalesce(loose_number(F.col("_date")) > EPOCH_MILLIS_FLOOR, F.lit(False))
    day = epoch_or_text_date(F.col("_date"), is_epoch)
    reason = F.when(F.col("_document").isNull() & F.col("_text").isNotNull(), F.lit("not a document")).when(
        F.col("_date").isNull(), F.lit("no date column")).when(F.col("_value").isNull() & day.isNotNull(), F.lit("no value column"))
    return parsed.select(F.col(key), day.alias("as_of"), number.alias("value"), F.coalesce(
        reason, _reason(F.col("_date"), [day], F.col("_value"), number, no_observation(F.col("_value")))).alias("reason"))


def snapshot_readings(feed: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Readings of mapped indicators and the reason for every rejected one.

    ``feed`` holds ``as_of`` and an array ``snapshot`` of ``indicator, value``. The
    mapping is configuration and travels as a literal.
    """
    names = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    parsed = (
        feed.select("as_of", F.inline("snapshot"))
        .withColumn("series_id", names[F.col("indicator")]).filter(F.col("series_id").isNotNull())
        .withColumn("number", loose_number(F.col("value")))
    )
    bad = F.col("as_of").isNull() | F.col("number").isNull() | (F.col("number") <= 0)
    good = parsed.filter(~bad).select("series_id", F.col("as_of").cast("date").alias("as_of"),
                                      F.round("number", 6).alias("value"))
    refused = parsed.filter(bad).select(
        "series_id", F.col("as_of").cast("date").alias("as_of"),
        F.concat(F.col("indicator"), F.lit(": missing or non-positive value "), F.coalesce("value", F.lit("none"))).alias("reason"))
    return good, refused


def manual_slot(rows: DataFrame, cut: dt.date | None = None, newest_provisional: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Hand-entered rows. One bad row turns its whole series away.

    The newest row of a series is provisional; rows up to ``cut`` are marked as the earlier source.
    """
    parsed = rows.select("series_id", lenient_date(F.col("as_of")).alias("as_of"), loose_number(F.col("value")).alias("value"))
    bad = F.col("as_of").isNull() | F.col("value").isNull()
    status = parsed.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad")).withColumn(
        "ok", F.col("n_bad") == 0)
    good = parsed.join(status.filter("ok").select("series_id"), "series_id", "left_semi")
    tip = (F.col("as_of") == F.max("as_of").over(whole())) & (F.lit(True) if newest_provisional is None else newest_provisional)
    earlier = F.lit(False) if cut is None else F.col("as_of") <= F.lit(cut)
    return good.withColumn("provisional", tip).withColumn("earlier_source", earlier), status


def completeness(rows: DataFrame, manifest: DataFrame, key: str = "series_id") -> DataFrame:
    """Received against announced row counts per extract."""
    received = rows.groupBy(key).agg(F.count(F.lit(1)).alias("received"))
    return manifest.join(received, key, "left").select(
        key, "announced", F.coalesce("received", F.lit(0)).cast("long").alias("received"),
        (F.coalesce("received", F.lit(0)) == F.col("announced")).alias("complete"))


def only_complete(rows: DataFrame, checked: DataFrame, key: str = "series_id") -> DataFrame:
    return rows.join(checked.filter("complete").select(key), key, "left_semi")


def extract_status(expected: DataFrame, rows: DataFrame, malformed: Column) -> DataFrame:
    """Each expected series as ok, malformed, empty or dead, so that one bad extract stops no other.

    ``rows`` has at least one row per series whose extract arrived; a row with a NULL
    ``value`` and no error is an arrived but empty one.
    """
    seen = rows.groupBy("series_id").agg(
        F.max(F.coalesce(malformed, F.lit(False))).alias("malformed"), F.count("value").alias("n_rows"))
    reason = (F.when(F.col("malformed").isNull(), F.lit("dead")).when(F.col("malformed"), F.lit("malformed"))
              .when(F.col("n_rows") == 0, F.lit("empty")).otherwise(F.lit("ok")))
    return expected.select("series_id").distinct().join(seen, "series_id", "left").select(
        "series_id", reason.alias("status"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def accepted_rows(rows: DataFrame, status: DataFrame) -> DataFrame:
    return rows.join(status.filter("status = 'ok'").select("series_id"), "series_id", "left_semi").filter(
        F.col("value").isNotNull())
