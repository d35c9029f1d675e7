"""A landing run that lets through what arrived whole, and counts while it writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from seriesloom.session import scratch_path
from seriesloom.sources import deltas, extracts


class LandingRefused(RuntimeError):
    """Nothing, or too little, of a landing can be read."""


@dataclass
class LandingRun:
    status: DataFrame
    landed: int
    rejected: int
    values: int


def landing_run(typed: DataFrame, expected: DataFrame, manifest: DataFrame, path: str, most_rejected: float = 0.5) -> LandingRun:
    """Stores the series of a landing that are complete and readable, and tells what became of the others.

    ``typed`` holds series_id, as_of, value and ``reason`` (why a row could not be read, else NULL), straight
    from an extract. It is read once: its counts are observed while the typed rows are staged, and a
    landing of which more than ``most_rejected`` is unreadable, or nothing came, is refused before anything
    is stored. Per series: dead (nothing came), malformed (a row could not be read), empty (no value),
    short (fewer rows than announced), ok. One bad extract stops no other.
    """
    spark, seen = typed.sparkSession, Observation()
    staged = scratch_path(spark, "landing")
    counted = typed.select("series_id", "as_of", "value", "reason").observe(
        seen, F.count(F.lit(1)).alias("landed"), F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.count("value").alias("values"))
    counted.write.parquet(staged)
    found = seen.get
    if not found["landed"] or found["rejected"] > most_rejected * found["landed"]:
        raise LandingRefused(f"{found['rejected']} of {found['landed']} landed rows cannot be read")
    rows = spark.read.schema(counted.schema).parquet(staged)
    state = extracts.extract_status(expected, rows, F.col("reason").isNotNull())
    checked = extracts.completeness(rows, manifest)
    reasons = rows.filter(F.col("reason").isNotNull()).groupBy("series_id").agg(F.min("reason").alias("reason"))
    short = (F.col("status") == "ok") & ~F.coalesce("complete", F.lit(True))
    status = state.join(checked, "series_id", "left").join(reasons, "series_id", "left").select(
        "series_id", F.when(short, F.lit("short")).otherwise(F.col("status")).alias("status"), "n_rows", "announced",
        F.coalesce("received", F.lit(0)).cast("long").alias("received"),
        F.when(short, F.concat(F.lit("announced "), F.col("announced").cast("string"), F.lit(", received "), F.col("received").cast("string")))
        .otherwise(F.col("reason")).alias("reason"))
    accepted = extracts.accepted_rows(extracts.only_complete(rows, checked), status).select("series_id", "as_of", "value")
    deltas.replace_series(accepted, path)
    return LandingRun(status, found["landed"], found["rejected"], found["values"])
