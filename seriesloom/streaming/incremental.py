"""Incremental runs with Structured Streaming: each run takes the new files and stops."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesloom.functions.dates import month_end, week_ending_friday
from seriesloom.functions.frames import whole
from seriesloom.operators import bitemporal, revisions
from seriesloom.session import cut_lineage
from seriesloom.sources import commits, deltas, tables


def landing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has landed since the last run, then return."""
    (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def _newest(readings: DataFrame, run_date: dt.date) -> DataFrame:
    """One row per key of a micro-batch, recorded on the run date, with the tip provisional."""
    return bitemporal.current_view(readings).withColumns({
        "provisional": F.col("as_of") == F.max("as_of").over(whole()), "recorded_on": F.lit(run_date)})


def daily_append(stream: DataFrame, archive: str, checkpoint: str, run_date: dt.date,
                 append: Callable[[DataFrame, str], DataFrame] = tables.append_history) -> None:
    """Append landed readings to the history. A replayed micro-batch appends nothing twice.

    ``append`` is the store's own; ``deltas.append_history`` writes new files only.
    """
    def handle(batch: DataFrame, _: int) -> None:
        append(_newest(batch, run_date), archive)

    run_available(stream, checkpoint, handle)


def _keep_part(rows: DataFrame, parts: str, checkpoint: str, batch_id: int) -> None:
    """Store a micro-batch's part; a replay of it replaces the same part and no other.

    The part is named by the checkpoint as well as the batch: a new checkpoint counts from 0 again.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    (rows.withColumns({"run": F.lit(run), "micro_batch": F.lit(batch_id)}).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run", "micro_batch").parquet(parts))


def weekly_parts(stream: DataFrame, time: str, parts: str, checkpoint: str) -> None:
    """Keep the last reading per series and Saturday-to-Friday week of each micro-batch.

    ``stream`` holds ``series_id``, an event time, ``arrival`` (order inside one instant) and ``value``.
    However late a row comes, it amends its week: nothing is dropped by a watermark.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        week = week_ending_friday(F.col(time).cast("date"))
        last = F.max(F.struct(F.col(time).alias("at"), "arrival", "value")).alias("last")
        _keep_part(batch.groupBy("series_id", week.alias("as_of")).agg(last), parts, checkpoint, batch_id)

    run_available(stream, checkpoint, handle)


def completed_weeks(spark: SparkSession, parts: str) -> DataFrame:
    """Last reading of each week that ended before the newest day of any series."""
    kept = spark.read.parquet(parts)
    newest = kept.agg(F.max(F.col("last.at").cast("date"))).scalar()
    return (kept.groupBy("series_id", "as_of").agg(F.max("last").alias("last")).filter(F.col("as_of") < newest)
            .select("series_id", "as_of", F.col("last.value").alias("value")))


def monthly_parts(stream: DataFrame, parts: str, checkpoint: str) -> None:
    """Keep sums and counts per series and month of each micro-batch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("series_id", month_end("as_of").alias("month")).agg(
            F.sum("value").alias("total"), F.count("value").alias("n"))
        _keep_part(sums, parts, checkpoint, batch_id)

    run_available(stream, checkpoint, handle)


def completed_months(spark: SparkSession, parts: str, run_date: dt.date, digits: int = 6) -> DataFrame:
    """Monthly means from the kept parts, without the month of the run date.

    Rounded in two steps, so that the order in which parts are added cannot turn a tie.
    """
    return (
        spark.read.parquet(parts).filter(F.col("month") < F.trunc(F.lit(run_date), "month"))
        .groupBy("series_id", F.col("month").alias("as_of"))
        .agg(F.round(F.round(F.sum("total") / F.sum("n"), digits + 3), digits).alias("value"))
    )


def accumulate_snapshots(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Forward-accumulate one reading per series and day; the same day again overwrites it."""
    def handle(batch: DataFrame, _: int) -> None:
        readings = batch.groupBy("series_id", "as_of").agg(F.max_by("value", "arrival").alias("value"))
        held = tables._read_or_none(batch.sparkSession, path)
        if held is not None:
            mine = held.join(readings.select("series_id").distinct(), "series_id", "left_semi")
            readings = bitemporal.upsert(mine.select("series_id", "as_of", "value"), readings)
        tables.replace_series(readings, path)

    run_available(stream, checkpoint, handle)


def accumulate_readings(stream: DataFrame, path: str, checkpoint: str) -> None:
    """The same as a merge-on-read table: a micro-batch writes its own rows only, and a replayed one writes nothing."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, batch_id: int) -> None:
        marker, held = f"{run}-{batch_id}", commits.snapshot(batch.sparkSession, path)
        if held is None or marker not in held.markers:
            readings = batch.groupBy("series_id", "as_of").agg(F.max_by("value", "arrival").alias("value"))
            deltas.upsert_readings(readings, path, marker=marker)

    run_available(stream, checkpoint, handle)


def declare_and_append(stream: DataFrame, archive: str, face: str, journal: str, checkpoint: str, run_date: dt.date,
                       cells: str) -> None:
    """Late rows are classified against the stored view and restated, never dropped.

    Of the archive only the batch's years and series are read. The journal's named lists are short; every
    changed cell is stored under ``cells``.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        incoming = cut_lineage(_newest(batch, run_date))
        held = tables._read_or_none(batch.sparkSession, archive)
        first = incoming.agg(F.min(F.year("as_of"))).first()[0]
        if held is not None and first is not None:
            near = held.filter(F.col("year") >= first).join(incoming.select("series_id").distinct(), "series_id", "left_semi")
            stored, fresh = bitemporal.current_view(near.drop("year")), revisions.round_values(incoming)
            changed = cut_lineage(revisions.classified_cells(revisions.changed_cells(stored, fresh)))
            tables.write_ledger(revisions.declared_cells(changed), face, journal,
                                dt.datetime.combine(run_date, dt.time()), batch_id, revisions.ledger_cells(changed), cells)
        tables.append_history(incoming, archive)

    run_available(stream, checkpoint, handle)
