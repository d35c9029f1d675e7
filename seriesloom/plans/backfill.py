"""Backfill of a history in batches of series that can stop anywhere and go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.sources import commits, deltas


def batch_marker(number: int, batches: int) -> str:
    return f"backfill-{number:06d}-of-{batches:06d}"


def resumable_backfill(bars: DataFrame, path: str, batches: int, watch: deltas.Watch = lambda _: None) -> list[str]:
    """Append ``bars`` in ``batches`` of series; returns the markers of the batches done by this run.

    A batch's rows and its marker are published by one commit. A run that stops between any two writes leaves
    whole batches; the next run skips those whose marker is stored and does the rest. Batches are
    chosen by a hash of the series, so a repeated run deals them alike.
    """
    spark, done = bars.sparkSession, []
    for number in range(batches):
        marker = batch_marker(number, batches)
        held = commits.snapshot(spark, path)
        if held is not None and marker in held.markers:
            continue
        part = bars.filter(F.pmod(F.xxhash64("series_id", F.lit(17)), F.lit(batches)) == number)
        deltas.append_history(part, path, marker=marker, watch=watch)
        done.append(marker)
    return done
