"""Append-only history: current and point-in-time views, and the append plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.frames import whole

VALUE_TOLERANCE = 1e-6
KEY = ["series_id", "as_of"]
# Fields that make two bars differ; identity and bookkeeping fields do not.
VALUE_FIELDS = ["value", "open", "high", "low", "close", "value_tr", "volume", "split_factor", "dividend"]
ACTIONS = ["append", "restate", "revise", "freeze", "skip"]


def current_view(log: DataFrame, as_of_vintage: dt.date | None = None) -> DataFrame:
    """Newest line per series and day, optionally as known at a past vintage.

    One stored line is taken whole: of several lines of the newest vintage the greatest by all
    its fields, so that a replay gives the same line and fields of two lines never mix. A partial
    aggregate picks it, so days with many vintages shrink before the shuffle.
    """
    lines = log if as_of_vintage is None else log.filter(F.col("recorded_on") <= F.lit(as_of_vintage))
    rest = [c for c in log.columns if c not in KEY and c != "recorded_on"]
    line = F.max(F.struct("recorded_on", *rest)).alias("line")
    return lines.groupBy(*KEY).agg(line).select(*KEY, "line.*").select(*log.columns)


def _same(fields: Sequence[str], tolerance: float) -> Column:
    def close(name: str) -> Column:
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        return old.eqNullSafe(new) | F.coalesce(F.abs(new - old) <= tolerance, F.lit(False))
    return reduce(lambda a, b: a & b, [close(f) for f in fields])


def _side_by_side(log: DataFrame, batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Newest stored line and incoming row of each key, from one aggregate over both inputs."""
    line = F.struct(*columns)
    rows = log.select(*KEY, F.lit(False).alias("incoming"), line.alias("line")).unionByName(
        batch.select(*KEY, F.lit(True).alias("incoming"), line.alias("line")))

    def newest(side: Column) -> Column:
        return F.max_by("line", F.when(side, F.col("line.recorded_on")))

    return rows.groupBy(*KEY).agg(newest(~F.col("incoming")).alias("old"), newest(F.col("incoming")).alias("new"))


def append_plan(log: DataFrame, batch: DataFrame, tolerance: float = VALUE_TOLERANCE) -> DataFrame:
    """What appending ``batch`` would do, one row per touched (series, day).

    ``batch`` holds one row per key with ``provisional`` and ``recorded_on``. Actions:
    append a new day; skip an equal one; revise a stored provisional line in place;
    restate a changed final one as a new line; freeze a provisional line that a newer
    batch left behind. A changed final line whose vintage does not advance refuses the
    whole series. A provisional mark behind the overall tip is stripped.

    Two shuffles whatever the size: one aggregate by (series, day) over log and batch,
    then one regrouping by series, which by then holds at most one row per day.
    """
    fields = [f for f in VALUE_FIELDS if f in batch.columns and f in log.columns]
    shared = [c for c in batch.columns if c in log.columns]
    payload = [c for c in shared if c not in KEY]
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()

    def tip(side: Column) -> Column:
        return F.max(F.when(side, F.col("as_of"))).over(whole())

    was_provisional = F.coalesce("old.provisional", F.lit(False))
    left_behind = has_old & ~has_new & was_provisional & (F.col("as_of") < F.col("batch_tip"))
    paired = (
        _side_by_side(log, batch, payload)
        .withColumn("stored_tip", tip(has_old)).withColumn("batch_tip", tip(has_new))
        .filter(has_new | left_behind)
        .withColumn("stays_open", F.coalesce("new.provisional", F.lit(False))
                    & (F.col("as_of") >= F.greatest("stored_tip", "batch_tip")))
        .withColumn("equal", _same(fields, tolerance))
    )
    action = (
        F.when(~has_new, F.lit("freeze"))
        .when(~has_old, F.lit("append"))
        .when(was_provisional, F.when(F.col("equal") & F.col("stays_open"), F.lit("skip")).otherwise(F.lit("revise")))
        .when(F.col("equal"), F.lit("skip"))
        .otherwise(F.lit("restate"))
    )
    stale = (F.col("action") == "restate") & (F.col("new.recorded_on") <= F.col("old.recorded_on"))
    judged = paired.withColumn("action", action).withColumn(
        "refused", F.max(F.coalesce(stale, F.lit(False))).over(whole()))
    kept = judged.filter(~(F.col("refused") & (F.col("action") == "freeze")))
    written = {c: F.coalesce(f"new.{c}", F.when(~has_new, F.col(f"old.{c}"))) for c in payload}
    written["provisional"] = F.col("stays_open")
    return kept.select(*KEY, *[written[c].alias(c) for c in payload], "action", "refused",
                       F.col("old.recorded_on").alias("old_recorded_on"))


def append_summary(plan: DataFrame) -> DataFrame:
    """Per series: how many rows each action touches, and whether the batch was refused."""
    def n(action: str) -> Column:
        return F.count_if((F.col("action") == action) & ~F.col("refused"))

    years = F.array_sort(F.collect_set(F.when((F.col("action") != "skip") & ~F.col("refused"), F.year("as_of"))))
    return plan.groupBy("series_id").agg(
        (~F.max("refused")).alias("ok"), n("append").alias("appended"), n("restate").alias("restated"),
        n("revise").alias("revised"), n("freeze").alias("frozen"), n("skip").alias("skipped"),
        F.array_join(years.cast("array<string>"), ",").alias("years_touched"))


def apply_plan(log: DataFrame, plan: DataFrame) -> DataFrame:
    """The history after the accepted actions."""
    accepted = plan.filter(~F.col("refused") & (F.col("action") != "skip"))
    replaced = accepted.filter(F.col("action").isin("revise", "freeze")).select(
        *KEY, F.col("old_recorded_on").alias("recorded_on"))
    kept = log.join(replaced, [*KEY, "recorded_on"], "left_anti")
    return kept.unionByName(accepted.select(*[c for c in log.columns if c in accepted.columns]), allowMissingColumns=True)


def append(log: DataFrame, batch: DataFrame, tolerance: float = VALUE_TOLERANCE) -> DataFrame:
    return apply_plan(log, append_plan(log, batch, tolerance))


def promote(source_log: DataFrame, target_log: DataFrame) -> DataFrame:
    """Plan that replays the current view of a verified history into another one.

    Each line keeps its own ``recorded_on``. Only a history without restatements qualifies,
    so every line that would restate marks its series as refused. An empty source is refused.
    """
    if source_log.isEmpty():
        raise ValueError("the source history is empty; nothing is promoted")
    plan = append_plan(target_log, current_view(source_log))
    return plan.withColumn("refused", F.col("refused") | F.max(F.col("action") == "restate").over(whole()))


def upsert(history: DataFrame, readings: DataFrame) -> DataFrame:
    """Stored history plus new readings; a reading replaces the stored row of its day."""
    columns = history.columns
    both = history.withColumn("rank", F.lit(0)).unionByName(readings.select(*columns).withColumn("rank", F.lit(1)))
    rest = [c for c in columns if c not in KEY]
    return (both.groupBy(*KEY).agg(F.max_by(F.struct(*rest), F.col("rank")).alias("row"))
            .select(*KEY, *[F.col(f"row.{c}").alias(c) for c in rest]).select(*columns))


def unseen_vintages(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Vintage records whose (series, day, vintage) is not stored yet."""
    return incoming.join(stored.select(*KEY, "recorded_on"), [*KEY, "recorded_on"], "left_anti")
