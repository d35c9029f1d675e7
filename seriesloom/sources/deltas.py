"""Merge-on-read tables: a change appends rows and removals, existing files are never rewritten.

Every stored row carries the number of its commit (``seq``) and whether it is a row or a removal
(``live``). A removal takes back the rows with its identity and a smaller ``seq``. Rows lie by partition
(year and series bucket), so a reader and an append open only the partitions they need.

A history keeps its versions as intervals: a line is known from ``recorded_on`` to before
``recorded_to``; the newest line of a day is open (``OPEN``). A later vintage closes the line before it by a
removal and a new row. So a current or past view is a filter on two columns by which the files are
sorted, not an aggregate over all vintages.

Small files are merged in tiers: where ``fan`` parts of one partition have like sizes, they become one part
of the next tier, so a row is rewritten about log(table) times, and no partition is rewritten for a few rows.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesloom.operators import bitemporal
from seriesloom.session import cut_lineage, discard, scratch_path
from seriesloom.sources import commits
from seriesloom.sources.commits import Part, Snapshot

OPEN = dt.date(9999, 12, 31)
BUCKETS = 16
FAN = 4
#: Called with a name after each write; tests stop a run there.
Watch = Callable[[str], None]


@dataclass(frozen=True)
class Layout:
    """What names a row, the partition columns (derived from the row), and the order inside files."""

    identity: tuple[str, ...]
    parts: tuple[str, ...]
    order: tuple[str, ...]


HISTORY = Layout(("series_id", "as_of", "recorded_on", "recorded_to"), ("year", "bucket"), ("recorded_to", "recorded_on"))
SERIES = Layout(("series_id",), ("bucket",), ("series_id",))
READINGS = Layout(("series_id", "as_of"), ("bucket",), ("series_id", "as_of"))
LAYOUTS = {"history": HISTORY, "series": SERIES, "readings": READINGS}


def _quiet(_: str) -> None:
    pass


def bucket_of(series: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(series), F.lit(buckets)).cast("int")


def _placed(rows: DataFrame, buckets: int, layout: Layout) -> DataFrame:
    placed = rows.withColumn("bucket", bucket_of("series_id", buckets))
    return placed.withColumn("year", F.year("as_of")) if "year" in layout.parts else placed


def _write(rows: DataFrame, path: str, folder: str, layout: Layout) -> list[Part]:
    """Writes rows by partition and counts what each partition got."""
    target = f"{path}/data/{folder}"
    (rows.hint("rebalance", *layout.parts).sortWithinPartitions(*layout.parts, *layout.order)
     .write.partitionBy(*layout.parts).parquet(target))
    kept = rows.sparkSession.read.schema(rows.schema).parquet(target)
    counted = kept.groupBy(*layout.parts).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("live")).alias("gone"))
    return [Part(folder, tuple(row[key] for key in layout.parts), row["n"], row["gone"]) for row in counted.collect()]


def _read(spark: SparkSession, path: str, held: Snapshot, layout: Layout, parts: Iterable[Part]) -> DataFrame:
    schema = StructType.fromJson(json.loads(held.schema))
    places = sorted("/".join([f"{path}/data/{part.folder}", *[f"{k}={v}" for k, v in zip(layout.parts, part.keys)]]) for part in parts)
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*places).select(*schema.names)


def _surviving(rows: DataFrame, layout: Layout, removals: bool) -> DataFrame:
    """Rows that no later removal takes back."""
    puts = rows.filter("live")
    if not removals:
        return puts
    gone = rows.filter("NOT live").select(*layout.identity, "seq").alias("gone")
    puts = puts.alias("puts")
    same = [F.col(f"puts.{c}") == F.col(f"gone.{c}") for c in layout.identity]
    return puts.join(gone, [*same, F.col("puts.seq") < F.col("gone.seq")], "left_anti")


def _live(spark: SparkSession, path: str, held: Snapshot, layout: Layout, wanted: Callable[[tuple], bool] | None = None) -> DataFrame:
    parts = [part for part in held.parts if wanted is None or wanted(part.keys)]
    return _surviving(_read(spark, path, held, layout, parts), layout, any(part.removals for part in parts))


def _created(rows: DataFrame, path: str, layout: str, buckets: int, marker: str | None, watch: Watch) -> None:
    form = LAYOUTS[layout]
    stored = _placed(rows.withColumns({"seq": F.lit(1).cast("long"), "live": F.lit(True)}), buckets, form)
    stored = stored.select(*[c for c in stored.columns if c not in form.parts], *form.parts)
    parts = _write(stored, path, commits.new_folder(None), form)
    watch("data")
    commits.commit(rows.sparkSession, path, None, parts, schema=stored.schema.json(),
                   settings={"layout": layout, "buckets": buckets}, markers={marker: True} if marker else None)
    watch("commit")


# --- history ---------------------------------------------------------------------------------------

def with_intervals(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``recorded_to``: the vintage of the key's next line. Of several lines of one vintage the last by all fields is seen."""
    rest = [c for c in columns if c not in (*bitemporal.KEY, "recorded_on")]
    order = Window.partitionBy(*bitemporal.KEY).orderBy("recorded_on", *rest)
    return lines.withColumn("recorded_to", F.coalesce(F.lead("recorded_on").over(order), F.lit(OPEN)))


def write_history(log: DataFrame, path: str, buckets: int = BUCKETS, marker: str | None = None, watch: Watch = _quiet) -> None:
    """First commit of a history from a log with one row per line."""
    _created(with_intervals(log, log.columns), path, "history", buckets, marker, watch)


def _log_columns(held: Snapshot) -> list[str]:
    return [c for c in StructType.fromJson(json.loads(held.schema)).names if c not in ("recorded_to", "seq", "live", *HISTORY.parts)]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the history with its interval."""
    held = commits.snapshot(spark, path)
    return _live(spark, path, held, HISTORY).select(*_log_columns(held), "recorded_to")


def view(spark: SparkSession, path: str, as_of_vintage: dt.date | None = None) -> DataFrame:
    """The current view, or the history as known on a past day: a filter on the interval."""
    held = commits.snapshot(spark, path)
    lines = _live(spark, path, held, HISTORY)
    if as_of_vintage is None:
        seen = F.col("recorded_to") == F.lit(OPEN)
    else:
        seen = (F.col("recorded_on") <= F.lit(as_of_vintage)) & (F.col("recorded_to") > F.lit(as_of_vintage))
    return lines.filter(seen).select(*_log_columns(held))


def append_history(batch: DataFrame, path: str, tolerance: float = bitemporal.VALUE_TOLERANCE, marker: str | None = None,
                   buckets: int = BUCKETS, watch: Watch = _quiet) -> DataFrame:
    """Append a batch and return the per-series summary; only new files are written.

    The batch meets the open lines of its own series buckets: those of the years it reaches, and older ones
    that are still provisional. The days it changes are read with all their vintages, their intervals
    computed anew, and what differs is written. A batch that changes nothing writes a commit only for its marker.
    """
    spark = batch.sparkSession
    held = commits.snapshot(spark, path)
    if held is None:
        empty = spark.createDataFrame([], batch.schema)
        plan = cut_lineage(bitemporal.append_plan(empty, batch, tolerance))
        write_history(bitemporal.apply_plan(empty, plan).select(*batch.columns), path, buckets, marker, watch)
        return bitemporal.append_summary(plan)
    buckets, columns = held.settings["buckets"], _log_columns(held)
    reach = batch.agg(F.min(F.year("as_of")).alias("year"), F.collect_set(bucket_of("series_id", buckets)).alias("buckets")).first()
    mine = set(reach["buckets"])
    lines = _live(spark, path, held, HISTORY, lambda keys: keys[1] in mine)
    open_lines = lines.filter((F.col("recorded_to") == F.lit(OPEN)) & ((F.col("year") >= F.lit(reach["year"])) | F.col("provisional")))
    stored = open_lines.join(batch.select("series_id").distinct(), "series_id", "left_semi").select(*columns)
    plan = cut_lineage(bitemporal.append_plan(stored, batch, tolerance))
    accepted = plan.filter("NOT refused AND action <> 'skip'")
    years = {row["year"] for row in accepted.select(F.year("as_of").alias("year")).distinct().collect()}
    parts: list[Part] = []
    if years:
        parts = _write(_placed(_delta(_live(spark, path, held, HISTORY, lambda keys: keys[1] in mine and keys[0] in years),
                                      plan, columns, held.number + 1), buckets, HISTORY),
                       path, commits.new_folder(held), HISTORY)
        watch("data")
    if parts or marker:
        commits.commit(spark, path, held, parts, markers={marker: True} if marker else None)
        watch("commit")
    return bitemporal.append_summary(plan)


def _delta(lines: DataFrame, plan: DataFrame, columns: list[str], seq: int) -> DataFrame:
    """Rows and removals that take ``lines`` to their state after the plan."""
    accepted = plan.filter("NOT refused AND action <> 'skip'")
    keys = accepted.select(*bitemporal.KEY).distinct()
    before = lines.join(keys, bitemporal.KEY, "left_semi").select(*columns, F.col("recorded_to").alias("old_to"))
    replaced = accepted.filter("action IN ('revise', 'freeze')").select(*bitemporal.KEY, F.col("old_recorded_on").alias("recorded_on"))
    identity = [*bitemporal.KEY, "recorded_on"]
    kept = before.join(replaced, identity, "left_anti").withColumn("fresh", F.lit(False))
    fresh = accepted.select(*[c for c in columns if c in accepted.columns]).withColumn("fresh", F.lit(True))
    after = with_intervals(kept.unionByName(fresh, allowMissingColumns=True), columns)
    moved = after.filter(F.col("fresh") | (F.col("recorded_to") != F.col("old_to")))
    puts = moved.select(*columns, "recorded_to", F.lit(seq).cast("long").alias("seq"), F.lit(True).alias("live"))
    closed = moved.filter("NOT fresh").select(*identity, F.col("old_to").alias("recorded_to"))
    gone = before.join(replaced, identity, "left_semi").select(*identity, F.col("old_to").alias("recorded_to"))
    removals = closed.unionByName(gone).select("*", F.lit(seq).cast("long").alias("seq"), F.lit(False).alias("live"))
    return puts.unionByName(removals, allowMissingColumns=True)


# --- full-replace series -------------------------------------------------------------------------------

def replace_series(obs: DataFrame, path: str, buckets: int = BUCKETS, marker: str | None = None, watch: Watch = _quiet) -> None:
    """Replace the whole history of each series in ``obs``: its new rows, and one removal per series."""
    _replace(obs, path, "series", buckets, marker, watch)


def upsert_readings(readings: DataFrame, path: str, buckets: int = BUCKETS, marker: str | None = None, watch: Watch = _quiet) -> None:
    """One row per (series, day): a reading takes the place of the stored row of its day; nothing else is read or rewritten."""
    _replace(readings, path, "readings", buckets, marker, watch)


def _replace(rows: DataFrame, path: str, layout: str, buckets: int, marker: str | None, watch: Watch) -> None:
    spark, form = rows.sparkSession, LAYOUTS[layout]
    held = commits.snapshot(spark, path)
    if held is None:
        _created(rows, path, layout, buckets, marker, watch)
        return
    columns = [c for c in StructType.fromJson(json.loads(held.schema)).names if c not in ("seq", "live", *form.parts)]
    mark = {"seq": F.lit(held.number + 1).cast("long")}
    changes = rows.select(*columns).withColumns(mark | {"live": F.lit(True)}).unionByName(
        rows.select(*form.identity).distinct().withColumns(mark | {"live": F.lit(False)}), allowMissingColumns=True)
    parts = _write(_placed(changes, held.settings["buckets"], form), path, commits.new_folder(held), form)
    watch("data")
    commits.commit(spark, path, held, parts, markers={marker: True} if marker else None)
    watch("commit")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a series or readings table."""
    held = commits.snapshot(spark, path)
    form = LAYOUTS[held.settings["layout"]]
    return _live(spark, path, held, form).drop("seq", "live", *form.parts)


# --- compaction --------------------------------------------------------------------------------------

def due(parts: Iterable[Part], fan: int = FAN) -> list[list[Part]]:
    """Groups of parts to merge: in each partition all parts up to the highest tier that holds ``fan`` of like size."""
    by_partition = defaultdict(list)
    for part in parts:
        by_partition[part.keys].append(part)
    chosen = []
    for found in by_partition.values():
        tiers = {part: int(math.log(max(part.rows, 1), fan)) for part in found}
        full = [tier for tier in set(tiers.values()) if sum(t == tier for t in tiers.values()) >= fan]
        if full:
            chosen.append([part for part in found if tiers[part] <= max(full)])
    return chosen


def compact(spark: SparkSession, path: str, fan: int = FAN, watch: Watch = _quiet) -> int:
    """Merges the parts that are due in one job; returns how many went. Readers see the table before or after.

    Removals are applied; they are kept only where older parts of their partition stay as they are.
    """
    held = commits.snapshot(spark, path)
    layout = LAYOUTS[held.settings["layout"]]
    groups = due(held.parts, fan)
    if not groups:
        return 0
    partition = defaultdict(set)
    for part in held.parts:
        partition[part.keys].add(part)
    chosen = [part for group in groups for part in group]
    partly = [part for group in groups if set(group) != partition[group[0].keys] for part in group]
    rows = _surviving(_read(spark, path, held, layout, chosen), layout, any(part.removals for part in chosen))
    if any(part.removals for part in partly):
        rows = rows.unionByName(_read(spark, path, held, layout, partly).filter("NOT live"))
    aside = scratch_path(spark, "compact")  # settled before the partitions are dealt out
    rows.write.parquet(aside)
    parts = _write(spark.read.schema(rows.schema).parquet(aside), path, commits.new_folder(held), layout)
    discard(spark, aside)
    watch("data")
    commits.commit(spark, path, held, parts, chosen, whole=True)
    watch("commit")
    return len(chosen)
