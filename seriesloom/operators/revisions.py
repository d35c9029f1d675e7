"""Write-boundary hygiene: rounding, deadband, declared revisions, replace guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.frames import first_of_each

DECIMALS = 4
SETTLE_DAYS = 7
SPLIT_SUSPECT_ROWS = 20
NAMED_ITEMS = 50
EPSILON_ABS = 1e-4
EPSILON_REL = 1e-4
MIN_RETAIN = 0.9
FIELDS = ["value", "value_tr"]


def round_values(obs: DataFrame, digits: int = DECIMALS) -> DataFrame:
    return obs.withColumns({c: F.round(c, digits) for c in FIELDS if c in obs.columns})


def deadband(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keep the stored number where the incoming one moved less than the deadband."""
    fields = [c for c in FIELDS if c in incoming.columns and c in stored.columns]
    old = stored.select("series_id", "as_of", *[F.col(c).alias(f"old_{c}") for c in fields])
    joined = incoming.join(old, ["series_id", "as_of"], "left")

    def settled(name: str) -> Column:
        before, after = F.col(f"old_{name}"), F.col(name)
        still = F.abs(after - before) <= F.greatest(F.lit(EPSILON_ABS), F.abs(before) * EPSILON_REL)
        return F.when(still, F.round(before, DECIMALS)).otherwise(after)

    return joined.withColumns({c: settled(c) for c in fields}).select(*incoming.columns)


def changed_cells(stored: DataFrame, incoming: DataFrame, settle_days: int = SETTLE_DAYS) -> DataFrame:
    """One row per changed number: ``series_id, as_of, field, old, new, settled, tip``.

    Stored numbers are compared at write precision; NULL and number count as different.
    """
    fields = [c for c in FIELDS if c in incoming.columns and c in stored.columns]
    tips = incoming.groupBy("series_id").agg(F.max("as_of").alias("tip"))
    old = stored.select("series_id", "as_of", *[F.round(c, DECIMALS).alias(f"old_{c}") for c in fields])
    paired = incoming.select("series_id", "as_of", *fields).join(old, ["series_id", "as_of"])
    cells = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("field"), F.col(f"old_{c}").alias("old"), F.col(c).alias("new"))
        for i, c in enumerate(fields)])
    moved = F.filter(cells, lambda cell: ~cell["old"].eqNullSafe(cell["new"]))
    return (
        paired.select("series_id", "as_of", F.inline(moved))
        .join(tips, "series_id")
        .withColumn("settled", F.col("as_of") >= F.date_sub("tip", settle_days))
    )


def classified_cells(cells: DataFrame, recomputed: DataFrame | None = None) -> DataFrame:
    """Adds ``kind``: settled, historical_value, value_recomputed or value_tr_rescale."""
    if recomputed is None:
        marked = cells.withColumn("recomputed", F.lit(False))
    else:
        flags = recomputed.select("series_id").distinct().withColumn("recomputed", F.lit(True))
        marked = cells.join(flags, "series_id", "left").withColumn("recomputed", F.coalesce("recomputed", F.lit(False)))
    kind = (F.when(F.col("settled"), F.lit("settled"))
            .when((F.col("field") == "value") & F.col("recomputed"), F.lit("value_recomputed"))
            .when(F.col("field") == "value", F.lit("historical_value"))
            .otherwise(F.lit("value_tr_rescale")))
    return marked.withColumn("kind", kind)


def named_items(classified: DataFrame, limit: int = NAMED_ITEMS) -> DataFrame:
    """The first ``limit`` named changes per series and kind, in day and field order."""
    named = classified.filter(F.col("kind").isin("settled", "historical_value"))
    return (
        first_of_each(named, ["series_id", "kind"], ["as_of", "place"], limit, "position")
        .select("series_id", "kind", F.col("position").cast("long").alias("position"), "as_of", "field", "old", "new")
    )


def all_changed_cells(stored: DataFrame, incoming: DataFrame, recomputed: DataFrame | None = None) -> DataFrame:
    """Every changed cell with its kind, for the ledger; nothing is capped."""
    return ledger_cells(classified_cells(changed_cells(stored, incoming), recomputed))


def ledger_cells(cells: DataFrame) -> DataFrame:
    """The columns of classified cells that the ledger keeps."""
    return cells.select("series_id", "as_of", "field", "kind", "old", "new")


def declarations(stored: DataFrame, incoming: DataFrame, recomputed: DataFrame | None = None,
                 split_rows: int = SPLIT_SUSPECT_ROWS, limit: int = NAMED_ITEMS) -> DataFrame:
    """One row per series that changed; series without a change do not appear.

    Counts are always complete, only the named lists stop at ``limit``.
    """
    return declared_cells(classified_cells(changed_cells(stored, incoming), recomputed), split_rows, limit)


def declared_cells(cells: DataFrame, split_rows: int = SPLIT_SUSPECT_ROWS, limit: int = NAMED_ITEMS) -> DataFrame:
    """``declarations`` from classified cells already at hand."""
    def n(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    move = F.abs(F.col("new") - F.col("old"))
    relative = F.when((F.col("old") == 0) | F.col("old").isNull(), 0.0).otherwise(move / F.abs("old"))
    counts = cells.groupBy("series_id").agg(
        F.max("tip").alias("tip"), F.date_sub(F.max("tip"), SETTLE_DAYS).alias("settle_window_from"),
        n("settled").alias("settled_n"), n("historical_value").alias("historical_value_n"),
        n("value_recomputed").alias("recomputed_n"), n("value_tr_rescale").alias("tr_rescale_n"),
        F.round(F.max(F.when(F.col("kind") == "value_recomputed", F.coalesce(move, F.lit(0.0)))), 8).alias("recomputed_max_abs"),
        F.round(F.max(F.when(F.col("kind") == "value_tr_rescale", relative)), 8).alias("tr_rescale_max_rel"))
    item = F.struct("position", "as_of", "field", "old", "new")

    def named(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item)))

    lists = named_items(cells, limit).groupBy("series_id").agg(
        named("settled").alias("settled"), named("historical_value").alias("historical_value"))
    return counts.join(lists, "series_id", "left").withColumn(
        "split_suspect", F.col("historical_value_n") >= split_rows)


def _short(number: Column) -> Column:
    """Up to eight decimals without trailing zeros."""
    return F.regexp_replace(F.format_string("%.8f", number), r"(\.\d+?)0+$", "$1")


def summary_line(declared: DataFrame) -> DataFrame:
    """Adds one line of text per declared series."""
    parts = [
        F.when(F.col("settled_n") > 0, F.format_string("settled %d", "settled_n")),
        F.when(F.col("historical_value_n") > 0, F.concat(
            F.format_string("HISTORICAL value %d", "historical_value_n"),
            F.when(F.col("split_suspect"), F.lit(" SPLIT-SUSPECT")).otherwise(F.lit("")))),
        F.when(F.col("recomputed_n") > 0, F.concat(
            F.format_string("recomputed n=%d max_abs=", "recomputed_n"), _short(F.col("recomputed_max_abs")))),
        F.when(F.col("tr_rescale_n") > 0, F.concat(
            F.format_string("tr-rescale n=%d max_rel=", "tr_rescale_n"), _short(F.col("tr_rescale_max_rel")))),
    ]
    return declared.withColumn("summary", F.concat_ws(" · ", *parts))


# --- replace guards ----------------------------------------------------------------------

def keep_window(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Drop incoming rows before the stored first day; new series pass whole."""
    starts = stored.groupBy("series_id").agg(F.min("as_of").alias("first_day"))
    return (incoming.join(starts, "series_id", "left")
            .filter(F.col("first_day").isNull() | (F.col("as_of") >= F.col("first_day")))
            .drop("first_day"))


def truncation_check(stored: DataFrame, incoming: DataFrame, min_retain: float = MIN_RETAIN) -> DataFrame:
    """Per incoming series: row counts and whether the replace would lose too many rows."""
    before = stored.groupBy("series_id").agg(F.count(F.lit(1)).alias("stored_rows"))
    after = incoming.groupBy("series_id").agg(F.count(F.lit(1)).alias("incoming_rows"))
    both = after.join(before, "series_id", "left")
    refused = F.coalesce(F.col("incoming_rows") < F.col("stored_rows") * min_retain, F.lit(False))
    return both.select(
        "series_id", "stored_rows", "incoming_rows", refused.alias("refused"),
        F.when(refused, F.format_string("refused: would truncate %d->%d rows", "stored_rows", "incoming_rows")).alias("reason"))


def _edges(frame: DataFrame, label: str) -> DataFrame:
    return frame.groupBy("series_id").agg(F.min("as_of").alias(f"{label}_first"), F.max("as_of").alias(f"{label}_last"))


def interior_gaps(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Every stored day between a series' first and last incoming day that the incoming rows lack."""
    return (
        stored.select("series_id", "as_of").join(_edges(incoming, "new"), "series_id")
        .filter(F.col("as_of").between(F.col("new_first"), F.col("new_last"))).select("series_id", "as_of")
        .join(incoming.select("series_id", "as_of"), ["series_id", "as_of"], "left_anti")
    )


def edge_warnings(stored: DataFrame, incoming: DataFrame, named: int = 3) -> DataFrame:
    """Head, tail and interior losses of a replace, per series that has stored rows; all gaps: ``interior_gaps``."""
    spans = _edges(stored, "old").join(_edges(incoming, "new"), "series_id")
    holes = interior_gaps(stored, incoming)
    counted = holes.groupBy("series_id").agg(F.count(F.lit(1)).alias("gaps"))
    first = first_of_each(holes, ["series_id"], ["as_of"], named).groupBy("series_id").agg(
        F.array_sort(F.collect_list(F.col("as_of").cast("string"))).alias("first_gaps"))
    listed = counted.join(first, "series_id")
    return spans.join(listed, "series_id", "left").select(
        "series_id", (F.col("new_first") > F.col("old_first")).alias("head_shorter"),
        (F.col("new_last") < F.col("old_last")).alias("tail_regressed"),
        F.coalesce("gaps", F.lit(0)).cast("long").alias("interior_gaps"),
        F.coalesce(F.array_join("first_gaps", ","), F.lit("")).alias("first_gaps"))


def replace_batch(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ready for a full replace, and the status of every incoming series."""
    kept = keep_window(stored, incoming)
    status = truncation_check(stored, kept)
    ready = kept.join(status.filter(~F.col("refused")).select("series_id"), "series_id", "left_semi")
    return deadband(stored, round_values(ready)), status
