"""End-to-end runs composed from the operators. Each returns frames; writing is the caller's step."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.frames import whole
from seriesloom.operators import bitemporal, corporate, positioning, quality, registry, revisions, windows
from seriesloom.session import cut_lineage


@dataclass
class PriceRun:
    plan: DataFrame
    summary: DataFrame
    mismatched: DataFrame
    unstamped: DataFrame
    split: DataFrame
    unhealed: DataFrame


def daily_price_run(landed: DataFrame, log: DataFrame, instruments: DataFrame, catalog: DataFrame,
                    live_currency: DataFrame, run_date: dt.date, require_stamp: bool = True,
                    repull: DataFrame | None = None) -> PriceRun:
    """Landed rows to an append plan: shape, currency check, identity stamp, split heal, compare with the history.

    ``repull`` holds full re-pulled bars. A stock series whose batch carries a split is healed in the same
    run: its batch becomes the re-pull plus the stored days the re-pull lacks, rescaled, so that its archive
    never stays on two scales. ``unhealed`` names split series without a re-pull; they append as they are.
    """
    bars = corporate.build_bars(landed)
    outcomes = registry.reconcile_currency(instruments, live_currency)
    clean = registry.drop_mismatched(bars, outcomes)
    stamped, refused = registry.stamp(clean, catalog, require_stamp)
    batch = stamped.withColumn("recorded_on", F.lit(run_date))
    split = corporate.split_series(batch, instruments)
    unhealed = split
    if repull is not None:
        # One row per split series, written once: the bars are not built again for each list below.
        def held(frame: DataFrame, name: str) -> DataFrame:
            return frame.select("series_id").distinct().withColumn(name, F.lit(True))

        split = cut_lineage(split.join(held(repull, "offered"), "series_id", "left").join(held(log, "stored"), "series_id", "left"))
        unhealed = split.filter(F.col("offered").isNull()).select("series_id")
        known = split.filter("offered AND stored").select("series_id")  # a series new to the archive has nothing to heal
        split = split.select("series_id")
        stored = bitemporal.current_view(log).join(known, "series_id", "left_semi")
        healed = corporate.heal_batch(stored, repull.join(known, "series_id", "left_semi")).withColumns({
            "provisional": F.col("as_of") == F.max("as_of").over(whole()), "recorded_on": F.lit(run_date)})
        shared = [c for c in batch.columns if c in healed.columns]
        batch = batch.join(known, "series_id", "left_anti").unionByName(healed.select(*shared), allowMissingColumns=True)
    plan = bitemporal.append_plan(log, batch)
    return PriceRun(plan, bitemporal.append_summary(plan), outcomes.filter("outcome = 'mismatch'"), refused, split, unhealed)


def base_first_read(log: DataFrame, wanted: DataFrame, instruments: DataFrame, fallback: DataFrame, period: str,
                    end: dt.date, vintage: dt.date | None = None, pinned: Sequence[str] = (),
                    major_units: bool = True, **belt) -> DataFrame:
    """Adjusted bars per wanted symbol: archive first, fallback for the rest, then one unit for all."""
    view = corporate.positive_close(bitemporal.current_view(log, vintage))
    adjusted = corporate.auto_adjust(corporate.total_return(view, pinned, **belt))
    base = corporate.clip_window(adjusted, period, end)
    bars, _ = registry.base_first(wanted, instruments, base, corporate.clip_window(fallback, period, end))
    if not major_units:
        return bars
    by_symbol = instruments.select(F.col("symbol").alias("series_id"), "quote_basis")
    return corporate.to_major_units(bars.withColumnRenamed("symbol", "series_id"), by_symbol).withColumnRenamed("series_id", "symbol")


@dataclass
class MacroRun:
    ready: DataFrame
    status: DataFrame
    declared: DataFrame
    warnings: DataFrame
    absent: DataFrame


def macro_run(feeds: Sequence[DataFrame], stored: DataFrame, anchors: DataFrame, rates: DataFrame | None = None,
              cohort: DataFrame | None = None, expected: DataFrame | None = None) -> MacroRun:
    """Feeds to rows ready for a full replace, with replace status, declared revisions and edge warnings.

    Rows without a value are none. Series named in ``rates`` are extended by the nowcast; then the series of ``cohort`` (all
    without one) are carried forward to the latest month an anchor series reached. Other series,
    such as weekly ones, keep their rows. ``absent`` names the ``expected`` series no feed delivered.
    """
    stored = stored.filter(F.col("value").isNotNull())
    feeds = [feed.filter(F.col("value").isNotNull()) for feed in feeds]
    assembled = registry.assemble(feeds).select("series_id", "as_of", "value").withColumns({
        "filled": F.lit(None).cast("string"), "provisional": F.lit(False)})
    if rates is not None:
        assembled = assembled.unionByName(windows.chained_nowcast(assembled, rates))
    frontier = windows.cohort_frontier(assembled, anchors).scalar()
    filled = windows.carry_forward(assembled, frontier, cohort)
    ready, status = revisions.replace_batch(stored, filled)
    wanted = (stored if expected is None else expected).select("series_id").distinct()
    absent = wanted.join(assembled.select("series_id").distinct(), "series_id", "left_anti")
    return MacroRun(ready, status, revisions.declarations(stored, ready), revisions.edge_warnings(stored, filled), absent)


def configured_positioning_run(reports: DataFrame, markets: Sequence[positioning.Market], today: dt.date,
                               max_gap_days: int = 60) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw reports to stored rows of the configured markets.

    Each market picks its rows by code or name, pins and then excludes names, and reads the cohorts of
    its own report family. Markets that mix contracts without a declaration are refused.
    """
    chosen = positioning.pin_configured_names(positioning.assign_markets(reports, markets), markets)
    rows = None
    for family in sorted({m.family for m in markets}):
        keys = [m.key for m in markets if m.family == family]
        part = positioning.normalized(chosen.filter(F.col("market").isin(keys)), family)
        rows = part if rows is None else rows.unionByName(part)
    table = positioning.market_table(reports.sparkSession, markets).select(
        F.concat(F.lit("pos_"), F.lower(F.replace("market", F.lit("#"), F.lit("_")))).alias("series_id"),
        "declared", F.col("code").isNotNull().alias("pinned"), "declared_break", "satellite")
    return _guarded(positioning.stored_rows(rows), table, today, max_gap_days)


def positioning_run(landed: DataFrame, markets: DataFrame, today: dt.date, max_gap_days: int = 60) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landed reports to stored rows, a report per series, and the freshness of what was written."""
    return _guarded(positioning.stored_rows(positioning.normalized(landed)), markets, today, max_gap_days)


def _guarded(rows: DataFrame, markets: DataFrame, today: dt.date, max_gap_days: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    guard = positioning.identity_guard(rows, markets)
    written = rows.join(guard.filter("accepted").select("series_id"), "series_id", "left_semi")
    report = guard.join(positioning.quality_flags(rows, markets, max_gap_days=max_gap_days), "series_id")
    return written, report, quality.batch_freshness(written, today)


def verification_run(view: DataFrame, log: DataFrame, instruments: DataFrame, baselines: DataFrame, quarantine: DataFrame,
                     exemptions: DataFrame, required: Sequence[str], today: dt.date,
                     venue_view: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All gates over an archive, one row each, and their tally with the verdict.

    The view and the lines per day are written once; every gate reads those. ``venue_view`` carries
    ``symbol`` for the session calendars and defaults to the view.
    """
    held, lines = cut_lineage(view), cut_lineage(quality.lines_per_day(log))
    venue = held if venue_view is None else cut_lineage(venue_view)
    summary = cut_lineage(quality.series_profile(instruments, held))
    sound = F.col("traded_positive") & F.col("factor_positive") & F.col("anchored") & F.col("piecewise")
    rows = [
        quality.gate("depth", quality.depth_violations(held, baselines)),
        quality.gate("coverage", quality.coverage_report(summary, instruments, quarantine).filter(~F.col("quarantined"))),
        quality.gate("recency", quality.stale_series(held, exemptions, today).filter("tier = 'fail'")),
        quality.gate("density", quality.sparse_series(venue, exemptions, today).filter("tier = 'fail'")),
        quality.gate("split_soundness", quality.split_soundness(held).filter(~sound)),
        quality.gate("seed_conflict", lines.filter(F.col("n_lines") > 1)),
        quality.gate("vintage_conflict", lines.filter(F.col("n_lines") != F.col("n_vintages"))),
        quality.gate("provisional_tip", quality.provisional_violations(held)),
        quality.gate("record_shape", quality.shape_violations(held, list(required))),
        quality.gate("thin", quality.thin_series(summary), hard=False),
    ]
    gates = rows[0]
    for row in rows[1:]:
        gates = gates.unionByName(row)
    gates = cut_lineage(gates)
    return gates, quality.tally(gates)
