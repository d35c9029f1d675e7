"""Registry and catalog work: scopes, catalog rows, currency checks, identity stamps, feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.text import canonical_currency, exchange_code, name_key, venue_group

FAMILIES = ["etf", "stock"]


def family() -> Column:
    """An absent family means etf."""
    return F.coalesce("family", F.lit("etf"))


def labelled(registry: DataFrame) -> DataFrame:
    """Registry with canonical basis, exchange code, venue group and loose name."""
    return registry.withColumns({
        "basis": canonical_currency(F.col("quote_basis")), "exch_code": exchange_code(F.col("symbol")),
        "venue": venue_group(F.col("symbol")), "name_key": name_key(F.col("name"))})


def scope(registry: DataFrame, families: Sequence[str] | None = None, prefix: str | None = None,
          multi_currency: bool = True, only: Sequence[str] | None = None) -> DataFrame:
    """Active series of the wanted families, namespace and list; retired ones never match."""
    kept = registry.filter(~F.coalesce("retired", F.lit(False)))
    if families is not None:
        kept = kept.filter(family().isin(list(families)))
    if prefix is not None:
        kept = kept.filter(F.col("series_id").startswith(prefix))
    if not multi_currency:
        kept = kept.filter(F.col("currency").isNull())
    if only is not None:
        kept = kept.filter(F.col("series_id").isin(list(only)))
    return kept


def resolve_symbols(wanted: DataFrame, registry: DataFrame) -> DataFrame:
    """Series of each wanted symbol, ignoring case; unknown ones are marked, not lost."""
    known = registry.select(F.upper("symbol").alias("key"), "series_id")
    return (wanted.withColumn("key", F.upper(F.trim("symbol"))).join(known, "key", "left").drop("key")
            .withColumn("known", F.col("series_id").isNotNull()))


def catalog_rows(registry: DataFrame, stable: DataFrame | None = None) -> DataFrame:
    """Catalog entries by family, with a reason on every entry that must be refused."""
    stock = F.col("family") == "stock"
    known = family().isin(FAMILIES)
    reason = (F.when(F.col("currency").isNotNull() & ~F.coalesce(stock, F.lit(False)), F.lit("currency requires family stock"))
              .when(~known, F.concat(F.lit("unknown family "), "family")))
    rows = registry if stable is None else registry.join(stable, "series_id", "left")
    stable_id = F.when(stock, F.col("stable_id")) if stable is not None else F.lit(None).cast("string")
    basis = F.when(stock & F.col("currency").isNotNull(), F.coalesce("quote_basis", "currency"))
    return rows.select(
        "series_id", "symbol", "category", F.when(stock, F.lit("stock")).alias("family"),
        (~F.coalesce(stock, F.lit(False))).alias("backtest_valid"),
        F.when(stock, F.lit("current-members-only")).alias("survivorship"),
        F.when(stock, F.col("currency")).alias("currency"), basis.alias("quote_basis"),
        F.lit("daily").alias("frequency"), F.lit("price").alias("unit"), F.lit(1).cast("long").alias("schema_version"),
        stable_id.alias("stable_id"),
        F.concat(F.col("name"), F.lit(" ("), F.col("symbol"), F.lit(") daily price bar"),
                 F.when(basis != F.col("currency"), F.concat(F.lit(", quoted in "), basis)).otherwise(F.lit(""))).alias("description"),
        reason.alias("reject_reason"))


# Cohort names of each report family, primary to tertiary.
COHORT_NAMES = {
    "financial": ("leveraged funds", "asset managers", "dealers"),
    "commodity": ("managed money", "producers/merchants", "swap dealers"),
}


def positioning_catalog_rows(markets: DataFrame) -> DataFrame:
    """Catalog entries of positioning series; ``markets`` holds ``series_id, family, code, satellite``."""
    def cohort(place: int) -> Column:
        chosen = F.lit(None).cast("string")
        for name, cohorts in COHORT_NAMES.items():
            chosen = F.when(F.col("family") == name, F.lit(cohorts[place])).otherwise(chosen)
        return chosen

    quality = F.array_compact(F.array(
        F.when(F.col("code").isNotNull(), F.concat(F.lit("code_pinned "), F.col("code"))),
        F.when(F.col("satellite").isNotNull(), F.concat(F.lit("satellite: "), F.col("satellite")))))
    return markets.select(
        "series_id", F.concat(cohort(0), F.lit(" net = long - short, weekly report")).alias("basis"),
        F.lit("weekly").alias("frequency"), F.lit("contracts_net").alias("unit"), "code",
        F.array_join(quality, "; ").alias("quality"),
        F.concat_ws(", ", cohort(0), cohort(1), cohort(2)).alias("cohorts"),
        F.when(cohort(0).isNull(), F.concat(F.lit("unknown family "), F.col("family"))).alias("reject_reason"))


def backtest_eligible(catalog: DataFrame, overrides: Sequence[str] = ()) -> DataFrame:
    """Entries open to long-horizon use; an override lets a refused one pass, visibly."""
    listed = F.col("series_id").isin(list(overrides)) if overrides else F.lit(False)
    return catalog.withColumn("overridden", ~F.col("backtest_valid") & listed).filter(
        F.col("backtest_valid") | F.col("overridden"))


def merge_catalog(catalog: DataFrame, incoming: DataFrame, prefix: str, retired: DataFrame) -> DataFrame:
    """Catalog after an upsert inside one namespace, with ``status`` added, updated or kept.

    Entries of other namespaces and of retired series stay as they are; nothing is pruned.
    """
    wanted = (incoming.filter(F.col("series_id").startswith(prefix))
              .join(retired.select("series_id"), "series_id", "left_anti"))
    fields = [c for c in catalog.columns if c != "series_id"]
    old = catalog.select("series_id", F.struct(*fields).alias("old"))
    new = wanted.select("series_id", F.struct(*fields).alias("new"))
    status = (F.when(F.col("old").isNull(), F.lit("added")).when(F.col("new").isNull(), F.lit("kept"))
              .otherwise(F.lit("updated")))
    return (old.join(new, "series_id", "full_outer")
            .select("series_id", F.coalesce("new", "old").alias("entry"), status.alias("status"))
            .select("series_id", "entry.*", "status"))


def ready_scope(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each wanted series as ready, unregistered, or unstamped (a stock without a stable id)."""
    entry = catalog.select("series_id", "stable_id", F.lit(True).alias("registered"))
    readiness = (F.when(F.col("registered").isNull(), F.lit("unregistered"))
                 .when((family() == "stock") & F.col("stable_id").isNull(), F.lit("unstamped"))
                 .otherwise(F.lit("ready")))
    return wanted.select("series_id", "family").join(entry, "series_id", "left").select(
        "series_id", readiness.alias("readiness"))


def reconcile_currency(registry: DataFrame, live: DataFrame) -> DataFrame:
    """Registered basis against the live one: ok, mismatch or unverified.

    Series without a basis have nothing to reconcile. ``live`` holds ``symbol, live_currency``.
    """
    known = registry.filter(F.col("quote_basis").isNotNull()).join(live, "symbol", "left")
    outcome = (F.when(F.col("live_currency").isNull(), F.lit("unverified"))
               .when(canonical_currency(F.col("live_currency")) != canonical_currency(F.col("quote_basis")), F.lit("mismatch"))
               .otherwise(F.lit("ok")))
    return known.select("series_id", "quote_basis", "live_currency", outcome.alias("outcome"))


def drop_mismatched(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    return rows.join(outcomes.filter("outcome = 'mismatch'").select("series_id"), "series_id", "left_anti")


def stamp(bars: DataFrame, catalog: DataFrame, require_stamp: bool = False) -> tuple[DataFrame, DataFrame]:
    """Bars with the catalog's stable id, and the series refused for lacking one."""
    entry = catalog.select("series_id", F.col("family").alias("entry_family"), "stable_id")
    refused = catalog.filter((F.col("family") == "stock") & F.col("stable_id").isNull()).select(
        "series_id", F.lit("unstamped stock").alias("reason"))
    stamped = bars.join(entry, "series_id", "left").withColumn(
        "stable_id", F.when(F.col("entry_family") == "stock", F.col("stable_id"))).drop("entry_family")
    if not require_stamp:
        return stamped, refused.limit(0)
    return stamped.join(refused.select("series_id"), "series_id", "left_anti"), refused


# --- feeds ------------------------------------------------------------------------------------

def assemble(feeds: Sequence[DataFrame]) -> DataFrame:
    """Union of feeds ``series_id, as_of, value``; a later feed replaces a series whole."""
    ranked = reduce(lambda a, b: a.unionByName(b),
                    [f.select("series_id", "as_of", "value", F.lit(i).alias("feed")) for i, f in enumerate(feeds)])
    winners = ranked.groupBy("series_id").agg(F.max("feed").alias("feed"))
    return ranked.join(winners, ["series_id", "feed"], "left_semi").select(
        "series_id", "as_of", "value", F.col("feed").cast("long").alias("feed"))


def not_attempted(expected: DataFrame, attempted: DataFrame) -> DataFrame:
    return expected.select("series_id").distinct().join(attempted.select("series_id"), "series_id", "left_anti")


def unpivot_blocks(blocks: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """Wide result blocks to ``series_id, as_of, value, source`` by column, empty cells dropped."""
    cells = F.array(*[
        F.struct(F.lit(series).alias("series_id"), F.col(column).cast("double").alias("value"), F.lit(source).alias("source"))
        for column, (series, source) in mapping.items()])
    return blocks.select("as_of", F.inline(F.filter(cells, lambda c: c["value"].isNotNull())))


def block_status(blocks: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per mapped series: its row count, or why it is skipped."""
    counts = blocks.agg(*[F.count(c).alias(c) for c in mapping])
    cells = F.array(*[F.struct(F.lit(series).alias("series_id"), F.col(c).alias("n_rows")) for c, (series, _) in mapping.items()])
    return counts.select(F.inline(cells)).withColumn("skipped", F.when(F.col("n_rows") == 0, F.lit("no data")))


def run_summary(appended: DataFrame) -> DataFrame:
    """Accepted, changed, idempotent and skipped series, and bars appended."""
    changed = F.col("ok") & (F.col("years_touched") != "")
    return appended.agg(
        F.count_if("ok").alias("accepted"), F.count_if(changed).alias("changed"),
        F.count_if(F.col("ok") & ~changed).alias("idempotent"), F.count_if(~F.col("ok")).alias("skipped"),
        F.sum(F.when(F.col("ok"), F.col("appended")).otherwise(0)).alias("bars_appended"),
        F.count(F.lit(1)).alias("attempted"))


# --- base-first read ----------------------------------------------------------------------------

OHLCV = ["open", "high", "low", "close", "volume"]


def base_first(wanted: DataFrame, registry: DataFrame, base: DataFrame, fallback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars per wanted symbol, from the archive where it serves it and from the fallback elsewhere.

    ``base`` holds bars by series, already clipped; ``fallback`` bars by symbol. A symbol
    is served when a side has any close for it: one partial aggregate per side finds the served symbols,
    and only fallback rows of symbols that the archive does not serve are kept. No side is
    regrouped whole. The second frame names each symbol's provenance; symbols neither side
    can serve are absent.
    """
    resolved = resolve_symbols(wanted.select("symbol").distinct(), registry)
    mine = base.join(resolved.filter("known").select("symbol", "series_id"), "series_id")
    theirs = fallback.join(resolved.select("symbol"), "symbol", "left_semi")
    served = mine.filter(F.col("close").isNotNull()).select("symbol").distinct()
    offered = theirs.filter(F.col("close").isNotNull()).select("symbol").distinct()
    bars = (mine.join(served, "symbol", "left_semi").select("symbol", "as_of", *OHLCV, F.lit("base").alias("provenance"))
            .unionByName(theirs.join(offered.join(served, "symbol", "left_anti"), "symbol", "left_semi").select(
                "symbol", "as_of", *OHLCV, F.lit("fetch").alias("provenance"))))
    return bars, bars.select("symbol", "provenance").distinct()


def sources_of(resolved: DataFrame, provenance: DataFrame) -> DataFrame:
    """Provenance of every wanted symbol: base, fetch, unmapped or dead."""
    return resolved.join(provenance, "symbol", "left").select(
        "symbol", F.coalesce("provenance", F.when(F.col("known"), F.lit("dead")).otherwise(F.lit("unmapped"))).alias("provenance"))
