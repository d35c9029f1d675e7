"""Weekly positioning reports: cohorts, row choice, identity seams and quality flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.frames import in_order
from seriesloom.functions.text import holds_all, holds_any, loose_number, loose_number_or_zero

FINANCIAL = "financial"
COMMODITY = "commodity"

# Report columns of each cohort, long then short, by report family.
COHORT_COLUMNS = {
    FINANCIAL: {
        "primary": ("lev_money_positions_long", "lev_money_positions_short"),
        "secondary": ("asset_mgr_positions_long", "asset_mgr_positions_short"),
        "tertiary": ("dealer_positions_long_all", "dealer_positions_short_all"),
    },
    COMMODITY: {
        "primary": ("m_money_positions_long_all", "m_money_positions_short_all"),
        "secondary": ("prod_merc_positions_long", "prod_merc_positions_short"),
        "tertiary": ("swap_positions_long_all", "swap__positions_short_all"),
    },
}
SMALL_CONTRACTS = ["MICRO", "MINI-SIZED"]
LEGS = [f"{cohort}_{leg}" for cohort in ("primary", "secondary", "tertiary") for leg in ("long", "short", "net")]


@dataclass(frozen=True)
class Market:
    """One configured market: pinned by contract code, or found by name."""

    key: str
    family: str = FINANCIAL
    code: str | None = None
    query_name: str | None = None
    must_contain: Sequence[str] = field(default_factory=tuple)
    must_not_contain: Sequence[str] = field(default_factory=tuple)
    satellite: str | None = None
    declared_break: bool = False

    @property
    def declared(self) -> bool:
        return bool(self.code or self.satellite or self.declared_break)


def market_table(spark, markets: Sequence[Market]) -> DataFrame:
    return spark.createDataFrame(
        [(m.key, m.family, m.code, m.query_name, list(m.must_contain), list(m.must_not_contain),
          m.satellite, m.declared_break, m.declared) for m in markets],
        "market string, family string, code string, query_name string, must_contain array<string>, "
        "must_not_contain array<string>, satellite string, declared_break boolean, declared boolean")


def _net(long_leg: Column, short_leg: Column) -> Column:
    return long_leg - short_leg


def cohorts(landed: DataFrame, family: str) -> DataFrame:
    """Long, short and net of the three cohorts of one report family."""
    columns = []
    for cohort, (long_name, short_name) in COHORT_COLUMNS[family].items():
        long_leg, short_leg = loose_number(F.col(long_name)), loose_number(F.col(short_name))
        columns += [long_leg.alias(f"{cohort}_long"), short_leg.alias(f"{cohort}_short"),
                    _net(long_leg, short_leg).alias(f"{cohort}_net")]
    return landed.select(
        "market", F.col("report_date").alias("date"), F.col("contract_name").alias("market_name"),
        loose_number(F.col("open_interest_all")).alias("open_interest"), *columns)


def parsed_interest(landed: DataFrame) -> DataFrame:
    """Open interest parsed two ways: garbage as NULL, and garbage as zero."""
    text = F.col("open_interest_all")
    return landed.select("market", "report_date", "contract_name",
                         loose_number(text).alias("open_interest"),
                         loose_number_or_zero(text).alias("open_interest_or_zero"),
                         loose_number(F.col("lev_money_positions_long")).alias("primary_long"))


def _keep_if_any(rows: DataFrame, keep: Column) -> DataFrame:
    """Keep matching rows of a market; a market without any match keeps all its rows.

    The fallback is decided by a partial aggregate per market, so a market that holds a
    large share of the rows is never gathered in one place.
    """
    flagged = rows.withColumn("keep", keep)
    decided = flagged.groupBy("market").agg(F.max("keep").alias("any_match"))
    return flagged.join(decided, "market").filter(F.col("keep") | ~F.col("any_match")).drop("keep", "any_match")


def pin_names(landed: DataFrame, terms: Sequence[str]) -> DataFrame:
    return _keep_if_any(landed, holds_all(F.col("contract_name"), list(terms)))


def exclude_names(landed: DataFrame, terms: Sequence[str]) -> DataFrame:
    return landed.filter(~holds_any(F.col("contract_name"), list(terms)))


def exclude_small_contracts(landed: DataFrame) -> DataFrame:
    return _keep_if_any(landed, ~holds_any(F.col("contract_name"), SMALL_CONTRACTS))


def assign_markets(reports: DataFrame, markets: Sequence[Market]) -> DataFrame:
    """Attach each report row to the markets that ask for it.

    A pinned market matches by contract code; any other by a part of the contract name.
    The market list is configuration, so it travels as literals and no join is needed.
    Required and excluded terms come later: see ``pin_configured_names``.
    """
    name = F.upper("contract_name")

    def wanted(m: Market) -> Column:
        if m.code:
            return F.col("contract_code") == m.code
        return F.contains(name, F.lit((m.query_name or m.key).upper()))

    hits = F.array_compact(F.array(*[F.when(wanted(m), F.lit(m.key)) for m in markets]))
    return reports.withColumn("market", F.explode(hits))


def pin_configured_names(rows: DataFrame, markets: Sequence[Market]) -> DataFrame:
    """Apply each name-found market's required terms with the keep-all fallback, then drop excluded names.

    Exclusion has no fallback and comes second: if it takes the pinned rows, the market has none.
    """
    keep, barred = F.lit(True), F.lit(False)
    for m in markets:
        if not m.code and m.must_contain:
            keep = F.when(F.col("market") == m.key, holds_all(F.col("contract_name"), list(m.must_contain))).otherwise(keep)
        if not m.code and m.must_not_contain:
            barred = F.when(F.col("market") == m.key, holds_any(F.col("contract_name"), list(m.must_not_contain))).otherwise(barred)
    return _keep_if_any(rows, keep).filter(~barred)


def largest_per_date(landed: DataFrame) -> DataFrame:
    """One row per market and date: the largest open interest, then the first contract name."""
    rank = F.struct(loose_number_or_zero(F.col("open_interest_all")).alias("interest"),
                    F.col("contract_name"))
    payload = [c for c in landed.columns if c not in ("market", "report_date")]
    ordered = landed.withColumn("interest", rank["interest"])
    best = F.min_by(F.struct(*payload), F.struct(-F.col("interest"), F.col("contract_name")))
    return (ordered.groupBy("market", "report_date").agg(best.alias("best"))
            .select("market", "report_date", "best.*"))


def normalized(landed: DataFrame, family: str = FINANCIAL) -> DataFrame:
    """Landed rows to weekly cohort rows: drop small contracts, one row per date, parse."""
    return cohorts(largest_per_date(exclude_small_contracts(landed)), family)


def stored_rows(positions: DataFrame, prefix: str = "pos_") -> DataFrame:
    """Stored form of cohort rows: ``value`` is the primary net, rows without one are left out."""
    return positions.filter(F.col("primary_net").isNotNull()).select(
        F.concat(F.lit(prefix), F.lower(F.replace("market", F.lit("#"), F.lit("_")))).alias("series_id"),
        F.col("date").alias("as_of"), F.col("primary_net").alias("value"), F.lit("weekly_report").alias("source"),
        *LEGS, "open_interest", "market_name")


def report_rows(stored: DataFrame, family: str) -> DataFrame:
    """Reader view of stored rows, back in report shape."""
    return stored.select("series_id", F.col("as_of").alias("date"), "market_name", "open_interest", *LEGS,
                         F.lit(family).alias("report_family"))


def with_capacity(view: DataFrame, capacity: DataFrame, digits: int = 1) -> DataFrame:
    """Attach the capacity of each market in billions, NULL when it has none."""
    scaled = capacity.select("series_id", F.round(F.col("capacity") / 1e9, digits).alias("capacity_bn"))
    return view.join(scaled, "series_id", "left")


# --- identity -------------------------------------------------------------------------

def named(positions: DataFrame) -> DataFrame:
    """Rows of ``series_id, as_of`` that carry a contract name."""
    trimmed = positions.withColumn("market_name", F.trim("market_name"))
    return trimmed.filter(F.coalesce(F.col("market_name"), F.lit("")) != "")


def identities(positions: DataFrame) -> DataFrame:
    """Distinct contract names per series in order of first appearance."""
    first = named(positions).groupBy("series_id", "market_name").agg(F.min("as_of").alias("first_seen"))
    return first.groupBy("series_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("first_seen", "market_name"))),
                    lambda s: s["market_name"]).alias("names"))


def seam(positions: DataFrame, which: str = "first") -> DataFrame:
    """The first (or latest) date on which a series changes its contract name."""
    steps = named(positions).select(
        "series_id", F.col("as_of").alias("seam_date"), F.col("market_name").alias("to_identity"),
        F.lag("market_name").over(in_order()).alias("from_identity"),
        F.lag("as_of").over(in_order()).alias("last_clean_date"))
    changed = steps.filter(F.col("from_identity").isNotNull() & (F.col("from_identity") != F.col("to_identity")))
    record = F.struct("seam_date", "from_identity", "to_identity", "last_clean_date")
    pick = F.min_by(record, "seam_date") if which == "first" else F.max_by(record, "seam_date")
    return changed.groupBy("series_id").agg(pick.alias("seam")).select("series_id", "seam.*")


def clean_segment(positions: DataFrame, seams: DataFrame, which_benign: Column | None = None) -> DataFrame:
    """Rows under the identity named by the seam; a series without a seam keeps all rows.

    ``which_benign`` marks seams that are mere renames and must not cut the history.
    """
    real = seams if which_benign is None else seams.filter(~which_benign)
    joined = positions.join(real.select("series_id", "to_identity"), "series_id", "left")
    return joined.filter(F.col("to_identity").isNull() | (F.trim("market_name") == F.col("to_identity"))).withColumn(
        "segment", F.coalesce("to_identity", F.lit("single-contract"))).drop("to_identity")


def identity_guard(positions: DataFrame, declared: DataFrame) -> DataFrame:
    """Refuse series that mix contract names although nothing was declared for them."""
    names = identities(positions).join(declared.select("series_id", "declared"), "series_id", "left")
    refused = (F.size("names") > 1) & ~F.coalesce("declared", F.lit(False))
    return names.select(
        "series_id", F.size("names").cast("long").alias("n_names"), (~refused).alias("accepted"),
        F.when(refused, F.format_string("identity_rejected: %d contracts under one key", F.size("names")))
        .alias("reason"))


def quality_flags(positions: DataFrame, markets: DataFrame, min_obs: int = 8, max_gap_days: int = 60) -> DataFrame:
    """Flags per series, from one ordered pass and one aggregate.

    ``markets`` holds ``series_id, pinned, declared_break, satellite``.
    """
    net, name = F.col("primary_net"), F.nullif(F.trim(F.coalesce("market_name", F.lit(""))), F.lit(""))
    before = in_order().rowsBetween(Window.unboundedPreceding, -1)
    steps = positions.select(
        "series_id", "as_of", net.alias("net"), name.alias("name"),
        F.last(name, ignorenulls=True).over(before).alias("name_before"),
        F.datediff("as_of", F.lag("as_of").over(in_order())).cast("long").alias("step_days"))
    facts = steps.groupBy("series_id").agg(
        F.count("net").alias("n_obs"), F.min("net").alias("low"), F.max("net").alias("high"),
        F.max(F.when(F.col("net").isNull(), F.col("as_of"))).alias("newest_missing"), F.max("as_of").alias("newest"),
        F.min(F.when(F.col("name") != F.col("name_before"), F.col("as_of"))).alias("seam_date"),
        F.max("step_days").alias("widest"))
    full = facts.withColumn("gap_days", F.when(F.col("widest") > max_gap_days, F.col("widest"))).join(
        markets, "series_id", "left")
    has_seam = F.col("seam_date").isNotNull()
    pinned = F.coalesce("pinned", F.lit(False))
    short = F.col("n_obs") < min_obs
    flags = F.array_compact(F.array(
        F.when(has_seam & pinned, F.lit("name_rebrand")).when(has_seam, F.lit("contract_splice")),
        F.when(F.col("gap_days").isNotNull(), F.lit("history_gap")),
        F.when(F.coalesce("declared_break", F.lit(False)), F.lit("name_break")),
        F.when(F.col("satellite").isNotNull(), F.lit("satellite")),
        F.when(short, F.lit("insufficient_history")).when(F.col("low") == F.col("high"), F.lit("zero_dispersion")),
        F.when(F.col("newest_missing") == F.col("newest"), F.lit("missing_latest_net"))))
    return full.select("series_id", "n_obs", "seam_date", "gap_days", F.array_join(flags, ",").alias("flags"))
