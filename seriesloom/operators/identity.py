"""Stable instrument identity: epochs, continuation chains and rename links."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.text import name_key
from seriesloom.operators.numbering import number_in_order
from seriesloom.schemas import EPOCH
from seriesloom.session import cut_lineage

PREFIX = "SEC-"
#: Digits an id has at least; later numbers are longer and stay in order by number.
ID_DIGITS = 6
ID_PATTERN = rf"^SEC-(\d{{{ID_DIGITS}}}|[1-9]\d{{{ID_DIGITS},}})$"
EPOCH_COLUMNS = EPOCH.fieldNames()


def empty_epochs(spark) -> DataFrame:
    return spark.createDataFrame([], EPOCH)


def id_number(column="internal_id") -> Column:
    return F.substring(column, len(PREFIX) + 1, 20).cast("long")


def formatted_id(number) -> Column:
    return F.format_string(f"{PREFIX}%0{ID_DIGITS}d", number)


def open_epochs(epochs: DataFrame) -> DataFrame:
    return epochs.filter(F.col("effective_to").isNull())


def highest_id(epochs: DataFrame) -> int:
    """The largest number given out so far."""
    return epochs.agg(F.coalesce(F.max(id_number()), F.lit(0)).alias("n")).first()["n"]


def _as_epochs(rows: DataFrame, date: dt.date, note: str, **filled: Column) -> DataFrame:
    """New open epochs; columns not given stay NULL."""
    values = {
        "internal_id": formatted_id(F.col("position")), "ticker": F.col("ticker"), "exch_code": F.col("exch_code"),
        "first_seen": F.lit(date), "name": F.col("name"), "source_note": F.lit(note), **filled}
    return rows.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EPOCH.fields])


def seed(epochs: DataFrame, universe: DataFrame, date: dt.date, note: str = "seed") -> DataFrame:
    """Append an open epoch for every universe member that has none.

    ``universe`` holds ``series_id, ticker, exch_code, name``. Ids continue after the
    highest one, in series order; existing ids never change.
    """
    fresh = universe.join(open_epochs(epochs).select("ticker", "exch_code"), ["ticker", "exch_code"], "left_anti")
    numbered = number_in_order(fresh, ["series_id"], start_after=highest_id(epochs))
    return epochs.unionByName(_as_epochs(numbered, date, note))


# --- continuation chains ---------------------------------------------------------------------

def _jump(links: DataFrame) -> DataFrame:
    """Follow links by doubling until no node moves, or every walk must have entered a cycle."""
    rounds = math.ceil(math.log2(links.count() + 1)) + 1
    walk = cut_lineage(links.select("node", F.col("parent").alias("target")))
    for _ in range(rounds):
        further = walk.select(F.col("node").alias("target"), F.col("target").alias("beyond"))
        walk = cut_lineage(
            walk.join(further, "target", "left")
            .select("node", F.coalesce("beyond", "target").alias("target"),
                    (F.col("beyond") != F.col("target")).alias("moved")))
        if walk.filter("moved").isEmpty():
            break
        walk = walk.drop("moved")
    return walk.select("node", "target")


def _speakers(epochs: DataFrame) -> DataFrame:
    """One row per id: of several epochs with one id (a broken map) the newest speaks for it, so walks never fork."""
    order = [c for c in ("first_seen", "ticker", "exch_code", "effective_to", "continuation_of") if c in epochs.columns]
    return epochs.groupBy("internal_id").agg(F.max_by("continuation_of", F.struct(*order)).alias("continuation_of"))


def valid_links(epochs: DataFrame) -> DataFrame:
    """``node, parent`` for every id that continues an existing one; each node once."""
    speakers = _speakers(epochs)
    return (speakers.filter(F.col("continuation_of").isNotNull())
            .select(F.col("internal_id").alias("node"), F.col("continuation_of").alias("parent"))
            .join(speakers.select(F.col("internal_id").alias("parent")), "parent", "left_semi"))


def cycle_members(epochs: DataFrame) -> DataFrame:
    """Ids that lie on a continuation cycle."""
    links = cut_lineage(valid_links(epochs))
    ends = _jump(links).select(F.col("target").alias("node")).distinct()
    return ends.join(links.select("node"), "node", "left_semi")


def _rooted(epochs: DataFrame) -> DataFrame:
    """Every epoch with its ``stable_id``; epochs that share an id each follow their own link."""
    links = cut_lineage(valid_links(epochs))
    reached = _jump(links)
    stuck = reached.select(F.col("target").alias("node")).distinct().join(links.select("node"), "node", "left_semi")
    stuck = cut_lineage(stuck)
    if not stuck.isEmpty():
        reached = _jump(links.join(stuck, "node", "left_anti"))
    roots = epochs.select(F.col("internal_id").alias("parent")).distinct().join(
        reached.select(F.col("node").alias("parent"), "target"), "parent", "left").select(
        F.col("parent").alias("continuation_of"), F.coalesce("target", "parent").alias("root"))
    looped = stuck.select(F.col("node").alias("internal_id"), F.lit(True).alias("looped"))
    on_cycle = F.col("looped") & F.col("links_back")
    speakers = _speakers(epochs).select("internal_id", F.col("continuation_of").alias("spoken")).join(looped, "internal_id")
    return (
        epochs.join(roots, "continuation_of", "left").join(speakers, "internal_id", "left")
        .withColumn("links_back", F.col("spoken").eqNullSafe(F.col("continuation_of")))
        .withColumn("stable_id", F.when(on_cycle, F.col("internal_id")).otherwise(F.coalesce("root", "internal_id"))))


def chain_roots(epochs: DataFrame) -> DataFrame:
    """``internal_id, stable_id``: the first epoch of each continuation chain, one row per epoch.

    On a cycle every member is its own root, and a tail ends where it enters the cycle. A link leads to the
    newest epoch of its id, should several share it.
    """
    return _rooted(epochs).select("internal_id", "stable_id")


def stable_ids(epochs: DataFrame) -> DataFrame:
    """Stable id of every ticker that has an open epoch."""
    return open_epochs(_rooted(epochs)).select("ticker", "exch_code", "internal_id", "stable_id")


# --- snapshot comparison -----------------------------------------------------------------------

def named(column: str) -> Column:
    """An identifier, or NULL where the text is empty: an empty one names nothing."""
    return F.nullif(F.trim(column), F.lit(""))


def resolve_figi(snapshot: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Prefer the looked-up identifier over the one the snapshot carries."""
    if lookup is None:
        return snapshot
    found = lookup.select("ticker", "exch_code", named("share_class_figi").alias("found"))
    return (snapshot.join(found, ["ticker", "exch_code"], "left")
            .withColumn("share_class_figi", F.coalesce("found", named("share_class_figi"))).drop("found"))


def snapshot_diff(epochs: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Every ticker of either side as appeared, disappeared or stayed, with both sets of fields."""
    held = open_epochs(epochs).select(
        "ticker", "internal_id", F.col("name").alias("old_name"), named("isin").alias("old_isin"),
        named("share_class_figi").alias("old_figi"), F.col("review_flag").alias("old_flag"))
    new = snapshot.select("ticker", "exch_code", "name", named("isin").alias("isin"), named("share_class_figi").alias("figi"),
                          F.lit(True).alias("listed"))
    side = (F.when(F.col("internal_id").isNull(), F.lit("appeared"))
            .when(F.col("listed").isNull(), F.lit("disappeared")).otherwise(F.lit("stayed")))
    return held.join(new, "ticker", "full_outer").withColumn("change", side).drop("listed")


def contradicted() -> Column:
    """Both sides name an identifier and they differ."""
    return (F.coalesce(F.col("old_figi") != F.col("figi"), F.lit(False))
            | F.coalesce(F.col("old_isin") != F.col("isin"), F.lit(False)))


def recycled(diff: DataFrame) -> DataFrame:
    """Tickers that stayed but now name a different instrument."""
    return diff.filter((F.col("change") == "stayed") & contradicted())


def refreshed(diff: DataFrame) -> DataFrame:
    """Stayed tickers with first identifiers cached, name renewed and doubtful handovers flagged."""
    stayed = diff.filter((F.col("change") == "stayed") & ~contradicted())
    given = F.coalesce("name", F.lit("")) != ""
    first_figi = F.col("figi").isNotNull() & F.col("old_figi").isNull()
    renamed = given & (name_key(F.col("old_name")) != "") & (name_key(F.col("old_name")) != name_key(F.col("name")))
    return stayed.select(
        "ticker", "internal_id", F.when(given, F.col("name")).otherwise(F.col("old_name")).alias("name"),
        F.coalesce("old_figi", "figi").alias("share_class_figi"), F.coalesce("old_isin", "isin").alias("isin"),
        F.coalesce("old_flag", F.when(first_figi & renamed, F.lit("stayed_identity_review"))).alias("review_flag"))


# --- rename links -------------------------------------------------------------------------------

def _sole_candidate(members: DataFrame, key: str, claims: DataFrame) -> DataFrame:
    """Per group: the member left when all others are taken, and between which claims that holds.

    Only the two latest claims of a group matter, so the ranking keeps two rows per group
    on the map side already.
    """
    timed = members.join(claims, "old_ticker", "left")
    latest = F.row_number().over(Window.partitionBy(key).orderBy(F.col("claimed_by").desc_nulls_first(), "old_ticker"))
    top = timed.select(key, "old_ticker", "claimed_by", latest.alias("place")).filter(F.col("place") <= 2)
    first = top.filter("place = 1").select(key, "old_ticker", F.col("claimed_by").alias("until"))
    second = top.filter("place = 2").select(key, F.col("claimed_by").alias("since"), F.lit(True).alias("several"))
    return first.join(second, key, "left").filter(F.col("several").isNull() | F.col("since").isNotNull())


def _links(members: DataFrame, applicants: DataFrame, key: str, claims: DataFrame) -> DataFrame:
    """The one link a group can make by itself: first applicant while one candidate is left."""
    window = (F.col("since").isNull() | (F.col("ticker") > F.col("since"))) & (
        F.col("until").isNull() | (F.col("ticker") < F.col("until")))
    return (applicants.join(_sole_candidate(members, key, claims), key).filter(window)
            .groupBy(key, "old_ticker").agg(F.min("ticker").alias("claimed_by"))
            .select("old_ticker", "claimed_by"))


def rename_links(appeared: DataFrame, disappeared: DataFrame, figi_offline: bool = False) -> DataFrame:
    """How each appeared ticker relates to the disappeared ones.

    Tickers apply in sorted order. One that shares a share-class id with disappeared
    tickers takes the single one of them not yet taken; without such an id match the
    same holds for the ISIN. A match with several candidates left, or with none left, is
    flagged and not linked. A link by one kind of identifier takes a candidate away from
    the other kind, so the two are solved in turn until nothing changes. Each turn uses
    per-group aggregates only: no group is gathered and no pairs within a group are formed.

    ``appeared`` and ``disappeared`` hold ``ticker, name, isin, figi``; the result has
    ``ticker, old_ticker, link_via, review_flag``.
    """
    gone = cut_lineage(disappeared.select(
        F.col("ticker").alias("old_ticker"), F.col("name").alias("old_name"), named("isin").alias("old_isin"),
        named("figi").alias("old_figi")))
    appeared = appeared.withColumns({"isin": named("isin"), "figi": named("figi")})
    by_figi = gone.filter(F.col("old_figi").isNotNull()).select("old_ticker", F.col("old_figi").alias("figi"))
    by_isin = gone.filter(F.col("old_isin").isNotNull()).select("old_ticker", F.col("old_isin").alias("isin"))
    figi_known = by_figi.select("figi").distinct().withColumn("figi_match", F.lit(True))
    isin_known = by_isin.select("isin").distinct().withColumn("isin_match", F.lit(True))
    sharing = appeared.filter(F.col("figi").isNotNull()).groupBy("figi").agg(F.count(F.lit(1)).alias("figi_sharers"))
    incoming = cut_lineage(
        appeared.select("ticker", "name", "isin", "figi").join(figi_known, "figi", "left")
        .join(isin_known, "isin", "left").join(sharing, "figi", "left"))
    figi_applicants = incoming.filter("figi_match").select("ticker", "figi")
    isin_applicants = incoming.filter("figi_match IS NULL AND isin_match").select("ticker", "isin")

    none = gone.limit(0).select("old_ticker", F.col("old_name").alias("claimed_by"))
    figi_claims, isin_claims = none, none
    while True:
        figi_next = cut_lineage(_links(by_figi, figi_applicants, "figi", isin_claims))
        isin_next = cut_lineage(_links(by_isin, isin_applicants, "isin", figi_next))
        settled = isin_next.exceptAll(isin_claims).isEmpty() and isin_claims.exceptAll(isin_next).isEmpty()
        figi_claims, isin_claims = figi_next, isin_next
        if settled:
            break

    claims = figi_claims.withColumn("via", F.lit("figi")).unionByName(isin_claims.withColumn("via", F.lit("isin")))
    first_claim = claims.groupBy("old_ticker").agg(F.min("claimed_by").alias("claimed_by"))
    timed = gone.join(first_claim, "old_ticker", "left").withColumn("name_hint", name_key(F.col("old_name")))

    def exhausted(key: str, label: str) -> DataFrame:
        """When the last member of each group was taken; NULL while one is left."""
        return timed.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(label)).agg(
            F.when(F.count("claimed_by") == F.count(F.lit(1)), F.max("claimed_by")).alias(f"{label}_gone"),
            F.lit(True).alias(f"{label}_group"))

    linked = claims.join(gone.select("old_ticker", "old_isin"), "old_ticker").select(
        F.col("claimed_by").alias("ticker"), "old_ticker", F.col("via").alias("link_via"), "old_isin")
    judged = (
        incoming.withColumn("name_hint", name_key(F.col("name")))
        .join(exhausted("old_figi", "figi"), "figi", "left").join(exhausted("old_isin", "isin"), "isin", "left")
        .join(exhausted("name_hint", "name_hint"), "name_hint", "left").join(linked, "ticker", "left")
    )

    def spent(label: str) -> Column:
        return F.coalesce(F.col("ticker") > F.col(f"{label}_gone"), F.lit(False))

    winner = (F.when((F.col("link_via") == "figi") & F.col("isin_match") & ~F.col("old_isin").eqNullSafe(F.col("isin")),
                     F.lit("rename_figi_isin_disagree"))
              .when((F.col("link_via") == "figi") & (F.col("figi_sharers") > 1), F.lit("rename_multi_class_winner")))
    loser = (
        F.when(F.col("figi_match"), F.when(spent("figi"), F.lit("rename_multi_class_figi")).otherwise(F.lit("rename_ambiguous_figi")))
        .when(F.col("isin_match"), F.when(spent("isin"), F.lit("rename_multi_class_isin")).otherwise(F.lit("rename_ambiguous_isin")))
        .when(F.col("name_hint_group") & ~spent("name_hint"),
              F.lit("rename_figi_offline" if figi_offline else "rename_name_only")))
    return judged.select("ticker", "old_ticker", "link_via",
                         F.when(F.col("link_via").isNotNull(), winner).otherwise(loser).alias("review_flag"))


def apply_snapshot(epochs: DataFrame, snapshot: DataFrame, date: dt.date, lookup: DataFrame | None = None,
                   figi_offline: bool = False, note: str = "snapshot") -> tuple[DataFrame, DataFrame]:
    """The epochs after one universe snapshot, and a report of ``kind, ticker, detail``."""
    diff = cut_lineage(snapshot_diff(epochs, resolve_figi(snapshot, lookup)))
    recycles = recycled(diff)
    appeared = diff.filter("change = 'appeared'")
    disappeared = diff.filter("change = 'disappeared'").select(
        "ticker", "internal_id", F.col("old_name").alias("name"), F.col("old_isin").alias("isin"),
        F.col("old_figi").alias("figi"))
    links = cut_lineage(rename_links(appeared, disappeared, figi_offline))
    parents = disappeared.select(F.col("ticker").alias("old_ticker"), F.col("internal_id").alias("parent"))

    minted = recycles.select(
        F.lit(0).alias("phase"), "ticker", "exch_code", "name", "isin", "figi",
        F.lit("ticker_recycle_contradiction").alias("flag"), F.lit(None).cast("string").alias("parent"),
    ).unionByName(
        appeared.join(links, "ticker").join(parents, "old_ticker", "left").select(
            F.lit(1).alias("phase"), "ticker", "exch_code", "name", "isin", "figi",
            F.col("review_flag").alias("flag"), "parent"))
    numbered = number_in_order(minted, ["phase", "ticker"], start_after=highest_id(epochs))
    created = _as_epochs(
        numbered.withColumn("name", F.coalesce("name", F.lit(""))), date, note,
        isin=F.col("isin"), share_class_figi=F.col("figi"), continuation_of=F.col("parent"), review_flag=F.col("flag"))

    closing = recycles.select("internal_id").unionByName(disappeared.select("internal_id")).withColumn("closed", F.lit(True))
    renewal = refreshed(diff).select(
        "internal_id", F.lit(True).alias("renewed"), F.col("name").alias("new_name"),
        F.col("share_class_figi").alias("new_figi"), F.col("isin").alias("new_isin"), F.col("review_flag").alias("new_flag"))

    def renewed(new: str, old: str) -> Column:
        return F.when(F.col("renewed"), F.col(new)).otherwise(F.col(old))

    kept = (
        epochs.join(closing, "internal_id", "left").join(renewal, "internal_id", "left")
        .withColumn("effective_to", F.when(F.col("closed"), F.lit(date)).otherwise(F.col("effective_to")))
        .withColumn("name", renewed("new_name", "name")).withColumn("share_class_figi", renewed("new_figi", "share_class_figi"))
        .withColumn("isin", renewed("new_isin", "isin")).withColumn("review_flag", renewed("new_flag", "review_flag"))
        .select(*EPOCH_COLUMNS)
    )
    def lines(frame: DataFrame, kind: str, detail: Column) -> DataFrame:
        return frame.select(F.lit(kind).alias("kind"), "ticker", detail.cast("string").alias("detail"))

    flagged_stay = refreshed(diff).join(diff.select("ticker", "old_flag"), "ticker").filter(
        "old_flag IS NULL AND review_flag IS NOT NULL")
    report = (
        lines(created, "minted", F.col("internal_id"))
        .unionByName(lines(recycles, "closed", F.col("internal_id")))
        .unionByName(lines(disappeared, "closed", F.col("internal_id")))
        .unionByName(lines(links.filter("old_ticker IS NOT NULL"), "continued", F.col("old_ticker")))
        .unionByName(lines(created.filter("review_flag IS NOT NULL"), "flagged", F.col("review_flag")))
        .unionByName(lines(flagged_stay, "flagged", F.col("review_flag")))
        .unionByName(lines(refreshed(diff), "resolved", F.col("internal_id")))
    )
    return kept.unionByName(created), report


# --- checks and enrichment --------------------------------------------------------------------

def recycle_seams(epochs: DataFrame) -> DataFrame:
    """Tickers that carried more than one id: a benign re-appearance or a real splice."""
    order = Window.partitionBy("ticker").orderBy("first_seen", id_number())
    placed = epochs.withColumn("place", F.row_number().over(order)).withColumn(
        "total", F.count(F.lit(1)).over(Window.partitionBy("ticker"))).filter("total > 1")
    earlier = placed.select(F.col("internal_id").alias("continuation_of"), F.col("ticker").alias("parent_ticker"),
                            F.col("place").alias("parent_place"))
    judged = placed.join(earlier, "continuation_of", "left").withColumn(
        "linked", F.coalesce((F.col("parent_ticker") == F.col("ticker")) & (F.col("parent_place") < F.col("place")), F.lit(False)))

    def at(back: int, column: str) -> Column:
        return F.max(F.when(F.col("place") == F.col("total") - back, F.col(column)))

    return judged.groupBy("ticker").agg(
        F.min((F.col("place") == 1) | F.col("linked")).alias("linked"), at(1, "internal_id").alias("from_identity"),
        at(0, "internal_id").alias("to_identity"), at(0, "first_seen").alias("seam_date"),
        at(1, "effective_to").alias("last_clean_date"),
    ).withColumn("flag", F.when(F.col("linked"), F.lit("name_rebrand")).otherwise(F.lit("ticker_recycle_splice")))


def invariants(epochs: DataFrame) -> DataFrame:
    """One row per rule: how many violations it has."""
    def rule(name: str, violations: DataFrame) -> DataFrame:
        return violations.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("rule"), "n_violations")

    ids = epochs.select("internal_id").distinct()
    dangling = (epochs.filter(F.col("continuation_of").isNotNull()).select(F.col("continuation_of").alias("internal_id"))
                .join(ids, "internal_id", "left_anti"))
    dense = epochs.agg(F.min(id_number()).alias("low"), F.max(id_number()).alias("high"), F.count(F.lit(1)).alias("n")).filter(
        "low <> 1 OR high <> n")
    checks = [
        rule("unique_id", epochs.groupBy("internal_id").count().filter("count > 1")),
        rule("id_format", epochs.filter(~F.col("internal_id").rlike(ID_PATTERN))),
        rule("one_open_epoch", open_epochs(epochs).groupBy("ticker").count().filter("count > 1")),
        rule("dangling_link", dangling), rule("link_cycle", cycle_members(epochs)), rule("dense_numbers", dense)]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def unstamped(universe: DataFrame, epochs: DataFrame) -> DataFrame:
    """Universe members without an open epoch."""
    return universe.join(open_epochs(epochs).select("ticker", "exch_code"), ["ticker", "exch_code"], "left_anti").select(
        "series_id", "ticker")


def enrich_figi(epochs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Fill a missing share-class id on open epochs from a lookup table."""
    found = lookup.select("ticker", "exch_code", named("share_class_figi").alias("found"))
    return epochs.join(found, ["ticker", "exch_code"], "left").withColumn(
        "share_class_figi", F.when(F.col("effective_to").isNull(), F.coalesce(named("share_class_figi"), "found"))
        .otherwise(F.col("share_class_figi"))).select(*EPOCH_COLUMNS)
