"""Rename linking against a plain one-by-one walk over sorted tickers."""

import random

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import identity


def walk(appeared, disappeared):
    """Apply tickers one after the other, taking candidates as they are linked."""
    taken, result = set(), {}
    gone = sorted(disappeared)
    for ticker, name, isin, figi in sorted(appeared):
        same_figi = [g for g in gone if figi and g[3] == figi]
        same_isin = [g for g in gone if isin and g[2] == isin]
        group, kind = (same_figi, "figi") if same_figi else (same_isin, "isin")
        free = [g for g in group if g[0] not in taken]
        link, flag = None, None
        if group and len(free) == 1:
            link = free[0]
            taken.add(link[0])
            if kind == "figi":
                if same_isin and link not in same_isin:
                    flag = "rename_figi_isin_disagree"
                elif sum(a[3] == figi for a in appeared) > 1:
                    flag = "rename_multi_class_winner"
        elif group:
            flag = f"rename_ambiguous_{kind}" if free else f"rename_multi_class_{kind}"
        elif any(g[0] not in taken and g[1] == name for g in gone):
            flag = "rename_name_only"
        result[ticker] = (link and link[0], kind if link else None, flag)
    return result


SCHEMA = "ticker string, name string, isin string, figi string"


@pytest.mark.parametrize("seed", range(6))
def test_matches_the_walk(spark, seed):
    rng = random.Random(seed)
    codes = 4 if seed % 2 else 9

    def member(prefix, i):
        return (f"{prefix}{i:03d}", f"NAME {rng.randrange(12)}",
                rng.choice([None, *[f"I{n}" for n in range(codes)]]),
                rng.choice([None, *[f"F{n}" for n in range(codes)]]))

    disappeared = [member("A", i) for i in range(14)]
    appeared = [member("B", i) for i in rng.sample(range(40), 22)]
    got = identity.rename_links(spark.createDataFrame(appeared, SCHEMA), spark.createDataFrame(disappeared, SCHEMA))
    rows = {r["ticker"]: (r["old_ticker"], r["link_via"], r["review_flag"]) for r in got.collect()}
    assert rows == walk(appeared, disappeared)


def test_one_hot_identifier(spark):
    """A third of all tickers share one id: nothing is linked, everything is flagged."""
    gone = [(f"A{i:04d}", "n", None, "HOT" if i % 3 == 0 else f"F{i}") for i in range(300)]
    new = [(f"B{i:04d}", "m", None, "HOT" if i % 3 == 0 else f"F{i}") for i in range(300)]
    got = identity.rename_links(spark.createDataFrame(new, SCHEMA), spark.createDataFrame(gone, SCHEMA))
    counts = {r["review_flag"]: r["count"] for r in got.groupBy("review_flag").count().collect()}
    assert counts == {"rename_ambiguous_figi": 100, None: 200}


def epochs(spark, links):
    frame = spark.createDataFrame([(k, v) for k, v in links.items()], "internal_id string, continuation_of string")
    return frame.withColumns({"ticker": F.col("internal_id"), "effective_to": F.lit(None).cast("date"), "exch_code": F.lit("US")})


def test_chain_roots_with_cycle_and_tail(spark):
    links = {"a": None, "b": "a", "c": "b", "d": "c", "e": "missing",
             "p": "q", "q": "r", "r": "p", "t": "q", "u": "t", "x": "y", "y": "x", "z": "x"}
    got = {r["internal_id"]: r["stable_id"] for r in identity.chain_roots(epochs(spark, links)).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e",
                   "p": "p", "q": "q", "r": "r", "t": "q", "u": "q", "x": "x", "y": "y", "z": "x"}
    assert {r["node"] for r in identity.cycle_members(epochs(spark, links)).collect()} == {"p", "q", "r", "x", "y"}


def test_long_chain(spark):
    links = {f"n{i:03d}": (f"n{i - 1:03d}" if i else None) for i in range(200)}
    got = {r["stable_id"] for r in identity.chain_roots(epochs(spark, links)).collect()}
    assert got == {"n000"}


def test_repeated_ids_never_fork_a_walk(spark):
    """Ids that several epochs share, one of them linked to itself: a row per epoch, walks of one way."""
    data = []
    for i in range(40):
        link = f"m{i - 1:02d}" if i else None
        data += [(f"m{i:02d}", link, f"A{i:02d}", "2020-01-01"), (f"m{i:02d}", link if i % 2 else f"m{i:02d}", f"B{i:02d}", "2021-01-01")]
    data += [("leaf", "m39", "C", "2022-01-01")]
    frame = spark.createDataFrame(data, "internal_id string, continuation_of string, ticker string, first_seen string").withColumns(
        {"effective_to": F.lit(None).cast("date"), "exch_code": F.lit("US")})
    got = {r["ticker"]: r["stable_id"] for r in identity.stable_ids(frame).collect()}
    want = {"C": "m38"}
    for i in range(40):
        loop = f"m{i - i % 2:02d}"  # the newest epoch of an even id continues itself
        want[f"A{i:02d}"] = loop if i % 2 else f"m{i - 2:02d}" if i else "m00"
        want[f"B{i:02d}"] = loop
    assert got == want and identity.chain_roots(frame).count() == 81
    assert {r["node"] for r in identity.cycle_members(frame).collect()} == {f"m{i:02d}" for i in range(0, 40, 2)}
