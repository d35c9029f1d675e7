"""Digest tree of an archive: order-free sums of line hashes per (series, year), summed upwards.

Equal archives have equal digests whatever the order and layout of their files. Two archives are
compared from the root down: equal roots end it, then only series with different digests are
opened, then only their years. Lines are read where a leaf differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = ["series_id", "year"]


def leaf_digests(lines: DataFrame, columns: list[str]) -> DataFrame:
    """``series_id, year, n, digest``; ``columns`` of a line take part, nulls included."""
    marks = [F.col(c).isNull() for c in columns]
    line = F.xxhash64(*columns, *marks).cast("decimal(38,0)")
    return lines.groupBy("series_id", F.year("as_of").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum(line).alias("digest"))


def rolled_up(digests: DataFrame, *keys: str) -> DataFrame:
    """The digests one level up: per series, or the root without a key."""
    return digests.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("digest").alias("digest"))


def _differing(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    left = one.select(*keys, F.struct("n", "digest").alias("one"))
    right = other.select(*keys, F.struct("n", "digest").alias("other"))
    return left.join(right, keys, "full_outer").filter(~F.col("one").eqNullSafe(F.col("other")))


def differing_leaves(one: DataFrame, other: DataFrame) -> DataFrame:
    """``series_id, year, n_one, n_other`` of the leaves that differ between two archives' leaf digests."""
    empty = one.sparkSession.createDataFrame([], "series_id string, year int, n_one long, n_other long")
    if rolled_up(one).first() == rolled_up(other).first():
        return empty
    series = _differing(rolled_up(one, "series_id"), rolled_up(other, "series_id"), ["series_id"]).select("series_id")
    opened = _differing(one.join(series, "series_id", "left_semi"), other.join(series, "series_id", "left_semi"), LEAF)
    return opened.select(*LEAF, F.coalesce("one.n", F.lit(0)).alias("n_one"), F.coalesce("other.n", F.lit(0)).alias("n_other"))


def differing_lines(one: DataFrame, other: DataFrame, leaves: DataFrame, columns: list[str]) -> DataFrame:
    """Per opened leaf: how many days stand in one archive only, and how many differ."""
    def opened(lines: DataFrame, name: str) -> DataFrame:
        marked = lines.withColumn("year", F.year("as_of")).join(leaves.select(*LEAF), LEAF, "left_semi")
        return marked.select(*LEAF, "as_of", F.struct(*columns).alias(name))

    both = opened(one, "one").join(opened(other, "other"), [*LEAF, "as_of"], "full_outer")
    return both.groupBy(*LEAF).agg(
        F.count_if(F.col("other").isNull()).alias("only_one"), F.count_if(F.col("one").isNull()).alias("only_other"),
        F.count_if(F.col("one").isNotNull() & F.col("other").isNotNull() & ~F.col("one").eqNullSafe(F.col("other"))).alias("n_differing"))
