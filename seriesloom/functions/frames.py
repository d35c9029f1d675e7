"""Window frames over one row per (series, day).

Every window here runs on rows already reduced to one per series and day, so the
largest group is bounded by the number of days on record, not by the raw rows of a
hot series: those are folded by a hash aggregate, for bars in the series' own partition,
elsewhere with a part before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = "series_id"
DAY = "as_of"


def in_order(key: str = SERIES, day: str = DAY):
    return Window.partitionBy(key).orderBy(day)


def newest_first(key: str = SERIES, day: str = DAY):
    return Window.partitionBy(key).orderBy(F.col(day).desc())


def whole(key: str = SERIES):
    return Window.partitionBy(key)


def trailing(rows: int, key: str = SERIES, day: str = DAY):
    return in_order(key, day).rowsBetween(-(rows - 1), 0)


def later_rows(key: str = SERIES, day: str = DAY):
    """All rows strictly after the current one, read newest first so the frame only grows."""
    return newest_first(key, day).rowsBetween(Window.unboundedPreceding, -1)


def recency(key: str = SERIES, day: str = DAY) -> Column:
    """1 for the newest row of a series."""
    return F.row_number().over(newest_first(key, day))


def first_of_each(rows: DataFrame, keys: list[str], order: list, most: int, position: str | None = None) -> DataFrame:
    """The first ``most`` rows of each key.

    A row number that is only filtered becomes a bounded top-k: every task keeps the first rows of its
    own keys, and those are merged per key, so no key's rows come together in one task.
    """
    name = position or "_position"
    numbered = rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.filter(F.col(name) <= most)
    return kept if position else kept.drop(name)
