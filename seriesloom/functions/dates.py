"""Calendar expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_ending_friday(day) -> Column:
    """Friday that closes the Saturday-to-Friday week of ``day``."""
    return F.next_day(F.date_sub(day, 1), "FRI")


def month_end(day) -> Column:
    return F.last_day(day)


def iso_week(day) -> Column:
    return F.weekofyear(day).cast("long")


def lenient_date(text) -> Column:
    """Date at the start of a text, alone or before a time; NULL for anything else."""
    alone = F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:.*|Z)?$"))
    return F.when(alone, F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def epoch_or_text_date(column, is_epoch: Column) -> Column:
    """Day of a column that holds either epoch milliseconds or date text."""
    millis = F.try_to_number(column.cast("string"), F.lit("99999999999999")).cast("long")
    return F.when(is_epoch, F.timestamp_millis(millis).cast("date")).otherwise(lenient_date(column))


def lookback_start(period: str | None, end: dt.date) -> Column | None:
    """Left edge of a look-back such as ``2y``, ``6mo`` or ``30d``; None means unbounded."""
    matched = re.fullmatch(r"(\d+)(mo|y|d)", (period or "").strip().lower())
    if not matched:
        return None
    amount, unit = int(matched[1]), matched[2]
    edge = F.lit(end)
    if unit == "d":
        return F.date_sub(edge, amount)
    return F.add_months(edge, -amount * (12 if unit == "y" else 1))


# Delivery-month letters, January to December.
MONTH_LETTERS = ["F", "G", "H", "J", "K", "M", "N", "Q", "U", "V", "X", "Z"]


def contract_code(prefix: str, suffix: str, delivery: Column) -> Column:
    """Futures code for a delivery month: prefix, month letter, two-digit year, suffix."""
    letters = F.array(*[F.lit(letter) for letter in MONTH_LETTERS])
    return F.concat(
        F.lit(prefix), F.element_at(letters, F.month(delivery)),
        F.date_format(delivery, "yy"), F.lit(suffix),
    )
