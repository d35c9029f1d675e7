"""Text and number clean-up expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no observation" in macro extracts.
MISSING_MARKS = [".", "", "NaN", "null"]

# Exchange suffix of a symbol and the exchange code it stands for.
EXCHANGE_CODES = {
    "L": "LN", "PA": "FP", "DE": "GR", "SW": "SW", "ST": "SS", "MI": "IM",
    "AS": "NA", "MC": "SM", "CO": "DC", "OL": "NO", "HE": "FH", "WA": "PW",
    "BR": "BB", "VI": "AV", "IR": "ID", "LS": "PL", "NYB": "US",
}

# Legal-form words and punctuation dropped from a company name, in this order.
NAME_NOISE = [
    " PLC", " AG", " SA", " NV", " SE", " INC", " CORP", " CO", " LTD",
    " GROUP", " HOLDINGS", " CLASS A", " CLASS B", ".", ",", "-",
]


def loose_number(text) -> Column:
    """Number with optional thousands commas; anything else is NULL."""
    parsed = F.replace(text, F.lit(","), F.lit("")).try_cast("double")
    return F.when(F.isnan(parsed), None).otherwise(parsed)


def loose_number_or_zero(text) -> Column:
    return F.coalesce(loose_number(text), F.lit(0.0))


def observed_number(text) -> Column:
    """Number from a macro extract; sentinels and garbage are NULL."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(MISSING_MARKS), loose_number(trimmed))


def strip_invisible(text) -> Column:
    """Trim, and drop byte-order marks and zero-width spaces."""
    return F.trim(F.translate(F.trim(text), "\ufeff\u200b", ""))


def canonical_currency(code) -> Column:
    """Pence labels become GBX; the mixed-case check must precede upper-casing."""
    label = F.trim(code)
    return F.when((label == "GBp") | (F.upper(label) == "GBX"), F.lit("GBX")).otherwise(F.upper(label))


def symbol_suffix(symbol) -> Column:
    """Text after the last dot, NULL when there is none."""
    return F.nullif(F.regexp_extract(symbol, r"\.([^.]*)$", 1), F.lit(""))


def venue_group(symbol) -> Column:
    return F.coalesce(symbol_suffix(symbol), F.lit("US"))


def exchange_code(symbol) -> Column:
    suffix = F.upper(symbol_suffix(symbol))
    known = F.create_map(*[F.lit(x) for pair in EXCHANGE_CODES.items() for x in pair])
    return F.when(suffix.isNull(), F.lit("US")).otherwise(F.coalesce(known[suffix], suffix))


def name_key(name) -> Column:
    """Loose company-name key, for hints only."""
    cleaned = reduce(
        lambda text, noise: F.replace(text, F.lit(noise), F.lit(" ")),
        NAME_NOISE,
        F.upper(F.coalesce(name, F.lit(""))),
    )
    return F.trim(F.regexp_replace(cleaned, r"\s+", " "))


def holds_all(text, terms: list[str]) -> Column:
    """Every term occurs in the text, ignoring case."""
    return reduce(lambda a, b: a & b, [F.contains(F.upper(text), F.lit(t.upper())) for t in terms])


def holds_any(text, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.upper(text), F.lit(t.upper())) for t in terms])
