"""Explicit schemas for every stored or landed record kind."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


OBSERVATION = _struct(
    series_id=T.StringType(), as_of=T.DateType(), value=T.DoubleType(), value_tr=T.DoubleType(),
    source=T.StringType(), resolution=T.StringType(), provisional=T.BooleanType(),
    filled=T.StringType(),
)

BAR_PRICES = ["value", "open", "high", "low", "close", "value_tr"]

BAR = _struct(
    series_id=T.StringType(), as_of=T.DateType(), value=T.DoubleType(), open=T.DoubleType(),
    high=T.DoubleType(), low=T.DoubleType(), close=T.DoubleType(), value_tr=T.DoubleType(),
    volume=T.LongType(), split_factor=T.DoubleType(), dividend=T.DoubleType(),
    source=T.StringType(), provisional=T.BooleanType(), recorded_on=T.DateType(),
    stable_id=T.StringType(),
)

POSITION = _struct(
    market=T.StringType(), date=T.DateType(), market_name=T.StringType(),
    open_interest=T.DoubleType(), primary_long=T.DoubleType(), primary_short=T.DoubleType(),
    primary_net=T.DoubleType(), secondary_long=T.DoubleType(), secondary_short=T.DoubleType(),
    secondary_net=T.DoubleType(), tertiary_long=T.DoubleType(), tertiary_short=T.DoubleType(),
    tertiary_net=T.DoubleType(),
)

EPOCH = _struct(
    internal_id=T.StringType(), ticker=T.StringType(), exch_code=T.StringType(),
    first_seen=T.DateType(), effective_to=T.DateType(), name=T.StringType(),
    isin=T.StringType(), share_class_figi=T.StringType(), continuation_of=T.StringType(),
    review_flag=T.StringType(), source_note=T.StringType(),
)

# One stored series: a JSON array of records in one file.
SERIES_FILE = _struct(as_of=T.StringType(), value=T.DoubleType(), source=T.StringType())

# Landed macro extracts carry numbers as text, with sentinels for missing.
OBSERVATION_TEXT = _struct(series_id=T.StringType(), date=T.StringType(), value=T.StringType())

VINTAGE_TEXT = _struct(
    series_id=T.StringType(), realtime_start=T.StringType(), realtime_end=T.StringType(),
    date=T.StringType(), value=T.StringType(),
)

SLOT_FILE = _struct(series_id=T.StringType(), as_of=T.StringType(), value=T.StringType())

SNAPSHOT_FEED = _struct(
    as_of=T.StringType(),
    snapshot=T.ArrayType(_struct(indicator=T.StringType(), value=T.StringType())),
)
