"""Conversions of raw strings: numbers, timestamps, flags, sentinels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.schema import MISSING, TIMESTAMP_FORMAT

# Fixed value: what counts as a number when a string is converted.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"

# What a nanosecond timestamp can hold, in milliseconds.
EPOCH_RANGE = (-9_223_372_036_854, 9_223_372_036_854)

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def to_number(x: Column) -> Column:
    """String to double; anything that is no number, and ``nan``, becomes null."""
    value = F.when(F.regexp_like(x, F.lit(NUMBER_PATTERN)), F.trim(x).try_cast("double"))
    return F.when(~F.isnan(value), value)


def to_whole(x: Column) -> Column:
    """String to bigint by way of a number; null when it is none."""
    return to_number(x).try_cast("bigint")


def epoch_millis(x: Column) -> Column:
    """Epoch milliseconds, given as a string, to a timestamp cut to whole seconds; null out of range."""
    millis = F.trim(x).try_cast("decimal(20,3)").cast("bigint")
    return F.date_trunc("second", F.timestamp_millis(F.when(millis.between(*EPOCH_RANGE), millis)))


def to_flag(x: Column, missing: bool | None = False) -> Column:
    """True only for the word ``true`` in any case, with blanks around allowed; ``missing`` for null."""
    return F.coalesce(F.lower(F.regexp_replace(x, r"^\s+|\s+$", "")) == "true", F.lit(missing).cast("boolean"))


def format_timestamp(x: Column) -> Column:
    return F.date_format(x, TIMESTAMP_FORMAT)


def parse_timestamp(x: Column) -> Column:
    """Text to timestamp after turning en-dashes into hyphens; null when it does not fit."""
    repaired = F.replace(x, F.lit("–"), F.lit("-"))
    return F.try_to_timestamp(repaired, F.lit(TIMESTAMP_FORMAT))


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No")


def text_form(x: Column, data_type: T.DataType) -> Column:
    """String form of a typed value: ``True``/``False`` for flags, ISO-like timestamps."""
    if isinstance(data_type, T.BooleanType):
        return F.initcap(x.cast("string"))
    if isinstance(data_type, T.TimestampType):
        return format_timestamp(x)
    return x.cast("string")


def filled(x: Column) -> Column:
    """Null or empty string to the sentinel; ``x`` appears, and is worked out, only once."""
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(MISSING))


def drop_prefixed(df: DataFrame, prefix: str = "X") -> DataFrame:
    """Drop columns whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])
