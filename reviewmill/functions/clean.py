"""Cleaning of free text with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.schema import MISSING

# A tag ends at the first ">" of its line.
HTML_TAG = r"<[^>\n]*>"

# Code point ranges treated as emoji and symbols.
EMOJI = (
    r"[\x{1F600}-\x{1F64F}"
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F680}-\x{1F6FF}"
    r"\x{1F1E0}-\x{1F1FF}"
    r"\x{2500}-\x{2BEF}"
    r"\x{2702}-\x{27B0}"
    r"\x{24C2}-\x{1F251}]+"
)

# Characters kept by the last cleaning step, and plain ASCII.
NOT_PRINTABLE = r"[^\x20-\x7F]+"
ASCII_ONLY = r"^[\x00-\x7F]*$"


def strip_html(x: Column) -> Column:
    return F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, HTML_TAG, "")).otherwise(x)


def strip_emoji(x: Column) -> Column:
    return F.regexp_replace(x, EMOJI, "")


def strip_unprintable(x: Column) -> Column:
    """Drop everything outside 0x20-0x7F, line breaks and tabs too, without a blank in place."""
    return F.regexp_replace(x, NOT_PRINTABLE, "")


def clean_review(x: Column) -> Column:
    """Tags, symbols and unprintable characters removed, blanks trimmed.

    Each emoji range lies outside 0x20-0x7F, so the last replacement removes them
    as well and a separate pass over the text is not needed.  The result is ASCII: the test
    for English text that follows in the classic order can no longer fail.
    """
    return F.trim(strip_unprintable(strip_html(x)))


def is_ascii(x: Column) -> Column:
    return F.regexp_like(x, F.lit(ASCII_ONLY))


def english_or_missing(x: Column) -> Column:
    return F.when(is_ascii(x), x).otherwise(MISSING)


def has_text(x: Column) -> Column:
    """The value is not the sentinel, in any case; null for null, which filters and counts drop."""
    return F.lower(x) != MISSING
