"""Choosing rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = 1 << 20


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo; a null doc_id has none."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def held_out(modulus: int, value: int) -> Column:
    """Whether a row is kept from learning.  Rows without a doc_id are: nothing says that they may be learnt from."""
    return F.coalesce(remainder(modulus) == value, F.lit(True))


def bounded(rows: DataFrame, limit: int) -> DataFrame:
    """About ``limit`` rows at most, evenly by a hash of doc_id; all of them if there are no more."""
    share = min(1.0, limit / max(rows.select("doc_id").count(), 1))
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(GRAIN)) < int(share * GRAIN))


def bounded_each(rows: DataFrame, group: str, limit: int, least: int) -> DataFrame:
    """As ``bounded``, but about ``least`` rows of each group (all, if it has no more), or its part of ``limit`` if that is more.

    With many groups, ``least`` shrinks so that the groups together stay below twice the limit, to two rows of each.
    """
    counts = [tuple(r) for r in rows.groupBy(group).count().collect()]
    whole = sum(n for _, n in counts)
    least = max(2, min(least, limit // max(len(counts), 1)))
    # Groups with the plain share need no name; of the others there are few rows.
    common = min(1.0, limit / max(whole, 1))
    rare = {name: min(1.0, least / n) for name, n in counts if n * common < least}
    share = F.lit(int(common * GRAIN))
    if rare:
        table = F.create_map(*(x for name, s in rare.items() for x in (F.lit(name), F.lit(int(s * GRAIN)))))
        share = F.coalesce(table[F.col(group)], share)
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(GRAIN)) < share)
