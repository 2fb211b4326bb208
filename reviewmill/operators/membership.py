"""Exact membership of 64-bit codes in a set, as an expression without a join.

The set is written as a cascade of bit maps.  The first has a bit for every member; a code that is none may
hit one by chance.  As all codes that can come are known, those that do are the *strays*, and the second map has a bit for each of
them; members that hit one of these are the strays of the second map, and so on.  Each map is a small part of the
one before; when at most ``LISTED`` strays are left they are named.  Maps are made by Spark and become part of the
expression: ``BITS`` bits a member (or a code that is none, if there are fewer of these), and a sixtieth or so of that for what follows.  The codes themselves are not gathered.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import Scratch, stage

BITS = 64
LISTED = 200


def _place(code: Column, level: int, slots: int) -> tuple[Column, Column]:
    """The word of a code in a map, and its bit there.

    The first two maps take other parts of the code itself, which is a hash and is tested for each word of a text; the
    maps after them, for the few codes that are left, hash it anew, so that a cascade ends for codes of any kind.
    """
    mixed = code if level < 2 else F.xxhash64(code, F.lit(level))
    bit = F.call_function("shiftrightunsigned", mixed, F.lit(44 - 12 * (level % 2))).bitwiseAND(F.lit(63))
    return F.pmod(mixed, F.lit(slots)).cast("int"), bit.cast("int")


def _slots(members: int) -> int:
    return -(-members * BITS // 64) | 1


def _bit_map(codes: DataFrame, level: int, slots: int) -> np.ndarray:
    """The map as 64-bit words; one for each slot that has a bit comes to the driver."""
    slot, bit = _place(F.col("code"), level, slots)
    placed = codes.select(slot.alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    found = placed.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(slots, dtype=np.int64)
    words[found.column("slot").to_numpy()] = found.column("bits").to_numpy()
    return words


def _literal(spark: SparkSession, words: np.ndarray) -> Column:
    """The map as an array literal.  ``F.lit`` would send it number by number, a call to the JVM for each; it goes as bytes, in one."""
    jvm = spark._jvm
    numbers = spark.sparkContext._gateway.new_array(jvm.long, len(words))
    jvm.java.nio.ByteBuffer.wrap(words.astype(">i8").tobytes()).asLongBuffer().get(numbers)
    return Column(jvm.org.apache.spark.sql.functions.lit(numbers))


def _hit(code: Column, level: int, words: Column, slots: int) -> Column:
    slot, bit = _place(code, level, slots)
    return F.getbit(F.get(words, slot), bit) == 1


def likely_test(members: DataFrame) -> Callable[[Column], Column]:
    """A test that all ``members`` (a staged column ``code``) pass, and about one in ``BITS`` of other codes: the first map alone.

    It spares a join the rows that cannot match; the join itself still decides.
    """
    n = members.count()
    if not n:
        return lambda code: F.lit(False)
    slots = _slots(n)
    words = _literal(members.sparkSession, _bit_map(members, 0, slots))
    return lambda code: _hit(code, 0, words, slots)


def member_test(members: DataFrame, others: DataFrame) -> Callable[[Column], Column]:
    """A test of codes for membership; ``members`` and ``others`` (columns ``code``) are all codes that can come.

    The maps are made of the smaller of the two.  Both are read more than once, so they should be cheap to read, as a staged table is.
    """
    maps: list[tuple[Column, int]] = []
    with Scratch(members.sparkSession) as scratch:
        inside, outside = members.select("code"), others.select("code")
        n, left = inside.count(), outside.count()
        swapped = left < n
        if swapped:
            inside, outside, n = outside, inside, left
        while n > LISTED:
            level = len(maps)
            slots = _slots(n)
            maps.append((_literal(members.sparkSession, _bit_map(inside, level, slots)), slots))
            strays = scratch.stage(outside.filter(_hit(F.col("code"), level, *maps[level])), "strays")
            inside, outside, n = strays, inside, strays.count()
        named = [r.code for r in inside.collect()]

    def test(code: Column) -> Column:
        found = code.isin(named) if named else F.lit(False)
        for level in reversed(range(len(maps))):
            found = _hit(code, level, *maps[level]) & ~found
        return ~found if swapped else found

    return test


def settled(df: DataFrame, label: str) -> DataFrame:
    """A staged copy of ``df``, in whose expressions are maps.

    Spark plans anew after each shuffle and goes through the maps every time, on the driver and alone; the plans that go on from
    the copy are without them.
    """
    return stage(df, label)
