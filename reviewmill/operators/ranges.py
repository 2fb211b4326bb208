"""Running totals, places and quantiles over an order that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.session import stage


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores as it takes to be a new column."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def running_totals(rows: DataFrame, by: list[str], totals: dict[str, str]) -> DataFrame:
    """``rows`` with the sums of columns over all rows before, in the order of ``by``: ``{column: name of its sum}``.

    Rows are shared out by sampled ranges of ``by`` (which should tell rows apart), so tasks have about equally many;
    the ranges' own sums, one row a range, are added up in a single task, and the rows of each range in its own.
    """
    part = free_name([*rows.columns, *totals.values()], "range")
    ranged = stage(rows.repartitionByRange(*by).withColumn(part, F.spark_partition_id()), "ranges")
    sums = [F.sum(column).alias(name) for column, name in totals.items()]
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy(part).agg(*sums)
    starts = starts.select(part, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals.values()])
    before = W.partitionBy(part).orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    within = {name: F.coalesce(F.sum(column).over(before), F.lit(0)) for column, name in totals.items()}
    inner = {name: free_name([*ranged.columns, *totals.values()], f"{name}_in_range") for name in totals.values()}
    ranged = ranged.select("*", *[w.alias(inner[name]) for name, w in within.items()])
    joined = ranged.join(starts, part)
    return joined.select(*rows.columns, *[(F.col(n) + F.col(inner[n])).alias(n) for n in totals.values()])


def quantiles(histogram: DataFrame, by: list[str], value: str, weight: str, share: float, name: str = "quantile") -> DataFrame:
    """``(*by, name)``: the exact quantile of ``value`` in each group, with linear interpolation, weighted by whole numbers.

    Running totals give the ranks that each value takes, so the two values around the wanted rank are picked
    where they are; no task holds the values of a group.  ``histogram`` has each value of a group once; null values count as none.
    """
    rows = histogram.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).select(*by, value, weight)
    before, total, base = (free_name(rows.columns, n) for n in ("before", "total", "base"))
    placed = running_totals(rows, [*by, value], {weight: before})
    groups = placed.groupBy(*by).agg(F.sum(weight).alias(total), F.min(before).alias(base))
    if by:
        other = {c: free_name(placed.columns, f"{c}_of_group") for c in by}
        groups = groups.withColumnsRenamed(other)
        same = [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()]
        ranked = placed.join(groups, same).drop(*other.values())
    else:
        ranked = placed.withColumns({total: groups.select(total).scalar(), base: F.lit(0)})
    rank = F.lit(share) * (F.col(total) - 1)
    start = F.col(before) - F.col(base)

    def picked(place):
        return F.max(F.when((start <= place) & (place < start + F.col(weight)), F.col(value).cast("double")))

    low, high, at = picked(F.floor(rank)), picked(F.ceil(rank)), F.first(rank)
    mixed = F.when(F.ceil(at) == F.floor(at), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)
    return ranked.groupBy(*by).agg(mixed.alias(name))


def places(rows: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """``rows`` numbered 0, 1, ... in the order of ``column``, whose values differ."""
    one = free_name([*rows.columns, name], "one")
    return running_totals(rows.withColumn(one, F.lit(1)), [column], {one: name}).drop(one)
