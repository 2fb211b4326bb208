"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, by doc_id, form blocks of ``block`` documents.  With quota ``q`` of ``slots``
slots, block ``j`` of a source may run from slot ``floor(j * slots / q)`` on and must run before slot
``ceil((j + 1) * slots / q)``; in each slot, of the blocks that may run, the one with the earliest deadline
runs.  As the quotas fill all slots, every block meets its deadline, and after any number of slots each
source has run less than one block more or less than its weight asks, until a source has no more blocks;
its slots are then left out and all others keep their order.  No document is dropped.

The schedule repeats after ``slots`` slots, so one period of it is a table of ``slots`` rows (made by a
fold over them, in SQL) and is broadcast.  Ranks within a source come from counts per source and range
of doc_id plus ranks within a range, so a source with most rows is spread over all ranges.

That is ``scheduled``, the schedule that the SQL counterpart gives too.  Its quotas are of a fixed number of slots, with one
for each source first, so its deviation is below one block of the quota only; against the weight it grows with the
data, and with as many sources as slots all sources are equal.  ``placed`` and ``mixed`` have no period: they run the
same rule over all blocks with the weights as shares of ``FINE``, so each source stays within one block of its weight (and
slots / ``FINE``) from the first slot until a source has no more blocks.  The driver works out those turns in pieces of ``PIECE``
blocks and stages them; of the data it sees the number of documents of each source alone.

Weights: a mapping of source to weight, or none for the square root of each source's documents, as often
used.  For ``scheduled``, quotas are one slot each and the weights' shares of the other slots by largest remainders, sources that a
mapping leaves out get one slot each, and there are as many slots as sources at least.  For ``placed``, sources without
a weight come after all others, in equal turns.

Nulls and edges: a null source is a source of its own; rows without a doc_id come last in their source; rows
of equal doc_id go by a hash of their text, and equal rows are all kept; an empty table gives no rows; other columns
are carried by ``mixed`` and do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import reduce
from heapq import heappop, heappush
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.ordering import Ranges
from reviewmill.session import stage

SLOTS = 1000
BLOCK = 16
FINE = 1 << 32  # slots that weights without a period are shares of
PIECE = 1 << 20
NONE = "\x00none"  # stands for a null source inside


def quotas(rows: DataFrame, slots: int = SLOTS, weights: Mapping[str, float] | None = None) -> DataFrame:
    """One row: the sources in order with their quotas, and the number of slots.

    ``rows`` has ``_source``.  There are few sources; they meet in one row, as their names and quotas only.
    """
    counts = rows.groupBy("_source").count()
    if weights is None:
        weight = F.sqrt("count")
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("_source") == name, float(share)).otherwise(weight)
    everything = Window.partitionBy(F.lit(0))
    known = counts.withColumns({"weight": weight, "n": F.count("*").over(everything)})
    known = known.withColumn("slots", F.greatest(F.lit(slots), "n").cast("long"))
    total = F.sum("weight").over(everything.orderBy("_source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # One slot each, the others by weight.
    exact = F.coalesce(F.col("weight") / F.nullif(total, F.lit(0.0)), 1 / F.col("n")) * (F.col("slots") - F.col("n"))
    known = known.withColumn("exact", exact).withColumn("floor", F.floor("exact"))
    left = F.col("slots") - F.col("n") - F.sum("floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc(F.round(F.col("exact") - F.col("floor"), 9)), "_source"))
    known = known.withColumn("quota", (1 + F.col("floor") + (place <= left).cast("long")).cast("long"))
    return known.groupBy("slots").agg(F.sort_array(F.collect_list(F.struct("_source", "quota"))).alias("s"))


def period(quota: DataFrame) -> DataFrame:
    """Earliest deadline first over one period: (source, index of the block in the period, slot)."""
    candidate = (
        "CASE WHEN get(a.done, i) < x.quota AND get(a.done, i) * slots DIV x.quota <= t"
        " THEN ((get(a.done, i) + 1) * slots + x.quota - 1) DIV x.quota END"
    )
    pick = f"array_min(filter(transform(s, (x, i) -> struct({candidate} AS d, i AS i)), c -> c.d IS NOT NULL)).i"
    # The pick is made first and then booked, so that it is worked out once for each slot.
    fold = (
        "aggregate(sequence(0L, slots - 1), struct(transform(s, x -> 0L) AS done, CAST(array() AS array<int>) AS picks),"
        f" (a, t) -> element_at(transform(array({pick}), k -> struct("
        "transform(a.done, (n, i) -> n + CASE WHEN i = k THEN 1L ELSE 0L END) AS done,"
        " array_append(a.picks, k) AS picks)), 1), a -> a.picks)"
    )
    rows = quota.select("slots", "s", F.posexplode(F.expr(fold)).alias("slot", "k"))
    rows = rows.select(
        "slots", "slot", F.expr("get(s, k)._source").alias("_source"), F.expr("get(s, k).quota").alias("quota")
    )
    order = Window.partitionBy("_source").orderBy("slot")
    return rows.withColumn("turn", (F.row_number().over(order) - 1).cast("long"))


def by_source(docs: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_source``, and the same with ``_rank`` in their source."""
    rows = docs.select(
        F.struct(*(docs.columns if keep is None else keep)).alias("row"),
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("_source"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64(F.col("text").cast("string")).alias("_tie"),
    )
    ranges = Ranges(rows, "_id")
    rows = rows.withColumn("_range", ranges.number)
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_source", "_range").count()
    counts = counts.select("_source", "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_source", "_range").orderBy(F.col("_id").isNull(), "_id", "_tie")
    ranked = rows.withColumn("_rank", F.row_number().over(inside)).join(counts, ["_source", "_range"])
    return rows, ranked.withColumn("_rank", F.col("_before") + F.col("_rank") - 1)


def scheduled(
    docs: DataFrame,
    block: int = BLOCK,
    slots: int = SLOTS,
    weights: Mapping[str, float] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns (all by default) as a struct ``row`` with block, slot, release, deadline and position."""
    rows, ranked = by_source(docs, keep)
    turns = period(quotas(rows, slots, weights))
    quota = turns.groupBy("_source", "slots", "quota").agg(F.collect_list(F.struct("turn", "slot")).alias("t"))
    quota = quota.select("_source", "slots", "quota", F.expr("transform(sort_array(t), x -> x.slot)").alias("plan"))
    # One row a source, ``slots`` numbers in all: the bound of this broadcast.
    found = ranked.join(F.broadcast(quota), "_source").withColumn("block", F.expr(f"_rank DIV {block}"))
    found = found.withColumns({"_period": F.expr("block DIV quota"), "_turn": F.expr("block % quota")})
    return found.select(
        "row",
        "block",
        F.expr("_period * slots + get(plan, int(_turn))").alias("slot"),
        F.expr("_period * slots + _turn * slots DIV quota").alias("release"),
        F.expr("_period * slots + ((_turn + 1) * slots + quota - 1) DIV quota").alias("deadline"),
        F.expr(f"(_period * slots + get(plan, int(_turn))) * {block} + _rank % {block}").alias("position"),
    )


def in_turn(blocks: list[int], weights: list[float], first: int = 0) -> Iterator[tuple[int, int, int]]:
    """Earliest deadline first over all blocks of all sources: (source, block, slot)."""
    whole = math.fsum(weights)
    exact = [w / whole * FINE for w in weights]
    quota = [math.floor(x) for x in exact]
    for i in sorted(range(len(exact)), key=lambda i: (quota[i] - exact[i], i))[: max(FINE - sum(quota), 0)]:
        quota[i] += 1
    quota = [max(q, 1) for q in quota]
    waiting = [(0, i, 0) for i in range(len(blocks))]
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])  # sources that ended leave slots without a block
        while waiting and waiting[0][0] <= slot:
            _, i, j = heappop(waiting)
            heappush(ready, (-(-(j + 1) * FINE // quota[i]), i, j))
        _, i, j = heappop(ready)
        yield i, j, first + slot
        slot += 1
        if j + 1 < blocks[i]:
            heappush(waiting, ((j + 1) * FINE // quota[i], i, j + 1))


def turns_of(counts: Mapping[str, int], block: int = BLOCK, weights: Mapping[str, float] | None = None) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of all blocks, sources without a weight after all others."""
    names = sorted(counts)
    share = {x: math.sqrt(counts[x]) if weights is None else float(weights.get(x, 0)) for x in names}
    first = 0
    for group in ([x for x in names if share[x] > 0], [x for x in names if not share[x] > 0]):
        even = [share[x] if share[x] > 0 else 1.0 for x in group]
        for i, j, slot in in_turn([-(-counts[x] // block) for x in group], even, first):
            yield group[i], j, slot
            first = slot + 1


def placed(
    docs: DataFrame, block: int = BLOCK, weights: Mapping[str, float] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """The ``keep`` columns (all by default) as a struct ``row`` with block, slot and position, by the weights as they are."""
    spark = docs.sparkSession
    rows, ranked = by_source(docs, keep)
    turns = turns_of({r._source: r["count"] for r in rows.groupBy("_source").count().collect()}, block, weights)
    schema = pa.schema([("_source", pa.string()), ("block", pa.int64()), ("slot", pa.int64())])
    pieces = []
    while (piece := list(islice(turns, PIECE))) or not pieces:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*piece) if piece else [[], [], []], schema)]
        pieces.append(stage(spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema)), "turns"))
        if len(piece) < PIECE:
            break
    found = ranked.withColumn("block", F.expr(f"_rank DIV {block}")).join(reduce(DataFrame.union, pieces), ["_source", "block"])
    return found.select("row", "block", "slot", F.expr(f"slot * {block} + _rank % {block}").alias("position"))


def mixed(docs: DataFrame, block: int = BLOCK, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The documents, all columns kept, in the order of the mixture: over partitions and inside them."""
    return placed(docs, block, weights).orderBy("position").select("row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select("row.doc_id", "row.source", "block", "slot", "release", "deadline", "position")


ORACLE = """
WITH RECURSIVE n AS (
  SELECT coalesce(source, chr(1)) AS s, count(*) AS c FROM documents GROUP BY 1
), e AS (
  SELECT s, sqrt(c) / (SELECT sum(sqrt(c)) FROM n) * (1000 - (SELECT count(*) FROM n)) AS x FROM n
), q AS (
  SELECT s, CAST(1 + floor(x) + CASE WHEN row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, s)
      <= 1000 - count(*) OVER () - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota
  FROM e
), b AS (
  SELECT s, quota, j, CAST(j * 1000 // quota AS BIGINT) AS r, CAST(((j + 1) * 1000 + quota - 1) // quota AS BIGINT) AS d
  FROM q, (SELECT unnest(range(0, 1000)) AS j) WHERE j < quota
), l AS (
  SELECT list({'d': d, 's': s, 'j': j, 'r': r} ORDER BY d, s, j) AS todo FROM b
), run AS (
  SELECT 0 AS t, todo, list_filter(todo, lambda z: z.r <= 0)[1] AS pick FROM l
  UNION ALL
  SELECT t + 1, rest, list_filter(rest, lambda z: z.r <= t + 1)[1]
  FROM (SELECT t, list_filter(todo, lambda z: NOT (z.s = pick.s AND z.j = pick.j)) AS rest FROM run WHERE t < 999)
), plan AS (
  SELECT pick.s AS s, pick.j AS j, t FROM run
), ranked AS (
  SELECT doc_id, source, coalesce(source, chr(1)) AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST) - 1 AS k
  FROM documents
), blocks AS (
  SELECT doc_id, source, k, k // 16 AS block, (k // 16) // quota AS p, (k // 16) % quota AS j, quota, s
  FROM ranked JOIN q USING (s)
)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(p * 1000 + t AS BIGINT) AS slot,
  CAST(p * 1000 + j * 1000 // quota AS BIGINT) AS release,
  CAST(p * 1000 + ((j + 1) * 1000 + quota - 1) // quota AS BIGINT) AS deadline,
  CAST((p * 1000 + t) * 16 + k % 16 AS BIGINT) AS position
FROM blocks JOIN plan USING (s, j)
"""
