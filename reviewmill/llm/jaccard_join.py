"""Jaccard join of word-shingle sets, heavy and light sets apart.

1. One pass over the texts makes each document's set of 64-bit shingle hashes (array code in Arrow
   batches) and keeps a 128-bit signature of it and the *block*: the elements in a fixed part of the hash
   range.  Documents of equal sets form a class at once, so copies are never paired.
2. Elements are in one global order: block elements by frequency among classes, rare ones first, then all
   others by hash.  Two sets that link have at least ``o`` common elements, so each misses at most
   ``d = n - ceil(threshold * n)`` of its own, and they share at least ``c`` of the first ``d + c``
   elements of each.  Elements of one class alone can be shared by none, yet take up places.
3. Light sets (below a boundary size) enumerate the ``c`` = 2 subsets of that beginning as keys.  Heavy
   sets scan inverted lists, one for each of their first ``d + 1`` elements; light sets within reach of the
   boundary are in these lists too.  The boundary minimises the estimated cost: subsets to enumerate against
   list entries to scan, summed by size.
4. Each list has a *pivot*, a member whose elements are among the most common (an original rather than an altered copy), of several
   the one with the smallest id.
   All members are held against it; exact intersections of whole sets decide, and components of these links are found.
   A group of copies thus costs as many comparisons as it has members.
5. Pairs within a component cannot change it.  A list that is *mixed*, with members of other components than its pivot's, is
   crossed if it has at most ``SHORT`` members: each outsider meets the members of other components.
   A longer mixed list says too little about its members (a passage that many share).  They are joined once more
   among themselves by steps 2 to 5 with all elements in the block, so that what they share with few others decides,
   and there every mixed list is crossed.  Two sets that link share a list in the first join; if none of these is short,
   both are in the second.  No link between different components is lost.
6. A pair is held against each other only if it can link by size and by parity: every element that only one of
   two sets has flips one bit of ``BITS`` parity bits, so their maps differ in no more bits than the sets differ in elements.

Staged tables are in the shared folder and are released when the result is staged; no step gathers documents on the driver (the size bands'
costs, at most some 200 rows, are).

Nulls and edges: a null or empty text, or one without words, has an empty set and is its own component; a
text of one or two words has one shingle; a row without a doc_id has no component and links nothing (doc_ids have at most 55 bits); rows
of one doc_id are one document with several sets; equal rows are returned as often as they came; an empty
table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.arrays import lower_ascii, mixed, slices, words_of
from reviewmill.session import Scratch, stage

THRESHOLD = 90  # per cent
BLOCK = 1.25  # times the share that a set may miss: the part of the hash range that the block takes
ENTRY = 20  # cost of one list entry, in looks at an entry of a list
SHORT = 64  # members of a mixed list that is crossed as it is
BETWEEN = 1 << 40  # frequency rank of elements outside the block
BITS = 256  # of the parity map of a set
HALF = 1 << 54  # doc_ids lie between this and its negative
WORDS = BITS // 64
PARITY = [f"p{k}" for k in range(WORDS)]
NARROW = "doc_id long, n int, sig_a long, sig_b long, parity array<long>, block array<long>, tail array<long>"


def factor(k: int) -> np.uint64:
    """An odd number for each place of a shingle."""
    return mixed(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1)


def shingles(texts: pa.Array, width: int = 3) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    words = words_of(lower_ascii(texts))
    n = len(texts)
    counts = np.bincount(words.doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    h = words.hashes
    total = np.zeros(max(len(h) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        total += h[k : k + len(total)] * factor(k)
    total = mixed(total).view(np.int64)
    out = []
    for i in range(n):
        a, m = first[i], counts[i]
        if m >= width:
            out.append(np.unique(total[a : a + m - width + 1]))
        elif m:
            short = np.full(1, m, dtype=np.uint64)
            for k in range(m):
                short = short + h[a + k : a + k + 1] * factor(k)
            out.append(mixed(short).view(np.int64))
        else:
            out.append(np.empty(0, dtype=np.int64))
    return out


def prefix(n: int, threshold: int = THRESHOLD) -> int:
    """Elements that a set may miss of itself."""
    return n - -(-threshold * n // 100)


def listed(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([*parts, np.empty(0, dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def narrow_batches(width: int, threshold: int, part: int):
    """Sets as their signature, the elements in the first ``part`` of 256 parts of the hash range, and what is missing to a beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingles(batch.column(1), width)
            sums, blocks, tails = [], [], []
            for s in sets:
                u = s.view(np.uint64)
                sums.append([mixed(u).sum(dtype=np.uint64), mixed(u ^ factor(0)).sum(dtype=np.uint64)])
                inside = (s & 255) < part
                block = s[inside]
                missing = prefix(len(s), threshold) + 2 - len(block)
                blocks.append(block)
                tails.append(s[~inside][: max(missing, 0)])
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            bit = (np.concatenate([*sets, np.empty(0, np.int64)]) >> 8) & (BITS - 1)
            odd = (np.bincount(owner * BITS + bit, minlength=len(sets) * BITS) & 1).astype(np.uint8)
            parity = np.packbits(odd.reshape(-1, BITS), axis=1).reshape(-1).view(np.int64)
            parity = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * WORDS), pa.array(parity))
            signs = np.array(sums, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(signs[:, 0].copy()), pa.array(signs[:, 1].copy()), parity, listed(blocks), listed(tails),
                ],
                names=["doc_id", "n", "sig_a", "sig_b", "parity", "block", "tail"],
            )

    return run


def whole_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), listed(shingles(batch.column(1), width))], names=["rep", "items"])

    return run


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Smallest id of each vertex' component, for links (a, b): minimum labels with pointer jumping."""
    both = scratch.stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
    labels = scratch.stage(labels.select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        lower = scratch.stage(lower, "labels")
        of = lower.select(F.col("id").alias("at"), F.col("label").alias("jump"))
        jumped = lower.join(of, F.col("label") == F.col("at")).select("id", "old", F.least("label", "jump").alias("label"))
        jumped = scratch.stage(jumped, "labels")
        labels = jumped.select("id", "label")
        if not jumped.filter("label < old").limit(1).count():
            return labels


def boundary(beginnings: DataFrame) -> int:
    """The size from which inverted lists are estimated to be cheaper than pairs of elements."""
    costs = beginnings.select(
        F.floor(F.log2(F.col("n")) * 4).alias("band"),
        F.expr(f"{ENTRY}D * size(begin) * (size(begin) - 1) / 2").alias("pairs"),
        F.expr(f"{ENTRY}D * size(begin) + aggregate(begin, 0D, (a, x) -> a + least(x.f % {BETWEEN}, {SHORT}))").alias("scans"),
    )
    rows = costs.groupBy("band").agg(F.sum("pairs").alias("pairs"), F.sum("scans").alias("scans")).collect()
    rows = sorted((r.band, r.pairs, r.scans) for r in rows)
    options = [(sum(p for b, p, _ in rows if b < cut) + sum(s for b, _, s in rows if b >= cut), cut)
               for cut in [0, *[b + 1 for b, _, _ in rows]]]
    return math.ceil(2 ** (min(options)[1] / 4)) if rows else 1


def near(threshold: int, x: str, y: str) -> Column:
    """Whether sets x and y (columns ``n``, ``parity`` with these endings) can link by size and parity."""
    n, m = F.col(f"n{x}").cast("long"), F.col(f"n{y}").cast("long")
    apart = sum(F.bit_count(F.col(f"p{k}{x}").bitwiseXOR(F.col(f"p{k}{y}"))) for k in range(WORDS))
    sizes = (100 * n >= threshold * m) & (100 * m >= threshold * n)
    return sizes & ((100 + threshold) * apart <= (100 - threshold) * (n + m))


def beginnings(classes: DataFrame, threshold: int) -> DataFrame:
    """Per class the elements of its beginning that another class has, with the room for them and how common its elements are.

    Only (class, element) is shuffled; what else is known of a class is joined to the few that are left.
    """
    block = classes.select("key", F.explode("block").alias("h"))
    often = block.groupBy("h").count().filter("count > 1").select("h", F.col("count").alias("f"))
    hits = block.join(often, "h").select("key", "h", "f")
    rest = classes.select("key", F.explode("tail").alias("h"), F.lit(BETWEEN).alias("f"))
    inside = F.col("f") < BETWEEN
    lists = hits.unionByName(rest).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("f", "h"))).alias("begin"),
        F.sum(inside.cast("int")).alias("hits"),
        F.sum(F.when(inside, F.col("f")).otherwise(0)).alias("uses"),
    )
    known = classes.select(
        "key", "rep", "n", F.size("block").alias("size"), *[F.col("parity")[k].alias(f"p{k}") for k in range(WORDS)]
    )
    rows = lists.join(known, "key")
    rows = rows.withColumn("room", F.expr(f"n - int(ceil({threshold} * n / 100)) + 2 - (size - hits)"))
    begin = F.expr("slice(begin, 1, greatest(room, 0))").alias("begin")
    common = (F.col("uses") / F.greatest("size", F.lit(1))).cast("float").alias("common")
    return rows.select("rep", "n", *PARITY, "room", common, begin).filter("size(begin) > 0")


def entries(begin: DataFrame, heavy_from: int, threshold: int) -> DataFrame:
    """Members of lists: (rep, rank to be the pivot, key)."""
    single = "transform(slice(begin, 1, greatest(room - 1, 0)), x -> xxhash64(x.h))"
    double = (
        "flatten(transform(begin, (x, i) -> transform(slice(begin, i + 2, size(begin)),"
        " y -> xxhash64(least(x.h, y.h), greatest(x.h, y.h)))))"
    )
    keys = (
        f"concat(CASE WHEN 100 * n >= {threshold} * {heavy_from} THEN {single} ELSE array() END,"
        f" CASE WHEN n < {heavy_from} THEN {double} ELSE array() END)"
    )
    # By commonness in steps of a fifth, then by the smallest id, so that lists of one group have few pivots.
    rank = F.expr(f"shiftleft(CAST(least(4 * log2(1 + common), 200) AS long), 55) + ({HALF - 1}L - rep)").alias("rank")
    return begin.select("rep", rank, F.explode(F.array_distinct(F.expr(keys))).alias("key"))


def verified(docs: DataFrame, pairs: DataFrame, scratch: Scratch, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b) that link, by whole sets."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    wanted = docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    sets = scratch.stage(wanted.mapInArrow(whole_batches(width), "rep long, items array<long>"), "sets")
    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    return pairs.join(left, "a").join(right, "b").filter(100 * common >= threshold * union).select("a", "b").distinct()


def compared(pairs: DataFrame, facts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that can link by size and parity."""
    first = facts.select(F.col("rep").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("n", *PARITY)])
    second = facts.select(F.col("rep").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("n", *PARITY)])
    return pairs.join(first, "a").join(second, "b").filter(near(threshold, "_a", "_b")).select("a", "b")


def labelled(pairs: DataFrame, label: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of different components."""
    if label is None:
        return pairs
    for side in "ab":
        pairs = pairs.join(label.toDF(side, f"c_{side}"), side, "left").withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))
    return pairs.filter("c_a <> c_b").select("a", "b")


class Sweep:
    """One join by lists: links of pivots, then of the members of mixed lists."""

    def __init__(self, docs: DataFrame, scratch: Scratch, width: int, threshold: int):
        self.docs, self.scratch, self.width, self.threshold = docs, scratch, width, threshold
        self.links: DataFrame | None = None
        self.label: DataFrame | None = None

    def linked(self, pairs: DataFrame, facts: DataFrame) -> None:
        """Adds the links among the pairs (a, b) and finds the components again."""
        with Scratch(self.docs.sparkSession) as brief:
            pairs = brief.stage(compared(labelled(pairs, self.label), facts, self.threshold), "pairs")
            found = self.scratch.stage(verified(self.docs, pairs, brief, self.width, self.threshold), "verified")
        self.links = found if self.links is None else self.links.union(found)
        self.label = components(self.links, self.scratch)

    def run(self, begin: DataFrame, short: int | None) -> DataFrame:
        """Links what lists of ``begin`` tell; the members (rep) of mixed lists with more than ``short`` of them."""
        members = entries(begin, boundary(begin), self.threshold)
        pivots = members.groupBy("key").agg(F.max("rank").alias("rank"), F.count("*").alias("m")).filter("m > 1")
        pivots = pivots.select("key", "m", F.expr(f"{HALF - 1}L - (rank & {2 * HALF - 1}L)").alias("pivot"))
        long = F.lit(False) if short is None else F.col("m") > short
        lists = members.join(pivots, "key").select("key", "rep", "pivot", long.alias("long"))
        lists = self.scratch.stage(lists, "lists")
        spokes = self.scratch.stage(lists.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "spokes")
        self.linked(spokes, begin)

        # Members of other components than their pivot's, and the lists that have them.
        foreign = self.scratch.stage(labelled(spokes, self.label).toDF("pivot", "rep"), "foreign")
        outsiders = lists.join(foreign, ["pivot", "rep"], "left_semi").select("key", "rep", "long")
        outsiders = self.scratch.stage(outsiders, "outsiders")
        mixed = outsiders.select("key").distinct()
        crossing = outsiders.filter("NOT long").select("key", "rep")
        others = lists.filter("NOT long AND rep <> pivot").join(mixed, "key", "left_semi").select("key", "rep")
        # What decides whether a pair can link comes to the members of mixed lists, so that a list gives no other pairs.
        about = begin.select("rep", "n", *PARITY).join(self.label.toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
        first = crossing.join(about, "rep").select("key", *[F.col(x).alias(f"{x}_a") for x in ("rep", "n", "c", *PARITY)])
        second = others.join(about, "rep").select("key", *[F.col(x).alias(f"{x}_b") for x in ("rep", "n", "c", *PARITY)])
        apart = (first["key"] == second["key"]) & (F.col("c_a") != F.col("c_b")) & near(self.threshold, "_a", "_b")
        both = first.join(second, apart).select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
        self.linked(both, begin)
        return lists.filter("long").join(mixed, "key", "left_semi").select("rep").distinct()


def join(docs: DataFrame, width: int = 3, threshold: int = THRESHOLD, short: int = SHORT) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id of the same set), component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        part = min(256, int(256 * BLOCK * (1 - threshold / 100)))
        narrow = scratch.stage(docs.mapInArrow(narrow_batches(width, threshold, part), NARROW), "narrow")
        signature = ["n", "sig_a", "sig_b"]
        sets = narrow.filter("doc_id IS NOT NULL AND n > 0")

        def begun(classes: DataFrame) -> DataFrame:
            """The beginnings of ``classes``, which they read four times: these are made once, and released when they are used."""
            # Sets of one doc_id are told apart by eight bits of their signature.
            key = F.shiftleft("rep", 8).bitwiseOR(F.col("sig_a").bitwiseAND(255)).alias("key")
            with Scratch(docs.sparkSession) as brief:
                classes = brief.stage(classes.select(key, "rep", "n", "parity", "block", "tail"), "classes")
                return scratch.stage(beginnings(classes, threshold), "beginnings")

        about = [F.first(c).alias(c) for c in ("parity", "block", "tail")]
        # A set of fewer elements than a difference of one needs links with none but its equals.
        linking = f"n >= {math.ceil(threshold / (100 - threshold))}"
        classes = sets.filter(linking).groupBy(*signature).agg(F.min("doc_id").alias("rep"), *about)
        sweep = Sweep(docs, scratch, width, threshold)
        begin = begun(classes)
        crowded = scratch.stage(sweep.run(begin, short), "crowded")
        if not crowded.isEmpty():
            again = docs.join(crowded.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
            whole = scratch.stage(again.mapInArrow(narrow_batches(width, threshold, 256), NARROW), "whole")
            named = sets.groupBy(*signature).agg(F.min("doc_id").alias("rep")).join(crowded, "rep", "left_semi")
            classes = whole.filter(linking).groupBy(*signature).agg(*about).join(named, signature)
            begin = begun(classes)
            sweep.run(begin, None)
        label = sweep.label.toDF("class_id", "component")

        names = sets.groupBy(*signature).agg(F.min("doc_id").alias("class_id")).join(label, "class_id", "left")
        rows = narrow.select("doc_id", *signature).join(names, signature, "left")
        found = F.col("doc_id").isNotNull() & (F.col("n") > 0)
        rows = rows.select(
            "doc_id",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(found, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
            F.when(found, F.coalesce("component", "class_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        return stage(rows, "joined")


def digest(joined: DataFrame) -> DataFrame:
    return joined.select("doc_id", "n_shingles", "component_id")
