"""Order MinHash fingerprints.

The k-mers of a text are its word pairs (its one word, if it has one), numbered by occurrence, so that
the same pair met again is another element.  Each element has one 64-bit hash; 40 bits of it and 24 bits
of its place make one number, and a text is one sorted array of such numbers.  Hash function ``i`` of
``SIZE`` is that hash turned by ``i / SIZE`` of its range: its ``WIDTH`` = 2 smallest elements are the
next two of the sorted array from there on, round the end.  The two are put back into text order and
hashed together, which makes the component depend on order.  Likeness is the share of equal components.

All of it is built-in functions; a text costs one sort.  The next document by doc_id comes from one
shuffle into ranges of doc_id (bounds are quantiles of the ids, as many as four for each shuffle
partition); the first row of each range is sent to the range before as well.

Nulls and edges: a null text is empty; an empty text (or one without words) has components of zero;
rows of equal doc_id follow each other by a hash of their text; rows without a doc_id follow all others;
a single row is its own successor; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
Places beyond 16,777,215 words count as that place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.ordering import Ranges

SIZE = 64
BITS = 6  # SIZE is two to this power
PLACE = 24
MASK = (1 << PLACE) - 1


def components(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the array of ``SIZE`` components of a non-null text column as ``name``."""
    key, bin_ = f"shiftright(%s, {PLACE})", f"shiftright(%s, {64 - BITS})"
    kept = [c for c in rows.columns]

    def step(frame: DataFrame, column: str, expression: str) -> DataFrame:
        return frame.withColumn(column, F.expr(expression))

    rows = step(rows, "_words", rf"array_remove(split({text}, r'[\x20\x09-\x0D]+'), '')")
    rows = step(
        rows,
        "_all",
        "sort_array(slice(transform(_words, (w, i) ->"
        f" (xxhash64(w, get(_words, i + 1)) & {~MASK}L) | CAST(least(i, {MASK}) AS long)),"
        " 1, greatest(size(_words) - 1, least(size(_words), 1))))",
    )
    same = f"{key % 'x'} = {key % 'get(_all, j - 1)'}"
    rows = step(rows, "_again", f"filter(_all, (x, j) -> coalesce({same}, false))")
    # Occurrence numbers: runs of equal pairs among those met again.
    rows = step(
        rows,
        "_runs",
        "filter(transform(_again, (x, j) -> CASE WHEN"
        f" {key % 'x'} = {key % 'get(_again, j - 1)'} THEN -1 ELSE j END), j -> j >= 0)",
    )
    numbered = (
        "flatten(transform(_runs, (s, r) -> transform("
        "slice(_again, s + 1, coalesce(get(_runs, r + 1), size(_again)) - s), (x, o) ->"
        f" (xxhash64({key % 'x'}, o + 1) & {~MASK}L) | (x & {MASK}L))))"
    )
    rows = step(
        rows,
        "_ring",
        f"CASE WHEN size(_again) = 0 THEN _all ELSE sort_array(concat(array_except(_all, _again), {numbered})) END",
    )
    rows = step(
        rows,
        "_heads",
        "filter(transform(_ring, (x, j) -> CASE WHEN"
        f" {bin_ % 'x'} = {bin_ % 'get(_ring, j - 1)'} THEN -1 ELSE j END), j -> j >= 0)",
    )
    half = SIZE // 2
    rows = step(
        rows,
        "_from",
        "flatten(concat(transform(_heads, (h, r) -> array_repeat(h, int("
        f"{bin_ % 'get(_ring, h)'} - coalesce({bin_ % 'get(_ring, get(_heads, r - 1))'}, {-half - 1})))),"
        f" array(array_repeat(0, int({half - 1} - {bin_ % 'element_at(_ring, -1)'})))))",
    )
    first, second = "get(_ring, j)", "get(_ring, (j + 1) % size(_ring))"
    low = f"{first} & {MASK}L <= {second} & {MASK}L"
    pair = [f"CASE WHEN {low} THEN {key % a} ELSE {key % b} END" for a, b in ((first, second), (second, first))]
    rows = step(
        rows,
        name,
        f"CASE WHEN size(_ring) = 0 THEN array_repeat(0, {SIZE}) ELSE"
        f" transform(_from, j -> int(xxhash64({pair[0]}, {pair[1]}) & 65535L)) END",
    )
    return rows.select(*kept, name)


def written(parts: str) -> Column:
    """Components as a string of four hexadecimal digits each."""
    return F.expr(f"array_join(transform({parts}, x -> lower(lpad(hex(x), 4, '0'))), '')")


def likeness(left: str, right: str) -> Column:
    same = F.expr(f"size(filter(zip_with({left}, {right}, (a, b) -> a = b), x -> x))")
    return (same / F.lit(float(SIZE))).cast("double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint of every document."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return components(rows, "text", "_parts").select("doc_id", "text", written("_parts").alias("fingerprint"))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row that follows by doc_id; after the last, the first."""
    ranges = Ranges(rows, "doc_id")
    bounds, last = ranges.bounds, ranges.last
    first = "NULL" if ranges.first is None else f"{ranges.first}L"
    rows = rows.withColumn("_range", ranges.number)
    # (range, 0) for the row itself; (range before, 1) if it may begin its range.
    places = (
        "CASE WHEN doc_id <=> " + first + f" THEN array(struct(_range AS r, 0 AS border), struct({last} AS r, 1 AS border))"
        f" WHEN array_contains({bounds}, doc_id) THEN array(struct(_range AS r, 0 AS border), struct(_range - 1 AS r, 1 AS border))"
        " ELSE array(struct(_range AS r, 0 AS border)) END"
    )
    rows = rows.withColumn("_place", F.explode(F.expr(places)))
    order = Window.partitionBy("_place.r").orderBy(
        "_place.border", F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.length("text")
    )
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return rows.filter("_place.border = 0").drop("_range", "_place")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document, its text with the second half replaced from the next document, and likenesses."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = with_next(components(rows, "text", "parts"), ["text", "parts"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = "int(floor(n_chars / 2))"
    rows = rows.withColumn(
        "edited", F.expr(f"concat(substring(text, 1, int(n_chars - {half})), substring(next_text, 1, {half}))")
    )
    rows = components(rows.drop("text", "next_text"), "edited", "edited_parts")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written("parts").alias("fingerprint"),
        written("edited_parts").alias("edited_fingerprint"),
        likeness("parts", "edited_parts").alias("near_edited"),
        likeness("parts", "next_parts").alias("near_next"),
    )
