"""JSON files that hold one object of products each, on many lines or on one, read by many tasks.

A file is cut at ``}`` into the byte ranges (blocks) of a scan, and these into chunks.  The first pass counts quotes and
brackets of each chunk, for both cases that a block may begin in: outside or inside a string.  Running sums over the blocks of a file then
tell which case holds and how deep each block begins.  With that, the second pass finds the *marks* of the outer
three levels (object, product, list of reviews): brackets, commas and colons outside strings.  The text between
two marks is a *segment*: a key, a review, or nothing.  Segments that lie over several chunks are chained and joined.

Each review becomes a document ``{key: {"chunk": its byte in the file, "reviews": [review]}}``; a product without reviews
becomes one with its text as it is.  Of repeated keys the last one counts, as in most readers; ``NaN`` and infinite numbers
become null.  What is no JSON gives a document that is none either, beside the documents of the rest.  Scans leave out files
without a byte, so these give nothing.

Limits: files are not compressed; a review, and all of a product that holds no reviews, is one value.  Brackets of the two kinds
are told apart inside reviews only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.session import sent_if_small, stage
from reviewmill.sources.blocks import BEHIND, BLOCK, COMPLETE, UP_TO, WITHOUT, chains, joined_texts

SEPARATOR = "}"
LEVELS = 3
CHUNK_BYTES = 4 << 20

# A chunk with what its block has before it, or a block's own sums: bytes, quotes, and depth if it begins outside or inside a string.
MEASURED = "file long, block long, kind int, n int, size long, quotes long, outside long, inside long, file_size long, record binary"
SEGMENTS = (
    "file long, block long, n int, kind int, place int, at long, level int, mark string, prev string,"
    " owner int, member int, reviews boolean, key string, record binary"
)
_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_REST_OF_STRING = re.compile(rb'(?:[^"\\]|\\.)*(?:"|\Z)', re.DOTALL)
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*(?:"|\Z)|[{}\[\],:]', re.DOTALL)


# ---- first pass -------------------------------------------------------------------


def _measure(text: bytes) -> tuple[int, int, int]:
    """Quotes, and the change of depth if the text begins outside and inside a string."""
    parts = (_ESCAPED.sub(b"", text) if b"\\" in text else text).split(b'"')
    deeper = [sum(x.count(c) * s for c, s in ((b"{", 1), (b"[", 1), (b"}", -1), (b"]", -1))) for x in map(b"".join, (parts[::2], parts[1::2]))]
    return len(parts) - 1, *deeper


class _Block:
    def __init__(self, file: int, start: int, file_size: int):
        self.file, self.start, self.file_size, self.n = file, start, file_size, 0
        self.sums = [0, 0, 0, 0]  # bytes, quotes, depth from outside, depth from inside
        self.held: list[bytes] = []
        self.bytes = 0

    def chunk(self) -> tuple:
        text = b"".join(self.held)
        row = (self.file, self.start, COMPLETE, self.n, *self.sums, self.file_size, text)
        quotes, outside, inside = _measure(text)
        if self.sums[1] % 2:
            outside, inside = inside, outside
        self.sums = [a + b for a, b in zip(self.sums, (len(text), quotes, outside, inside))]
        self.n, self.held, self.bytes = self.n + 1, [], 0
        return row

    def add(self, piece: bytes, size: int) -> tuple | None:
        first = self.start == 0 and not self.n and not self.held
        self.held.append(piece if first else SEPARATOR.encode() + piece)
        self.bytes += len(piece) + 1
        return self.chunk() if self.bytes >= size else None

    def end(self) -> list[tuple]:
        rows = [self.chunk()] if self.held else []
        return [*rows, (self.file, self.start, BLOCK, self.n, *self.sums, self.file_size, None)]


def _batches(rows: Iterator[tuple], types: list[pa.DataType], names: list[str], size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += len(row[-1] or b"") + 100
        if weight >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",")]


def _measured(size: int):
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        block: _Block | None = None
        for batch in batches:
            for file, start, file_size, piece in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if block is None or file != block.file or start != block.start:
                    yield from block.end() if block else []
                    block = _Block(file, start, file_size)
                found = block.add(piece, size)
                if found:
                    yield found
        yield from block.end() if block else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), types, _names(MEASURED), CHUNK_BYTES)

    return run


# ---- second pass ------------------------------------------------------------------


def strict(text: bytes) -> bytes:
    """The text of a JSON value without repeated keys, ``NaN`` and infinite numbers; anything else as it is."""
    odd = False

    def pairs(found: list[tuple]) -> dict:
        nonlocal odd
        kept = dict(found)
        odd |= len(kept) < len(found)
        return kept

    def number(_: str) -> None:
        nonlocal odd
        odd = True

    try:
        value = json.loads(text, object_pairs_hook=pairs, parse_constant=number)
    except (ValueError, RecursionError):
        return text
    return json.dumps(value, ensure_ascii=False).encode() if odd else text


def _chunk_segments(file: int, block: int, n: int, at: int, inside: bool, depth: int, file_size: int, text: bytes) -> Iterator[tuple]:
    first = block == 0 and n == 0
    if at + len(text) + 1 == file_size:
        text += SEPARATOR.encode()  # the file's last byte, behind which there is no piece
    start, place, prev = 0, 0, "start" if first else None
    owner = member = -1
    reviews: bool | None = None
    key: str | None = None

    def row(stop: int, level: int, mark: str) -> tuple:
        crossing = place == 0 and not first
        kind = (BEHIND if not crossing else WITHOUT) if not mark else UP_TO if crossing else COMPLETE
        record = text[start:stop]
        if kind == COMPLETE and level == LEVELS and mark in ",]}" and record.strip():
            record = strict(record)
        return file, block, n, kind, place, at + start, level, mark, prev, owner, member, reviews, key, record

    begin = _REST_OF_STRING.match(text).end() if inside else 0
    for token in _TOKEN.finditer(text, begin):
        here = token.start()
        c = text[here : here + 1].decode("latin-1")
        if c == '"':
            continue
        opens, closes = c in "{[", c in "}]"
        if depth <= (LEVELS - 1 if opens else LEVELS):
            yield row(here, depth, c)
            if c == ":" and depth == 1:
                whole = place > 0 or first
                owner, member, reviews = place, -1, None
                key = text[start:here].strip().decode("utf-8", "replace") if whole else None
            elif c == ":" and depth == 2:
                member, reviews = place, json_text(text[start:here]) == "reviews"
            elif c == "{" and depth == 2:
                member, reviews = place, False  # no list
            start, place, prev = token.end(), place + 1, c
        depth += opens - closes
    yield row(len(text), depth, "")


def json_text(text: bytes) -> str | None:
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return found if isinstance(found, str) else None


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [
        pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(),
        pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.binary(),
    ]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                yield from _chunk_segments(*values)

    return _batches(rows(), types, _names(SEGMENTS), CHUNK_BYTES)


# ---- documents --------------------------------------------------------------------


def _begun(measured: DataFrame) -> DataFrame:
    """How each block begins: byte, inside a string or not, depth; and how its file ends."""
    blocks = measured.filter(F.col("kind") == BLOCK).drop("record", "kind", "n")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    known = blocks.select(
        "file", "block", "size", "outside", "inside", "quotes", "file_size",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("in_string"),
    )
    deeper = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    known = known.withColumn("deeper", deeper)
    return known.select(
        "file", "block", "base", "size", "file_size", "in_string", "quotes", "deeper",
        F.coalesce(F.sum("deeper").over(before), F.lit(0)).alias("depth"),
    )


def _whole_segments(cut: DataFrame) -> DataFrame:
    """All segments, those over several chunks joined; ``text`` instead of ``record``."""
    columns = ["file", "block", "n", "place", "at", "level", "mark", "prev", "owner", "member", "reviews", "key"]
    inside = cut.filter(F.col("kind") == COMPLETE).select(*columns, F.col("record").cast("string").alias("text"))
    parts = cut.filter(F.col("kind").isin(UP_TO, WITHOUT, BEHIND))
    closed = chains(parts, ["block", "n"], begin=["at", "prev"], end=["block", "n", "level", "mark"])
    joined = joined_texts(parts, closed, ["block", "n"])
    none = F.lit(-1)
    across = joined.select(
        "file", F.col("end_block").alias("block"), F.col("end_n").alias("n"), F.lit(0).alias("place"), F.col("begin_at").alias("at"),
        F.col("end_level").alias("level"), F.col("end_mark").alias("mark"), F.col("begin_prev").alias("prev"),
        none.alias("owner"), none.alias("member"), F.lit(None).cast("boolean").alias("reviews"), F.lit(None).cast("string").alias("key"),
        strict_text("text").alias("text"),
    )
    return inside.unionByName(across)


@F.arrow_udf(T.StringType())
def strict_text(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else strict(t.encode()).decode() for t in texts.to_pylist()], pa.string())


def _carried(cut: DataFrame) -> DataFrame:
    """What holds at the beginning of each chunk: the key and member that it lies in, from the chunks before."""
    ends = cut.filter(F.col("kind").isin(WITHOUT, BEHIND)).select(
        "file", "block", "n", "prev",
        F.when(F.col("owner") >= 0, F.struct("block", "n", F.col("owner").alias("place"))).alias("own"),
        F.when(
            (F.col("owner") >= 0) | (F.col("member") >= 0),
            F.struct("block", "n", F.col("member").alias("place"), "reviews"),
        ).alias("mem"),
    )
    before = W.partitionBy("file").orderBy("block", "n").rowsBetween(W.unboundedPreceding, -1)
    return ends.select(
        "file", "block", "n",
        F.last("own", True).over(before).alias("own"), F.last("mem", True).over(before).alias("mem"), F.last("prev", True).over(before).alias("last_mark"),
    )


def _faulty(rows: DataFrame) -> Column:
    """Segments that cannot stand between their marks."""
    blank = F.trim(F.regexp_replace("text", r"[\t\r\n]", " ")) == ""
    name = F.regexp_like("text", F.lit(r'(?s)\A\s*"(?:[^"\\]|\\.)*+"\s*\z'))
    opener = F.col("mark").isin("{", "[")
    prev = F.col("prev")
    return (
        F.when(F.col("mark") == ":", ~name | ~prev.isin("{", ","))
        .when(opener, ~blank | ~prev.isin("start", "[", ",", ":"))
        .when(prev.isin("}", "]"), ~blank)
        .when(prev.isin("{", "["), blank & (F.col("mark") == ","))
        .otherwise(blank)
    )


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """Documents ``value`` of the products in the objects of all files under ``path``."""
    return members(spark, path).select("value")


def members(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents with the hash of their file's path: ``(file, value)``."""
    pieces = spark.read.text(path, lineSep=SEPARATOR).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "_metadata.file_size",
        F.col("value").cast("binary").alias("piece"),
    )
    measured = stage(pieces.mapInArrow(_measured(chunk_bytes), MEASURED), "measured")
    begun = stage(_begun(measured), "begun")
    starts = sent_if_small(begun.select("file", "block", "base", "in_string", "depth"))
    chunks = measured.filter(F.col("kind") == COMPLETE).join(starts, ["file", "block"]).select(
        "file", "block", "n",
        (F.col("base") + F.col("size")).alias("at"),
        (F.col("in_string") != (F.col("quotes") % 2 == 1)).alias("inside"),
        (F.col("depth") + F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))).cast("int").alias("depth"),
        "file_size", "record",
    )
    cut = stage(chunks.mapInArrow(_segments, SEGMENTS), "segments")
    rows = _whole_segments(cut)

    # Rows that know their key go on as they are; the first ones of a chunk get it from the chunks before.
    places = ["file", "block", "n"]
    known = rows.filter("owner >= 0 AND key IS NOT NULL").select(
        *[c for c in rows.columns if c not in ("owner", "member")],
        F.struct("block", "n", F.col("owner").alias("place")).alias("own"),
        F.struct("block", "n", F.col("member").alias("place")).alias("mem"),
    )
    keys = rows.filter("mark = ':' AND level = 1").select(
        "file", F.struct("block", "n", "place").alias("own"), F.btrim("text", F.lit(" \t\r\n")).alias("name")
    )
    keys = stage(keys, "keys")
    late = rows.filter("owner < 0 OR key IS NULL").join(_carried(cut), places)
    late = late.select(
        *[c for c in rows.columns if c not in ("owner", "member", "reviews", "key")],
        F.when(F.col("member") >= 0, F.col("reviews")).when(F.col("owner") < 0, F.col("mem.reviews")).alias("reviews"),
        F.when(F.col("owner") >= 0, F.struct("block", "n", F.col("owner").alias("place"))).otherwise(F.col("own")).alias("own"),
        F.when((F.col("owner") >= 0) | (F.col("member") >= 0), F.struct("block", "n", F.col("member").alias("place")))
        .otherwise(F.struct("mem.block", "mem.n", "mem.place")).alias("mem"),
    ).join(keys.withColumnRenamed("name", "key"), ["file", "own"], "left")
    rows = stage(known.unionByName(late.select(*known.columns)), "rows")

    # The last of equal keys, and of several lists of a product, counts.
    plain = F.get(F.from_json(F.concat(F.lit("["), "name", F.lit("]")), "array<string>"), F.lit(0))
    repeated = keys.groupBy("file", F.coalesce(plain, F.col("name")).alias("plain")).agg(
        F.max("own").alias("last"), F.collect_list("own").alias("all"), F.count("*").alias("times")
    )
    dropped = repeated.filter("times > 1").select("file", F.explode("all").alias("own"), "last").filter("own <> last")
    rows = rows.join(dropped.select("file", "own"), ["file", "own"], "left_anti")
    lists = rows.filter("mark = ':' AND level = 2").filter(_is_reviews("text"))
    lists = lists.groupBy("file", "own").agg(F.max(F.struct("block", "n", "place")).alias("list"), F.count("*").alias("times"))
    several = lists.filter("times > 1").select("file", "own", "list")

    elements = rows.filter("level = 3 AND mark IN (',', ']') AND reviews")
    elements = elements.join(several, ["file", "own"], "left").filter("list IS NULL OR list = mem").drop("list")
    elements = elements.filter(F.trim(F.regexp_replace("text", r"[\t\r\n]", " ")) != "")
    one = F.concat(
        F.lit("{"), "key", F.lit(':{"chunk":'), F.col("at").cast("string"), F.lit(',"reviews":['), "text", F.lit("]}}")
    )
    with_reviews = elements.select("file", "own").distinct()
    others = rows.filter("own IS NOT NULL AND NOT (level = 1 AND mark = ':')").join(with_reviews, ["file", "own"], "left_anti")
    ends = (F.col("level") == 1) & F.col("mark").isin(",", "}")
    tail = F.when(ends, "").otherwise(F.col("mark"))
    each = F.struct("block", "n", "place", F.concat("text", tail).alias("text"))
    others = others.groupBy("file", "own", "key").agg(F.sort_array(F.collect_list(each)).alias("parts"))
    text = F.array_join("parts.text", "")
    whole = F.concat(F.lit("{"), "key", F.lit(":"), text, F.lit("}"))

    found = elements.select("file", one.alias("value")).union(others.select("file", strict_text(whole).alias("value")))
    return found.union(_broken(cut, begun, rows))


def _is_reviews(column: str) -> Column:
    return F.get(F.from_json(F.concat(F.lit("["), column, F.lit("]")), "array<string>"), F.lit(0)) == "reviews"


def _broken(cut: DataFrame, begun: DataFrame, rows: DataFrame) -> DataFrame:
    """A document that is no JSON, or no object, for each file that is none as a whole."""
    unread = F.first("file_size") - F.sum("size")  # 1 if the file ends in a bracket
    ends = begun.groupBy("file").agg((F.sum("quotes") % 2).alias("open"), (F.sum("deeper") - unread).alias("depth"))
    first = cut.filter("block = 0 AND n = 0 AND place = 0").select("file", "level", "mark", F.col("record").cast("string").alias("text"))
    is_object = (F.col("mark") == "{") & (F.trim(F.regexp_replace("text", r"[\t\r\n]", " ")) == "")
    is_list = (F.col("mark") == "[") & (F.trim(F.regexp_replace("text", r"[\t\r\n]", " ")) == "")
    shape = first.join(ends, "file").select(
        "file",
        F.when((F.col("open") != 0) | (F.col("depth") != 0), "{").when(is_list, "[]").when(F.col("mark") == "", F.col("text"))
        .when(~is_object, "{").alias("value"),
    )
    objects = shape.filter("value IS NULL").select("file")
    marks = rows.filter(_faulty(rows) | ((F.col("level") == 0) & (F.col("prev") != "start")))
    wrong = marks.select("file", F.concat(F.lit("{ at byte "), F.col("at").cast("string")).alias("value"))
    rest = W.partitionBy("file").orderBy(F.desc("block"), F.desc("n"))
    last = cut.filter(F.col("kind").isin(WITHOUT, BEHIND)).select(
        "file", "at", F.col("record").cast("string").alias("text"), F.row_number().over(rest).alias("number")
    )
    last = last.filter("number = 1").filter(F.trim(F.regexp_replace("text", r"[\t\r\n]", " ")) != "")
    behind = last.select("file", F.concat(F.lit("{ at byte "), F.col("at").cast("string")).alias("value"))
    return shape.filter("value IS NOT NULL").union(wrong.union(behind).join(objects, "file", "left_semi"))
