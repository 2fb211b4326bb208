"""Tagged text files: ``<record> ... </record>`` blocks in a folder tree.

Files of any size are read by byte ranges.  A scan cuts them at ``</``, which has no letter and so no case; a task has the pieces of its
ranges (*blocks*) in file order.  In one pass over them it joins pieces up to the next closing record tag, in
any case, and counts records and bytes.  Text before a block's first closing tag and behind its last one belongs to a
record that may lie over several blocks: these *fragments* are chained by file, and only chains that are closed are joined.
Running sums over the blocks in path order then number the records and give their byte offsets, so rows, numbers and
offsets are the same however files are split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.operators.ranges import running_totals
from reviewmill.schema import SEQ, SOURCE_SHIFT, TEXT_SOURCE
from reviewmill.session import sent_if_small, stage
from reviewmill.sources.blocks import BEHIND, BLOCK, COMPLETE, UP_TO, WITHOUT, chains, joined_texts

# Fixed value: a record runs to the nearest closing tag, over lines, in any case.
RECORD_PATTERN = r"(?is)<record>(.*?)</record>"
SEPARATOR = "</"
CLOSING = b"record>"  # what follows the separator
OPENING = re.compile(b"<record>", re.IGNORECASE)

CUT = "file long, block long, kind int, at long, place int, record binary"
BATCH_BYTES = 4 << 20


def list_files(spark: SparkSession, folder: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    """Paths and sizes of matching files; the content column is never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .load(folder)
        .select("path", "length")
    )


def count_files(spark: SparkSession, folder: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    return list_files(spark, folder, pattern, recursive).agg(F.count_distinct("path").alias("files"))


def split_records(df: DataFrame, value: str = "value", keep_count: bool = False) -> DataFrame:
    """One row per record block of ``value``; ``pos`` is its place in the text.

    The outer form of explode keeps the optimizer from adding a size filter, which would run
    the pattern over the text a second time.
    """
    others = [c for c in df.columns if c != value]
    found = df.select(*others, F.regexp_extract_all(F.col(value), F.lit(RECORD_PATTERN), 1).alias("found"))
    count = [F.size("found").alias("records")] if keep_count else []
    rows = found.select(*others, *count, F.posexplode_outer("found").alias("pos", "record"))
    return rows.filter(F.col("record").isNotNull())


class _Block:
    """The pieces of one byte range of a file, in order."""

    def __init__(self, file: int, start: int):
        self.file, self.start = file, start
        self.pieces: list[bytes] = []
        self.at = 0  # bytes before the pieces held
        self.size = 0  # bytes so far
        self.closed = start == 0  # whether the pieces held begin at a closing tag or the beginning of the file
        self.records = 0

    def row(self, kind: int, at: int, record: bytes | None, place: int = 0) -> tuple:
        return self.file, self.start, kind, at, place, record

    def text(self) -> bytes:
        """The pieces held; the separator before a block's first piece belongs to it."""
        text = SEPARATOR.encode().join(self.pieces)
        return text if self.closed or not self.pieces else SEPARATOR.encode() + text

    def add(self, piece: bytes) -> tuple | None:
        """Takes a piece; the record or fragment that it closes."""
        found = None
        if piece[:7].lower() == CLOSING:
            text = self.text()
            if not self.closed:
                found = self.row(UP_TO, self.at, text)
            elif opening := OPENING.search(text):
                found = self.row(COMPLETE, self.at + opening.start(), text[opening.end() :], self.records)
                self.records += 1
            self.pieces, self.at, self.closed = [piece[7:]], self.size + 7, True
        else:
            self.pieces.append(piece)
        self.size += len(piece) + len(SEPARATOR)
        return found

    def end(self) -> list[tuple]:
        kind = BEHIND if self.closed else WITHOUT
        return [self.row(kind, self.at, self.text()), self.row(BLOCK, self.size, None, self.records)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    names = ["file", "block", "kind", "at", "place", "record"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: _Block | None = None
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for file, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if block is None or file != block.file or start != block.start:
                rows += block.end() if block else []
                block = _Block(file, start)
            found = block.add(piece)
            if found:
                rows.append(found)
                held += len(found[5]) + 64
                if held > BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
    rows += block.end() if block else []
    if rows:
        yield _batch(rows)


def _chained(cut: DataFrame) -> DataFrame:
    """Records that lie over several blocks: ``(file, block, last_block, at, record)``."""
    parts = cut.filter(F.col("kind").isin(UP_TO, WITHOUT, BEHIND))
    closed = chains(parts, ["block"], begin=["block", "at"], end=["block"])
    whole = joined_texts(parts, closed, ["block"])
    before, record = (F.regexp_extract("text", r"(?is)\A(.*?)<record>(.*)\z", g) for g in (1, 2))
    return whole.filter(F.regexp_like("text", F.lit("(?i)<record>"))).select(
        "file",
        F.col("begin_block").alias("block"),
        F.col("end_block").alias("last_block"),
        (F.col("begin_at") + F.octet_length(before)).alias("at"),
        record.alias("record"),
    )


def read_records(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """All records under ``folder`` as ``(path, seq, offset, record)``.

    Records follow each other by path and place in the file; ``offset`` is the byte of the opening tag.  A record left open
    at the end of its file is no record, and no record runs on into another file.  The records are written once, as
    cut; their numbers are joined to that copy, from a table of one row a block.
    """
    scan = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    pieces = scan.text(folder, lineSep=SEPARATOR).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )
    cut = stage(pieces.mapInArrow(_cut, CUT), "cut")
    chained = stage(_chained(cut), "chained")
    files = scan.format("binaryFile").load(folder).select("_metadata.file_path")
    files = stage(files.select(F.xxhash64("file_path").alias("file"), F.col("file_path").alias("path")), "files")

    over = chained.select("file", F.col("last_block").alias("block"), F.lit(1).alias("over"))
    blocks = cut.filter(F.col("kind") == BLOCK).select("file", "block", F.col("at").alias("bytes"), "place")
    blocks = blocks.join(over, ["file", "block"], "left").join(files, "file")
    blocks = blocks.withColumn("over", F.coalesce("over", F.lit(0))).withColumn("records", F.col("place") + F.col("over"))
    blocks = running_totals(blocks, ["path", "block"], {"records": "earlier", "bytes": "base"})
    base = F.col("base") - F.min("base").over(W.partitionBy("file"))
    blocks = stage(blocks.select("file", "block", "over", "earlier", base.alias("base")), "blocks")
    blocks, files = sent_if_small(blocks), sent_if_small(files)

    inside = cut.filter(F.col("kind") == COMPLETE).join(blocks, ["file", "block"])
    inside = inside.select(
        "file",
        (F.col("earlier") + F.col("over") + F.col("place")).alias("number"),
        (F.col("base") + F.col("at")).alias("offset"),
        F.col("record").cast("string").alias("record"),
    )
    ends = blocks.select("file", F.col("block").alias("last_block"), "earlier")
    across = chained.join(blocks.select("file", "block", "base"), ["file", "block"]).join(ends, ["file", "last_block"])
    across = across.select("file", F.col("earlier").alias("number"), (F.col("base") + F.col("at")).alias("offset"), "record")
    seq = F.lit(TEXT_SOURCE << SOURCE_SHIFT) + F.col("number")
    return inside.unionByName(across).join(files, "file").select("path", seq.alias(SEQ), "offset", "record")


def first_record(records: DataFrame) -> DataFrame:
    """Preview: body of the first record."""
    return records.orderBy(SEQ).limit(1).select("record")
