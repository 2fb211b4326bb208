"""Cost-balanced packing of token ids into sequences.

Every task tokenises its own documents and packs them in blocks of ``block_tokens``; nothing is
shuffled.  Inside a block, pieces go in descending length to the sequence of lowest estimated cost
(``linear * n + quadratic * n * n`` for each piece, as attention stays inside a piece) that still has
room.  A piece that fits nowhere is cut to fill the sequences with the most room.  A block has just
enough sequences of ``capacity`` ids and one of the next power of two, so its padding is below that
last sequence's length, whatever the documents are.

With ``in_order``, rows come in an order over partitions and inside them, as after ``orderBy``, and sequence_id follows it:
partitions, their blocks, and inside a block sequences of one document by its place, the others (each with documents
from all over the block) evenly between.

Nulls and edges: a null text is empty and has the closing id alone; a null doc_id stays null; rows of
equal doc_id are packed one by one; an empty table gives no rows.  Only ``doc_id`` and ``text`` are
read, so other columns can have any names.  Texts of any length are tokenised whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
BLOCK_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
CLOSING_ID = 1
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The ids are those of the ``tokenizers`` vocabulary file.  The same vocabulary as ranks gives them
    faster; only a text that may name a special token goes to the vocabulary file's own library.
    """

    kept: dict[tuple[str, str], "Encoder"] = {}

    def __init__(self, vocabulary: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )

    @classmethod
    def of(cls, vocabulary: str, ranks: str) -> "Encoder":
        if (vocabulary, ranks) not in cls.kept:
            cls.kept[vocabulary, ranks] = cls(vocabulary, ranks)
        return cls.kept[vocabulary, ranks]

    def ids(self, text: str) -> bytes:
        if "<|" in text:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.encoding.encode_ordinary(text)
        return np.asarray(found, dtype="<u4").tobytes()


def assign(
    lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one block of documents."""
    total = sum(lengths)
    if not total:
        return []
    whole, rest = divmod(total, capacity)
    room = [capacity] * whole + ([1 << (rest - 1).bit_length()] if rest else [])
    pieces, placed, at = [], [], 0
    for document, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            placed.append((document, start, capacity, at, 0))
            at += 1
        if n % capacity:
            pieces.append((n % capacity, document, n - n % capacity))
    free = np.array(room[at:], dtype=np.int64)
    size, cost = free.copy(), np.zeros(len(free))
    for n, document, start in sorted(pieces, key=lambda p: (-p[0], p[1])):
        while n:
            open_cost = np.where(free >= n, cost, np.inf)
            k = int(open_cost.argmin())
            if free[k] < n:
                k = int(free.argmax())
            used = min(n, int(free[k]))
            placed.append((document, start, used, at + k, int(size[k] - free[k])))
            free[k] -= used
            cost[k] += linear * used + quadratic * used * used
            start, n = start + used, n - used
    return placed


def by_place(placed: list[tuple[int, int, int, int, int]], lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
    """The same pieces, their sequences numbered by the places of their documents."""
    begin = np.cumsum([0, *lengths])
    middle: dict[int, float] = {}
    used: dict[int, int] = {}
    held: dict[int, set[int]] = {}
    for d, start, n, k, _ in placed:
        middle[k] = middle.get(k, 0.0) + float(begin[d] + start + n / 2) * n
        used[k] = used.get(k, 0) + n
        held.setdefault(k, set()).add(d)
    middle = {k: m / used[k] for k, m in middle.items()}
    several = sorted((k for k in middle if len(held[k]) > 1), key=lambda k: (middle[k], k))
    middle |= {k: (i + 0.5) / len(several) * float(begin[-1]) for i, k in enumerate(several)}
    number = {k: i for i, k in enumerate(sorted(middle, key=lambda k: (middle[k], k)))}
    return [(d, start, n, number[k], offset) for d, start, n, k, offset in placed]


def packed_batches(
    vocabulary: str, ranks: str, capacity: int, block_tokens: int, linear: float, quadratic: float, in_order: bool = False
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary, ranks)
        closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        keys: list = []
        ids: list[bytes] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            lengths = [len(x) // 4 for x in ids]
            placed = assign(lengths, capacity, linear, quadratic)
            if in_order:
                placed = by_place(placed, lengths)
            columns = [
                pa.array([keys[d] for d, *_ in placed], pa.int64()),
                pa.array([s for _, s, *_ in placed], pa.int64()),
                pa.array([n for _, _, n, *_ in placed], pa.int64()),
                pa.array([ids[d][4 * s : 4 * (s + n)] for d, s, n, *_ in placed], pa.binary()),
                pa.array([len(ids[d]) // 4 for d, *_ in placed], pa.int64()),
                pa.array([sequence + k for *_, k, _ in placed], pa.int64()),
                pa.array([o for *_, o in placed], pa.int64()),
            ]
            sequence += 1 + max(k for *_, k, _ in placed)
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                ids.append(encoder.ids(text.as_py() or "") + closing)
                tokens += len(ids[-1]) // 4
                if tokens >= block_tokens:
                    yield flush()
                    keys, ids, tokens = [], [], 0
        if ids:
            yield flush()

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    capacity: int = CAPACITY,
    block_tokens: int = BLOCK_TOKENS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    in_order: bool = False,
) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit), sequence and place in it."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = packed_batches(vocabulary, ranks, capacity, block_tokens, linear, quadratic, in_order)
    return narrow.mapInArrow(run, SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(*columns)
