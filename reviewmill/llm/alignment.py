"""Alignment of two tokenizers' tokens of the same text.

A is a byte-level vocabulary of the ``tokenizers`` library, B a sentencepiece model; both read a blank and the text (B adds the
blank itself).  Character offsets of A's tokens and spans of B's pieces (counted in bytes of whole characters) give the *coarse cuts*: characters
that end tokens of both.  Where a stretch between them has characters of several bytes or byte pieces, offsets say too
little (a token may end inside a character): there the decoded bytes of the tokens are counted, a coarse cut stays only
if both reach its byte, and further cuts inside are found.  Between two cuts lies a *group* of A's and of B's tokens.

No token of either reaches over certain *borders*: before a blank between two characters that are no white space; around a line
feed between such, and between a letter and a closing mark, if no piece of B has the two together (A's words never do).  Texts are
aligned part by part between borders, and the groups of short parts are kept (``PARTS`` of them; with the next ones begun, those used again stay); longer
parts are aligned each time.

A link is a token of A and one of B that end at the same byte.  Then the bytes of the shorter are the end of those of
the longer, so the number of different links is bounded by the vocabularies alone (each token has fewer ends than bytes):
``most_links`` gives the bound, and the table of their counts is sent to the tasks within it.

Nulls and edges: a text that is null, empty, or whose joined bytes of A or B differ from blank and text (B may lose or change
characters) has no tokens, all zeros and an empty ``groups``; equal rows and null doc_ids are aligned one by one; an empty
table gives no rows.  Only ``doc_id`` and ``text`` are read, whole and in slices.  (The library gave up the name ``immutable_proto``;
its spans come from ``proto``.)
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.arrays import slices
from reviewmill.session import Scratch, stage

PARTS = 200_000
PART_LENGTH = 48  # characters of a part whose groups are kept
BLANK = "▁"
MARKS = ",.;:!?"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<long>, times array<int>"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and kept answers."""

    loaded: dict[tuple[str, str], "Pair"] = {}

    def __init__(self, vocabulary: str, model: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        letters = byte_letters()
        names = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            # A name with other letters is no token of bytes; no text gives it.
            self.a_bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else b""
        numbers = range(self.b.get_piece_size())
        pieces = self.b.id_to_piece(list(numbers))
        self.b_bytes = [
            bytes([int(name[1:-1], 16)]) if self.b.is_byte(i) else name.replace(BLANK, " ").encode()
            for i, name in zip(numbers, pieces)
        ]
        names = [n for i, n in zip(numbers, pieces) if not self.b.is_byte(i)]
        if any("\n" in n for n in names):
            raise ValueError("pieces with line feeds are not cut right")
        inside = {n[i : i + 2] for n in names for i in range(len(n) - 1)}
        marks = "".join(m for m in MARKS if not any(x[1] == m and x[0].isalpha() for x in inside))
        solid = rf"[^\s{BLANK}]"
        self.border = re.compile(
            rf"(?<={solid})(?= {solid})|(?<={solid})(?=\n{solid})|(?<={solid}\n)(?={solid})"
            + (rf"|(?<=[{LETTERS}])(?=[{marks}][ \n])" if marks else "")
        )
        self.a_text, self.b_text = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in numbers]
        self.kept: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    @classmethod
    def of(cls, vocabulary: str, model: str) -> "Pair":
        if (vocabulary, model) not in cls.loaded:
            cls.loaded[vocabulary, model] = cls(vocabulary, model)
        return cls.loaded[vocabulary, model]

    def most_links(self) -> int:
        return sum(map(len, self.a_bytes)) + sum(map(len, self.b_bytes))

    def spans(self, parts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of B's pieces of each part, and the bytes of it at which they end.

        A line feed is no part of any piece, so parts between line feeds are read together as they are alone.
        """
        pieces = iter(self.b.encode("\n" + "\n".join(parts), return_type="proto").pieces)
        next(pieces)  # the blank that B adds
        found = []
        next(pieces)  # the first line feed
        at = 0
        for part in parts:
            at += 1  # the line feed before
            stop = at + len(part.encode())
            ids, ends = [], []
            for piece in pieces:
                end = piece.end
                if end > stop:  # the next line feed
                    break
                ids.append(piece.id)
                ends.append(end - at)
            found.append((ids, ends))
            at = stop
        return found

    def part(self, text: str, a: object, b_ids: list[int], b_ends: list[int]) -> tuple | None:
        """(ids of A, ids of B, number of groups, groups as text, links) of a part; None if bytes differ."""
        raw = text.encode()
        a_ids = a.ids
        a_bytes, b_bytes = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b_ids]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return None
        a_ends = [end for _, end in a.offsets]
        if len(raw) == len(text):
            cuts = met(a_ends, b_ends)
        else:
            place = [0, *accumulate(len(c.encode()) for c in text)]  # byte at which each character begins
            character = {byte: i for i, byte in enumerate(place)}
            cuts = self.refined(place, a_ends, [character[e] for e in b_ends], a_bytes, b_bytes)
        groups, links = [], []
        a_text, b_text = self.a_text, self.b_text
        i = j = 0
        for x, y in cuts:
            groups.append(",".join([a_text[k] for k in a_ids[i : x + 1]]) + "|" + ",".join([b_text[k] for k in b_ids[j : y + 1]]))
            links.append(a_ids[x] << 32 | b_ids[y])
            i, j = x + 1, y + 1
        return len(a_ids), len(b_ids), len(cuts), ";".join(groups), array("q", links).tobytes()

    @staticmethod
    def refined(place: list, a_chars: list, b_chars: list, a_bytes: list, b_bytes: list) -> list[tuple[int, int]]:
        """Cuts as (token of A, token of B), with stretches of longer characters measured in bytes."""
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        # Of several tokens that end at a character, the last one can end where it ends.
        a_at, b_at = {e: i for i, e in enumerate(a_chars)}, {e: i for i, e in enumerate(b_chars)}
        cuts: list[tuple[int, int]] = []
        i = j = start = 0  # tokens and characters before the last cut
        for e in sorted(a_at.keys() & b_at.keys()):
            x, y = a_at[e], b_at[e]
            if not a_ends[x] == b_ends[y] == place[e]:
                continue  # a token ends inside the character
            if place[e] - place[start] > e - start:
                cuts += [(i + k, j + m) for k, m in met(a_ends[i:x], b_ends[j:y])]
            cuts.append((x, y))
            i, j, start = x + 1, y + 1, e
        return cuts

    def aligned(self, text: str) -> tuple | None:
        """(tokens of A, of B, groups, groups as text, link keys) of a text; None if it has no tokens."""
        if not text:
            return None
        parts = self.border.split(" " + text)
        kept, found = self.kept, []
        missing = [p for p in dict.fromkeys(parts) if p not in kept]
        if missing:
            found = [p for p in missing if p not in self.older]
            kept.update((p, self.older[p]) for p in missing if p in self.older)
            if found:
                encoded = self.a.encode_batch(found, add_special_tokens=False)
                kept.update((p, self.part(p, a, *b)) for p, a, b in zip(found, encoded, self.spans(found)))
        rows = [kept[p] for p in parts]
        for p in found:
            if len(p) > PART_LENGTH:
                del kept[p]
        if len(kept) >= PARTS:
            self.older, self.kept = kept, {}
        if None in rows:
            return None
        n_a, n_b, n_groups, written, links = zip(*rows)
        return sum(n_a), sum(n_b), sum(n_groups), ";".join(written), np.frombuffer(b"".join(links), dtype=np.int64)


def met(first: list[int], second: list[int]) -> list[tuple[int, int]]:
    """Places (in the first, in the second) of equal values of two rising lists."""
    found = []
    i = j = 0
    while i < len(first) and j < len(second):
        if first[i] == second[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif first[i] < second[j]:
            i += 1
        else:
            j += 1
    return found


def aligned(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Per document: numbers of tokens, groups and links, the groups as ``a1,a2|b1;a3|b2,b3``, its distinct links and their times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair.of(vocabulary, model)
        for batch in slices(batches):
            numbers, groups, links, times = [], [], [], []
            for text in batch.column(1).to_pylist():
                *counts, written, every = pair.aligned(text) or (0, 0, 0, "", np.empty(0, dtype=np.int64))
                keys, n = np.unique(every, return_counts=True)
                numbers.append((*counts, len(every)))
                groups.append(written)
                links.append(keys)
                times.append(n.astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in links])]).astype(np.int32))
            columns = [
                batch.column(0),
                *(pa.array(c) for c in np.array(numbers, dtype=np.int64).reshape(-1, 4).T.copy()),
                pa.array(groups, pa.large_string()).cast(pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(links))),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ALIGNED)


def link_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n): how often each two ids are linked in all documents."""
    each = rows.select(F.inline(F.arrays_zip("links", "times")))
    counts = each.groupBy("links").agg(F.sum("times").alias("n"))
    return counts.select(F.shiftright("links", 32).alias("a"), F.col("links").bitwiseAND(0xFFFFFFFF).alias("b"), "n")


def weighed(rows: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """``rows`` of :func:`aligned` with n_best (links whose count is their B id's highest) and count_sum instead of the links.

    ``most`` bounds the rows of ``counts``, which are sent to the tasks.
    """
    table = counts.toArrow()
    if table.num_rows > most:
        raise ValueError("more links than two vocabularies can have")
    a, b, n = (table.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    highest = np.zeros(int(b.max(initial=0)) + 1, dtype=np.int64)
    np.maximum.at(highest, b, n)
    sent = rows.sparkSession.sparkContext.broadcast((a << 32 | b, n, n == highest[b]))
    kept = [c for c in rows.columns if c not in ("links", "times")]
    schema = rows.select(*kept).schema.add("n_best", "long").add("count_sum", "long")
    links, times = rows.columns.index("links"), rows.columns.index("times")
    places = [rows.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = sent.value
        for batch in batches:
            lengths = batch.column(links).value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            at = np.searchsorted(keys, batch.column(links).flatten().to_numpy())
            often = batch.column(times).flatten().to_numpy().astype(np.int64)
            sums = np.zeros((2, batch.num_rows), dtype=np.int64)
            np.add.at(sums[0], row, often * best[at])
            np.add.at(sums[1], row, often * n[at])
            yield pa.RecordBatch.from_arrays([*(batch.column(p) for p in places), pa.array(sums[0]), pa.array(sums[1])], names=schema.names)

    return rows.mapInArrow(run, schema)


def query(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    with Scratch(docs.sparkSession) as scratch:
        rows = aligned(docs, vocabulary, model).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "links", "times"
        )
        rows = scratch.stage(rows, "aligned")
        found = weighed(rows, link_counts(rows), Pair.of(vocabulary, model).most_links())
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return stage(found.select(*names), "alignment")
