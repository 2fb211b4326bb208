"""Encoding and decoding with a sentencepiece model of merges, by a table over prefixes.

Merging works from the strongest pair to the weakest, so a row of tokens is the encoding of its text exactly when each two
neighbours are the encoding of theirs.  Hence every prefix of a text has one last token: of the tokens that an automaton
finds at the prefix' end, the one that is *compatible* with the last token of the prefix before it.  The table keeps that token for each prefix, from left to
right; ids are then recovered backwards from the end.  Two tokens are compatible if merging their joined characters gives
these two again: no two parts that meet at their border at some moment make a stronger piece than those that the two tokens grow
by next.  Answers are kept (``PAIRS`` at most, then afresh).  Characters outside the model stand alone and fall back to byte pieces.

A piece has no blank behind another character in models that keep words apart, so nothing merges over such a place: texts are
cut there (and at line feeds, if no piece has one), and the ids of short parts are kept (``PARTS`` of them; with the next ones begun, those used again stay).  A model with other pieces is read without cuts.

The model's own normalisation, its added blank and its ``decode`` are the library's.  Models need merge scores and byte pieces.

Nulls and edges: a null text is empty; an empty text has no ids and decodes to an empty text; equal rows and null doc_ids are
coded one by one; an empty table gives no rows.  Only the text column is read, whole and in slices; ``keep`` carries others along.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm.arrays import slices

BLANK = "▁"
PAIRS = 4_000_000
PARTS = 400_000
PART_LENGTH = 48  # characters of a part whose ids are kept


class Pieces:
    """A model's merges, automaton and kept answers."""

    loaded: dict[str, "Pieces"] = {}

    def __init__(self, model: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(self.library.get_piece_size())
        names = self.library.id_to_piece(list(ids))
        self.byte = {int(names[i][1:-1], 16): i for i in ids if self.library.is_byte(i)}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte pieces to fall back to")
        self.halves: dict[str, tuple[str, str]] = {}
        unmerged = (self.library.is_control, self.library.is_unknown, self.library.is_byte, self.library.is_unused)
        # A token is its characters; single characters are tokens, whether the model has them or not.
        self.id = {names[i]: i for i in ids if not any(test(i) for test in unmerged)}
        self.strength = {p: self.library.get_score(i) for p, i in self.id.items()}
        self.tokens = [p for p in self.id if len(p) == 1 or self.merged(p) == [p]]
        singles = {c for p in self.id for c in p} - set(self.tokens)
        self.tokens += sorted(singles)
        self.automaton = ahocorasick.Automaton()
        for number, token in enumerate(self.tokens):
            self.automaton.add_word(token, number)
        self.automaton.make_automaton()
        self.size = [len(t) for t in self.tokens]
        self.tails, self.heads = [self.border(t, 1) for t in self.tokens], [self.border(t, 0) for t in self.tokens]
        self.reversed_ids = [self.ids_of(t)[::-1] for t in self.tokens]
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        apart = all(BLANK not in p[1:] or not p.strip(BLANK) for p in self.id)
        line = "" if any("\n" in p for p in self.id) else "\n"
        self.part = re.compile(f"{BLANK}+[^{BLANK}{line}]*|[^{BLANK}{line}]+|\n+" if apart else "(?s).+")

    @classmethod
    def of(cls, model: str) -> "Pieces":
        if model not in cls.loaded:
            cls.loaded[model] = cls(model)
        return cls.loaded[model]

    def ids_of(self, token: str) -> list[int]:
        found = self.id.get(token)
        return [self.byte[b] for b in token.encode()] if found is None else [found]

    def merged(self, text: str) -> list[str]:
        """Plain merging, for texts of two tokens at most: the strongest pair first, of equal ones the left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                strength = self.strength.get(parts[i] + parts[i + 1])
                if strength is not None and (best is None or strength > best):
                    best, at = strength, i
            if best is None:
                return parts
            if len(parts) == 2:
                self.halves[text] = parts[0], parts[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def border(self, token: str, side: int) -> list[tuple[str, float]] | None:
        """The parts that stand at the token's end (``side`` 1) or beginning (0) while it grows, with the strength of the piece
        that each grows into.  None if a piece is not weaker than what it is made of: then time does not follow strength."""
        found = [(token, -math.inf)]
        while len(token) > 1:
            halves = self.halves[token]
            strength = self.strength[token]
            if any(len(h) > 1 and self.strength[h] <= strength for h in halves):
                return None
            token = halves[side]
            found.append((token, strength))
        return found[::-1]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            found = self.fits[key] = self.fit(left, right)
        return found

    def fit(self, left: int, right: int) -> bool:
        tail, head = self.tails[left], self.heads[right]
        if tail is None or head is None:
            a, b = self.tokens[left], self.tokens[right]
            return a + b not in self.id and self.merged(a + b) == [a, b]
        strength = self.strength
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = tail[i], head[j]
            both = strength.get(x + y)
            # Of equally strong pieces the left one is made first.
            if both is not None and both > x_until and both >= y_until:
                return False
            if x_until == y_until == -math.inf:
                return True
            if x_until >= y_until:
                i += 1
            else:
                j += 1

    def last_tokens(self, part: str) -> list[int]:
        """The last token of each prefix; -1 for a character outside the model, which nothing merges with."""
        last = [-1] * (len(part) + 1)
        size, fits = self.size, self.fits
        found = 0  # the prefix that has its token; longer matches at the same end come first
        for end, token in self.automaton.iter(part):
            if end + 1 != found:
                before = last[end + 1 - size[token]]
                if before >= 0:
                    fit = fits.get(before << 32 | token)
                    if fit is None:
                        fit = self.compatible(before, token)
                    if not fit:
                        continue
                found = end + 1
                last[found] = token
        return last

    def part_ids(self, part: str) -> bytes:
        last = self.last_tokens(part)
        found, end = [], len(part)
        while end:
            token = last[end]
            if token < 0:
                end -= 1
                found += [self.byte[b] for b in reversed(part[end].encode())]
            else:
                end -= self.size[token]
                found += self.reversed_ids[token]
        return array("i", reversed(found)).tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """Ids as 32-bit whole numbers one after the other."""
        known = self.known
        ids = []
        for part in self.part.findall(self.library.normalize(text)) if text else []:
            found = known.get(part)
            if found is None:
                found = self.older.get(part)
                if found is None:
                    found = self.part_ids(part)
                if len(part) <= PART_LENGTH:
                    if len(known) >= PARTS:
                        self.older, self.known = known, {}
                        known = self.known
                    known[part] = found
            ids.append(found)
        return b"".join(ids)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype=np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


def _free(taken: list[str], name: str) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def encoded(
    docs: DataFrame, model: str, keep: list[str] | None = None, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """The ``keep`` columns (doc_id alone by default) and the ids of the text; if a name is given, also what they decode to."""
    keep = ["doc_id"] if keep is None else keep
    name = _free(keep, "read")
    rows = docs.select(F.col(text).cast("string").alias(name), *keep)
    schema = T.StructType(rows.schema.fields[1:]).add(ids, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add(decoded, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in slices(batches, name):
            found = [np.frombuffer(pieces.encode_bytes(t), dtype=np.int32) for t in batch.column(0).to_pylist()]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            columns = [*batch.columns[1:], pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))]
            if decoded:
                columns.append(pa.array([pieces.decode(i.tolist()) for i in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the text that the library's ``decode`` gives for the ids; a null list is empty."""
    name = _free(rows.columns, text)
    schema = T.StructType([*rows.schema.fields]).add(name, "string")
    place = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in batches:
            lists = batch.column(place)
            ends = np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
            values = lists.flatten().to_numpy()
            texts = [pieces.decode(values[a:b].tolist()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
