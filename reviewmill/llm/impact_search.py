"""Ranked lexical search over impact lists by best positions.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are lower-cased.  A term's *impact* in a
document depends on its occurrences and the document's length, a document's score is the weighted sum of the impacts of
the query's terms (all in 64-bit integers, so equal scores are equal).

1. One pass over the texts keeps of each document its length and the occurrences of the terms that queries have; numbers of
   documents, all terms and documents with a term come from that copy.
2. Every task takes its documents in chunks.  For each term a chunk has an *impact list*, highest first, and a table of
   the documents' places in it, which gives a document's impact and place directly.
3. A query reads its terms' lists from the top, a stretch of each in turn.  A document met for the first time is scored by direct access to all lists,
   which also marks its places there as seen.  A list's *best position* is the end of the seen places
   without a gap, however they were seen; the weighted impacts at the best positions bound every document not yet met.
   Reading stops when that bound is strictly below the k-th score, so that no tie is lost; a list seen to its
   end bounds nothing.  The k-th score is carried from chunk to chunk.
4. The tasks' k best of each query are ranked by score, then doc_id.

Queries go to the tasks in blocks of about ``BLOCK_BYTES`` of their text (a query is not divided), each with a pass of its
own, so what is sent is bounded however many there are.  A chunk's place table has at most ``TABLE_CELLS`` cells.  Terms
are told apart by 64-bit hashes.

Nulls and edges: a null text has no terms; a query without terms, or whose terms no document has, gives no rows; documents without a
doc_id count in the statistics but cannot be returned; equal documents rank one by one, equal queries are answered
each; empty tables give no rows.  Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read, texts whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.arrays import lower_ascii, slices, words_of
from reviewmill.session import Scratch, stage

TOP = 10
BLOCK_BYTES = 1 << 18
TABLE_CELLS = 1 << 24
STRETCH = 16  # places of each list in the first round; doubled from round to round
POSTINGS = "doc_id long, n long, terms array<int>, times array<int>"
FOUND = "query int, doc_id long, score long"
GAPS = np.zeros(256, dtype=bool)
GAPS[:0x80] = True
GAPS[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = False


class Queries(NamedTuple):
    """A block of queries: their terms' hashes, sorted, and each query's terms as places among them."""

    items: list
    hashes: np.ndarray
    terms: list[np.ndarray]


class Statistics(NamedTuple):
    documents: int
    occurrences: int
    weights: np.ndarray  # of the block's terms


def texts_array(texts: list) -> pa.Array:
    return pa.array(["" if t is None else t for t in texts], pa.large_string())


def block_of(items: list, texts: list) -> Queries:
    words = words_of(lower_ascii(texts_array(texts)), GAPS)
    hashes, place = np.unique(words.hashes, return_inverse=True)
    return Queries(items, hashes, [np.unique(place[words.doc == i]) for i in range(len(items))])


def counted(hashes: np.ndarray):
    """Batches of (doc_id, text) as postings over the terms with these hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(lower_ascii(batch.column(1)), GAPS)
            n = batch.num_rows
            size = max(len(hashes), 1)
            at = np.searchsorted(hashes, words.hashes)
            hit = np.zeros(len(at), dtype=bool)
            inside = at < len(hashes)
            hit[inside] = hashes[at[inside]] == words.hashes[inside]
            cells, times = np.unique(words.doc[hit] * size + at[hit], return_counts=True)
            doc = cells // size
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32))
            columns = [
                batch.column(0),
                pa.array(np.bincount(words.doc, minlength=n).astype(np.int64)),
                pa.ListArray.from_arrays(offsets, pa.array((cells % size).astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return run


def statistics(postings: DataFrame, n_terms: int) -> Statistics:
    """Counts over all documents; on the driver there is one number for each of the block's terms."""
    whole = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("occurrences")).first()
    rows = postings.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    held = np.zeros(n_terms, dtype=np.int64)
    held[rows.column("term").to_numpy()] = rows.column("count").to_numpy()
    top = 2 * whole.documents + 2
    weights = [math.floor(1000 * math.log(top / (2 * int(df) + 1))) for df in held]
    return Statistics(whole.documents, whole.occurrences or 0, np.array(weights, dtype=np.int64))


class Chunk:
    """Impact lists of some documents, and the places of the documents in them."""

    def __init__(self, doc_ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc_ids, self.doc, self.impact = doc_ids, doc[order], impact[order]
        term = term[order]
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        self.place = np.full((n_terms, len(doc_ids)), -1, dtype=np.int32)
        self.place[term, self.doc] = np.arange(len(term)) - self.start[term]
        self.stretch = STRETCH

    def best(self, terms: np.ndarray, weights: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
        """``scores`` and ``ids`` of the k best so far, with this chunk's documents."""
        terms = terms[(self.start[terms + 1] > self.start[terms]) & (weights[terms] > 0)]
        weight = weights[terms]
        first, size = self.start[terms], self.start[terms + 1] - self.start[terms]
        bound = int((weight * self.impact[first]).sum()) if len(terms) else 0
        met = np.zeros(len(self.doc_ids), dtype=bool)
        base = np.cumsum(size) - size
        seen = np.zeros(int(size.sum()), dtype=bool)
        position = np.zeros(len(terms), dtype=np.int64)  # best positions: places seen without a gap
        depth, stretch = 0, self.stretch
        while bound > 0 and (len(scores) < k or bound >= scores[-1]):
            read = [self.doc[f + depth : f + min(depth + stretch, s)] for f, s in zip(first, size)]
            docs = np.unique(np.concatenate(read))
            docs = docs[~met[docs]]
            met[docs] = True
            place = self.place[terms[:, None], docs[None, :]]
            held = place >= 0
            seen[(base[:, None] + place)[held]] = True
            local = np.where(held, self.impact[np.where(held, first[:, None] + place, 0)], 0)
            total = (weight[:, None] * local).sum(axis=0)
            if len(scores) >= k:
                docs, total = docs[total >= scores[-1]], total[total >= scores[-1]]
            scores, ids = merged(scores, ids, total, self.doc_ids[docs], k)
            depth, stretch = depth + stretch, stretch * 2
            bound = 0
            for i, (b, s) in enumerate(zip(base, size)):
                p = int(position[i])
                if p < s:
                    rest = seen[b + p : b + s]
                    gap = int(rest.argmin())
                    p = p + gap if not rest[gap] else int(s)
                    position[i] = p
                if p < s:
                    bound += int(weight[i] * self.impact[first[i] + p - 1])
        return scores, ids


def merged(scores: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray, k: int):
    """The k best of both, highest first, equal scores by rising id."""
    scores, ids = np.concatenate([scores, more]), np.concatenate([ids, more_ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def chunks(batches: Iterator[pa.RecordBatch], stats: Statistics, n_terms: int) -> Iterator[Chunk]:
    """Postings as chunks of at most ``TABLE_CELLS // n_terms`` documents."""
    limit = max(1, TABLE_CELLS // max(n_terms, 1))
    kept: list[tuple] = []
    held = 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, limit - held)
            lengths = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
            doc = held + np.repeat(np.arange(part.num_rows), lengths)
            term, times = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy().astype(np.int64)
            n = np.repeat(part.column(1).to_numpy(), lengths)
            m = 10 + 90 * n * stats.documents // max(stats.occurrences, 1)
            kept.append((part.column(0).to_numpy(), doc, term, 1_000_000_000 * times // (1000 * times + 8 * m)))
            held += part.num_rows
            start += part.num_rows
            if held == limit:
                yield Chunk(*map(np.concatenate, zip(*kept)), n_terms)
                kept, held = [], 0
    if kept:
        yield Chunk(*map(np.concatenate, zip(*kept)), n_terms)


def searched(queries: Queries, stats: Statistics, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, dtype=np.int64)
        found = [(none, none)] * len(queries.items)
        for chunk in chunks(batches, stats, len(queries.hashes)):
            for i, terms in enumerate(queries.terms):
                found[i] = chunk.best(terms, stats.weights, *found[i], k)
        number = np.repeat(np.arange(len(found)), [len(s) for s, _ in found]).astype(np.int32)
        columns = [number, np.concatenate([none, *(i for _, i in found)]), np.concatenate([none, *(s for s, _ in found)])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` highest-scoring documents of each item with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n_blocks, 1)))
    result = spark.createDataFrame([], items.select("item_id").schema).selectExpr(
        "item_id", "0 AS rank", "0L AS doc_id", "0L AS score"
    )
    with Scratch(spark) as scratch:
        for number in range(n_blocks):
            rows = items.filter(block == number).collect()
            queries = block_of([r.item_id for r in rows], [r.text for r in rows])
            postings = scratch.stage(docs.mapInArrow(counted(queries.hashes), POSTINGS), "postings")
            stats = statistics(postings, len(queries.hashes))
            named = postings.filter("doc_id IS NOT NULL AND size(terms) > 0")
            found = named.mapInArrow(searched(queries, stats, k), FOUND)
            place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc_id"))
            ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
            names = spark.createDataFrame(list(enumerate(queries.items)), f"query int, item_id {items.schema['item_id'].dataType.simpleString()}")
            result = result.unionByName(names.join(scratch.stage(ranked, "ranked"), "query").select(*result.columns))
        return stage(result, "searched")


def digest(found: DataFrame) -> DataFrame:
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE = f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
whole AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
m AS (SELECT doc_id, 10 + (90 * n * nn) // ll AS m FROM len, whole),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weight AS (SELECT item_id, term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
           FROM asked JOIN df USING (term), whole),
score AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
          FROM weight JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
placed AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
           FROM score WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= {TOP}"""
