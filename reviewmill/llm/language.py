"""Language identification with bit-sliced Bloom filters.

An n-gram is three code points of the lower-cased text with a letter in the middle; others than letters
count as blank.  Learning counts, per language, the documents with each n-gram; a language holds an n-gram
that at least ``MIN_DOCS`` of its documents have, at no less than ``SHARE`` of the highest rate among
languages (mixed documents would otherwise put every n-gram everywhere).  The filters of all languages share
their hash functions and lie bit-sliced in one table of 64-bit masks, so ``PROBES`` look-ups and one AND give
all languages that hold an n-gram.  Per-language popcounts over a text, corrected by each filter's false-positive
rate, decide; the score is the winner's share of all corrected counts, the coverage its corrected count as a share of
all n-grams of the text (low for languages not learnt and for gibberish, whoever wins).

Learning takes ``fit_rows`` documents (20,000, evenly by hash of doc_id), with a known language and not held out; of a language
that would have fewer than its part of ``fit_rows`` among 64 languages it takes as many (or all it has), so that rare
languages are learnt at every size: below 2 * ``fit_rows`` in all.  Each 64 languages have a mask of their own in every slot.

Nulls and edges: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learnt; of equal
counts the language first by name wins; an empty table gives no rows; texts of any length are read whole, in slices.
Only ``doc_id``, ``text`` and (to learn) ``lang`` are read; ``keep`` carries other columns along.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm.arrays import buffer_of, mixed, slices
from reviewmill.llm.learning import bounded_each, held_out

FIT_ROWS = 20_000
MIN_DOCS = 2
SHARE = 0.3
PROBES = 3
SLOTS_PER_GRAM = 16
LEAST_PARTS = 64
UNKNOWN = "und"
_letters: list[np.ndarray] = []


class Filters(NamedTuple):
    languages: list[str]
    masks: np.ndarray  # one mask of languages for each slot; a row of them for each 64 languages
    wrong: np.ndarray  # false-positive rate of each language


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of a slice and their documents."""
    texts = pc.utf8_lower(texts)
    data, _ = buffer_of(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    points = np.where(letters()[points], points, 0)
    # A blank before each document and one at the very end part them.
    padded = np.append(np.insert(points, ends - sizes, 0), 0).astype(np.uint64)
    doc = np.append(np.repeat(np.arange(len(sizes)), sizes + 1), len(sizes))
    middle = np.flatnonzero(padded[1:-1]) + 1
    keys = (padded[middle - 1] << np.uint64(42)) | (padded[middle] << np.uint64(21)) | padded[middle + 1]
    return keys, doc[middle]


def slots(keys: np.ndarray, size: int) -> list[np.ndarray]:
    return [(mixed(keys + np.uint64(k * 0x632BE59BD9B4E019 % (1 << 64))) % np.uint64(size)).astype(np.int64) for k in range(PROBES)]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        names, lang = np.unique(np.array(batch.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
        keys, doc = grams(batch.column(0))
        distinct, place = np.unique(keys, return_inverse=True)
        pairs = np.unique(doc * len(distinct) + place)  # each n-gram once for each document
        cells, n = np.unique((pairs % max(len(distinct), 1)) * len(names) + lang[pairs // max(len(distinct), 1)], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(distinct[cells // len(names)].astype(np.int64)), pa.array(names[cells % len(names)].tolist(), pa.string()), pa.array(n)],
            names=["key", "lang", "n"],
        )


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Filters:
    known = bounded_each(docs.filter("lang IS NOT NULL"), "lang", fit_rows, fit_rows // LEAST_PARTS)
    totals = known.groupBy("lang").count()
    found = known.select("text", "lang").mapInArrow(counted, "key long, lang string, n long")
    rates = found.groupBy("key", "lang").agg(F.sum("n").alias("n")).join(F.broadcast(totals), "lang")
    rates = rates.withColumn("rate", F.col("n") / F.col("count"))
    best = F.max("rate").over(Window.partitionBy("key"))
    kept = rates.withColumn("best", best).filter((F.col("n") >= MIN_DOCS) & (F.col("rate") >= SHARE * F.col("best")))
    # The n-grams of a bounded number of documents.
    rows = kept.select("key", "lang").toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    keys = rows.column("key").to_numpy().astype(np.uint64)
    number = {name: i for i, name in enumerate(languages)}
    lang = np.array([number[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    size = max(64, SLOTS_PER_GRAM * len(set(keys.tolist())))
    masks = np.zeros((max(1, -(-len(languages) // 64)), size), dtype=np.uint64)
    for place in slots(keys, size):
        np.bitwise_or.at(masks, (lang // 64, place), np.uint64(1) << (lang % 64).astype(np.uint64))
    fill = [((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))]
    return Filters(languages, masks, np.array(fill) ** PROBES)


def weighed(filters: Filters, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and coverage of each text."""
    keys, doc = grams(texts)
    n = len(texts)
    total = np.bincount(doc, minlength=n).astype(float)
    if not filters.languages:
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n)
    masks = np.atleast_2d(filters.masks)
    places = slots(keys, masks.shape[1])
    counts = np.empty((n, len(filters.languages)))
    for row, mask in enumerate(masks):
        held = np.full(len(keys), np.iinfo(np.uint64).max, dtype=np.uint64)
        for place in places:
            held &= mask[place]
        for i in range(64 * row, min(64 * row + 64, len(filters.languages))):
            found = ((held >> np.uint64(i % 64)) & np.uint64(1)).astype(float)
            counts[:, i] = np.bincount(doc, weights=found, minlength=n)
    corrected = np.maximum((counts - total[:, None] * filters.wrong) / np.maximum(1 - filters.wrong, 1e-9), 0)
    best = corrected.argmax(axis=1)
    won = corrected[np.arange(n), best]
    whole = corrected.sum(axis=1)
    score = np.where(whole > 0, won / np.maximum(whole, 1e-9), 0.0)
    language = [filters.languages[b] if t else UNKNOWN for b, t in zip(best, total)]
    score = np.where(total > 0, np.minimum(score, 1.0), 0.0)
    return language, score, np.minimum(won / np.maximum(total, 1), 1.0)


def decided(filters: Filters, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    return weighed(filters, texts)[:2]


def identify(
    docs: DataFrame,
    filters: Filters,
    keep: list[str] | None = None,
    names: tuple[str, ...] = ("lang_pred", "score"),
    text: str | Column = "text",
) -> DataFrame:
    """The ``keep`` columns (doc_id alone by default) with predicted language and score, and coverage if a third name is given.

    Only the text is sent to Python and only the verdict comes back; the columns kept stay where they are.
    """
    keep = ["doc_id"] if keep is None else keep
    name = "_found"
    while name in keep:
        name += "_"
    schema = T.StructType().add(names[0], "string")
    for number in names[1:]:
        schema = schema.add(number, "double")

    def run(texts: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([texts], names=["text"])
        found = [weighed(filters, part.column(0)) for part in slices([whole])]
        columns = [pa.array([x for language, *_ in found for x in language], pa.string())]
        for k in range(1, len(names)):
            columns.append(pa.array(np.concatenate([np.empty(0), *[part[k] for part in found]]), pa.float64()))
        return pa.StructArray.from_arrays(columns, names=list(names))

    text = F.col(text) if isinstance(text, str) else text
    # Not to be repeated in a filter of its results.
    verdict = F.arrow_udf(run, schema).asNondeterministic()(text.cast("string"))
    rows = docs.select(*keep, verdict.alias(name))
    return rows.select(*keep, *[F.col(name)[c].alias(c) for c in names])


def held_out_query(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    out = held_out(3, 1)
    filters = fit(docs.filter(~out), fit_rows)
    return identify(docs, filters).select("doc_id", out.alias("held_out"), "lang_pred", "score")
