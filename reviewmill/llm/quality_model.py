"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Inputs of a text: counts of lower-cased words in ``BUCKETS`` hashed buckets, scaled to length one, and
``DENSE`` numbers on its structure (lengths, shares of symbols, capitals, digits, distinct words and lines, ...),
standardised on the learning rows.  The score is logistic of bias, linear terms and all pairwise interactions
of ``RANK``-dimensional factors, by the sum-of-squares identity, so in time linear in the words.

It learns from ``fit_rows`` labelled documents at most (8,000, evenly by hash of doc_id); their bucket counts - at most
``BUCKETS`` a document - are trained on the driver, by AdaGrad.

Nulls and edges: a null text is empty, and an empty text is scored by its structure like any other; labels that are null are not
learnt from; without rows of both labels every score is the mean label (0.5 without any); an empty table gives no rows.  Only ``doc_id`` and ``text``
are read; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.arrays import lower_ascii, slices, span_hashes, words_of
from reviewmill.llm.learning import bounded, held_out

FIT_ROWS = 8_000
BUCKETS = 1 << 13
RANK = 4
EPOCHS = 12
RATE = 0.1
DECAY = 1e-5
LINE = 10


class Machine(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray


class Inputs(NamedTuple):
    """Sparse buckets by row, and the dense numbers."""

    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    dense: np.ndarray


CLASSES = {
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "symbol": [ord(c) for c in "#*$%&|<>"],
    "point": [ord(c) for c in ".,;:"],
    "cry": [ord(c) for c in "!?"],
    "blank": [0x20, *range(0x09, 0x0E)],
    "rest": range(0x80, 0x100),
}


def inputs(texts: pa.Array) -> Inputs:
    n = len(texts)
    words = words_of(lower_ascii(texts))
    original, offsets = words_of(texts).data, words.offsets
    cells, counts = np.unique(words.doc * BUCKETS + (words.hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    row = cells // BUCKETS
    norm = np.sqrt(np.bincount(row, weights=counts.astype(float) ** 2, minlength=n))
    value = counts / norm[row]

    size = np.diff(offsets).astype(float)
    shares = []
    for members in CLASSES.values():
        table = np.zeros(256, dtype=bool)
        table[list(members)] = True
        sums = np.concatenate([[0], np.cumsum(table[original])])
        shares.append((sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1))
    n_words = np.bincount(words.doc, minlength=n).astype(float)
    distinct = np.bincount(row, minlength=n)
    ends = np.union1d(np.flatnonzero(original == LINE), offsets[1:] - 1)
    ends = ends[ends >= 0]
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else ends
    line_doc = np.searchsorted(offsets, starts, side="right") - 1
    hashes = span_hashes(original, starts, np.where(original[ends] == LINE, ends, ends + 1)) if len(ends) else np.empty(0, np.uint64)
    n_lines = np.bincount(line_doc, minlength=n).astype(float)
    order = np.lexsort((hashes, line_doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_doc[order][1:] != line_doc[order][:-1])
    n_distinct = np.bincount(line_doc[order][new], minlength=n)
    dense = np.stack(
        [
            *shares, np.log1p(size), np.log1p(n_words), size / np.maximum(n_words, 1), distinct / np.maximum(n_words, 1),
            np.log1p(n_lines), n_distinct / np.maximum(n_lines, 1), np.log1p(size / np.maximum(n_lines, 1)),
        ],
        axis=1,
    )
    return Inputs(row, (cells % BUCKETS).astype(np.int64), value, dense)


DENSE = len(CLASSES) + 7


def scores(m: Machine, x: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores before the logistic, the factor sums, and the dense inputs standardised."""
    n = len(x.dense)
    dense = np.clip((x.dense - m.mean) / m.scale, -3, 3)
    w, v = m.linear[x.bucket], m.factors[x.bucket]
    wd, vd = m.linear[BUCKETS:], m.factors[BUCKETS:]
    weighted = v * x.value[:, None]
    # Sums by row of contributions that lie in row order.
    edges = np.searchsorted(x.row, np.arange(n + 1))

    def by_row(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)])
        return sums[edges[1:]] - sums[edges[:-1]]

    parts = by_row(np.column_stack([w * x.value, weighted, weighted**2]))
    rank = m.factors.shape[1]
    total = parts[:, 1 : 1 + rank] + dense @ vd
    squares = parts[:, 1 + rank :] + dense**2 @ vd**2
    return m.bias + parts[:, 0] + dense @ wd + 0.5 * (total**2 - squares).sum(axis=1), total, dense


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: Inputs, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Machine:
    rnd = np.random.default_rng(seed)
    n = len(labels)
    mean, scale = x.dense.mean(axis=0) if n else np.zeros(DENSE), x.dense.std(axis=0) + 1e-6 if n else np.ones(DENSE)
    share = min(max(labels.mean() if n else 0.5, 0.001), 0.999)
    bias = float(np.log(share / (1 - share)))
    linear, factors = np.zeros(BUCKETS + DENSE), rnd.normal(0, 0.02, (BUCKETS + DENSE, RANK))
    if n == 0 or labels.min() == labels.max():
        return Machine(mean, scale, bias, linear, np.zeros_like(factors))
    seen_w, seen_v, seen_b = np.full(len(linear), 1e-3), np.full(factors.shape, 1e-3), 1e-3
    edges = np.searchsorted(x.row, np.arange(n + 1))
    for _ in range(epochs):
        for rows in np.array_split(rnd.permutation(n), max(1, n // 128)):
            picks = np.concatenate([np.arange(edges[r], edges[r + 1]) for r in rows])
            local = np.repeat(np.arange(len(rows)), edges[rows + 1] - edges[rows])
            part = Inputs(local, x.bucket[picks], x.value[picks], x.dense[rows])
            z, total, dense = scores(Machine(mean, scale, bias, linear, factors), part)
            g = (logistic(z) - labels[rows]) / len(rows)
            gw, gv = DECAY * linear, DECAY * factors
            np.add.at(gw, part.bucket, g[local] * part.value)
            own = part.value[:, None]
            np.add.at(gv, part.bucket, g[local, None] * own * (total[local] - factors[part.bucket] * own))
            gw[BUCKETS:] += dense.T @ g
            gv[BUCKETS:] += dense.T @ (g[:, None] * total) - factors[BUCKETS:] * (dense**2).T.dot(g)[:, None]
            seen_w += gw**2
            seen_v += gv**2
            seen_b += g.sum() ** 2
            linear -= rate * gw / np.sqrt(seen_w)
            factors -= 0.5 * rate * gv / np.sqrt(seen_v)
            bias -= rate * g.sum() / np.sqrt(seen_b)
    return Machine(mean, scale, float(bias), linear, factors)


def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x = inputs(batch.column(0))
        edges = np.searchsorted(x.row, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(1),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(x.bucket.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(x.value.astype(np.float32))),
                pa.array(x.dense.tolist(), pa.list_(pa.float64())),
            ],
            names=["label", "bucket", "value", "dense"],
        )


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    """``labels`` has doc_id and label (0 or 1)."""
    known = bounded(labels.filter("label IS NOT NULL"), fit_rows)
    # A bounded number of rows, so small beside the documents.
    rows = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id", "label")), "doc_id")
    schema = "label int, bucket array<int>, value array<float>, dense array<double>"
    found = rows.select(F.col("text").cast("string"), F.col("label").cast("int")).mapInArrow(featured, schema).toArrow()
    bucket = found.column("bucket").combine_chunks()
    counts = np.array([len(b) for b in bucket], dtype=np.int64)
    x = Inputs(
        np.repeat(np.arange(len(counts)), counts),
        bucket.flatten().to_numpy().astype(np.int64),
        found.column("value").combine_chunks().flatten().to_numpy().astype(float),
        np.array(found.column("dense").to_pylist(), dtype=float).reshape(-1, DENSE),
    )
    return train(x, found.column("label").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = logistic(scores(machine, inputs(batch.column(1)))[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def held_out_query(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = 0.3) -> DataFrame:
    out = held_out(5, 0)
    learn = labels.filter(~out).select("doc_id", F.col("quality").cast("int").alias("label"))
    machine = fit(docs, learn, fit_rows)
    return score(docs, machine, threshold).select("doc_id", out.alias("held_out"), "score", "predicted")
