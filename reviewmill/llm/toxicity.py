"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is cut into all overlapping windows of ``WINDOW`` words, ``STRIDE`` apart (a shorter text is one
window).  A word's input is an embedding of its hash beside the mean embeddings of its hashed byte trigrams and of its
beginnings of 4 to 8 bytes, so the spelling of unknown words counts.  Two gated recurrent layers read a window from either side, attention
pools their states, and a logistic unit scores it.  A text's score is that of its highest window, at every
length.

Learning takes ``fit_rows`` labelled documents at most (4,000, evenly by hash of doc_id) and ``FIT_WINDOWS`` evenly placed
windows of each.  Labels belong to documents, so windows of toxic documents are chosen anew in every round: first
by the log-odds of their words and beginnings, then by the network; clean documents give windows at random and those that the network
holds most toxic.  The network is small and is trained on the driver.

Nulls and edges: a null text is empty, and a text without words has the score of an empty window; null labels are not learnt
from; without rows of both labels all scores are the mean label (0.5 without any); an empty table gives no rows.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.arrays import Words, mixed, slices, span_hashes, words_of
from reviewmill.llm.learning import bounded, held_out

FIT_ROWS = 4_000
FIT_WINDOWS = 24
WINDOW, STRIDE = 24, 12
WORDS, GRAMS, STEMS = 1 << 14, 1 << 12, 1 << 15
WORD_SIZE, GRAM_SIZE, STEM_SIZE, HIDDEN = 8, 6, 6, 8
SIZE = WORD_SIZE + GRAM_SIZE + STEM_SIZE
LENGTHS = (4, 5, 6, 7, 8)
SLICE = 1 << 19
PART = 1 << 14  # words at a time where arrays over their bytes are made
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BATCH, RATE, ROUNDS, EPOCHS = 256, 0.015, 3, 3
Net = dict[str, np.ndarray]


class Vocabulary(NamedTuple):
    """Distinct words of a slice: bucket, buckets of beginnings, and trigram buckets with the word of each."""

    bucket: np.ndarray
    stem: np.ndarray
    gram: np.ndarray
    gram_word: np.ndarray


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    length = ends - starts
    owner = np.repeat(np.arange(len(starts)), length)
    return np.arange(len(owner)) + np.repeat(starts - np.cumsum(length) + length, length), owner


def vocabulary(words: Words) -> tuple[Vocabulary, np.ndarray]:
    """The distinct words, and the number of each word among them."""
    distinct, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
    starts, ends = words.starts[first], words.ends[first]
    data, grams, owners = words.data, [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    for a in range(0, len(distinct), PART):
        begin, end = starts[a : a + PART], ends[a : a + PART]
        at, word = ranges(begin, end)
        left = np.where(at > begin[word], data[np.maximum(at - 1, 0)], 32).astype(np.uint64)
        right = np.where(at + 1 < end[word], data[np.minimum(at + 1, len(data) - 1)], 32).astype(np.uint64)
        key = (left << np.uint64(16)) | (data[at].astype(np.uint64) << np.uint64(8)) | right
        grams.append((mixed(key) % np.uint64(GRAMS)).astype(np.int32))
        owners.append((word + a).astype(np.int32))
    gram, word = np.concatenate(grams), np.concatenate(owners)
    stems = [span_hashes(data, starts, np.minimum(starts + n, ends)) + np.uint64(n) for n in LENGTHS]
    stem = (mixed(np.stack(stems, axis=1)) % np.uint64(STEMS)).astype(np.int32)
    return Vocabulary((distinct % np.uint64(WORDS)).astype(np.int64), stem, gram, word), place


def windows(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words in document order: first word, length and document of every window."""
    counts = np.bincount(doc, minlength=n)
    begin = np.cumsum(counts) - counts
    many = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(n), many)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
    return begin[owner] + offset, np.minimum(counts[owner] - offset, WINDOW), owner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(rnd: np.random.Generator) -> Net:
    size, h = SIZE, HIDDEN

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rnd.normal(0, scale, shape).astype(np.float32)

    net = {"word": normal(WORDS, WORD_SIZE, scale=0.05), "gram": normal(GRAMS, GRAM_SIZE, scale=0.3)}
    net["stem"] = normal(STEMS, STEM_SIZE, scale=0.05)
    for side in "fb":
        net |= {f"in_{side}": normal(size, 3 * h, scale=size**-0.5), f"base_{side}": np.zeros(3 * h, np.float32)}
        net[f"turn_{side}"] = normal(h, 3 * h, scale=h**-0.5)
    net |= {"look": normal(2 * h, 2 * h, scale=0.25), "pay": normal(2 * h, scale=0.25)}
    return net | {"out": normal(2 * h, scale=0.25), "bias": np.zeros(1, np.float32)}


def embedded(net: Net, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of the distinct words, and their numbers of trigrams."""
    edges = np.searchsorted(v.gram_word, np.arange(len(v.bucket) + 1))
    counts = np.maximum(np.diff(edges), 1).astype(np.float32)
    x = np.empty((len(v.bucket), SIZE), np.float32)
    for a in range(0, len(x), PART):
        b = min(a + PART, len(x))
        grams = net["gram"][v.gram[edges[a] : edges[b]]]
        sums = np.concatenate([np.zeros((1, GRAM_SIZE), np.float64), np.cumsum(grams, axis=0, dtype=np.float64)])
        inner = edges[a : b + 1] - edges[a]
        x[a:b, :WORD_SIZE] = net["word"][v.bucket[a:b]]
        x[a:b, WORD_SIZE : WORD_SIZE + GRAM_SIZE] = (sums[inner[1:]] - sums[inner[:-1]]) / counts[a:b, None]
        x[a:b, WORD_SIZE + GRAM_SIZE :] = net["stem"][v.stem[a:b]].mean(axis=1)
    return x, counts


def forward(net: Net, gates: dict[str, np.ndarray], ids: np.ndarray, live: np.ndarray, keep: bool = False):
    """Scores of windows of word numbers ``ids``; with ``keep``, also what the way back needs."""
    b, steps, h = *ids.shape, HIDDEN
    states = np.zeros((b, steps, 2 * h), np.float32)
    kept = {}
    for side, order, part in (("f", range(steps), slice(0, h)), ("b", range(steps - 1, -1, -1), slice(h, 2 * h))):
        state, turn = np.zeros((b, h), np.float32), net[f"turn_{side}"]
        for t in order:
            x, y = gates[side][ids[:, t]], state @ turn
            zr = sigmoid(x[:, : 2 * h] + y[:, : 2 * h])
            z, r, q = zr[:, :h], zr[:, h:], y[:, 2 * h :]
            new = np.tanh(x[:, 2 * h :] + r * q)
            if keep:
                kept[side, t] = (state, z, r, q, new)
            state = (new + z * (state - new)) * live[:, t, None]
            states[:, t, part] = state
    seen = np.tanh(states @ net["look"])
    weight = np.where(live > 0, seen @ net["pay"], -1e9)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True)) * live
    weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
    pooled = np.einsum("bt,bth->bh", weight, states)
    score = sigmoid(pooled @ net["out"] + net["bias"])
    return (score, states, seen, weight, pooled, kept) if keep else score


def gates_of(net: Net, x: np.ndarray) -> dict[str, np.ndarray]:
    return {side: x @ net[f"in_{side}"] + net[f"base_{side}"] for side in "fb"}


def backward(net: Net, v: Vocabulary, ids: np.ndarray, live: np.ndarray, target: np.ndarray) -> Net:
    """Gradients of the mean logistic loss."""
    x, counts = embedded(net, v)
    score, states, seen, weight, pooled, kept = forward(net, gates_of(net, x), ids, live, keep=True)
    h, grad = HIDDEN, {}
    d = ((score - target) / len(target)).astype(np.float32)
    grad["out"], grad["bias"] = pooled.T @ d, d.sum(keepdims=True)
    d_pooled = d[:, None] * net["out"]
    d_states = weight[:, :, None] * d_pooled[:, None, :]
    d_weight = np.einsum("bh,bth->bt", d_pooled, states)
    d_weight = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    grad["pay"] = np.einsum("bt,bth->h", d_weight, seen)
    d_seen = d_weight[:, :, None] * net["pay"] * (1 - seen**2)
    grad["look"] = np.einsum("bti,btj->ij", states, d_seen)
    d_states += d_seen @ net["look"].T
    d_x = np.zeros_like(x)
    for side, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
        order = range(ids.shape[1] - 1, -1, -1) if side == "f" else range(ids.shape[1])
        turn, d_turn = net[f"turn_{side}"], np.zeros_like(net[f"turn_{side}"])
        d_gates = np.zeros((len(x), 3 * h), np.float32)
        carried = np.zeros((len(ids), h), np.float32)
        for t in order:
            state, z, r, q, new = kept[side, t]
            d_state = (d_states[:, t, part] + carried) * live[:, t, None]
            d_new = d_state * (1 - z) * (1 - new**2)
            d_z = d_state * (state - new) * z * (1 - z)
            d_r = d_new * q * r * (1 - r)
            back = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_turn += state.T @ back
            carried = d_state * z + back @ turn.T
            np.add.at(d_gates, ids[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
        grad[f"turn_{side}"], grad[f"in_{side}"], grad[f"base_{side}"] = d_turn, x.T @ d_gates, d_gates.sum(axis=0)
        d_x += d_gates @ net[f"in_{side}"].T
    grad["word"], grad["gram"] = np.zeros_like(net["word"]), np.zeros_like(net["gram"])
    np.add.at(grad["word"], v.bucket, d_x[:, :WORD_SIZE])
    np.add.at(grad["gram"], v.gram, (d_x[:, WORD_SIZE : WORD_SIZE + GRAM_SIZE] / counts[:, None])[v.gram_word])
    grad["stem"] = np.zeros_like(net["stem"])
    d_stem = d_x[:, WORD_SIZE + GRAM_SIZE :] / len(LENGTHS)
    for k in range(len(LENGTHS)):
        np.add.at(grad["stem"], v.stem[:, k], d_stem)
    return grad


def laid(first: np.ndarray, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and masks of windows; places beyond a window's end show word 0 and are masked."""
    steps = np.arange(WINDOW)
    live = (steps < length[:, None]).astype(np.float32)
    at = np.where(live > 0, first[:, None] + steps, 0)
    return (place[at] if len(place) else at), live


def scored(net: Net, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score and document of every window, and the highest score of each document."""
    words = words_of(pc.utf8_lower(texts))
    v, place = vocabulary(words)
    first, length, owner = windows(words.doc, len(texts))
    x = embedded(net, v)[0] if len(v.bucket) else np.zeros((1, SIZE), np.float32)
    gates = gates_of(net, x)
    parts = []
    for a in range(0, len(owner), 8192):
        ids, live = laid(first[a : a + 8192], length[a : a + 8192], place)
        parts.append(forward(net, gates, ids, live))
    score = np.concatenate([*parts, np.empty(0, np.float32)])
    best = np.full(len(texts), 0.0, np.float32)
    np.maximum.at(best, owner, score)
    return score, owner, best


def train(texts: list[str], doc: np.ndarray, label: np.ndarray, seed: int = 11) -> Net:
    """``texts`` are windows; ``doc`` and ``label`` the document of each and that document's label."""
    rnd = np.random.default_rng(seed)
    net = initial(rnd)
    share = float(np.clip(label.mean() if len(label) else 0.5, 0.001, 0.999))
    if not len(label) or label.min() == label.max():
        net["out"][:] = 0
        net["bias"][:] = np.log(share / (1 - share))
        return net
    # Words are numbered first, so that arrays over bytes are needed for distinct words alone.
    number: dict[str, int] = {}
    flat, counts = array("q"), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(pc.utf8_lower(pa.array(texts, pa.large_string()))):
        before = len(flat)
        flat.extend(number.setdefault(w, len(number)) for w in WORD.findall(text.as_py()))
        counts[i] = len(flat) - before
    flat = np.frombuffer(flat, dtype=np.int64) if flat else np.empty(0, np.int64)
    v, place = vocabulary(words_of(pa.array([" ".join(number)], pa.large_string())))
    flat = place[flat]
    window = np.repeat(np.arange(len(counts)), counts)
    ids, live = laid(np.cumsum(counts) - counts, np.minimum(counts, WINDOW), flat)

    # Log-odds of words and beginnings between toxic and clean documents: the first choice and the first input.
    toxic_docs, clean_docs = np.unique(doc[label == 1]), np.unique(doc[label == 0])

    def log_odds(bucket: np.ndarray, size: int) -> np.ndarray:
        pairs = np.unique(doc[window] * size + bucket[flat])
        toxic = np.isin(pairs // size, toxic_docs)
        in_toxic = np.bincount(pairs[toxic] % size, minlength=size)
        in_clean = np.bincount(pairs[~toxic] % size, minlength=size)
        odds = np.log((in_toxic + 0.5) / (len(toxic_docs) + 1)) - np.log((in_clean + 0.5) / (len(clean_docs) + 1))
        return np.where(in_toxic >= 3, np.clip(odds, -3, 3), 0).astype(np.float32)

    odds = log_odds(v.bucket, WORDS)
    net["word"][:, 0] += odds / 3
    evidence = odds[v.bucket]
    for k in range(len(LENGTHS)):
        odds = log_odds(v.stem[:, k], STEMS)
        net["stem"][:, 0] += odds / 3
        evidence = np.maximum(evidence, odds[v.stem[:, k]])
    belief = np.full(len(texts), -9.0, np.float32)
    np.maximum.at(belief, window, evidence[flat])

    edges = np.searchsorted(v.gram_word, np.arange(len(v.bucket) + 1))
    moment = {k: [np.zeros_like(p), np.zeros_like(p)] for k, p in net.items()}
    step = 0
    for _ in range(ROUNDS):
        order = np.lexsort((-belief, doc))
        rank = np.empty(len(order), dtype=np.int64)
        heads = np.r_[True, doc[order][1:] != doc[order][:-1]]
        rank[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(heads, np.arange(len(order)), 0))
        top = np.zeros(doc.max() + 1, np.float32) - 9
        np.maximum.at(top, doc, belief)
        chosen = (label == 1) & ((rank == 0) | ((rank < 6) & (belief >= 0.9 * top[doc]) & (belief > 0)))
        chosen |= (label == 0) & ((rank < 2) | (rnd.random(len(label)) < 0.1))
        picks = np.flatnonzero(chosen)
        # Toxic windows count as much as a third of all.
        toxic_picks = picks[label[picks] == 1]
        clean = len(picks) - len(toxic_picks)
        picks = np.concatenate([picks, rnd.choice(toxic_picks, max(0, clean // 2 - len(toxic_picks)))])
        for _ in range(EPOCHS):
            for rows in np.array_split(rnd.permutation(picks), max(1, len(picks) // BATCH)):
                used, local = np.unique(ids[rows], return_inverse=True)
                grams, owner = ranges(edges[used], edges[used + 1])
                part = Vocabulary(v.bucket[used], v.stem[used], v.gram[grams], owner)
                grad = backward(net, part, local.reshape(ids[rows].shape), live[rows], label[rows].astype(np.float32))
                step += 1
                for k, g in grad.items():
                    m, s = moment[k]
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    net[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
                net["word"] *= 0.9995
                net["stem"] *= 0.9995
        gates = gates_of(net, embedded(net, v)[0])
        belief = np.concatenate([forward(net, gates, ids[a : a + 8192], live[a : a + 8192]) for a in range(0, len(ids), 8192)])
    return net


def spread_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``FIT_WINDOWS`` evenly placed windows of each learning document, as texts."""
    for batch in slices(batches):
        words = words_of(batch.column(1))
        first, length, owner = windows(words.doc, batch.num_rows)
        many = np.bincount(owner, minlength=batch.num_rows)
        place = np.arange(len(owner)) - (np.cumsum(many) - many)[owner]
        step = np.maximum(many / FIT_WINDOWS, 1.0)[owner]
        chosen = np.flatnonzero(np.floor(place / step) != np.floor((place - 1) / step))
        raw = words.data.tobytes()
        texts = [
            raw[words.starts[first[i]] : words.ends[first[i] + length[i] - 1]].decode() if length[i] > 0 else "" for i in chosen
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner[chosen])), pa.array(texts, pa.string()), batch.column(2).take(pa.array(owner[chosen]))],
            names=["doc_id", "window", "label"],
        )


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Net:
    """``labels`` has doc_id and label (0 or 1)."""
    known = bounded(labels.filter("label IS NOT NULL"), fit_rows)
    # A bounded number of rows, so small beside the documents.
    rows = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id", "label")), "doc_id")
    rows = rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), F.col("label").cast("int"))
    found = rows.mapInArrow(spread_windows, "doc_id long, window string, label int").toArrow()
    order = np.lexsort((found.column("window").to_numpy(), found.column("doc_id").to_numpy()))
    found = found.take(pa.array(order))
    doc = np.unique(found.column("doc_id").to_numpy(), return_inverse=True)[1]
    return train(found.column("window").to_pylist(), doc, found.column("label").to_numpy())


def score(docs: DataFrame, net: Net, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            p = scored(net, batch.column(1))[2].astype(np.float64)
            columns = [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")


def held_out_query(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = 0.7) -> DataFrame:
    out = held_out(3, 1)
    learn = labels.filter(~out).select("doc_id", F.col("toxic").cast("int").alias("label"))
    net = fit(docs, learn, fit_rows)
    return score(docs, net, threshold).select("doc_id", out.alias("held_out"), "score", "predicted")
