"""Alignment, merge-type encoding and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewmill.llm import alignment, impact_search, piece_tokens
from tests.llm.samples import TYPES, corpus, frame, odd_rows, with_extra

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "b", "▁", " ", "\n", "\t", "\r", "\x00", "é", "漢字", "Ω", "Ж", "\U0001f603", "́", "the", "ing", "'s", "  ", "1", "23", ", "]
ODD += ["…", "ﷺ", "\U0001d4b3", "​", "\xa0", "　", "<|endoftext|>", "<s>", "<0x41>", "ß", "\x1c", "\x85", ".", "!\n", "don't "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def first():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer


def odd_texts(n, seed=2):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(25))) for _ in range(n)]


# ---- encoding ------------------------------------------------------------------------


def test_ids_are_the_librarys(library):
    pieces = piece_tokens.Pieces.of(MODEL)
    blanks = [a + " " * n + b for n in range(1, 70) for a in ("", "a") for b in ("", "the x", "\n")]
    for text in [*blanks, *odd_texts(5000), "ab" * 3000, "漢" * 300 + "x" * 5000, "", *(r[1] for r in corpus(60))]:
        assert pieces.encode(text) == library.encode(text), repr(text)


def test_every_piece_is_coded_like_the_library_does(library):
    pieces = piece_tokens.Pieces.of(MODEL)
    for name in pieces.id:
        text = name.replace("▁", " ")
        assert pieces.encode(text) == library.encode(text), repr(name)


def test_neighbours_are_compatible_and_prefixes_have_one_last_token():
    pieces = piece_tokens.Pieces.of(MODEL)
    rnd = random.Random(3)
    for _ in range(300):
        part = "▁" + "".join(rnd.choice("abcdeghinorstu") for _ in range(rnd.randrange(1, 14)))
        last = pieces.last_tokens(part)
        for end in range(1, len(part) + 1):
            merged = pieces.merged(part[:end])  # plain merging of the whole prefix
            assert pieces.tokens[last[end]] == merged[-1]
            fitting = [
                t for t in {p for p in pieces.tokens if part[:end].endswith(p)}
                if len(t) == end and merged == [t]
                or len(t) < end and pieces.compatible(last[end - len(t)], pieces.tokens.index(t))
            ] if end < 5 else [merged[-1]]
            assert fitting == [merged[-1]]


def test_pairs_fit_as_plain_merging_says():
    pieces = piece_tokens.Pieces.of(MODEL)
    rnd = random.Random(7)
    merging = [t for t in range(len(pieces.tokens)) if pieces.size[t] > 1]
    assert sum(pieces.tails[t] is not None for t in merging) > 0.99 * len(merging)
    first = {}
    for t in range(len(pieces.tokens)):
        first.setdefault(pieces.tokens[t][0], []).append(t)
    fits = 0
    for _ in range(30_000):
        left = rnd.choice(merging)
        whole = rnd.choice(merging)
        # Half of the pairs are likely neighbours: a token and one that begins like the second half of another.
        right = rnd.choice(first[pieces.tokens[whole][pieces.size[whole] // 2]]) if rnd.random() < 0.5 else whole
        a, b = pieces.tokens[left], pieces.tokens[right]
        assert pieces.fit(left, right) == (a + b not in pieces.id and pieces.merged(a + b) == [a, b]), (a, b)
        fits += pieces.fit(left, right)
    assert 1000 < fits < 29_900


def test_kept_answers_can_be_dropped(monkeypatch, library):
    pieces = piece_tokens.Pieces(MODEL)
    monkeypatch.setattr(piece_tokens, "PAIRS", 50)
    monkeypatch.setattr(piece_tokens, "PARTS", 20)
    for text in odd_texts(300, 9):
        assert pieces.encode(text) == library.encode(text)
    assert len(pieces.fits) <= 50 and len(pieces.known) <= 20 and len(pieces.older) <= 20


def test_a_model_without_byte_pieces_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda *_: False)
    with pytest.raises(ValueError, match="byte pieces"):
        piece_tokens.Pieces(MODEL)


def test_piece_query(spark, library):
    rows = [*corpus(30), *odd_rows(), *[(200 + i, t, None, None) for i, t in enumerate(odd_texts(200, 4))]]
    df = with_extra(frame(spark, rows)).withColumns({"ids": F.lit(1), "decoded": F.lit(1), "read": F.lit(2)})
    coded = piece_tokens.decoded(piece_tokens.encoded(df, MODEL), MODEL)
    both = piece_tokens.encoded(df, MODEL, decoded="decoded")
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, coded.collect()), key=repr)
    found = sorted((tuple(r) for r in piece_tokens.digest(coded).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "")
        code = [",".join(map(str, ids)), library.decode(ids) if ids else ""]
        want.append((doc_id, len(ids), *(hashlib.sha256(c.encode()).hexdigest() for c in code)))
    assert found == sorted(want, key=repr)
    carried = piece_tokens.encoded(df, MODEL, keep=["doc_id", "read", "n"], ids="list")
    assert carried.columns == ["doc_id", "read", "n", "list"] and carried.first().read == 2
    assert coded.limit(0).count() == 0 and piece_tokens.encoded(df.limit(0), MODEL).count() == 0


def test_decoding_of_null_lists(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [382, 28797])], "doc_id int, ids array<int>")
    found = {r.doc_id: r.decoded for r in piece_tokens.decoded(rows, MODEL).collect()}
    assert found == {1: "", 2: "", 3: "Hé"}


# ---- alignment -----------------------------------------------------------------------


def plain_alignment(text, first, library):
    """Cuts by the decoded bytes of whole texts."""
    pair = alignment.Pair.of(VOCABULARY, MODEL)
    if not text:
        return None
    a, b = first.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
    a_bytes = [first.decode([i]).encode() if first.id_to_token(i).isascii() and "Ġ" not in first.id_to_token(i) else pair.a_bytes[i] for i in a]
    b_bytes = [bytes([int(p[1:-1], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, library.id_to_piece(b))]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        x, y = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return len(a), len(b), ";".join(groups), links


def test_parts_align_like_whole_texts(first, library):
    pair = alignment.Pair.of(VOCABULARY, MODEL)
    for text in [*odd_texts(4000, 6), "x" * 3000, "漢字" * 200, "", "word, word.\nNext line! a b\n\n c", *(r[1] for r in corpus(40))]:
        found, want = pair.aligned(text), plain_alignment(text, first, library)
        if want is None:
            assert found is None, repr(text)
        else:
            links = [(key >> 32, key & 0xFFFFFFFF) for key in found[4].tolist()]
            assert (found[0], found[1], found[3], links) == want, repr(text)
            assert found[2] == len(links)


def test_cuts_inside_a_character_are_found(first, library):
    found = alignment.Pair.of(VOCABULARY, MODEL).aligned("\U0001d4b3 \U0001f603")
    assert found[3] == plain_alignment("\U0001d4b3 \U0001f603", first, library)[2]
    assert found[2] > 2


def test_alignment_query(spark, first, library):
    rows = [*corpus(40), *odd_rows(), *[(200 + i, t, None, None) for i, t in enumerate(odd_texts(300, 8))]]
    rows.append((900, "kept ▁ mark", "en", None))
    df = with_extra(frame(spark, rows))
    found = sorted((tuple(r) for r in alignment.query(df, VOCABULARY, MODEL).collect()), key=repr)
    whole = [(r[0], plain_alignment(r[1], first, library)) for r in rows]
    counts = Counter(link for _, w in whole if w for link in w[3])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = []
    for doc_id, w in whole:
        if w is None:
            want.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[x] == highest[x[1]] for x in w[3])
        code = hashlib.sha256(w[2].encode()).hexdigest()
        want.append((doc_id, w[0], w[1], len(w[3]), len(w[3]), best, sum(counts[x] for x in w[3]), code))
    assert found == sorted(want, key=repr)
    assert (900, 0, 0, 0, 0, 0, 0, "") in want
    assert alignment.query(df.limit(0), VOCABULARY, MODEL).count() == 0


def test_links_stay_within_their_bound(spark):
    pair = alignment.Pair.of(VOCABULARY, MODEL)
    rows = alignment.aligned(frame(spark, corpus(40)), VOCABULARY, MODEL)
    for a, b, _ in alignment.link_counts(rows).collect():
        x, y = pair.a_bytes[a], pair.b_bytes[b]
        assert x.endswith(y) or y.endswith(x)
    with pytest.raises(ValueError, match="more links"):
        alignment.weighed(rows, alignment.link_counts(rows), 3)


def test_kept_parts_can_be_dropped(monkeypatch, first, library):
    monkeypatch.setattr(alignment, "PARTS", 30)
    pair = alignment.Pair(VOCABULARY, MODEL)
    for text in odd_texts(200, 11):
        found, want = pair.aligned(text), plain_alignment(text, first, library)
        assert (found and found[3]) == (want and want[2])
    assert len(pair.kept) < 60 and len(pair.older) < 60


# ---- search --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(rows, items, k=10):
    docs = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t, *_ in rows]
    lengths = [sum(c.values()) for _, c in docs]
    n_docs, whole = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in docs for t in c)
    found = []
    for item, text in items:
        scored = []
        for (d, c), n in zip(docs, lengths):
            if d is None or not n:
                continue
            m = 100 - 90 + (90 * n * n_docs) // whole
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d))
        found += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def queries(seed=1):
    rnd = random.Random(seed)
    rows = corpus(150, seed)
    items = []
    for i in range(25):
        words = rnd.choice(rows)[1].split()
        start = rnd.randrange(len(words))
        items.append((i, " ".join(words[start : start + rnd.randrange(1, 40)])))
    return rows, [*items, (25, None), (26, "?!"), (27, "no_such_word_at_all"), (28, "THE the The of"), (29, "É é über"), (3, items[4][1])]


@pytest.mark.parametrize("seed, stretch, cells", [(1, 16, 1 << 24), (2, 1, 1 << 12), (3, 3, 1)])
def test_search_equals_scoring_everything(spark, monkeypatch, seed, stretch, cells):
    monkeypatch.setattr(impact_search, "STRETCH", stretch)
    monkeypatch.setattr(impact_search, "TABLE_CELLS", cells)
    rows, items = queries(seed)
    rows += odd_rows()
    df = with_extra(frame(spark, rows, 4))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    found = impact_search.digest(impact_search.search(df, asked))
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_search(rows, items)


def test_search_in_blocks_of_queries(spark):
    rows, items = queries(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = impact_search.search(frame(spark, rows), asked, k=3, block_bytes=1500)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_search(rows, items, 3)


def test_search_over_empty_tables(spark):
    rows, items = queries(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert impact_search.search(frame(spark, rows).limit(0), asked).count() == 0
    assert impact_search.search(frame(spark, rows), asked.limit(0)).count() == 0
    assert impact_search.search(frame(spark, [(1, None, None, None), (2, "", None, None)]), asked).count() == 0


def test_reading_stops_early_and_keeps_ties():
    rnd = np.random.default_rng(0)
    n = 5000
    doc = np.tile(np.arange(n), 2)
    term = np.repeat([0, 1], n)
    impact = np.concatenate([np.sort(rnd.integers(1, 100, n))[::-1]] * 2)
    impact[:20] = impact[n : n + 20] = 1000  # twenty equal ones at the top
    ids = rnd.permutation(n)
    chunk = impact_search.Chunk(ids, doc, term, impact, 2)
    read = []
    chunk.place = CountedAccess(chunk.place, read)
    none = np.empty(0, dtype=np.int64)
    scores, best = chunk.best(np.array([0, 1]), np.array([3, 5]), none, none, 10)
    assert scores.tolist() == [8000] * 10 and best.tolist() == sorted(ids[:20].tolist())[:10]
    assert sum(read) < 100


class CountedAccess:
    """A place table that notes how many documents are looked up."""

    def __init__(self, table, read):
        self.table, self.read = table, read

    def __getitem__(self, key):
        self.read.append(np.size(key[1]))
        return self.table[key]
