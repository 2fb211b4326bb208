"""Tokens of a text: split, stop, cut by length, stem."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pandas.util import hash_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions import porter

MIN_TOKEN_LENGTH = 3
MEMO_WORDS = 500_000

# English function words, the default when no stopword file is given.
STOPWORDS = (
    "a about above after again against all am an and any are as at be because been before "
    "being below between both but by can cannot could did do does doing down during each "
    "few for from further had has have having he her here hers herself him himself his how "
    "i if in into is it its itself just let me more most my myself no nor not now of off on "
    "once only or other ought our ours ourselves out over own same shall she should so some "
    "such than that the their theirs them themselves then there these they this those "
    "through to too under until up upon us very was we were what when where which while who "
    "whom why will with would you your yours yourself yourselves"
).split()


def words(text: Column) -> Column:
    """Runs of ASCII letters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]+"), 0)


def without_stopwords(tokens: Column, stopwords: list[str]) -> Column:
    """Drop tokens on a list of checked length, order and repeats kept."""
    return F.filter(tokens, lambda t: ~t.isin(*stopwords)) if stopwords else tokens


def long_enough(tokens: Column, at_least: int = MIN_TOKEN_LENGTH) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= at_least)


_memo: dict[str, str] = {}


def _stem_values(values: pa.Array) -> pa.Array:
    coded = values.dictionary_encode()
    stems = []
    for word in coded.dictionary.to_pylist():
        known = _memo.get(word)
        if known is None:
            if len(_memo) >= MEMO_WORDS:
                _memo.clear()
            known = _memo[word] = porter.stem(word)
        stems.append(known)
    return pa.array(stems, pa.string()).take(coded.indices)


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_all(tokens: pa.Array) -> pa.Array:
    """Stem arrays of tokens: each distinct word of a batch is stemmed once."""
    stems = _stem_values(tokens.flatten())
    offsets = pa.compute.subtract(tokens.offsets, tokens.offsets[0])
    return pa.ListArray.from_arrays(offsets, stems, mask=tokens.is_null())


@F.arrow_udf(T.StringType())
def stem_word(token: pa.Array) -> pa.Array:
    """Stem a column of single tokens."""
    return _stem_values(token)


def kept_words(text: Column, stopwords: list[str]) -> Column:
    """Split, stop, cut by length, before stemming, so that short stems stay.  Short runs are left out as the text is split."""
    long_runs = F.regexp_extract_all(F.lower(text), F.lit(f"[a-z]{{{MIN_TOKEN_LENGTH},}}"), 0)
    return without_stopwords(long_runs, stopwords)


def split_places(texts: pa.Array, stopwords: pa.Array, at_least: int = MIN_TOKEN_LENGTH) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """:func:`kept_words` of lower-cased texts without nulls, as places in the words that these have, each once.

    The first array tells where each text begins among the places.
    Runs of letters are found for all texts at once; words are stopped in the dictionary, not one by one.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    borders = offsets - offsets[0]
    letter = (data - np.uint8(97)) < 26
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    inside = borders[borders < len(data)]
    begins[inside] = letter[inside]  # a text begins: what is before it is none of its words
    ends = letter.copy()
    ends[:-1] &= ~letter[1:] | begins[1:]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = ends - begins >= at_least
    begins, ends = begins[long], ends[long]
    # Words and what lies between them, in turn, as one array over the bytes of the texts; then the words of it.
    turns = np.empty(2 * len(begins) + 1, np.int32)
    turns[0:-1:2], turns[1::2], turns[-1] = begins, ends, len(data)
    pieces = pa.StringArray.from_buffers(2 * len(begins), pa.py_buffer(turns), pa.py_buffer(np.ascontiguousarray(data)))
    coded = pieces.take(pa.array(np.arange(0, 2 * len(begins), 2))).dictionary_encode()
    kept = ~pa.compute.is_in(coded.dictionary, value_set=stopwords).to_numpy(zero_copy_only=False)
    indices = coded.indices.to_numpy()
    wanted = kept[indices]
    before = np.concatenate([[0], np.cumsum(wanted)])
    first = before[np.searchsorted(begins, borders)].astype(np.int32)
    place = (np.cumsum(kept) - 1).astype(np.int32)
    return first, place[indices[wanted]], coded.dictionary.filter(pa.array(kept))


def split_words(texts: pa.Array, stopwords: pa.Array, at_least: int = MIN_TOKEN_LENGTH) -> tuple[pa.ListArray, pa.Array]:
    """The words of :func:`split_places` text by text, and each once."""
    first, places, new = split_places(texts, stopwords, at_least)
    return pa.ListArray.from_arrays(pa.array(first), new.take(pa.array(places))), new


def hashed(words: list[str], seed: int = 0) -> np.ndarray:
    """64-bit hashes of words; another seed gives others."""
    return hash_array(np.array(words, object), hash_key=f"{seed:016d}", categorize=False).view(np.int64)


def review_tokens(text: Column, stopwords: list[str]) -> Column:
    """Split, stop, cut by length, stem - in this order."""
    return stem_all(kept_words(text, stopwords))


def adjacent_pairs(tokens: Column) -> Column:
    """Neighbouring tokens of an array as structs ``(w1, w2)``."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(F.slice(tokens, F.lit(1), n).alias("w1"), F.slice(tokens, F.lit(2), n).alias("w2"))


def word_count(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(text, F.lit(r"\S+"))
