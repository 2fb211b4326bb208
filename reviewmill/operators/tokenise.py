"""Words of reviews: lists, codes, and the dictionary that leads from words to terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions import tokens as tk
from reviewmill.functions.clean import has_text
from reviewmill.operators.summary import of_products, qualified_reviews
from reviewmill.schema import PRODUCT, SEQ
from reviewmill.session import stage

TEXT = "review_text"
SLICE_BYTES = 16 << 20  # of text that is split at once
SEEN_WORDS = 1_000_000  # that a task remembers as written
COUNTED_TOGETHER = 2_000_000  # counts that a task keeps before it adds them up, and writes them if they are still many


@dataclass
class Tokens:
    """Reviews as lists of word codes, the dictionary of the words and how often products have them; all are staged.

    A code is a 64-bit hash of the word, so a text is coded where it is: no token is shuffled to find its number.  Counting and
    pairing run on codes; terms (stems) are looked up for counts, never for tokens, and
    only the words of the dictionary, each once, are stemmed.
    """

    texts: DataFrame  # (product, seq, codes), in the order of the text
    words: DataFrame  # (code, word, term)
    counts: DataFrame  # (product, code, n)


def review_words(reviews: DataFrame, stopwords: list[str] | DataFrame = tk.STOPWORDS) -> DataFrame:
    """``(product, seq, words)``: the words of each review that are no stopwords and long enough, in order.

    Reviews left without words stay, with an empty list: their product still counts.
    A review without a text has none.  Stopwords come as a list, which becomes part of the
    expression, or as a table with a column ``word``, which is joined; the results are the same.
    """
    if isinstance(stopwords, DataFrame):
        return _words_by_join(reviews, stopwords)
    text = F.coalesce(F.col(TEXT), F.lit(""))
    return reviews.select(PRODUCT, SEQ, tk.kept_words(text, stopwords).alias("words"))


def _words_by_join(reviews: DataFrame, stopwords: DataFrame) -> DataFrame:
    spread = reviews.select(PRODUCT, SEQ, F.posexplode(tk.long_enough(tk.words(F.col(TEXT)))).alias("pos", "word"))
    kept = spread.join(stopwords.select("word"), "word", "left_anti")
    lists = kept.groupBy(PRODUCT, SEQ).agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("kept"))
    empty = F.array().cast("array<string>")
    return (
        reviews.select(PRODUCT, SEQ)
        .join(lists, [PRODUCT, SEQ], "left")
        .select(PRODUCT, SEQ, F.coalesce(F.col("kept.word"), empty).alias("words"))
    )


def review_tokens(reviews: DataFrame, stopwords: list[str] | DataFrame = tk.STOPWORDS) -> DataFrame:
    """``(product, seq, tokens)`` with the stems of each review in order."""
    return review_words(reviews, stopwords).select(PRODUCT, SEQ, tk.stem_all(F.col("words")).alias("tokens"))


def word_code(word: Column, seed: int = 0) -> Column:
    return F.xxhash64(word, F.lit(seed)) if seed else F.xxhash64(word)


def _counted(products: pa.Array, first: np.ndarray, places: np.ndarray, codes: np.ndarray, counting: np.ndarray) -> pa.Table:
    """``(product, code, n)``: how often the texts marked ``counting`` have each code, added up by product."""
    coded = products.dictionary_encode(null_encoding="encode")
    product = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(first)
    keys = np.repeat(product, lengths) * len(codes) + places
    found = pa.array(keys[np.repeat(counting, lengths)], pa.int64()).value_counts()
    owner, place = np.divmod(found.field("values").to_numpy(zero_copy_only=False), max(1, len(codes)))
    return pa.table([coded.dictionary.take(pa.array(owner)), pa.array(codes[place]), found.field("counts")], names=[PRODUCT, "code", "n"])


def _split_batches(stopwords: list[str], seed: int, texts_only: bool):
    """Rows (product, seq, has_text, text) with the codes of the words of the text.

    At the first of the rows read together stand those of their words that the task has not written yet.  Counts of codes by product,
    with ``texts_only`` of the rows that have a text, are added up over many texts and stand in rows of their own, whose ``has_text`` is null.
    """
    names = [PRODUCT, SEQ, "has_text", "codes", "new", "counted"]
    code_list, word_list = pa.list_(pa.int64()), pa.list_(pa.struct([("code", pa.int64()), ("word", pa.string())]))
    count_list = pa.list_(pa.struct([(PRODUCT, pa.string()), ("code", pa.int64()), ("n", pa.int64())]))

    def added_up(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts).group_by([PRODUCT, "code"], use_threads=False).aggregate([("n", "sum")])
        return found.rename_columns({"n_sum": "n"}).select([PRODUCT, "code", "n"])

    def counts_row(found: pa.Table, like: pa.Schema) -> pa.RecordBatch:
        values = found.combine_chunks().to_struct_array().combine_chunks()
        blank = [pa.nulls(1, like.field(i).type) for i in range(3)]
        ends = pa.array([0, len(values)], pa.int32())
        lists = pa.ListArray.from_arrays(ends, values).cast(count_list)
        return pa.RecordBatch.from_arrays([*blank, pa.array([[]], code_list), pa.array([[]], word_list), lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stops = pa.array(stopwords, pa.string())
        seen: set[str] = set()
        parts: list[pa.Table] = []
        schema = None
        for batch in batches:
            schema = batch.schema
            at = 0
            while at < len(batch):
                ends = np.frombuffer(batch.column(3).buffers()[1], np.int32)[batch.column(3).offset :][: len(batch) + 1]
                stop = max(at + 1, int(np.searchsorted(ends, int(ends[at]) + SLICE_BYTES, "right")) - 1)
                rows = batch.slice(at, stop - at)
                first, places, words = tk.split_places(rows.column(3), stops)
                named = words.to_pylist()
                codes = tk.hashed(named, seed)
                counting = rows.column(2).to_numpy(zero_copy_only=False) if texts_only else np.ones(len(rows), bool)
                parts.append(_counted(rows.column(0), first, places, codes, counting))
                if sum(map(len, parts)) > COUNTED_TOGETHER:
                    parts = [added_up(parts)]
                    if len(parts[0]) > COUNTED_TOGETHER // 2:
                        yield counts_row(parts.pop(), schema)
                fresh = np.array([word not in seen for word in named], bool)
                if len(seen) > SEEN_WORDS:
                    seen.clear()
                seen.update(named)
                new = pa.StructArray.from_arrays([pa.array(codes[fresh]), words.filter(pa.array(fresh))], names=["code", "word"])
                ends = np.full(len(rows) + 1, len(new), np.int32)
                ends[0] = 0
                lists = pa.ListArray.from_arrays(pa.array(first), pa.array(codes[places]))
                none = pa.ListArray.from_arrays(pa.array(np.zeros(len(rows) + 1, np.int32)), pa.array([], count_list.value_type))
                columns = [*rows.columns[:3], lists, pa.ListArray.from_arrays(pa.array(ends), new), none]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = stop
        if parts:
            yield counts_row(added_up(parts), schema)

    return run


def _coded_by(
    reviews: DataFrame, stopwords: list[str] | DataFrame, code, at_least: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What :func:`_coded_where_split` gives, by built-in expressions: for stopwords in a table, or codes of another kind."""
    kept = qualified_reviews(reviews, at_least) if at_least else reviews
    words = review_words(kept, stopwords)
    lists = stage(words.select(PRODUCT, SEQ, F.transform("words", code).alias("codes"), F.col("words").alias("new")), "codes")
    counts = lists.select(PRODUCT, F.explode("codes").alias("code")).groupBy(PRODUCT, "code").agg(F.count("*").alias("n"))
    new = lists.select(F.explode("new").alias("word")).distinct()
    return lists, new.select(code(F.col("word")).alias("code"), "word"), counts


def _coded_where_split(
    reviews: DataFrame, stopwords: list[str], seed: int, at_least: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(product, seq, codes)`` of the texts that count, ``(code, word)`` of all texts, and ``(product, code, n)``.

    A text is cleaned and split once: whether a review has one is written beside its codes, and products are counted from that.
    Words are hashed and counted once for the texts read together; a word is written once for these, and from there on a text is its codes.
    """
    text = F.lower(F.coalesce(F.col(TEXT), F.lit(""))).alias("text")
    rows = reviews.select(PRODUCT, SEQ, F.coalesce(has_text(F.col(TEXT)), F.lit(False)).alias("has_text"), text)
    added = f"codes array<long>, new array<struct<code: long, word: string>>, counted array<struct<{PRODUCT}: string, code: long, n: long>>"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields[:3]] + T.StructType.fromDDL(added).fields)
    lists = stage(rows.mapInArrow(_split_batches(stopwords, seed, at_least > 0), schema), "codes")
    words = lists.select(F.inline("new")).distinct()
    counts = lists.select(F.inline("counted")).groupBy(PRODUCT, "code").agg(F.sum("n").alias("n"))
    lists = lists.filter("has_text" if at_least else "has_text IS NOT NULL")
    if at_least:
        products = lists.groupBy(PRODUCT).agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)
        products = stage(products.select(PRODUCT), "products")
        lists, counts = of_products(lists, products), of_products(counts, products)
    return lists, words, counts


def coded(reviews: DataFrame, stopwords: list[str] | DataFrame = tk.STOPWORDS, code=None, at_least: int = 0) -> Tokens:
    """The words of the reviews as codes; with ``at_least``, of the reviews with text of products with so many of them.

    Codes are counted by product, and the dictionary holds the words that were counted.  If two of its words have one code, all are
    coded afresh.  ``code`` makes codes of another kind, from a column of words and a seed.
    """
    for seed in count():
        if code is None and not isinstance(stopwords, DataFrame):
            lists, words, counts = _coded_where_split(reviews, stopwords, seed, at_least)
        else:
            lists, words, counts = _coded_by(reviews, stopwords, lambda word: (code or word_code)(word, seed), at_least)
        lists = lists.select(PRODUCT, SEQ, "codes")
        counts = stage(counts, "word-counts")
        words = words.join(counts.select("code").distinct(), "code", "left_semi")
        words = stage(words.select("code", "word", tk.stem_word("word").alias("term")), "dictionary")
        if words.groupBy("code").count().filter("count > 1").isEmpty():
            return Tokens(lists, words, counts)


def without_stopwords(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Rows of single words that are on no stopword list; repeats stay."""
    return words.join(stopwords.select("word"), "word", "left_anti")


def term_counts(tokens: Tokens) -> DataFrame:
    """``(product, term, n)``; equal words of a product are added up before, then the words of a term."""
    terms = tokens.counts.join(tokens.words.select("code", "term"), "code")
    return terms.groupBy(PRODUCT, "term").agg(F.sum("n").alias("n"))
