"""Vocabulary: terms within a document-frequency band and the strongest word pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.tokens import adjacent_pairs
from reviewmill.operators.membership import member_test, settled
from reviewmill.operators.ranges import places
from reviewmill.operators.tokenise import Tokens, term_counts
from reviewmill.schema import PRODUCT
from reviewmill.session import stage

# Defaults of the vocabulary.
LOW_SHARE = 0.05
HIGH_SHARE = 0.95
MIN_PAIR_COUNT = 2
TOP_PAIRS = 200

FIRST_SHARE = 0.9  # of the terms, the rarest, whose pairs are counted first
ROUNDING = 1e-9  # more than scores in doubles can be off


def term_frequency(counts: DataFrame) -> DataFrame:
    """Products and occurrences of each term: ``(term, product_count, n)``."""
    return counts.groupBy("term").agg(F.count("*").alias("product_count"), F.sum("n").alias("n"))


def product_total(tokens: Tokens) -> DataFrame:
    """Number of products, those without any token included."""
    return tokens.texts.agg(F.count_distinct(PRODUCT))


def in_band(
    frequency: DataFrame, tokens: Tokens, low: float = LOW_SHARE, high: float = HIGH_SHARE
) -> DataFrame:
    """Terms with ``low * N <= product_count < high * N``."""
    total = product_total(tokens).scalar()
    df = F.col("product_count")
    return frequency.filter((df >= F.lit(low) * total) & (df < F.lit(high) * total))


def pair_counts(tokens: Tokens, terms: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``(w1, w2, n)``: neighbours inside a review once all words of other terms are removed.

    Words are told apart where they are, by bit maps over the codes of the dictionary (see ``membership``); only counts of
    pairs are shuffled, and terms are looked up for these.  With ``among``, some of the terms, only pairs of two of these are counted.
    """
    meant = terms if among is None else among
    # The dictionary meets the terms once; the rest is told by what is written beside its words.
    known = tokens.words.select("code", "term").join(terms.select("term", F.lit(True).alias("inside")), "term", "left")
    known = known.join(meant.select("term", F.lit(True).alias("meant")), "term", "left")
    known = stage(known.select("code", "term", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("inside", "meant")]), "band")
    is_kept = member_test(known.filter("inside"), known.filter("NOT inside"))
    lists = tokens.texts.select(F.filter("codes", is_kept).alias("codes"))
    pairs = lists.select(F.inline(adjacent_pairs(F.col("codes"))))
    inside = known.filter("inside AND meant")
    if among is not None:
        is_meant = member_test(inside, known.filter("inside AND NOT meant"))
        pairs = pairs.filter(is_meant(F.col("w1")) & is_meant(F.col("w2")))
    pairs = settled(pairs.groupBy("w1", "w2").agg(F.count("*").alias("n")), "code-pairs")
    return named_pairs(pairs, inside).groupBy("w1", "w2").agg(F.sum("n").alias("n"))


def named_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs of codes as pairs of terms, by a dictionary ``(code, term)``."""
    others = [c for c in pairs.columns if c not in ("w1", "w2")]
    first, second = words.select("code", "term").toDF("w1", "t1"), words.select("code", "term").toDF("w2", "t2")
    return pairs.join(first, "w1").join(second, "w2").select(F.col("t1").alias("w1"), F.col("t2").alias("w2"), *others)


def top_pairs(
    pairs: DataFrame, terms: DataFrame, min_count: int = MIN_PAIR_COUNT, top: int = TOP_PAIRS
) -> DataFrame:
    """The ``top`` pairs by pointwise mutual information, ties in alphabetical order.

    Ranking uses ``n / (n1 * n2)``, which orders like the information measure and leaves
    equal ratios equal.
    """
    total = terms.agg(F.sum("n")).scalar()
    first = terms.select(F.col("term").alias("w1"), F.col("n").cast("double").alias("n1"))
    second = terms.select(F.col("term").alias("w2"), F.col("n").cast("double").alias("n2"))
    scored = pairs.filter(F.col("n") >= min_count).join(first, "w1").join(second, "w2")
    best = scored.orderBy(F.desc(F.col("n") / (F.col("n1") * F.col("n2"))), "w1", "w2").limit(top)
    pmi = F.log2(F.col("n") * total.cast("double")) - F.log2(F.col("n1") * F.col("n2"))
    return best.select(
        "w1",
        "w2",
        F.concat_ws("_", "w1", "w2").alias("term"),
        "n",
        F.col("n1").cast("bigint").alias("n1"),
        F.col("n2").cast("bigint").alias("n2"),
        pmi.alias("pmi"),
    )


def best_pairs(tokens: Tokens, terms: DataFrame, min_count: int = MIN_PAIR_COUNT, top: int = TOP_PAIRS) -> DataFrame:
    """:func:`top_pairs` over all pairs, staged, without counting those that cannot be among them.

    A pair is no more frequent than either term, so ``n / (n1 * n2)`` is at most one by the more frequent term's count.  Pairs of
    terms of up to ``limit`` occurrences are counted first.  If their worst of ``top`` is better than that bound of the next count, they
    are the best of all; else it tells the counts above which no term can have a pair as good, and pairs up to there are counted.
    """
    bounds = terms.agg(F.percentile_approx("n", FIRST_SHARE), F.max("n")).first()
    limit, most = bounds[0] or 0, bounds[1] or 0
    while limit < most:
        rare = terms.filter(F.col("n") <= limit)
        found = stage(top_pairs(pair_counts(tokens, terms, rare), terms, min_count, top), "pairs")
        score = F.col("n") / (F.col("n1").cast("double") * F.col("n2").cast("double"))
        n, worst = found.agg(F.count("*"), F.min(score)).first()
        if n < top:
            break
        reach = int((1 + ROUNDING) / worst)  # a more frequent term has no pair as good as the worst
        if reach <= limit:
            return found
        limit = reach
    return stage(top_pairs(pair_counts(tokens, terms), terms, min_count, top), "pairs")


@dataclass
class Vocabulary:
    """A fitted vocabulary.  Counts, terms of the band and the few best pairs are staged copies, the rest follows from them."""

    counts: DataFrame  # (product, term, n) of every token
    unigrams: DataFrame  # (term, product_count, n) within the band
    pairs: DataFrame  # the best pairs with their scores
    terms: DataFrame  # (term, idx)


def vocabulary_terms(unigrams: DataFrame, pairs: DataFrame) -> DataFrame:
    """Single terms and pairs in one sorted list with dense numbers from 0."""
    return places(unigrams.select("term").unionByName(pairs.select("term")), "term")


def band_terms(tokens: Tokens, low: float = LOW_SHARE, high: float = HIGH_SHARE) -> DataFrame:
    return in_band(term_frequency(term_counts(tokens)), tokens, low, high)


def fit(
    tokens: Tokens,
    low: float = LOW_SHARE,
    high: float = HIGH_SHARE,
    min_count: int = MIN_PAIR_COUNT,
    top: int = TOP_PAIRS,
) -> Vocabulary:
    """Fit a vocabulary on coded texts."""
    counts = stage(term_counts(tokens), "counts")
    unigrams = stage(in_band(term_frequency(counts), tokens, low, high), "unigrams")
    pairs = best_pairs(tokens, unigrams, min_count, top)
    return Vocabulary(counts, unigrams, pairs, vocabulary_terms(unigrams, pairs))
