"""Sparse count vectors of products over a vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.functions.tokens import adjacent_pairs
from reviewmill.operators.membership import likely_test
from reviewmill.operators.tokenise import Tokens
from reviewmill.operators.vocabulary import Vocabulary
from reviewmill.schema import PRODUCT, SEQ, run_of
from reviewmill.session import stage


def inner_pairs(tokens: Tokens) -> DataFrame:
    """``(product, w1, w2)``: codes of neighbours inside each review."""
    return tokens.texts.select(PRODUCT, F.inline(adjacent_pairs(F.col("codes"))))


def border_pairs(tokens: Tokens) -> DataFrame:
    """``(product, w1, w2)``: codes of the last word of a review and the first of the product's next one.

    Only the two end words of each review with words take part.  They meet first within
    a run, then one row per run meets the next run of the product.
    """
    ends = tokens.texts.filter(F.size("codes") > 0).select(
        PRODUCT,
        run_of().alias("run"),
        SEQ,
        F.element_at("codes", 1).alias("head"),
        F.element_at("codes", -1).alias("tail"),
    )
    in_run = W.partitionBy(PRODUCT, "run").orderBy(SEQ)
    ends = ends.select(
        PRODUCT,
        "run",
        "head",
        "tail",
        F.lead("head").over(in_run).alias("next_head"),
        F.lag("tail").over(in_run).alias("previous_tail"),
    )
    runs = ends.groupBy(PRODUCT, "run").agg(
        F.max(F.when(F.col("previous_tail").isNull(), F.col("head"))).alias("head"),
        F.max(F.when(F.col("next_head").isNull(), F.col("tail"))).alias("tail"),
    )
    runs = runs.withColumn("next_head", F.lead("head").over(W.partitionBy(PRODUCT).orderBy("run")))
    both = ends.select(PRODUCT, "tail", "next_head").unionByName(runs.select(PRODUCT, "tail", "next_head"))
    met = both.filter(F.col("next_head").isNotNull())
    return met.select(PRODUCT, F.col("tail").alias("w1"), F.col("next_head").alias("w2"))


def count_vectors(tokens: Tokens, vocabulary: Vocabulary, boundary: str = "product") -> DataFrame:
    """``(product, idx, n)`` for terms and pairs of the vocabulary.

    Pairs are neighbours among all tokens of a product in review order, over review
    borders too; ``boundary="review"`` stops at the borders.
    """
    # The pairs of words that make one of the wanted pairs of terms: a few thousand rows by default, whose
    # size Spark sees, so that it sends them if that is small.
    known = tokens.words.select("code", "term")
    first, second = known.toDF("c1", "w1"), known.toDF("c2", "w2")
    wanted = vocabulary.pairs.select("w1", "w2", "term").join(first, "w1").join(second, "w2")
    wanted = stage(wanted.select(F.col("c1").alias("w1"), F.col("c2").alias("w2"), "term"), "wanted")
    pairs = inner_pairs(tokens)
    if boundary == "product":
        pairs = pairs.unionByName(border_pairs(tokens))
    # Nearly all pairs begin with another word, and one look at a bit map tells: the join gets the rest.
    pairs = pairs.filter(likely_test(wanted.select(F.col("w1").alias("code")))(F.col("w1")))
    paired = pairs.join(wanted, ["w1", "w2"]).groupBy(PRODUCT, "term").agg(F.count("*").alias("n"))
    every = vocabulary.counts.unionByName(paired)
    return every.join(vocabulary.terms, "term").select(PRODUCT, "idx", "n")


def vector_lines(vectors: DataFrame, products: DataFrame) -> DataFrame:
    """``product,idx:count,...`` by rising idx; a product without terms gives ``product,``.

    A line holds at most one item per term of the vocabulary.
    """
    item = F.struct("idx", "n")
    grouped = vectors.groupBy(PRODUCT).agg(F.sort_array(F.collect_list(item)).alias("items"))
    full = products.select(PRODUCT).distinct().join(grouped, PRODUCT, "left")
    text = F.array_join(F.transform("items", lambda i: F.concat_ws(":", i["idx"], i["n"])), ",")
    return full.select(PRODUCT, F.concat(PRODUCT, F.lit(","), F.coalesce(text, F.lit(""))).alias("line"))


def vocabulary_lines(terms: DataFrame) -> DataFrame:
    return terms.select("idx", F.concat_ws(":", "term", "idx").alias("line"))
