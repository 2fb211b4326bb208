"""Nested product documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.schema import NESTED_KEYS, PRODUCT, SEQ

# A document holds the reviews of one product whose ``seq`` agrees above this many bits.
CHUNK_BITS = 14


def nest(reviews: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``(product, chunk, reviews)`` with the reviews of a product in order, from one shuffle.

    Every document has a chunk number, by one rule for all products: ``seq >> chunk_bits``.  So a
    document has ``2 ** chunk_bits`` reviews at most, and chunks of a product follow each other.
    """
    review = F.struct(*NESTED_KEYS).alias("review")
    rows = reviews.select(PRODUCT, F.shiftright(SEQ, chunk_bits).alias("chunk"), F.struct(SEQ, review).alias("item"))
    listed = rows.groupBy(PRODUCT, "chunk").agg(F.sort_array(F.collect_list("item")).alias("listed"))
    return listed.select(PRODUCT, "chunk", F.col("listed.review").alias("reviews"))


def document_lines(nested: DataFrame) -> DataFrame:
    """Each document as one JSON line ``{product: {"chunk": n, "reviews": [...]}}``."""
    content = F.struct("chunk", "reviews")
    return nested.select(PRODUCT, "chunk", F.to_json(F.create_map(F.col(PRODUCT), content)).alias("value"))
