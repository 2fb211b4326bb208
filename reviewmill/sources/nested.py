"""Nested product documents: ``{product: {"reviews": [...]}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schema import MISSING, NESTED_DOCUMENT, NESTED_KEYS, PRODUCT, RUN_BITS, SEQ
from reviewmill.sources.json_object import read_members


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """JSON text as ``value``: one document per line, or with ``whole_file`` the products of one object per file."""
    return read_members(spark, path) if whole_file else spark.read.text(path)


def flatten(documents: DataFrame) -> DataFrame:
    """One row per review with the product as a column.

    A product may be spread over several documents that carry chunk numbers; ``seq``
    follows chunk and place in the list.
    """
    parsed = documents.select(F.explode(F.from_json("value", NESTED_DOCUMENT)).alias(PRODUCT, "content"))
    rows = parsed.select(PRODUCT, "content.chunk", F.posexplode("content.reviews").alias("pos", "r"))
    seq = F.shiftleft(F.coalesce("chunk", F.lit(0)).cast("long"), RUN_BITS) + F.col("pos")
    return rows.select(*[F.col("r")[k].alias(k) for k in NESTED_KEYS], PRODUCT, seq.alias(SEQ))


def product_texts(documents: DataFrame) -> DataFrame:
    """Only product and text of each review; a missing text becomes the sentinel."""
    text = F.coalesce("review_text", F.lit(MISSING)).alias("review_text")
    return flatten(documents).select(PRODUCT, text, SEQ)
