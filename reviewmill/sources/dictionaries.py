"""Readers of stopword lists, vocabularies and count vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schema import PRODUCT


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, repeats dropped."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``term:idx`` lines as ``(term, idx)``."""
    parts = F.split(F.trim("value"), ":")
    lines = spark.read.text(path).filter(F.contains("value", F.lit(":")))
    return lines.select(parts[0].alias("term"), parts[1].cast("bigint").alias("idx"))


def _items(value):
    """Items of a vector line behind the product; those without a colon are skipped."""
    parts = F.split(F.trim(value), ",")
    return parts[0], F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda i: F.contains(i, F.lit(":")))


def read_vector_maps(spark: SparkSession, path: str) -> DataFrame:
    """``product,idx:count,...`` lines as a map per product, products without terms too."""
    product, items = _items(F.col("value"))
    pairs = F.transform(
        items, lambda i: F.struct(F.split(i, ":")[0].cast("bigint"), F.split(i, ":")[1].cast("bigint"))
    )
    return spark.read.text(path).select(product.alias(PRODUCT), F.map_from_entries(pairs).alias("counts"))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The same lines in long form ``(product, idx, n)``."""
    product, items = _items(F.col("value"))
    lines = spark.read.text(path).select(product.alias(PRODUCT), items.alias("items"))
    # Taken before the items are spread: beside ``explode`` the line would be split again for every item.
    long = lines.select(PRODUCT, F.explode("items").alias("item"))
    parts = F.split("item", ":")
    return long.select(PRODUCT, parts[0].cast("bigint").alias("idx"), parts[1].cast("bigint").alias("n"))
