"""Files in the formats the readers take."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.nest import CHUNK_BITS, document_lines, nest
from reviewmill.operators.vectors import vector_lines, vocabulary_lines
from reviewmill.schema import PRODUCT


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """UTF-8 with a header, no index column."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_summary(summary: DataFrame, path: str, mode: str = "error") -> None:
    """Per-product counts, sorted by product over the files."""
    write_csv(summary.orderBy(PRODUCT), path, mode)


def write_helpful_flags(flags: DataFrame, path: str, mode: str = "error") -> None:
    """``product, rating, is_helpful`` per review; flags as ``True`` and ``False``."""
    write_csv(flags.withColumn("is_helpful", F.initcap(F.col("is_helpful").cast("string"))), path, mode)


def write_nested(reviews: DataFrame, path: str, mode: str = "error", chunk_bits: int = CHUNK_BITS) -> None:
    """One JSON document per line; see :func:`reviewmill.operators.nest.nest`."""
    document_lines(nest(reviews, chunk_bits)).select("value").write.mode(mode).text(path)


def export_single_object(reviews: DataFrame, path: str, mode: str = "error", chunk_bits: int = CHUNK_BITS) -> None:
    """All products in one JSON object, one key each, over the part files in their order.

    The chunks of a product are lines of one list; nothing is gathered.
    """
    documents = nest(reviews, chunk_bits)
    ends = documents.groupBy(PRODUCT).agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"))
    edge = ends.agg(F.min(PRODUCT).alias("low"), F.max(PRODUCT).alias("high")).first()
    if edge.low is None:
        reviews.sparkSession.range(1).select(F.lit("{}").alias("value")).write.mode(mode).text(path)
        return
    listed = F.to_json("reviews")
    name = F.to_json(F.array(PRODUCT))
    opens, closes = F.col("chunk") == F.col("first"), F.col("chunk") == F.col("last")
    line = F.concat(
        F.when(opens & (F.col(PRODUCT) == edge.low), "{\n").otherwise(""),
        F.when(opens, F.concat(F.substr(name, F.lit(2), F.length(name) - 2), F.lit(':{"reviews":['))).otherwise(""),
        F.substr(listed, F.lit(2), F.length(listed) - 2),
        F.when(~closes, ",").when(F.col(PRODUCT) == edge.high, "]}\n}").otherwise("]},"),
    )
    lines = documents.join(ends, PRODUCT).select(PRODUCT, "chunk", line.alias("value"))
    lines.orderBy(PRODUCT, "chunk").select("value").write.mode(mode).text(path)


def write_vocabulary(terms: DataFrame, path: str, mode: str = "error") -> None:
    """``term:idx`` lines by idx."""
    vocabulary_lines(terms).orderBy("idx").select("line").write.mode(mode).text(path)


def write_vectors(vectors: DataFrame, products: DataFrame, path: str, mode: str = "error") -> None:
    """``product,idx:count,...`` lines by product."""
    vector_lines(vectors, products).orderBy(PRODUCT).select("line").write.mode(mode).text(path)
