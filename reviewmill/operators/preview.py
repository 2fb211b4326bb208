"""Small looks at the data: first rows, first rows per product, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.schema import PRODUCT, SEQ


def first_rows(df: DataFrame, n: int = 5, *order: str) -> DataFrame:
    return df.orderBy(*(order or (SEQ,))).limit(n)


def first_per_product(reviews: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` reviews of every product; each task passes on at most ``n`` per product."""
    rank = F.row_number().over(W.partitionBy(PRODUCT).orderBy(SEQ))
    return reviews.withColumn("rank", rank).filter(F.col("rank") <= n)


def preview(reviews: DataFrame, products: int = 2, n: int = 2) -> DataFrame:
    """First ``n`` reviews of the first ``products`` products."""
    some = reviews.select(PRODUCT).distinct().orderBy(PRODUCT).limit(products)
    # ``limit`` bounds the broadcast side.
    return first_per_product(reviews.join(F.broadcast(some), PRODUCT, "left_semi"), n)


def sample_rows(df: DataFrame, n: int = 5, seed: int = 0, key: str = SEQ) -> DataFrame:
    """``n`` rows by the digest of seed and key: the same rows for a seed however the table is split.

    Only keys are ranked; the columns are fetched for the chosen ones.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    chosen = df.select(key, digest.alias("digest")).orderBy("digest", key).limit(n).select(key)
    # ``limit`` bounds the broadcast side.
    return df.join(F.broadcast(chosen), key, "left_semi")
