"""Per-product counts and the products with enough texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.clean import has_text
from reviewmill.schema import PRODUCT

MIN_REVIEWS = 50


def product_summary(reviews: DataFrame) -> DataFrame:
    """Reviews and reviews with text per product, from one pass over the rows."""
    return reviews.groupBy(PRODUCT).agg(
        F.count("*").alias("review_count"),
        F.count_if(has_text(F.col("review_text"))).alias("review_text_count"),
    )


def with_text(reviews: DataFrame) -> DataFrame:
    return reviews.filter(has_text(F.col("review_text")))


def frequent_products(reviews: DataFrame, at_least: int = MIN_REVIEWS) -> DataFrame:
    """Products with at least ``at_least`` reviews that have text."""
    return with_text(reviews).groupBy(PRODUCT).agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)


def of_products(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews whose product is listed."""
    return reviews.join(products.select(PRODUCT), PRODUCT, "left_semi")


def qualified_reviews(reviews: DataFrame, at_least: int = MIN_REVIEWS) -> DataFrame:
    """Reviews with text of the products that have enough of them."""
    return of_products(with_text(reviews), frequent_products(reviews, at_least))
