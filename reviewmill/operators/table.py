"""The review table: types, union, cleaning, standard form, duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions import clean, convert
from reviewmill.schema import REVIEW_COLUMNS, SEQ


def typed(raw: DataFrame, missing_flag: bool | None = False) -> DataFrame:
    """Raw strings to the typed review table; values that do not convert become null.

    A missing flag is ``missing_flag``: false in tagged text, null in workbooks.
    """
    changed = {
        "rating": convert.to_number(F.col("rating")),
        "helpful_votes": convert.to_whole(F.col("helpful_votes")),
        "review_timestamp": convert.epoch_millis(F.col("review_timestamp")),
        "is_verified_purchase": convert.to_flag(F.col("is_verified_purchase"), missing_flag),
    }
    return raw.select(*[changed.get(c, F.col(c)).alias(c) for c in REVIEW_COLUMNS], SEQ)


def union_all(*tables: DataFrame) -> DataFrame:
    """Union by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def cleaned(reviews: DataFrame, compat: bool = False) -> DataFrame:
    """Clean the review text.

    A missing text stays missing.  With ``compat`` it turns into the word ``nan``, which
    then counts as a text, as in pipelines that stringify before they fill.
    """
    text = F.col("review_text")
    if compat:
        text = F.coalesce(text, F.lit("nan"))
    return reviews.withColumn("review_text", clean.clean_review(text))


def standard(reviews: DataFrame) -> DataFrame:
    """All columns as strings: sentinel for missing and empty values, text lower-cased."""

    def column(field: T.StructField):
        value = convert.filled(convert.text_form(F.col(field.name), field.dataType))
        if isinstance(field.dataType, T.StringType):
            value = F.lower(value)
        return value.alias(field.name)

    return reviews.select(*[column(reviews.schema[c]) for c in REVIEW_COLUMNS], SEQ)


def without_duplicates(reviews: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per distinct combination of ``columns``, at the place of its first copy.

    Copies collapse before the shuffle, however many there are.
    """
    columns = columns or REVIEW_COLUMNS
    return reviews.groupBy(*columns).agg(F.min(SEQ).alias(SEQ))
