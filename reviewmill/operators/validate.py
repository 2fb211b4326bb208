"""Rule checks on nested product documents.

Every document is parsed once.  It is opened into products and these into reviews with outer
explodes, so that a document or product that cannot be opened still has a row to report on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import convert
from reviewmill.schema import NESTED_KEYS, PRODUCT

# Limits of a rating and the written form of a timestamp.
RATING_RANGE = (0, 5)
TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"
LENIENT_FORMAT = "yyyy-M-d H:m:s"

OBJECT = "map<string,variant>"
LIST = "array<variant>"
ERROR = "error"
WARNING = "warning"


def _issue(condition: Column, rule: str, severity: str = ERROR) -> Column:
    return F.when(condition, F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity")))


def opened(documents: DataFrame) -> DataFrame:
    """One row per review of the JSON texts in ``value``, or per part that holds none.

    Columns: ``loaded`` and ``top`` tell whether the text is JSON and an object; ``product``
    with ``fields`` and ``reviews`` (null when not an object, not a list); ``review_idx`` and
    ``review`` (null when not an object).
    """
    parsed = documents.select(F.try_parse_json("value").alias("json"))
    tops = parsed.select(F.col("json").isNotNull().alias("loaded"), F.try_variant_get("json", "$", OBJECT).alias("map"))
    each = tops.select("loaded", F.col("map").isNotNull().alias("top"), F.explode_outer("map").alias(PRODUCT, "content"))
    lists = each.select(
        "loaded",
        "top",
        PRODUCT,
        F.try_variant_get("content", "$", OBJECT).alias("fields"),
        F.try_variant_get("content", "$.reviews", LIST).alias("reviews"),
    )
    kept = [
        "loaded",
        "top",
        PRODUCT,
        F.col("fields").isNotNull().alias("is_object"),
        F.coalesce(F.map_contains_key("fields", F.lit("reviews")), F.lit(False)).alias("has_reviews"),
        F.col("reviews").isNotNull().alias("is_list"),
    ]
    rows = lists.select(*kept, F.posexplode_outer("reviews").alias("review_idx", "element"))
    return rows.withColumns(
        {
            "review_idx": F.col("review_idx").cast("bigint"),
            "review": F.try_variant_get("element", "$", OBJECT),
        }
    ).drop("element")


def _judged(rows: DataFrame) -> DataFrame:
    """Facts about each review, step by step, so that none is worked out twice."""
    review = F.col("review")
    expected = F.array(*[F.lit(k) for k in NESTED_KEYS])
    keys = rows.withColumns(
        {
            "lacking": F.size(F.array_except(expected, F.map_keys(review))) > 0,
            "surplus": F.size(F.array_except(F.map_keys(review), expected)) > 0,
            "stamp": F.element_at(review, "review_timestamp"),
            "rating": F.element_at(review, "rating"),
            "foreign": F.size(F.filter(F.map_values(review), lambda v: ~_is_text(v))),
        }
    )
    texts = keys.withColumns(
        {
            "complete": ~F.col("lacking") & ~F.col("surplus"),
            "stamp": F.when(_is_text(F.col("stamp")), F.regexp_replace(F.col("stamp").cast("string"), r"\s+", " ")),
            "rating": F.when(_is_text(F.col("rating")), F.col("rating").cast("string")),
        }
    )
    stamp, rating = F.col("stamp"), F.col("rating")
    parsed = F.try_to_timestamp(stamp, F.lit(LENIENT_FORMAT))
    return texts.withColumns(
        {
            "bad_stamp": ~(F.regexp_like(stamp, F.lit(TIMESTAMP_SHAPE)) & parsed.isNotNull()),
            "bad_rating": ~F.regexp_like(rating, F.lit(convert.NUMBER_PATTERN)),
            # The word "nan" is a number outside no range: it converts to null, no warning.
            "out_of_range": ~convert.to_number(rating).between(*RATING_RANGE),
        }
    )


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def checked(documents: DataFrame) -> DataFrame:
    """The rows of :func:`opened` with the list of their issues."""
    has_product, here = F.col(PRODUCT).isNotNull(), F.col("review_idx").isNotNull()
    complete = F.col("complete")
    not_text = F.struct(F.lit("value_not_string").alias("rule"), F.lit(ERROR).alias("severity"))
    found = F.array(
        _issue(~F.col("loaded"), "not_loaded"),
        _issue(F.col("loaded") & ~F.col("top"), "top_level_not_object"),
        _issue(has_product & ~F.col("is_object"), "product_not_object"),
        _issue(F.col("is_object") & ~F.col("has_reviews"), "reviews_missing"),
        _issue(F.col("has_reviews") & ~F.col("is_list"), "reviews_not_list"),
        _issue(F.col("is_list") & ~here, "reviews_empty", WARNING),
        _issue(here & F.col("review").isNull(), "review_not_object"),
        _issue(F.col("lacking"), "keys_missing"),
        _issue(F.col("surplus"), "keys_extra"),
        _issue(complete & F.col("bad_stamp"), "bad_timestamp"),
        _issue(complete & F.col("bad_rating"), "bad_rating"),
        _issue(complete & F.col("out_of_range"), "rating_out_of_range", WARNING),
    )
    foreign = F.when(complete, F.col("foreign")).otherwise(0)
    listed = F.concat(F.array_compact(found), F.array_repeat(not_text, F.coalesce(foreign, F.lit(0))))
    return _judged(opened(documents)).select(PRODUCT, "review_idx", listed.alias("issues"))


def issues(documents: DataFrame) -> DataFrame:
    """``(product, review_idx, rule, severity)`` for JSON texts in column ``value``."""
    # The outer form, as a plain one gets a filter that works all checks out twice.
    return checked(documents).select(PRODUCT, "review_idx", F.inline_outer("issues")).filter(F.col("rule").isNotNull())


def verdict(documents: DataFrame) -> DataFrame:
    """Products, reviews, errors, warnings, and whether there are no errors."""

    def total(severity: str) -> Column:
        return F.coalesce(F.sum(F.size(F.filter("issues", lambda i: i["severity"] == severity))), F.lit(0)).cast("bigint")

    counted = checked(documents).agg(
        F.count_distinct(PRODUCT).alias("products"),
        F.count("review_idx").alias("reviews"),
        total(ERROR).alias("errors"),
        total(WARNING).alias("warnings"),
    )
    return counted.withColumn("valid", F.col("errors") == 0)


def verify(documents: DataFrame) -> bool:
    return verdict(documents).first()["valid"]
