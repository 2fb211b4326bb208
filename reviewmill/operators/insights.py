"""Descriptive answers over reviews and vectors."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import convert
from reviewmill.functions.tokens import word_count
from reviewmill.operators.ranges import quantiles
from reviewmill.schema import MISSING, PRODUCT
from reviewmill.session import stage

# Defaults of the reports.
TRIM_SHARE = 0.95
GRID_POINTS = 200
GRID_REACH = 3
LENGTH_BAND = 500
CLOUD_TERMS = 200


# ---- volume over time -------------------------------------------------------------


def weekday_counts(df: DataFrame, ts: Column) -> DataFrame:
    """Rows per weekday, Monday first; a day without rows is null."""
    counts = df.groupBy(convert.weekday_name(ts).alias("weekday")).agg(F.count("*").alias("n"))
    days = F.array(*[F.lit(d) for d in convert.WEEKDAYS])
    week = df.sparkSession.range(len(convert.WEEKDAYS)).select(
        (F.col("id") + 1).alias("day"), F.get(days, F.col("id").cast("int")).alias("weekday")
    )
    return week.join(counts, "weekday", "left").select("day", "weekday", "n").orderBy("day")


def yearly_counts(df: DataFrame, ts: Column) -> DataFrame:
    """Rows per year by year; rows without a time are left out."""
    by_year = df.groupBy(F.year(ts).cast("bigint").alias("year")).agg(F.count("*").alias("n"))
    return by_year.filter(F.col("year").isNotNull() & (F.col("n") > 0)).orderBy("year")


# ---- length of reviews ------------------------------------------------------------


def with_word_count(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("review_length", word_count(F.col("review_text")).cast("bigint"))


def length_histogram(reviews: DataFrame) -> DataFrame:
    """Reviews per rating and word count: all later length figures come from this."""
    return with_word_count(reviews).groupBy("rating", "review_length").agg(F.count("*").alias("n"))


def length_cutoff(histogram: DataFrame, share: float = TRIM_SHARE) -> DataFrame:
    """Exact quantile with linear interpolation, weighted by the counts."""
    lengths = histogram.groupBy("review_length").agg(F.sum("n").alias("n"))
    return quantiles(lengths, [], "review_length", "n", share, "cutoff")


def trimmed(histogram: DataFrame, share: float = TRIM_SHARE) -> DataFrame:
    """Lengths up to the quantile."""
    return histogram.filter(F.col("review_length") <= length_cutoff(histogram, share).scalar())


def length_by_rating(reviews: DataFrame, share: float = TRIM_SHARE) -> DataFrame:
    """Number, mean, median and extremes of the trimmed lengths per rating."""
    kept = stage(trimmed(stage(length_histogram(reviews), "lengths"), share), "trimmed")
    length, n = F.col("review_length"), F.col("n")
    counts = kept.groupBy("rating").agg(
        F.sum("n").alias("reviews"),
        (F.sum(length * n) / F.sum("n")).alias("mean_length"),
        F.min("review_length").alias("min_length"),
        F.max("review_length").alias("max_length"),
    )
    medians = quantiles(kept, ["rating"], "review_length", "n", 0.5, "median_length").withColumnRenamed("rating", "rated")
    both = counts.join(medians, F.col("rating").eqNullSafe(F.col("rated")), "left")
    return both.select("rating", "reviews", "mean_length", "median_length", "min_length", "max_length")


def length_density(reviews: DataFrame, share: float = TRIM_SHARE, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density of the trimmed lengths per rating.

    Bandwidth is the sample deviation times ``n ** (-1/5)``; the grid reaches three
    bandwidths beyond the extremes.  Ratings with fewer than two distinct lengths have no
    density.  Work is the number of distinct lengths times the grid size.
    """
    kept = stage(trimmed(stage(length_histogram(reviews), "lengths"), share).filter(F.col("rating").isNotNull()), "trimmed")
    length, n = F.col("review_length").cast("double"), F.col("n").cast("double")
    shape = kept.groupBy("rating").agg(
        F.sum(n).alias("total"),
        (F.sum(n * length) / F.sum(n)).alias("mean"),
        F.min(length).alias("low"),
        F.max(length).alias("high"),
    )
    # Squares around the mean, which keep the digits that raw squares lose.
    away = kept.join(shape.select("rating", "mean"), "rating")
    squares = away.groupBy("rating").agg(F.sum(n * F.pow(length - F.col("mean"), 2)).alias("squares"))
    variance = F.col("squares") / (F.col("total") - 1)
    shape = shape.join(squares, "rating").filter(F.col("high") > F.col("low")).select(
        "rating",
        "total",
        "low",
        "high",
        (F.sqrt(variance) * F.pow(F.col("total"), F.lit(-0.2))).alias("width"),
    )
    step = (F.col("high") - F.col("low") + 2 * GRID_REACH * F.col("width")) / (points - 1)
    x = F.col("low") - GRID_REACH * F.col("width") + F.col("point") * step
    spread = kept.join(shape, "rating").select(
        "rating", "total", "width", length.alias("length"), n.alias("n"), "low", "high",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
    )
    spread = spread.withColumn("x", x)
    kernel = F.exp(-0.5 * F.pow((F.col("x") - F.col("length")) / F.col("width"), 2))
    return spread.groupBy("rating", "point", "x", "total", "width").agg(F.sum(F.col("n") * kernel).alias("mass")).select(
        "rating",
        F.col("point").cast("bigint").alias("point"),
        "x",
        (F.col("mass") / (F.col("total") * F.col("width") * math.sqrt(2 * math.pi))).alias("density"),
    )


# ---- votes and ratings ------------------------------------------------------------


def length_and_votes(reviews: DataFrame) -> DataFrame:
    """Characters and votes of each review; missing votes count as none."""
    votes = F.coalesce(F.col("helpful_votes"), F.lit(0)).alias("helpful_votes")
    text = F.coalesce(F.col("review_text"), F.lit(MISSING))
    return reviews.select(F.length(text).cast("bigint").alias("review_length"), votes)


def votes_by_length(reviews: DataFrame, band: int = LENGTH_BAND) -> DataFrame:
    """Votes per band of text length."""
    rows = length_and_votes(reviews)
    low = (F.floor(F.col("review_length") / band) * band).cast("bigint")
    counts = rows.groupBy(low.alias("from_length"), "helpful_votes").agg(F.count("*").alias("n"))
    votes, n = F.col("helpful_votes"), F.col("n")
    return counts.groupBy("from_length").agg(
        F.sum("n").alias("reviews"),
        (F.sum(votes * n) / F.sum("n")).alias("mean_votes"),
        F.percentile(votes, 0.5, n).alias("median_votes"),
        F.max(votes).alias("max_votes"),
    )


def length_votes_correlation(reviews: DataFrame) -> DataFrame:
    rows = length_and_votes(reviews)
    return rows.agg(F.count("*").alias("reviews"), F.corr("review_length", "helpful_votes").alias("correlation"))


def rating_share(reviews: DataFrame) -> DataFrame:
    """Share of each rating among the reviews that have one."""
    rated = reviews.filter(F.col("rating").isNotNull()).groupBy("rating").agg(F.count("*").alias("n"))
    return rated.select("rating", "n", (F.col("n") / rated.agg(F.sum("n")).scalar()).alias("share")).orderBy("rating")


# ---- table profile ----------------------------------------------------------------


def overview(reviews: DataFrame) -> DataFrame:
    return reviews.agg(F.count("*").alias("reviews"), F.count_distinct(PRODUCT).alias("products"))


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Type, filled values, nulls and sentinels of each column, from one pass."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    each = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.count(c).alias("filled"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.count_if(F.col(c).cast("string") == MISSING).alias("sentinels"),
        )
        for c in columns
    ]
    return df.agg(F.array(*each).alias("each")).select(F.explode("each").alias("p")).select("p.*")


# ---- helpful reviews and frequent terms -------------------------------------------


def helpful_flags(reviews: DataFrame, compat: bool = False) -> DataFrame:
    """``(product, rating, is_helpful)`` for rows whose rating and votes are numbers.

    With ``compat`` the votes must be written as a whole number: ``3.0`` drops the row.
    """
    rating = convert.to_number(F.col("rating").cast("string"))
    written = F.coalesce(F.col("helpful_votes").cast("string"), F.lit("0"))
    votes = convert.to_whole(written)
    if compat:
        votes = F.when(F.regexp_like(written, F.lit(r"^\s*[+-]?\d+\s*$")), votes)
    return reviews.select(PRODUCT, rating.alias("rating"), (votes >= 1).alias("is_helpful")).dropna()


def term_totals(vectors: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of each term over all vectors."""
    totals = vectors.groupBy("idx").agg(F.sum("n").alias("n"))
    return totals.join(terms, "idx").select("idx", "term", "n")


def top_terms(totals: DataFrame, n: int = 10) -> DataFrame:
    return totals.orderBy(F.desc("n"), "idx").limit(n)


def helpful_terms(vectors: DataFrame, flags: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of each term, weighted by the helpful reviews of its product.

    Equal to joining vectors with helpful rows one by one, but the helpful rows are counted
    per product first.
    """
    helpful = flags.filter("is_helpful").groupBy(PRODUCT).agg(F.count("*").alias("helpful"))
    weighted = vectors.join(helpful, PRODUCT).groupBy("idx").agg(F.sum(F.col("n") * F.col("helpful")).alias("n"))
    return weighted.join(terms, "idx").select("idx", "term", "n")


def cloud_weights(totals: DataFrame, top: int = CLOUD_TERMS) -> DataFrame:
    """The most frequent terms with weights relative to the first.

    Without any term there is a single row ``empty``.  The list that is gathered has at most
    ``top`` items.
    """
    best = totals.orderBy(F.desc("n"), "idx").limit(top)
    item = F.struct((-F.col("n")).alias("rank"), "idx", "term", "n")
    listed = best.agg(F.sort_array(F.collect_list(item)).alias("items"))
    stand_in = F.array(F.struct(F.lit(-1), F.lit(0), F.lit("empty"), F.lit(1)))
    items = F.when(F.size("items") == 0, stand_in.cast(listed.schema["items"].dataType)).otherwise(F.col("items"))
    rows = listed.select(items.alias("items")).select(F.col("items")[0]["n"].alias("first"), F.explode("items").alias("i"))
    return rows.select("i.term", "i.n", (F.col("i.n") / F.col("first")).alias("weight"))
