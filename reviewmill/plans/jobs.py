"""The three batch jobs: raw files to tables, tables to vectors, vectors to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.convert import parse_timestamp
from reviewmill.functions.tokens import STOPWORDS
from reviewmill.operators import extract, insights, summary, table, validate, vectors, vocabulary
from reviewmill.operators.tokenise import Tokens, coded
from reviewmill.session import stage
from reviewmill.sinks import files
from reviewmill.sources import dictionaries, nested, tagged_text, workbook


def standard_reviews(*typed: DataFrame, compat: bool = False) -> DataFrame:
    """Typed tables to one clean table of strings without duplicates."""
    return table.without_duplicates(table.standard(table.cleaned(table.union_all(*typed), compat)))


def ingest(
    spark: SparkSession,
    folder: str,
    text_pattern: str = "*.txt",
    workbook_pattern: str | None = "*.xlsx",
    compat: bool = False,
) -> DataFrame:
    """Tagged text and workbooks under ``folder`` to the standard review table, staged."""
    parts = []
    if workbook_pattern:
        rows = workbook.read_workbooks(spark, folder, workbook_pattern)
        parts.append(table.typed(workbook.workbook_reviews(rows), missing_flag=None))
    records = tagged_text.read_records(spark, folder, text_pattern)
    parts.append(table.typed(extract.extract_fields(records)))
    return stage(standard_reviews(*parts, compat=compat), "reviews")


def publish(reviews: DataFrame, folder: str) -> bool:
    """Summary CSV and nested JSON of a staged review table; whether the written documents are valid."""
    files.write_summary(summary.product_summary(reviews), f"{folder}/summary")
    files.write_nested(reviews, f"{folder}/nested")
    return validate.verify(nested.read_documents(reviews.sparkSession, f"{folder}/nested"))


def staged_tokens(
    reviews: DataFrame,
    min_reviews: int = summary.MIN_REVIEWS,
    stopwords: list[str] | DataFrame = STOPWORDS,
) -> Tokens:
    """Coded texts and dictionary of the reviews of products with enough texts, written once for all later steps."""
    return coded(reviews, stopwords, at_least=min_reviews)


def vectorise(
    spark: SparkSession,
    nested_path: str,
    folder: str,
    min_reviews: int = summary.MIN_REVIEWS,
    stopwords: list[str] | DataFrame = STOPWORDS,
    low: float = vocabulary.LOW_SHARE,
    high: float = vocabulary.HIGH_SHARE,
    min_count: int = vocabulary.MIN_PAIR_COUNT,
    top: int = vocabulary.TOP_PAIRS,
    boundary: str = "product",
    whole_file: bool = False,
) -> vocabulary.Vocabulary:
    """Nested JSON, by line or with ``whole_file`` one object a file, to vocabulary and vector files."""
    texts = nested.product_texts(nested.read_documents(spark, nested_path, whole_file))
    tokens = staged_tokens(texts, min_reviews, stopwords)
    fitted = vocabulary.fit(tokens, low, high, min_count, top)
    files.write_vocabulary(fitted.terms, f"{folder}/vocabulary")
    found = stage(vectors.count_vectors(tokens, fitted, boundary), "vectors")
    files.write_vectors(found, tokens.texts, f"{folder}/vectors")
    return fitted


def typed_again(standard: DataFrame) -> DataFrame:
    """Figures, flags and times of a standard table of strings, for the reports."""
    flag = F.lower("is_verified_purchase")
    return standard.withColumns(
        {
            "rating": table.convert.to_number(F.col("rating")),
            "helpful_votes": table.convert.to_whole(F.col("helpful_votes")),
            "is_verified_purchase": F.when(flag == "true", True).when(flag == "false", False),
            "review_timestamp": parse_timestamp(F.col("review_timestamp")),
        }
    )


def explore(
    spark: SparkSession,
    nested_path: str,
    vocabulary_path: str,
    vectors_path: str,
    compat: bool = False,
    whole_file: bool = False,
) -> dict[str, DataFrame]:
    """The reports over the files of the first two jobs, by name."""
    flat = stage(nested.flatten(nested.read_documents(spark, nested_path, whole_file)), "flat")
    typed = typed_again(flat)
    terms = dictionaries.read_vocabulary(spark, vocabulary_path)
    long = dictionaries.read_vectors(spark, vectors_path)
    flags = insights.helpful_flags(flat, compat)
    return {
        "overview": insights.overview(flat),
        "profile": insights.profile(typed),
        "rating_share": insights.rating_share(typed),
        "weekdays": insights.weekday_counts(typed, F.col("review_timestamp")),
        "length_by_rating": insights.length_by_rating(typed),
        "length_density": insights.length_density(typed),
        "years": insights.yearly_counts(typed, F.col("review_timestamp")),
        "votes_by_length": insights.votes_by_length(typed),
        "length_votes_correlation": insights.length_votes_correlation(typed),
        "helpful_flags": flags,
        "cloud": insights.cloud_weights(insights.helpful_terms(long, flags, terms)),
        "top_terms": insights.top_terms(insights.term_totals(long, terms)),
    }
