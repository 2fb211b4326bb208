"""Review tables and tagged text derived from the driver tables, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schema import PRODUCT, REVIEW_COLUMNS, SEQ

MIN_REVIEWS = 20


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str = "documents", shared_out: bool = False) -> DataFrame:
    """A table with long texts.

    The given files have few row groups, and a row group is not divided, so one task would have all the texts.
    ``shared_out`` deals the rows (of the columns that are read) to tasks anew, by size; tables of many row groups need no such shuffle.
    """
    rows = load(spark, folder, name)
    return rows.hint("rebalance") if shared_out else rows


def reviews(
    spark: SparkSession, folder: str, flags: bool = True, shared_out: bool = False, by_product: bool = False
) -> DataFrame:
    """Typed review table: ``documents``, with ``labels`` where the flags are used.

    ``by_product`` deals the rows anew as ``shared_out`` does, but those of a product to few tasks, so that counts by product
    are nearly whole before they are shuffled.  A product with more rows than a task should have is divided.
    """
    docs = texts(spark, folder, shared_out=shared_out).drop("n_chars")
    if flags:
        docs = docs.join(load(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    else:
        docs = docs.withColumn("quality", F.lit(None).cast("int"))
    i = F.col("doc_id")
    start = F.lit("2014-01-01 00:00:00").cast("timestamp")
    rows = docs.select(
        F.col("lang").alias("category"),
        F.concat(F.lit("u"), i % 97).alias("reviewer_id"),
        (1 + i % 5).cast("double").alias("rating"),
        F.substring("text", 1, 20).alias("review_title"),
        F.col("text").alias("review_text"),
        F.lit("none").alias("attached_images"),
        F.concat(F.lit("p"), i % 500).alias("product_id"),
        F.col("source").alias("parent_product_id"),
        F.timestamp_seconds(F.unix_timestamp(start) + (i % 4000) * 79190).alias("review_timestamp"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_verified_purchase"),
        (i % 4).alias("helpful_votes"),
        i.alias(SEQ),
    )
    return rows.hint("rebalance", PRODUCT) if by_product else rows


REVIEWS_SQL = """
rv AS (
  SELECT d.lang AS category,
         'u' || (d.doc_id % 97) AS reviewer_id,
         CAST(1 + d.doc_id % 5 AS DOUBLE) AS rating,
         left(d.text, 20) AS review_title,
         d.text AS review_text,
         'none' AS attached_images,
         'p' || (d.doc_id % 500) AS product_id,
         d.source AS parent_product_id,
         TIMESTAMP '2014-01-01 00:00:00' + to_seconds((d.doc_id % 4000) * 79190) AS review_timestamp,
         coalesce(l.quality = 1, false) AS is_verified_purchase,
         d.doc_id % 4 AS helpful_votes,
         d.doc_id AS seq
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


# ---- tagged text ------------------------------------------------------------------

# Spellings that take turns: (opening, closing).
SPELLINGS = {
    "category": [("<category>", "</category>"), ("< CATEGORY>", "< //category >"), ("</Category>", "< /CaTEGORY>")],
    "reviewer_id": [("<reviewerID>", "</reviewer_id>"), ("< Reviewer id >", "<reviewerID>"), ("<REVIEWER_ID>", "< / reviewer_id>")],
    "rating": [("<rate>", "</rate>"), ("< Rating>", "< //rating>"), ("<RATE>", "</Rating>")],
    "review_title": [("<heading>", "</heading>"), ("< Review_title>", "</review title>")],
    "review_text": [("<text>", "</text>"), ("<review_text>", "</revie_text>"), ("< Review_Text >", "<text>")],
    "attached_images": [("<pics>", "</pics>"), ("<Pictures>", "< /pictures>"), ("<attached_images>", "</Attached_images>")],
    "product_id": [("<productID>", "</productID>"), ("< product_id>", "<Product_id>")],
    "parent_product_id": [("<parentPRODUCTID>", "</parentPRODUCTID>"), ("<parent_product_id>", "<Parent_product_id>")],
    "review_timestamp": [("<date>", "</date>"), ("<Time>", "</time>"), ("<review_timestamp>", "< /Timestamp>")],
    "is_verified_purchase": [("<verified_purchase>", "</verified_purchase>"), ("< Is_verified_purchase>", "</is_verified_purchase>")],
    "helpful_votes": [("<likes>", "</likes>"), ("<votes>", "</vote>"), ("< Helpful_votes>", "</helpful_vote>")],
}
RECORD_TAGS = [("<record>", "</record>"), ("<RECORD>", "</Record>")]

# Fields left out of some records, by remainder of the row number: (field, divisor, remainder).
LEFT_OUT = [("review_text", 7, 3), ("rating", 11, 5), ("helpful_votes", 13, 1)]


def raw_strings(rv: DataFrame) -> DataFrame:
    """The typed table written as raw strings; times as epoch milliseconds."""
    return rv.withColumns(
        {
            "rating": F.col("rating").cast("string"),
            "review_timestamp": F.unix_millis("review_timestamp").cast("string"),
            "is_verified_purchase": F.col("is_verified_purchase").cast("string"),
            "helpful_votes": F.col("helpful_votes").cast("string"),
        }
    )


RAW_SQL = """
raw AS (
  SELECT category, reviewer_id, CAST(rating AS VARCHAR) AS rating, review_title, review_text, attached_images,
         product_id, parent_product_id, CAST(epoch_ms(review_timestamp) AS VARCHAR) AS review_timestamp,
         CAST(is_verified_purchase AS VARCHAR) AS is_verified_purchase, CAST(helpful_votes AS VARCHAR) AS helpful_votes, seq
  FROM rv
)"""


def tagged(rv: DataFrame, leave_out: bool = False) -> DataFrame:
    """Tagged text with two records per row, as ``(seq, value)``."""
    raw = raw_strings(rv)

    def field(name: str, turn: int):
        n = len(SPELLINGS[name])
        at = ((F.col(SEQ) + turn) % n).cast("int")
        opening = F.get(F.array(*[F.lit(a) for a, _ in SPELLINGS[name]]), at)
        closing = F.get(F.array(*[F.lit(b) for _, b in SPELLINGS[name]]), at)
        text = F.concat(opening, F.lit(" "), F.col(name), closing, F.lit("\n"))
        for left, divisor, remainder in LEFT_OUT if leave_out else []:
            if left == name:
                text = F.when(F.col(SEQ) % divisor == remainder, "").otherwise(text)
        return text

    records = [
        F.concat(F.lit(a + "\n"), *[field(c, turn) for c in REVIEW_COLUMNS], F.lit(b + "\n"))
        for turn, (a, b) in enumerate(RECORD_TAGS)
    ]
    return raw.select(F.col(SEQ).alias("row"), F.concat(*records).alias("value"))


def tagged_sql(leave_out: bool = False) -> str:
    """The same text in SQL: CTE ``rec(seq, record)``, one row per record."""

    def field(name: str) -> str:
        n = len(SPELLINGS[name])
        at = f"((seq + turn) % {n}) + 1"
        opening = "[" + ",".join(f"'{a}'" for a, _ in SPELLINGS[name]) + f"][{at}]"
        closing = "[" + ",".join(f"'{b}'" for _, b in SPELLINGS[name]) + f"][{at}]"
        text = f"{opening} || ' ' || {name} || {closing} || chr(10)"
        for left, divisor, remainder in LEFT_OUT if leave_out else []:
            if left == name:
                text = f"CASE WHEN seq % {divisor} = {remainder} THEN '' ELSE {text} END"
        return f"({text})"

    body = " || ".join(field(c) for c in REVIEW_COLUMNS)
    return f"""
rec AS (
  SELECT seq * 2 + turn AS seq, chr(10) || {body} AS record
  FROM raw, (VALUES (0), (1)) t(turn)
)"""
