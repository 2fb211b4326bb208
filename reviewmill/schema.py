"""Data model: the review table, its nested form and row order.

Row order is explicit.  Every review row carries ``seq``, a bigint that is
unique within its product and rises in input order.  ``seq >> RUN_BITS`` names
the *run* a row lies in.  A (product, run) group can never hold more than
``2 ** RUN_BITS`` rows, so every ordered operator works run by run and then
stitches the runs together; no product is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT = "parent_product_id"
SEQ = "seq"
MISSING = "none"
RUN_BITS = 20

# Names and order of the eleven review fields.
REVIEW_COLUMNS = [
    "category",
    "reviewer_id",
    "rating",
    "review_title",
    "review_text",
    "attached_images",
    "product_id",
    "parent_product_id",
    "review_timestamp",
    "is_verified_purchase",
    "helpful_votes",
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Inside a nested product document the key column is gone.
NESTED_KEYS = [c for c in REVIEW_COLUMNS if c != PRODUCT]

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in REVIEW_COLUMNS]
    + [T.StructField(SEQ, T.LongType(), False)]
)

NESTED_REVIEW = T.StructType([T.StructField(c, T.StringType()) for c in NESTED_KEYS])

NESTED_DOCUMENT = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("reviews", T.ArrayType(NESTED_REVIEW)),
        ]
    ),
)

# Sources are ordered by a number in the top bits of ``seq``:
# workbook rows come before tagged-text rows.
SOURCE_SHIFT = 58
WORKBOOK_SOURCE = 0
TEXT_SOURCE = 1


def scan_seq(source: int) -> Column:
    """Row number in scan order, placed after all rows of earlier sources."""
    return F.lit(source << SOURCE_SHIFT) + F.monotonically_increasing_id()


def run_of(seq: str = SEQ) -> Column:
    return F.shiftright(F.col(seq), RUN_BITS)
