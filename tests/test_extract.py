import pytest
from pyspark.sql import functions as F

from reviewmill.operators import extract, table

CASES = [
    ("< Rate> 5.0 < /Rate>", "rating", "5.0"),
    ("<rating>4</Rating>", "rating", "4"),
    ("<likes>3</likes>", "helpful_votes", "3"),
    ("< Helpful_votes>7</helpful_vote>", "helpful_votes", "7"),
    ("<Heading>t</Heading>", "review_title", "t"),
    ("<review_title> a b </ Review_title>", "review_title", "a b"),
    ("<pics>x</pics>", "attached_images", "x"),
    ("<Pictures>x</attached_images>", "attached_images", "x"),
    ("<Date>1588687728923</Date>", "review_timestamp", "1588687728923"),
    ("<review_timestamp>1</time>", "review_timestamp", "1"),
    ("<parentPRODUCTID>b1</parentPRODUCTID>", "parent_product_id", "b1"),
    ("<parentPRODUCTID>b1</parentPRODUCTID>", "product_id", None),
    ("<productID>b2<productID>", "product_id", "b2"),
    ("<revie_text>ok<text>", "review_text", "ok"),
    ("<text>a<br>b</text>", "review_text", "a<br>b"),
    ("<text>a\nb</text>", "review_text", None),
    ("<text>\n a \n</text>", "review_text", "a"),
    ("<text></text>", "review_text", ""),
    ("<text> x </text>", "review_text", "x"),
    ("<Reviewer id>r< / reviewerID>", "reviewer_id", "r"),
    ("</category>c< //CATEGORY >", "category", "c"),
    ("<category>c</ category>", "category", None),
    ("<is_verified_purchase>true</verified purchase>", "is_verified_purchase", "true"),
    ("<rating>5<rating>", "rating", None),
]


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(CASES)]
    return {r["seq"]: r for r in extract.extract_fields(spark.createDataFrame(rows, "seq long, record string")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_tag_spellings(extracted, i):
    _, field, value = CASES[i]
    assert extracted[i][field] == value


def test_tag_inventory_and_counts(spark):
    records = spark.createDataFrame(
        [
            (1, "<category>a</category><productID>1</productID><parent_product_id>2</parent_product_id>"),
            (2, "<category>b< /category><text>x</text><text>y</text>"),
        ],
        "seq long, record string",
    )
    variants = {(r.field, r.tag): r.n for r in extract.tag_variants(records).collect()}
    assert variants[("category", "<category>")] == 2
    assert variants[("category", "< /category>")] == 1  # only tags that start with "</" are left out
    assert ("category", "</category>") not in variants
    assert ("product_id", "<parent_product_id>") not in variants
    assert variants[("review_text", "<text>")] == 2
    counts = {r.field: (r.hits, r.records) for r in extract.match_counts(records).collect()}
    assert counts["review_text"] == (2, 2)
    assert counts["category"] == (2, 2)
    missing = {r.field: r.unmatched for r in extract.unmatched_counts(records).collect()}
    assert missing["review_text"] == 1 and missing["rating"] == 2
    assert [r.seq for r in extract.first_unmatched(records, "review_text").collect()] == [1]


def test_typed_and_standard(spark):
    raw = spark.createDataFrame(
        [("C", "u", " 4.5 ", "", "Text <b>x</b>", None, "P", "Q", "1588687728923", " TRUE ", "3", 1),
         ("C", "u", "five", "t", "<br/>", "none", "P", "Q", "soon", "yes", None, 2)],
        "category string, reviewer_id string, rating string, review_title string, review_text string, attached_images string,"
        "product_id string, parent_product_id string, review_timestamp string, is_verified_purchase string, helpful_votes string, seq long",
    )
    rows = table.standard(table.cleaned(table.typed(raw))).orderBy("seq").collect()
    assert rows[0].asDict() == {
        "category": "c", "reviewer_id": "u", "rating": "4.5", "review_title": "none", "review_text": "text x",
        "attached_images": "none", "product_id": "p", "parent_product_id": "q", "review_timestamp": "2020-05-05 14:08:48",
        "is_verified_purchase": "True", "helpful_votes": "3", "seq": 1,
    }
    assert (rows[1].rating, rows[1].review_text, rows[1].review_timestamp) == ("none", "none", "none")
    assert (rows[1].is_verified_purchase, rows[1].helpful_votes) == ("False", "none")
    assert extract.extract_or_missing(raw.select("seq", F.lit("").alias("record"))).first().rating == "none"


def test_missing_text_in_compatible_mode(spark):
    df = spark.createDataFrame([(None, 1)], "review_text string, seq long")
    assert table.cleaned(df).first().review_text is None
    assert table.cleaned(df, compat=True).first().review_text == "nan"


def test_dedup_keeps_first_and_is_idempotent(spark):
    rows = [("A", 5), ("a", 3), ("b", 9), ("a", 1)]
    df = spark.createDataFrame(rows, "review_text string, seq long").withColumn("review_text", F.lower("review_text"))
    once = table.without_duplicates(df, ["review_text"])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 9)]
    assert sorted(map(tuple, table.without_duplicates(once, ["review_text"]).collect())) == [("a", 1), ("b", 9)]
