"""The one-pass tag scan against the field patterns, field by field."""

import random

from pyspark.sql import functions as F

from reviewmill.operators import extract
from reviewmill.schema import REVIEW_COLUMNS

PARTS = [
    "<category>", "</category>", "< //Category >", "<///category>", "</ category>", "<text>", "</text>", "<revie_text>", "< /Review Text>",
    "<review_title>", "</Heading>", "<heading >", "<rate>", "</Rating>", "<rating>", "<likes>", "</vote>", "<helpful votes>", "<productID>",
    "<product_id>", "</parent_product_id>", "<parentPRODUCTID>", "<time>", "< / review_timestamp>", "<liKes>", "</liKes>",
    "<veriﬁed_purchase>", "<is verified_purchase>", "</VERIFIED_PURCHASE>", "<reviewer id>", "</REVIEWER_ID>", "<pics>", "</PICTURES>",
]
FILL = ["x", " ", "\n", "a b", " ", " y", "<br>", "<", ">", "é", "\r\n", "\t", "", "", "a\nb"]


def random_records(n, seed):
    rnd = random.Random(seed)
    few = rnd.sample(PARTS, 6)
    return ["".join(rnd.choice(PARTS if rnd.random() < 0.3 else few) + rnd.choice(FILL) for _ in range(rnd.randrange(14))) for _ in range(n)]


def test_values_and_counts_are_those_of_the_patterns(spark):
    texts = [t for seed in range(40) for t in random_records(50, seed)]
    df = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "seq long, record string").repartition(4)
    found = {r.seq: r for r in extract.extract_fields(df).collect()}
    by_pattern = [F.regexp_extract_all("record", F.lit(extract.field_pattern(c)), 1).alias(c) for c in REVIEW_COLUMNS]
    hits = dict.fromkeys(REVIEW_COLUMNS, 0)
    without = dict.fromkeys(REVIEW_COLUMNS, 0)
    some = 0
    for r in df.filter("record IS NOT NULL").select("seq", "record", *by_pattern).collect():
        for c in REVIEW_COLUMNS:
            assert found[r.seq][c] == (r[c][0] if r[c] else None), (c, r.record)
            hits[c] += len(r[c])
            without[c] += not r[c]
            some += bool(r[c])
    assert some > 500
    assert all(found[len(texts)][c] is None for c in REVIEW_COLUMNS)
    known = df.filter("record IS NOT NULL")
    assert {r.field: r.hits for r in extract.match_counts(known).collect()} == hits
    assert {r.field: r.unmatched for r in extract.unmatched_counts(known).collect()} == without


def test_first_of_several_and_columns_of_any_name(spark):
    text = "<rating>no\nline</rating><rating> 4 </rating><rating>5</rating><text>a<b<text>c</text>"
    df = spark.createDataFrame([(1, text, 2, 3)], "seq long, record string, found int, tags int")
    row = extract.extract_fields(df, "none").first()
    assert (row.rating, row.review_text, row.category) == ("4", "a<b", "none")


def test_plan_scans_each_record_twice(spark):
    df = spark.createDataFrame([(1, "x")], "seq long, record string")
    plan = extract.extract_fields(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(record") == 1 and plan.count("split(record") == 1
