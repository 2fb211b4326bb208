import math
import statistics

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import insights, preview

REVIEWS = [(float(1 + i % 3), " ".join(["word"] * (1 + (i * i) % 17)), i % 4, f"p{i % 5}", i) for i in range(60)]


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(
        REVIEWS, "rating double, review_text string, helpful_votes long, parent_product_id string, seq long"
    )


def cut(values, share):
    values = sorted(values)
    at = (len(values) - 1) * share
    low = math.floor(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


def test_cutoff_and_lengths(reviews):
    lengths = [len(t.split()) for _, t, _, _, _ in REVIEWS]
    limit = cut(lengths, 0.95)
    assert insights.length_cutoff(insights.length_histogram(reviews)).first().cutoff == pytest.approx(limit)
    for row in insights.length_by_rating(reviews).collect():
        kept = [len(t.split()) for r, t, _, _, _ in REVIEWS if r == row.rating and len(t.split()) <= limit]
        assert (row.reviews, row.min_length, row.max_length) == (len(kept), min(kept), max(kept))
        assert row.mean_length == pytest.approx(statistics.mean(kept))
        assert row.median_length == statistics.median(kept)


def test_density(reviews):
    lengths = [(r, len(t.split())) for r, t, _, _, _ in REVIEWS]
    limit = cut([n for _, n in lengths], 0.95)
    rows = insights.length_density(reviews, points=50).orderBy("rating", "point").collect()
    for rating in (1.0, 2.0, 3.0):
        kept = [n for r, n in lengths if r == rating and n <= limit]
        width = statistics.stdev(kept) * len(kept) ** -0.2
        mine = [r for r in rows if r.rating == rating]
        assert len(mine) == 50
        assert mine[0].x == pytest.approx(min(kept) - 3 * width) and mine[-1].x == pytest.approx(max(kept) + 3 * width)
        x = mine[20].x
        density = sum(math.exp(-0.5 * ((x - n) / width) ** 2) for n in kept) / (len(kept) * width * math.sqrt(2 * math.pi))
        assert mine[20].density == pytest.approx(density)
        area = sum(r.density for r in mine) * (mine[1].x - mine[0].x)
        assert area == pytest.approx(1, abs=0.01)


def test_weekdays_and_years(spark):
    stamps = [("2020-05-05 00:00:00",), ("2020-05-05 10:00:00",), ("2021-05-09 00:00:00",), (None,)]
    df = spark.createDataFrame(stamps, "t string").withColumn("t", F.col("t").cast("timestamp"))
    week = [(r.weekday, r.n) for r in insights.weekday_counts(df, F.col("t")).collect()]
    assert week == [("Monday", None), ("Tuesday", 2), ("Wednesday", None), ("Thursday", None), ("Friday", None),
                    ("Saturday", None), ("Sunday", 1)]
    assert [tuple(r) for r in insights.yearly_counts(df, F.col("t")).collect()] == [(2020, 2), (2021, 1)]


@pytest.mark.parametrize("votes,kept", [("3", 2), ("3.0", 1), ("x", 1), (None, 2), (" 4 ", 2)])
def test_helpful_flags_compatible(spark, votes, kept):
    df = spark.createDataFrame([("p", "5.0", votes), ("p", "4.0", "0"), ("p", "none", "1")],
                               "parent_product_id string, rating string, helpful_votes string")
    assert insights.helpful_flags(df, compat=True).count() == kept
    plain = insights.helpful_flags(df).collect()
    assert len(plain) == (1 if votes == "x" else 2)
    assert any(r.is_helpful for r in plain) == (votes in ("3", "3.0", " 4 "))


def test_votes_by_length(spark):
    rows = [("a" * 10, 1), ("a" * 20, None), ("a" * 600, 4), (None, 2)]
    df = spark.createDataFrame(rows, "review_text string, helpful_votes long")
    found = {r.from_length: (r.reviews, r.mean_votes, r.median_votes, r.max_votes) for r in insights.votes_by_length(df).collect()}
    assert found == {0: (3, 1.0, 1.0, 2), 500: (1, 4.0, 4.0, 4)}
    assert insights.length_votes_correlation(df).first().reviews == 4


def test_shares_profile_overview(spark):
    df = spark.createDataFrame([(5.0, "none"), (5.0, "x"), (1.0, None), (None, "none")], "rating double, t string")
    assert [(r.rating, r.n, r.share) for r in insights.rating_share(df).collect()] == [(1.0, 1, 1 / 3), (5.0, 2, 2 / 3)]
    rows = {r.column: (r.type, r.filled, r.nulls, r.sentinels) for r in insights.profile(df).collect()}
    assert rows == {"rating": ("double", 3, 1, 0), "t": ("string", 3, 1, 2)}


def test_cloud(spark):
    totals = spark.createDataFrame([(0, "a", 4), (1, "b", 8), (2, "c", 8)], "idx long, term string, n long")
    assert [tuple(r) for r in insights.cloud_weights(totals, 2).collect()] == [("b", 8, 1.0), ("c", 8, 1.0)]
    assert [tuple(r) for r in insights.cloud_weights(totals.filter("n < 0")).collect()] == [("empty", 1, 1.0)]
    assert [r.term for r in insights.top_terms(totals, 2).collect()] == ["b", "c"]


def test_previews(reviews):
    assert [(r.parent_product_id, r.seq) for r in preview.preview(reviews).orderBy("parent_product_id", "seq").collect()] == [
        ("p0", 0), ("p0", 5), ("p1", 1), ("p1", 6)]
    assert preview.first_per_product(reviews, 3).count() == 15
    assert [r.seq for r in preview.first_rows(reviews, 2).collect()] == [0, 1]
    assert preview.sample_rows(reviews, 5, seed=1).count() == 5
    plan = preview.first_per_product(reviews)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # hot products are cut before the shuffle
