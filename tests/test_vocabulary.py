import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import TYPES, brute_vocabulary, random_texts, token_list
from pyspark.sql import functions as F

from reviewmill.catalog import corpus
from reviewmill.functions.tokens import STOPWORDS, split_words
from reviewmill.operators import insights, membership, summary, tokenise, vectors, vocabulary
from reviewmill.operators.membership import member_test
from reviewmill.operators.ranges import places, quantiles
from reviewmill.operators.tokenise import coded, review_tokens, term_counts, without_stopwords, word_code

LOW, HIGH, FLOOR, TOP = 0.3, 0.95, 2, 5


@pytest.fixture(scope="module")
def rows():
    # Two rare words make the band matter; one product has no tokens at all.
    return random_texts(400) + [("p1", 7 << 21, "zebra zebra crossing"), ("empty", 8 << 21, "1 2 3")]


@pytest.fixture(scope="module")
def tokens(spark, rows):
    return coded(spark.createDataFrame(rows, TYPES))


@pytest.fixture(scope="module")
def fitted(tokens):
    return vocabulary.fit(tokens, LOW, HIGH, FLOOR, TOP)


def test_against_brute_force(tokens, fitted, rows):
    band, pairs, best, terms, expected = brute_vocabulary(rows, LOW, HIGH, FLOOR, TOP)
    assert {r.term for r in fitted.unigrams.collect()} == band
    assert {r.term for r in fitted.pairs.collect()} == set(best)
    assert {r.term: r.idx for r in fitted.terms.collect()} == terms
    found = {}
    for r in vectors.count_vectors(tokens, fitted).collect():
        found.setdefault(r.parent_product_id, {})[r.idx] = r.n
    assert found == {p: v for p, v in expected.items() if v}
    lines = {r.parent_product_id: r.line for r in vectors.vector_lines(vectors.count_vectors(tokens, fitted), tokens.texts).collect()}
    assert lines["empty"] == "empty,"
    assert lines["p0"] == "p0," + ",".join(f"{i}:{n}" for i, n in sorted(expected["p0"].items()))


def test_pairs_after_other_words_are_removed(tokens, fitted, rows):
    pairs = brute_vocabulary(rows, LOW, HIGH, FLOOR, TOP)[1]
    found = {(r.w1, r.w2): r.n for r in vocabulary.pair_counts(tokens, fitted.unigrams).collect()}
    assert found == pairs


@pytest.mark.parametrize("listed, bits", [(200, 64), (3, 64), (0, 2), (0, 8)])
def test_members_are_told_apart_exactly(spark, monkeypatch, listed, bits):
    """Few bits and no list make many strays and a long cascade."""
    monkeypatch.setattr(membership, "LISTED", listed)
    monkeypatch.setattr(membership, "BITS", bits)
    codes = spark.range(3000).select(F.xxhash64("id").alias("code"), (F.col("id") % 7 == 0).alias("inside"))
    is_member = member_test(codes.filter("inside"), codes.filter("NOT inside"))
    assert codes.filter(is_member(F.col("code")) != F.col("inside")).count() == 0
    listed = codes.agg(F.collect_list("code").alias("codes")).select(F.size(F.filter("codes", is_member)))
    assert listed.first()[0] == codes.filter("inside").count()


def test_membership_in_empty_sets(spark):
    codes = spark.range(500).select(F.col("id").alias("code"))
    for inside in (codes.limit(0), codes):
        is_member = member_test(inside, codes.join(inside, "code", "left_anti"))
        assert codes.filter(is_member(F.col("code"))).count() == inside.count()


def test_words_that_share_a_code_are_coded_afresh(spark):
    def short(word, seed=0):
        return F.length(word).cast("long") if seed < 2 else word_code(word, seed)

    rows = [("p", 1, "red glue"), ("p", 2, "dry tape dry")]
    found = coded(spark.createDataFrame(rows, TYPES), code=short)
    words = {r.code: r.word for r in found.words.collect()}
    texts = {r.seq: [words[c] for c in r.codes] for r in found.texts.collect()}
    assert texts == {1: ["red", "glue"], 2: ["dry", "tape", "dry"]}


def test_no_python_over_the_texts(tokens, fitted):
    """Stemming is done on the dictionary; later plans have no Python step."""
    for df in (vocabulary.pair_counts(tokens, fitted.unigrams), vectors.count_vectors(tokens, fitted), term_counts(tokens)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan and "Python" not in plan


def test_band_edges(spark):
    rows = [(f"p{i}", i, ("common " if i < 19 else "") + ("edge" if i == 0 else "other")) for i in range(20)]
    tokens = coded(spark.createDataFrame(rows, TYPES))
    kept = {r.term for r in vocabulary.band_terms(tokens).collect()}
    assert "edg" in kept  # in exactly 5 % of the products
    assert "common" not in kept  # in exactly 95 %


def test_places_are_those_of_a_sort(spark):
    words = sorted({f"{a}{b}{c}" for a in ("", "a", "ab", "b") for b in ("_x", "y", "zz") for c in ("", "q", "r_s")})
    df = spark.createDataFrame([(w,) for w in words], "term string").repartition(7)
    assert [r.term for r in places(df, "term").orderBy("idx").collect()] == words
    assert sorted(r.idx for r in places(df, "term").collect()) == list(range(len(words)))


def test_result_does_not_depend_on_partitions(spark, rows, fitted):
    other = coded(spark.createDataFrame(rows, TYPES).repartition(13))
    again = vocabulary.fit(other, LOW, HIGH, FLOOR, TOP)
    assert sorted(fitted.terms.collect()) == sorted(again.terms.collect())


def test_boundary_inside_reviews_only(spark):
    rows = [("p", 1, "red glue"), ("p", (1 << 20) + 1, "tape dry"), ("q", 3, "glue tape"), ("q", 4, "glue tape")]
    tokens = coded(spark.createDataFrame(rows, TYPES))
    fitted = vocabulary.fit(tokens, 0.0, 2.0)
    glue_tape = fitted.terms.filter("term = 'glue_tape'").first().idx
    count = {b: {r.parent_product_id: r.n for r in vectors.count_vectors(tokens, fitted, b).filter(F.col("idx") == glue_tape).collect()}
             for b in ("product", "review")}
    assert count == {"product": {"p": 1, "q": 2}, "review": {"q": 2}}


def test_stopwords_from_table(spark, rows):
    rows = [*rows, ("p1", -1, None), ("p1", -2, ""), ("p1", -3, "the and")]
    reviews = spark.createDataFrame(rows, TYPES)
    words = spark.createDataFrame([(w,) for w in STOPWORDS], "word string")
    expected = sorted((r[0], r[1], token_list(r[2] or "")) for r in rows)
    assert sorted(map(tuple, review_tokens(reviews, STOPWORDS).collect())) == expected
    assert sorted(map(tuple, review_tokens(reviews, words).collect())) == expected
    left = without_stopwords(spark.createDataFrame([("the",), ("glue",), ("glue",)], "word string"), words)
    assert [r.word for r in left.collect()] == ["glue", "glue"]


def test_vector_counts_add_up_to_tokens(tokens, fitted):
    single = fitted.terms.filter(~F.contains("term", F.lit("_")))
    total = vectors.count_vectors(tokens, fitted).join(single, "idx").agg(F.sum("n")).first()[0]
    assert total == term_counts(tokens).join(fitted.unigrams, "term", "left_semi").agg(F.sum("n")).first()[0]


def test_helpful_terms_equal_the_row_by_row_join(spark, tokens, fitted):
    flags = spark.createDataFrame([("p0", 5.0, True), ("p0", 4.0, True), ("p1", 1.0, True), ("p2", 1.0, False)],
                                  "parent_product_id string, rating double, is_helpful boolean")
    found = vectors.count_vectors(tokens, fitted)
    naive = found.join(flags.filter("is_helpful"), "parent_product_id").groupBy("idx").agg(F.sum("n").alias("n"))
    quick = insights.helpful_terms(found, flags, fitted.terms).select("idx", "n")
    assert sorted(naive.collect()) == sorted(quick.collect())


def test_products_with_enough_texts(spark):
    rows = [("a", i, "x") for i in range(3)] + [("b", 9, "x"), ("b", 10, "None"), ("b", 11, "x"), ("c", 12, None)]
    df = spark.createDataFrame(rows, TYPES)
    assert [tuple(r) for r in summary.frequent_products(df, 3).collect()] == [("a", 3)]
    assert summary.qualified_reviews(df, 2).count() == 5
    counts = {r.parent_product_id: (r.review_count, r.review_text_count) for r in summary.product_summary(df).collect()}
    assert counts == {"a": (3, 3), "b": (3, 2), "c": (1, 0)}


def test_places_of_words_with_a_common_beginning_are_shared_out(spark):
    words = spark.range(20_000).select(F.concat(F.lit("https://www."), F.lpad("id", 6, "0")).alias("term"))
    found = places(words.repartition(8), "term")
    assert found.filter("term <> concat('https://www.', lpad(idx, 6, '0'))").count() == 0
    sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 20_000


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_quantiles_are_exact(spark, share):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 5 < 4, F.col("id") % 5).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("v"), (1 + F.col("id") % 3).alias("n")
    )
    rows = rows.union(spark.sql("SELECT 2L, CAST(NULL AS long), 5L")).groupBy("g", "v").agg(F.sum("n").alias("n"))
    want = {r.g: r.q for r in rows.groupBy("g").agg(F.percentile("v", share, F.col("n")).alias("q")).collect()}
    found = {r.g: r.quantile for r in quantiles(rows, ["g"], "v", "n", share).collect()}
    assert found.keys() == want.keys() and all(abs(found[g] - want[g]) < 1e-3 for g in want)
    whole = rows.groupBy("v").agg(F.sum("n").alias("n"))
    assert abs(quantiles(whole, [], "v", "n", share).first()[0] - whole.agg(F.percentile("v", share, F.col("n"))).first()[0]) < 1e-3


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, v int, n int")
    assert quantiles(empty, ["g"], "v", "n", 0.5).count() == 0
    assert quantiles(empty, [], "v", "n", 0.5).first()[0] is None


def test_best_pairs_are_found_among_rare_terms_first(spark, monkeypatch):
    monkeypatch.setattr(vocabulary, "FIRST_SHARE", 0.5)
    counted = []
    plain = vocabulary.pair_counts
    monkeypatch.setattr(vocabulary, "pair_counts", lambda *a: counted.append(a) or plain(*a))
    rows = [(f"p{i % 7}", i, f"filler{i % 5} word{i % 11} " + (f"rare{i % 40}x next{i % 40}x" if i < 80 else "")) for i in range(300)]
    tokens = coded(spark.createDataFrame(rows, TYPES))
    terms = vocabulary.in_band(vocabulary.term_frequency(term_counts(tokens)), tokens, 0.0, 2.0)
    every = plain(tokens, terms).localCheckpoint()
    for top in (3, 4000):  # the last one is more than there are, so all pairs are needed
        found = [tuple(r) for r in vocabulary.best_pairs(tokens, terms, 2, top).orderBy("term").collect()]
        assert found == [tuple(r) for r in vocabulary.top_pairs(every, terms, 2, top).orderBy("term").collect()]
    assert len(counted[-1]) == 2 and any(len(a) == 3 for a in counted)


def test_maps_are_not_sent_number_by_number(spark, monkeypatch):
    plain = F.lit

    def lit(value):
        assert not isinstance(value, np.ndarray)
        return plain(value)

    monkeypatch.setattr(membership.F, "lit", lit)
    codes = spark.range(4000).select(F.xxhash64("id").alias("code"), (F.col("id") % 3 == 0).alias("inside"))
    is_member = member_test(codes.filter("inside"), codes.filter("NOT inside"))
    assert codes.filter(is_member(F.col("code")) != F.col("inside")).count() == 0


def test_products_are_counted_as_texts_are_coded(spark):
    rows = [("a", 1, "red glue"), ("a", 2, "1 2"), ("a", 3, "none"), ("a", 4, None), ("b", 5, "dry tape"), ("b", 6, "None")]
    df = spark.createDataFrame(rows, TYPES)
    for stopwords in (STOPWORDS, spark.createDataFrame([(w,) for w in STOPWORDS], "word string")):
        found = coded(df, stopwords, at_least=2)
        words = {r.code: r.word for r in found.words.collect()}
        assert {r.seq: [words[c] for c in r.codes] for r in found.texts.collect()} == {1: ["red", "glue"], 2: []}
        assert {(words[r.code], r.n) for r in found.counts.collect()} == {("red", 1), ("glue", 1)}


def test_words_of_texts_that_are_read_together():
    rnd = random.Random(3)
    bits = ["abc", "the", "x", "é", "ab", " ", "1", "\n", "zzzz", "and", "日本", "glue", "", ">", "foo-bar"]
    for n in [*range(40)] * 3:
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(7))) for _ in range(n)]
        array = pa.array(["left out", *texts, "left out"], pa.string()).slice(1, n)
        words, new = split_words(array, pa.array(STOPWORDS))
        expected = [[w for w in re.findall("[a-z]{3,}", text) if w not in STOPWORDS] for text in texts]
        assert words.to_pylist() == expected
        assert sorted(new.to_pylist()) == sorted({w for found in expected for w in found})


def test_words_are_not_written_text_by_text(spark, monkeypatch):
    """The staged texts hold codes; a word comes once for the texts that are read together, however they are cut."""
    rows = [(f"p{i % 3}", i, "red glue red glue" if i % 5 else None) for i in range(200)]
    staged = []
    plain = tokenise.stage
    monkeypatch.setattr(tokenise, "stage", lambda df, label: staged.append(plain(df, label)) or staged[-1])
    coded(spark.createDataFrame(rows, TYPES).coalesce(1), at_least=2)
    assert staged[0].agg(F.sum(F.size("new"))).first()[0] == 2 and staged[0].agg(F.sum(F.size("codes"))).first()[0] == 640
    monkeypatch.setattr(tokenise, "SLICE_BYTES", 40)
    found = coded(spark.createDataFrame(rows, TYPES).coalesce(1), at_least=2)
    words = {r.code: r.word for r in found.words.collect()}
    assert {r.seq: [words[c] for c in r.codes] for r in found.texts.collect()} == {i: ["red", "glue"] * 2 for i in range(200) if i % 5}


def test_texts_are_shared_out_by_product(spark, tmp_path, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'word glue tape' AS text", "'en' AS lang", "concat('s', id % 7) AS source", "5 AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus.reviews(spark, str(tmp_path), flags=False, by_product=True).select("parent_product_id", F.spark_partition_id().alias("task"))
    assert rows.count() == 3000
    assert rows.groupBy("parent_product_id").agg(F.count_distinct("task").alias("n")).filter("n > 1").isEmpty()


def test_dictionary_meets_the_terms_once(tokens, fitted, monkeypatch):
    staged = []
    plain = vocabulary.stage
    monkeypatch.setattr(vocabulary, "stage", lambda df, label: staged.append(label) or plain(df, label))
    rare = fitted.unigrams.filter("n < 300")
    found = {(r.w1, r.w2): r.n for r in vocabulary.pair_counts(tokens, fitted.unigrams, rare).collect()}
    kept = {r.term for r in rare.collect()}
    every = {(r.w1, r.w2): r.n for r in vocabulary.pair_counts(tokens, fitted.unigrams).collect()}
    assert found == {p: n for p, n in every.items() if kept.issuperset(p)}
    assert staged == ["band", "band"]


def test_pairs_are_sifted_before_the_join(spark, tokens, fitted):
    """Pairs whose first word begins no wanted pair do not come to the join; all others do."""
    codes = spark.range(20_000).select(F.xxhash64("id").alias("code"), (F.col("id") % 100 == 0).alias("inside"))
    is_likely = membership.likely_test(codes.filter("inside"))
    assert codes.filter("inside").filter(~is_likely(F.col("code"))).count() == 0
    assert codes.filter("NOT inside").filter(is_likely(F.col("code"))).count() < 20_000 / 30
    assert codes.filter(membership.likely_test(codes.limit(0))(F.col("code"))).count() == 0
    plan = vectors.count_vectors(tokens, fitted)._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftrightunsigned" in plan.lower() or ">>>" in plan


@pytest.mark.parametrize("together", [2_000_000, 3])
def test_a_task_writes_a_word_and_its_counts_once(spark, monkeypatch, together):
    """However small the parts that are split at once; counts that do not fit come in several rows and are the same."""
    rows = [(f"p{i % 3}", i, ("red glue red glue", None, "none", "tape")[i % 4]) for i in range(200)]
    staged = []
    plain = tokenise.stage
    monkeypatch.setattr(tokenise, "stage", lambda df, label: staged.append(plain(df, label)) or staged[-1])
    monkeypatch.setattr(tokenise, "SLICE_BYTES", 40)
    monkeypatch.setattr(tokenise, "COUNTED_TOGETHER", together)
    for at_least in (0, 2):
        staged.clear()
        found = coded(spark.createDataFrame(rows, TYPES).coalesce(1), at_least=at_least)
        expected = {}
        for product, _, text in rows:
            for word in (text or "").split():
                if word != "none" or not at_least:
                    expected[product, word] = expected.get((product, word), 0) + 1
        words = {r.code: r.word for r in found.words.collect()}
        assert {(r.parent_product_id, words[r.code]): r.n for r in found.counts.collect()} == expected
        assert found.texts.count() == (100 if at_least else 200)
        assert staged[0].agg(F.sum(F.size("new"))).first()[0] == 4
        if together > 3:
            assert staged[0].agg(F.sum(F.size("counted"))).first()[0] == len(expected)


def test_maps_do_not_stay_in_later_plans(tokens, fitted):
    """Spark goes through the whole plan again after each shuffle, so pairs are written before they are joined."""
    for among in (None, fitted.unigrams.filter("n < 300")):
        plan = vocabulary.pair_counts(tokens, fitted.unigrams, among)._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "getbit" not in plan and "bit_get" not in plan and "shiftrightunsigned" not in plan and ">>>" not in plan
