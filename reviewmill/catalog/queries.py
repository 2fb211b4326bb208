"""Registered queries: each takes ``(spark, folder)`` and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.catalog.corpus import MIN_REVIEWS, load, raw_strings, reviews, tagged, texts
from reviewmill.functions import clean, convert
from reviewmill.functions import tokens as tk
from reviewmill.operators import extract, insights, nest, preview, summary, table, tokenise, validate, vectors, vocabulary
from reviewmill.plans.jobs import staged_tokens
from reviewmill.schema import PRODUCT, REVIEW_COLUMNS, RUN_BITS, SEQ
from reviewmill.session import new_folder, stage
from reviewmill.sinks import files
from reviewmill.sources import dictionaries, nested, tagged_text

REGISTRY: dict = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def _bigints(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _cleaned(spark: SparkSession, folder: str, flags: bool = False) -> DataFrame:
    return table.cleaned(reviews(spark, folder, flags, shared_out=True))


def _standard(spark: SparkSession, folder: str, flags: bool = False) -> DataFrame:
    """The standard table; ``flags`` where a query shows or compares them."""
    return table.standard(_cleaned(spark, folder, flags))


def _records(spark: SparkSession, folder: str, leave_out: bool = False) -> DataFrame:
    found = tagged_text.split_records(tagged(reviews(spark, folder, shared_out=True), leave_out))
    return found.select((F.col("row") * 2 + F.col("pos")).alias(SEQ), "record")


def _tokens(spark: SparkSession, folder: str) -> tokenise.Tokens:
    rows = reviews(spark, folder, flags=False, by_product=True).select(*REVIEW_COLUMNS, SEQ)
    return staged_tokens(table.standard(table.cleaned(rows)).select(PRODUCT, SEQ, "review_text"), MIN_REVIEWS)


# ---- summaries --------------------------------------------------------------------


@query
def summary_counts(spark, folder):
    return summary.product_summary(_standard(spark, folder)).orderBy(PRODUCT)


@query
def having_min_reviews(spark, folder):
    return summary.frequent_products(_standard(spark, folder), MIN_REVIEWS)


@query
def semi_qualified(spark, folder):
    kept = summary.qualified_reviews(_standard(spark, folder), MIN_REVIEWS)
    return kept.select(SEQ, PRODUCT, F.length("review_text").cast("bigint").alias("text_length"))


# ---- cleaning and conversion ------------------------------------------------------


@query
def clean_text(spark, folder):
    docs = texts(spark, folder, shared_out=True).select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), "text")
    pages = texts(spark, folder, "pages", shared_out=True).select(F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.col("html").alias("text"))
    marked = F.concat(F.lit("☕<b>"), "text", F.lit("</b>\U0001f603 ok\U0001f1e6"))
    return docs.unionByName(pages).select(
        "kind",
        "id",
        convert.filled(clean.english_or_missing(clean.clean_review(F.col("text")))).alias("cleaned"),
        F.length(clean.strip_emoji(marked)).cast("bigint").alias("without_emoji"),
        clean.is_ascii(F.col("text")).alias("ascii"),
    )


@query
def html_strip_pages(spark, folder):
    html = F.col("html")
    return texts(spark, folder, "pages", shared_out=True).select(
        "page_id",
        clean.strip_html(html).alias("text"),
        F.length(clean.strip_unprintable(clean.strip_html(html))).cast("bigint").alias("printable"),
    )


@query
def standardise_fields(spark, folder):
    raw = raw_strings(reviews(spark, folder))
    i = F.col(SEQ)
    raw = raw.withColumns(
        {
            "rating": F.when(i % 17 == 0, "five").when(i % 19 == 0, " 4.5 ").otherwise(F.col("rating")),
            "helpful_votes": F.when(i % 23 == 0, F.lit(None)).when(i % 29 == 0, "").otherwise(F.col("helpful_votes")),
            "review_timestamp": F.when(i % 31 == 0, "soon").when(i % 41 == 0, "99999999999999999").otherwise(F.col("review_timestamp")),
            "is_verified_purchase": F.when(i % 2 == 0, F.concat(F.lit(" "), F.initcap("is_verified_purchase"))).otherwise(
                F.col("is_verified_purchase")
            ),
            "review_title": F.when(i % 37 == 0, "").otherwise(F.col("review_title")),
        }
    )
    return table.standard(table.typed(raw))


@query
def drop_prefixed_columns(spark, folder):
    rv = reviews(spark, folder, flags=False).select(PRODUCT, SEQ, "rating", F.lit("x").alias("X1"), F.col("category").alias("X.2"))
    return convert.drop_prefixed(rv)


@query
def dedup_rows(spark, folder):
    standard = _standard(spark, folder).select("category", PRODUCT, "review_text", SEQ)
    return table.without_duplicates(standard, ["category", PRODUCT, "review_text"])


@query
def dedup_all_columns(spark, folder):
    """The eleven columns of a table in which every row occurs twice."""
    rv = _standard(spark, folder, flags=True)
    again = rv.withColumn(SEQ, F.col(SEQ) + (1 << 40))
    return table.without_duplicates(table.union_all(rv, again)).select(SEQ, PRODUCT, "product_id", "reviewer_id")


@query
def union_sources(spark, folder):
    rv = reviews(spark, folder, flags=False).select(PRODUCT, SEQ, "rating", "helpful_votes")
    first = rv.filter(F.col(SEQ) % 3 == 0)
    second = rv.filter(F.col(SEQ) % 3 == 1).select("helpful_votes", "rating", SEQ, PRODUCT)
    third = rv.filter(F.col(SEQ) % 3 == 2).select("rating", PRODUCT, SEQ)
    return table.union_all(first, second, third)


@query
def verified_label(spark, folder):
    return reviews(spark, folder).select(SEQ, convert.yes_no(F.col("is_verified_purchase")).alias("verified"))


# ---- extraction -------------------------------------------------------------------


@query
def extract_fields(spark, folder):
    return extract.extract_or_missing(_records(spark, folder))


@query
def tag_variants(spark, folder):
    return extract.tag_variants(_records(spark, folder)).orderBy("field", "tag")


@query
def match_counts(spark, folder):
    return extract.match_counts(_records(spark, folder, leave_out=True))


@query
def unmatched_records(spark, folder):
    return extract.unmatched_counts(_records(spark, folder, leave_out=True))


@query
def unmatched_preview(spark, folder):
    return extract.first_unmatched(_records(spark, folder, leave_out=True), "review_text")


# ---- tokens, vocabulary, vectors --------------------------------------------------


@query
def tokens_by_doc(spark, folder):
    docs = texts(spark, folder, shared_out=True)
    kept = tk.long_enough(tk.without_stopwords(tk.words(F.col("text")), tk.STOPWORDS))
    listed = docs.select("doc_id", kept.alias("tokens"))
    return listed.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").cast("bigint").alias("n"))


@query
def stopword_anti(spark, folder):
    words = texts(spark, folder, shared_out=True).select(F.explode(tk.words(F.col("text"))).alias("word"))
    stop = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{w}')" for w in tk.STOPWORDS) + " AS stop(word)")
    return tokenise.without_stopwords(words, stop).groupBy("word").agg(F.count("*").alias("n"))


@query
def porter_stem(spark, folder):
    words = texts(spark, folder, shared_out=True).select(F.explode(tk.words(F.col("text"))).alias("word")).distinct()
    return words.select("word", tk.stem_word("word").alias("stem"))


@query
def product_tokens(spark, folder):
    return tokenise.term_counts(_tokens(spark, folder))


@query
def doc_freq_band(spark, folder):
    return vocabulary.band_terms(_tokens(spark, folder))


@query
def bigram_freq(spark, folder):
    tokens = _tokens(spark, folder)
    return vocabulary.pair_counts(tokens, vocabulary.band_terms(tokens)).filter(F.col("n") >= vocabulary.MIN_PAIR_COUNT)


@query
def pmi_top200(spark, folder):
    pairs = vocabulary.fit(_tokens(spark, folder)).pairs
    return _rounded(pairs.select("term", "n", "n1", "n2", "pmi"), "pmi")


@query
def vocab_index(spark, folder):
    return vocabulary.fit(_tokens(spark, folder)).terms


@query
def vocab_text(spark, folder):
    return vectors.vocabulary_lines(vocabulary.fit(_tokens(spark, folder)).terms)


def _vectors(spark, folder):
    tokens = _tokens(spark, folder)
    fitted = vocabulary.fit(tokens)
    return tokens, fitted, vectors.count_vectors(tokens, fitted)


@query
def count_vectors(spark, folder):
    return _vectors(spark, folder)[2]


@query
def vector_text(spark, folder):
    tokens, _, found = _vectors(spark, folder)
    return vectors.vector_lines(found, tokens.texts)


# ---- insights ---------------------------------------------------------------------


@query
def helpful_flag(spark, folder):
    rv = _standard(spark, folder)
    votes = F.when(F.col(SEQ) % 7 == 0, F.concat("helpful_votes", F.lit(".0"))).otherwise(F.col("helpful_votes"))
    rating = F.when(F.col(SEQ) % 9 == 0, "none").otherwise(F.col("rating"))
    rows = rv.withColumns({"helpful_votes": votes, "rating": rating})
    return insights.helpful_flags(rows, compat=True).groupBy(PRODUCT, "rating", "is_helpful").agg(F.count("*").alias("n"))


@query
def helpful_terms(spark, folder):
    _, fitted, found = _vectors(spark, folder)
    return insights.helpful_terms(found, insights.helpful_flags(_standard(spark, folder)), fitted.terms)


@query
def term_totals(spark, folder):
    _, fitted, found = _vectors(spark, folder)
    return insights.term_totals(found, fitted.terms)


@query
def top10_terms(spark, folder):
    _, fitted, found = _vectors(spark, folder)
    return insights.top_terms(insights.term_totals(found, fitted.terms))


@query
def cloud_weights(spark, folder):
    return _rounded(insights.cloud_weights(helpful_terms(spark, folder)), "weight")


@query
def weekday_counts(spark, folder):
    rv = _standard(spark, folder)
    dashed = F.when(F.col(SEQ) % 2 == 0, F.replace("review_timestamp", F.lit("-"), F.lit("–"))).otherwise(
        F.col("review_timestamp")
    )
    return insights.weekday_counts(rv, convert.parse_timestamp(dashed))


@query
def weekday_counts_events(spark, folder):
    return insights.weekday_counts(load(spark, folder, "events"), F.col("ts"))


@query
def yearly_counts(spark, folder):
    rv = _standard(spark, folder)
    stamp = F.when(F.col(SEQ) % 10 == 0, "none").otherwise(F.col("review_timestamp"))
    return insights.yearly_counts(rv, convert.parse_timestamp(stamp))


@query
def yearly_counts_orders(spark, folder):
    return insights.yearly_counts(load(spark, folder, "orders"), F.col("o_orderdate"))


@query
def length_p95_by_rating(spark, folder):
    return _rounded(insights.length_by_rating(_cleaned(spark, folder)), "mean_length")


@query
def length_density(spark, folder):
    return _rounded(insights.length_density(_cleaned(spark, folder)), "x", "density")


@query
def votes_by_length(spark, folder):
    return _rounded(insights.votes_by_length(_cleaned(spark, folder)), "mean_votes")


@query
def length_votes_correlation(spark, folder):
    return _rounded(insights.length_votes_correlation(_cleaned(spark, folder)), "correlation")


@query
def length_and_votes(spark, folder):
    return insights.length_and_votes(_cleaned(spark, folder).select(SEQ, "review_text", "helpful_votes"))


@query
def rating_share(spark, folder):
    return _rounded(insights.rating_share(reviews(spark, folder, flags=False)), "share")


@query
def overview_counts(spark, folder):
    return insights.overview(_standard(spark, folder, flags=True))


@query
def null_profile(spark, folder):
    labels = load(spark, folder, "labels").select(F.col("doc_id").alias(SEQ), "quality", "toxic")
    return insights.profile(reviews(spark, folder).join(labels, SEQ, "left"))


# ---- nested documents -------------------------------------------------------------


def _nested(spark, folder):
    """Nesting reads its input several times, so the standard table is written first."""
    return nest.nest(stage(_standard(spark, folder, flags=True), "reviews"))


def _documents(spark, folder):
    return nest.document_lines(_nested(spark, folder))


def _placed(rows: DataFrame, chunk: Column, pos: Column) -> DataFrame:
    """Place of each row in its product: the sizes of the chunks before, and the place in its own."""
    rows = rows.withColumns({"chunk": chunk, "place": pos})
    before = Window.partitionBy(PRODUCT).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(PRODUCT, "chunk").agg(F.count("*").alias("size"))
    sizes = sizes.select(PRODUCT, "chunk", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return rows.join(sizes, [PRODUCT, "chunk"]).withColumn("place", F.col("start") + F.col("place")).drop("chunk", "start")


def _numbered(flat: DataFrame) -> DataFrame:
    """Flattened rows with their place in the product as ``seq``."""
    chunk, pos = F.shiftright(SEQ, RUN_BITS), F.col(SEQ) % (1 << RUN_BITS)
    return _placed(flat, chunk, pos).drop(SEQ).withColumnRenamed("place", SEQ)


@query
def nested_reviews(spark, folder):
    listed = _nested(spark, folder)
    each = listed.select(PRODUCT, "chunk", F.posexplode("reviews").alias("pos", "review"))
    each = _placed(each, F.col("chunk"), F.col("pos").cast("bigint"))
    return each.select(PRODUCT, F.col("place").alias("pos"), "review.product_id", "review.rating", "review.review_text")


@query
def flatten_nested(spark, folder):
    return _numbered(nested.flatten(_documents(spark, folder)))


@query
def product_texts(spark, folder):
    return _numbered(nested.product_texts(_documents(spark, folder)))


# Faults that hide a whole product, so that its further chunks are left out.
HIDDEN = ["src5", "src6", "src7", "src8", "src9", "src10", "src14"]


def _faulty(documents: DataFrame) -> DataFrame:
    """Documents with one kind of fault per product."""
    first = F.col("chunk") == F.min("chunk").over(Window.partitionBy(PRODUCT))
    documents = documents.withColumn("first", first).filter(F.col("first") | ~F.col(PRODUCT).isin(HIDDEN))
    p, value = F.col(PRODUCT), F.col("value")

    def swap(old: str, new: str):
        return F.replace(value, F.lit(old), F.lit(new))

    faults = {
        "src1": swap('"rating":"3.0"', '"rating":"7.0"'),
        "src2": swap('"rating":"2.0"', '"rating":2.0'),
        "src3": swap('"helpful_votes"', '"votes"'),
        "src4": swap('"review_timestamp":"2014-', '"review_timestamp":"2014/'),
        "src5": swap('"reviews":[', '"reviewz":['),
        "src6": F.lit('{"src6":[]}'),
        "src7": F.lit('{"src7":{"reviews":{}}}'),
        "src8": F.lit('{"src8":{"reviews":[]}}'),
        "src9": F.lit("no json {"),
        "src10": F.lit("[1,2]"),
        "src11": F.when(F.col("first"), swap('"reviews":[', '"reviews":[5,')).otherwise(value),
        "src12": swap('"rating":"1.0"', '"rating":"one"'),
        "src13": swap('"rating":"5.0"', '"rating":"5.0","stars":"5"'),
        "src14": F.lit('{"src14":{"reviews":null}}'),
    }
    changed = value
    for source, text in faults.items():
        changed = F.when(p == source, text).otherwise(changed)
    return documents.select(changed.alias("value"))


@query
def validate_nested(spark, folder):
    found = validate.issues(_faulty(_documents(spark, folder)))
    return found.groupBy(PRODUCT, "rule", "severity").agg(F.count("*").alias("n"))


@query
def validate_verdict(spark, folder):
    return validate.verdict(_faulty(_documents(spark, folder)))


# ---- previews ---------------------------------------------------------------------


@query
def preview_products(spark, folder):
    return preview.preview(_standard(spark, folder).select(PRODUCT, SEQ, "product_id")).select(PRODUCT, SEQ, "product_id")


@query
def preview_per_group(spark, folder):
    return preview.first_per_product(_standard(spark, folder).select(PRODUCT, SEQ, "product_id")).select(PRODUCT, SEQ, "product_id")


@query
def first_rows(spark, folder):
    return preview.first_rows(_standard(spark, folder).select(SEQ, PRODUCT, "reviewer_id"))


@query
def random_sample(spark, folder):
    return preview.sample_rows(_standard(spark, folder, flags=True).select(SEQ, *REVIEW_COLUMNS), seed=7)


# ---- files ------------------------------------------------------------------------


def _tagged_files(spark, folder):
    """The tagged text of the driver tables as text files, in a folder of its own."""
    path = new_folder(spark, "tagged")
    tagged(reviews(spark, folder)).select("value").write.text(path)
    return path


@query
def tagged_files(spark, folder):
    """Records read back from files: how many there are of each length."""
    records = tagged_text.read_records(spark, _tagged_files(spark, folder))
    return records.groupBy(F.length("record").cast("bigint").alias("length")).agg(F.count("*").alias("n"))


@query
def file_listing(spark, folder):
    """Bytes of all listed files, and whether as many were counted as listed."""
    path = _tagged_files(spark, folder)
    listed = tagged_text.list_files(spark, path)
    found = listed.agg(F.sum("length").alias("bytes"), F.count_distinct("path").alias("listed"))
    counted = tagged_text.count_files(spark, path).scalar()
    return found.select("bytes", (F.col("listed") == counted).alias("all_counted"))


@query
def first_record_file(spark, folder):
    """The first record of the whole table, written in order of ``seq``."""
    path = new_folder(spark, "first")
    tagged(reviews(spark, folder)).orderBy("row").select("value").write.text(path)
    return tagged_text.first_record(tagged_text.read_records(spark, path))


@query
def summary_file(spark, folder):
    path = new_folder(spark, "summary")
    files.write_summary(summary.product_summary(_standard(spark, folder)), path)
    schema = f"{PRODUCT} string, review_count long, review_text_count long"
    return spark.read.schema(schema).csv(path, header=True)


@query
def helpful_flag_file(spark, folder):
    path = new_folder(spark, "flags")
    files.write_helpful_flags(insights.helpful_flags(_standard(spark, folder)).select(PRODUCT, "rating", "is_helpful"), path)
    rows = spark.read.schema(f"{PRODUCT} string, rating double, is_helpful string").csv(path, header=True)
    return rows.groupBy(PRODUCT, "rating", "is_helpful").agg(F.count("*").alias("n"))


@query
def stopword_file(spark, folder):
    """Stopwords by way of a file, with repeats, against the words of the documents."""
    path = new_folder(spark, "stopwords")
    spark.createDataFrame([(w,) for w in [*tk.STOPWORDS, *tk.STOPWORDS]], "value string").write.text(path)
    words = texts(spark, folder, shared_out=True).select(F.explode(tk.words(F.col("text"))).alias("word"))
    kept = tokenise.without_stopwords(words, dictionaries.read_stopwords(spark, path))
    return kept.groupBy("word").agg(F.count("*").alias("n"))


@query
def vocabulary_file(spark, folder):
    path = new_folder(spark, "vocabulary")
    files.write_vocabulary(vocabulary.fit(_tokens(spark, folder)).terms, path)
    return dictionaries.read_vocabulary(spark, path)


@query
def vector_file(spark, folder):
    """Count vectors by way of a file; products without terms are lines without items."""
    path = new_folder(spark, "vectors")
    tokens, _, found = _vectors(spark, folder)
    files.write_vectors(stage(found, "vectors"), tokens.texts, path)
    return dictionaries.read_vectors(spark, path)
