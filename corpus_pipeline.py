"""The corpus pipeline: language, near duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; each result is written as
Parquet and read again.  All but the last return the columns of their input.

* ``language``: documents without a letter are rejected, and those whose best language has less than ``MIN_SCORE`` of the
  counts of all languages or holds less than ``MIN_COVERAGE`` of the document's n-grams: foreign scripts and gibberish.  Keys,
  numbers and addresses (``OPAQUE``) are no words of any language and are left out of the judgement; a document with fewer
  than ``MIN_LETTERS`` letters beside them is too short to tell and stays.  A language not learnt that shares many n-grams
  with one that is can pass.  If nothing was learnt, all documents stay.
* ``near_duplicates``: of each component of documents linked by Jaccard similarity of word shingles, the one with the
  smallest doc_id stays (of equal rows, one).  Documents without words, and rows without a doc_id, are in no group and stay.
* ``secrets``: reported spans are replaced by a mask; no document goes.
* ``mixture``: the documents in the order of the schedule, over part files and inside them.
* ``packing``: pieces of token ids with sequence and place.  Files have no order, so the places in the schedule are worked out
  again from the rows; sequence_id follows them, block of tokens by block of tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import jaccard_join, language, mixing, packing, secrets
from reviewmill.session import Scratch, stage

MIN_SCORE = 0.1
MIN_COVERAGE = 0.2
MIN_LETTERS = 20
OPAQUE = r"[!-~]*[0-9][!-~]*|[!-~]{16,}"
SIMILARITY = 80  # per cent; shingles of five words
WIDTH = 5


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = language.fit(docs)
    if not filters.languages:
        return docs
    taken = {c.lower() for c in docs.columns}
    names = tuple(_free(taken, c) for c in ("language", "share", "coverage"))
    text = F.col("text").cast("string")
    told = F.regexp_replace(text, OPAQUE, " ")
    found = language.identify(docs, filters, docs.columns, names, told)
    known = (F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= MIN_SCORE) & (F.col(names[2]) >= MIN_COVERAGE)
    enough = F.regexp_like(told, F.lit(rf"(?:\p{{L}}[^\p{{L}}]*+){{{MIN_LETTERS}}}"))
    kept = F.regexp_like(text, F.lit(r"\p{L}")) & (known | ~enough)
    return found.filter(kept).drop(*names)


def _free(taken: set[str], name: str) -> str:
    """A column name that the input does not have."""
    while name in taken:
        name += "_"
    taken.add(name)
    return name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    joined = jaccard_join.join(docs, WIDTH, SIMILARITY)
    flag = _free({c.lower() for c in docs.columns}, "flag")
    dropped = joined.filter("component_id < doc_id").select("doc_id", F.lit(2).alias(flag))
    # Rows of one doc_id and one text are one document.
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    flags = dropped.union(again.select("doc_id", F.lit(1))).groupBy("doc_id").agg(F.max(flag).alias(flag))
    marked = docs.join(flags, "doc_id", "left")
    single = marked.filter(F.col(flag).isNull()).select(*docs.columns)
    repeated = marked.filter(F.col(flag) == 1).select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str, block_tokens: int = packing.BLOCK_TOKENS) -> DataFrame:
    import public_tokenizers

    vocabulary, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    ordered = mixing.placed(docs, keep=["doc_id", "text"]).orderBy("position").select("row.*")
    return packing.pack(ordered, vocabulary, ranks, block_tokens=block_tokens, in_order=True)


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixture", mixture),
    ("packing", packed),
]

#: A trained filter and a tokeniser are no SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, step in STAGES[:-1]:
            docs = scratch.stage(step(spark, docs, sf_dir), name)
        name, step = STAGES[-1]
        return stage(step(spark, docs, sf_dir), name)
