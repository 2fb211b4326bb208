"""Line-first cleaning: rules per line, failing lines removed, documents that lose too much rejected.

A line with a word fails by

* punctuation: symbols of ``[#*$%&|<>]`` are more than a tenth of it, or it has no letter or digit;
* navigation: two or more ``|``, or two or more arrows between short items;
* boilerplate: it equals an earlier line of its text, or names cookies, rights or subscriptions.

``kept`` is false if the base rules reject the text (fewer than 50 words, or more than half of the
words inside three-word windows that occur again) or if failing lines hold more than ``MAX_LOST``
of the characters in words.

Everything is one projection of built-in functions; there is no shuffle.  Repeated windows are found
by sorting 64-bit hashes inside the row, in n log n.

Nulls and edges: a null or empty text has zero words and is rejected; equal rows give equal results;
an empty table gives no rows; only ``doc_id`` and ``text`` are read, so other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_LOST = 0.5
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
NAVIGATION = r"\|[^|]*\||(?:\S{1,20} ?(?:>|»|›) ?){2}"
BOILERPLATE = (
    r"(?i)\b(?:cookies?|all rights reserved|copyright|terms of (?:use|service)|privacy policy|"
    r"subscribe|sign up|log ?in|click here|javascript)\b"
)


def quoted(pattern: str) -> str:
    """A pattern as a SQL raw string."""
    return "r'" + pattern.replace("'", "\\x27") + "'"


def symbols(text: str) -> str:
    return f"length(regexp_replace({text}, {quoted(NOT_SYMBOL)}, ''))"


def measured(docs: DataFrame) -> DataFrame:
    """The base counts, the lines and the failing lines of each document."""
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = rows.selectExpr(
        "doc_id",
        f"array_remove(split(text, {quoted(BLANK + '+')}), '') AS words",
        f"filter(split(text, '\\n'), l -> l rlike {quoted(WORD)}) AS lines",
        f"{symbols('text')} AS n_symbols",
    )
    rows = rows.selectExpr(
        "doc_id",
        "lines",
        "CAST(n_symbols AS long) AS n_symbols",
        "CAST(size(words) AS long) AS n_words",
        "CAST(length(array_join(words, '')) AS long) AS word_chars",
        "slice(transform(words, (w, i) -> xxhash64(w, get(words, i + 1), get(words, i + 2))),"
        " 1, greatest(size(words) - 2, 0)) AS windows",
        "array_distinct(lines) AS distinct_lines",
    )
    rows = rows.selectExpr(
        "*",
        "CAST(size(lines) - size(distinct_lines) AS long) AS n_dup_lines",
        # Only windows that occur again are sorted with their places.
        "CASE WHEN size(array_distinct(windows)) = size(windows) THEN"
        " array() ELSE array_sort(transform(windows, (h, i) -> struct(h, i))) END AS ranked",
        f"filter(distinct_lines, l -> NOT (10 * {symbols('l')} > length(l) OR NOT l rlike r'[\\p{{L}}\\p{{N}}]'"
        f" OR l rlike {quoted(NAVIGATION)} OR l rlike {quoted(BOILERPLATE)})) AS clean_lines",
    )
    rows = rows.withColumn(
        "places",
        F.expr(
            "sort_array(transform(filter(ranked, (e, j) -> coalesce(e.h = get(ranked, j - 1).h, false)"
            " OR coalesce(e.h = get(ranked, j + 1).h, false)), e -> e.i))"
        ),
    )
    return rows.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "clean_lines", "size(lines) AS n_lines",
        "aggregate(transform(places, (p, j) -> least(3, coalesce(get(places, j + 1) - p, 3))), 0L,"
        " (a, x) -> a + x) AS n_repeat_words",
    )


def clean(docs: DataFrame, min_words: int = MIN_WORDS, max_lost: float = MAX_LOST) -> DataFrame:
    """Counts and verdicts, with the text of the lines that passed as ``clean_text``."""
    rows = measured(docs).withColumns(
        {
            "clean_text": F.array_join("clean_lines", "\n"),
            "n_lines_removed": (F.col("n_lines") - F.size("clean_lines")).cast("long"),
        }
    )
    solid = f"length(regexp_replace(clean_text, {quoted(BLANK + '+')}, ''))"
    rows = rows.withColumns(
        {
            "base_failed": F.expr(f"n_words < {min_words} OR 100 * n_repeat_words > 50 * n_words"),
            "lost_chars": F.expr(f"word_chars - {solid}"),
        }
    )
    kept = (~F.col("base_failed")) & (F.col("lost_chars") <= F.lit(max_lost) * F.col("word_chars"))
    return rows.withColumn("kept", kept).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "lost_chars", "clean_text",
    )


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.drop("clean_text")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid
), li AS (
  SELECT rid, k, ls[k] AS l FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS k FROM w)
), fl AS (
  SELECT rid, l, min(k) AS k,
    10 * length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) > length(l)
    OR NOT regexp_matches(l, '[\pL\pN]')
    OR regexp_matches(l, '\|[^|]*\||(?:\S{1,20} ?(?:>|»|›) ?){2}')
    OR regexp_matches(l, '(?i)\b(?:cookies?|all rights reserved|copyright|terms of (?:use|service)|privacy policy|subscribe|sign up|log ?in|click here|javascript)\b')
    AS bad
  FROM li GROUP BY rid, l
), ln AS (
  SELECT rid, count(*) AS n_distinct, sum(CASE WHEN bad THEN 0 ELSE 1 END) AS n_clean,
    sum(CASE WHEN bad THEN 0 ELSE length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) END) AS clean_chars
  FROM fl GROUP BY rid
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - coalesce(n_distinct, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) - coalesce(n_clean, 0) AS BIGINT) AS n_lines_removed,
    coalesce(clean_chars, 0) AS clean_chars
  FROM w LEFT JOIN covered USING (rid) LEFT JOIN ln USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars - clean_chars <= 0.5 * word_chars AS kept,
  n_lines_removed, CAST(word_chars - clean_chars AS BIGINT) AS lost_chars
FROM m
"""
