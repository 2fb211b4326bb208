"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from reviewmill.catalog.corpus import LEFT_OUT, MIN_REVIEWS, RAW_SQL, RECORD_TAGS, REVIEWS_SQL, tagged_sql
from reviewmill.catalog.stem_sql import stem_ctes
from reviewmill.functions.convert import WEEKDAYS
from reviewmill.functions.tokens import STOPWORDS
from reviewmill.schema import NESTED_KEYS, REVIEW_COLUMNS

# Fixed value: what a tag scan takes for a tag.
TAG_SQL = r"<\s*/?\s*[a-zA-Z0-9_ ]+\s*>"
EMOJI_SQL = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2500}-\x{2BEF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)


def clean_sql(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '<.*?>', '', 'g'), '[^\x20-\x7F]+', '', 'g'))"


def _filled(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'none' ELSE {x} END"


CLEAN = f"""
cl AS (SELECT rv.* REPLACE ({clean_sql('review_text')} AS review_text) FROM rv)"""


def _standard(source: str, name: str) -> str:
    """Strings only, sentinel filled in, text lower-cased."""
    special = {
        "rating": "coalesce(CAST(rating AS VARCHAR), 'none')",
        "helpful_votes": "coalesce(CAST(helpful_votes AS VARCHAR), 'none')",
        "review_timestamp": "coalesce(strftime(review_timestamp, '%Y-%m-%d %H:%M:%S'), 'none')",
        "is_verified_purchase": "CASE WHEN is_verified_purchase THEN 'True' ELSE 'False' END",
    }
    columns = ", ".join(f"{special.get(c, 'lower(' + _filled(c) + ')')} AS {c}" for c in REVIEW_COLUMNS)
    return f"\n{name} AS (SELECT {columns}, seq FROM {source})"


STANDARD = _standard("cl", "std")
BASE = f"WITH {REVIEWS_SQL},{CLEAN},{STANDARD}"

QUALIFIED = f"""
freq AS (SELECT parent_product_id, count(*) AS n FROM std WHERE review_text <> 'none'
         GROUP BY 1 HAVING count(*) >= {MIN_REVIEWS}),
qual AS (SELECT * FROM std WHERE review_text <> 'none'
         AND parent_product_id IN (SELECT parent_product_id FROM freq))"""

STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def _split(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z]+')"


TOKENS = f"""
lists AS (SELECT parent_product_id AS pid, seq, {_split('review_text')} AS l FROM qual),
spread AS (SELECT pid, seq, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM lists),
kept AS (SELECT * FROM spread WHERE length(word) >= 3 AND word NOT IN ({STOP})),
words AS (SELECT DISTINCT word FROM kept),
{stem_ctes('words')},
tok AS (SELECT pid, seq, pos, stem AS term FROM kept JOIN stems USING (word)),
counts AS (SELECT pid, term, count(*) AS n FROM tok GROUP BY 1, 2),
total AS (SELECT count(DISTINCT parent_product_id) AS products FROM qual),
uni AS (SELECT term, count(*) AS product_count, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY 1
        HAVING count(*) >= 0.05 * (SELECT products FROM total) AND count(*) < 0.95 * (SELECT products FROM total))"""

PAIRS = """
follow AS (SELECT term AS w1, lead(term) OVER (PARTITION BY pid, seq ORDER BY pos) AS w2
           FROM tok WHERE term IN (SELECT term FROM uni)),
pairs AS (SELECT w1, w2, count(*) AS n FROM follow WHERE w2 IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
best AS (SELECT w1 || '_' || w2 AS term, p.n, a.n AS n1, b.n AS n2,
                log2(p.n * (SELECT sum(n) FROM uni)::DOUBLE) - log2(a.n::DOUBLE * b.n::DOUBLE) AS pmi
         FROM pairs p JOIN uni a ON a.term = w1 JOIN uni b ON b.term = w2
         ORDER BY p.n / (a.n::DOUBLE * b.n::DOUBLE) DESC, w1, w2 LIMIT 200),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx
          FROM (SELECT term FROM uni UNION ALL SELECT term FROM best))"""

VECTORS = """
chain AS (SELECT pid, term || '_' || lead(term) OVER (PARTITION BY pid ORDER BY seq, pos) AS term FROM tok),
used AS (SELECT pid, term FROM tok UNION ALL SELECT pid, term FROM chain),
vec AS (SELECT pid AS parent_product_id, idx, count(*) AS n FROM used JOIN vocab USING (term) GROUP BY 1, 2)"""

FULL = f"{BASE},{QUALIFIED},{TOKENS},{PAIRS},{VECTORS}"

HELPFUL = """
helpful AS (SELECT parent_product_id, count(*) AS h FROM rv WHERE helpful_votes >= 1 GROUP BY 1),
weighed AS (SELECT idx, term, CAST(sum(n * h) AS BIGINT) AS n
            FROM vec JOIN helpful USING (parent_product_id) JOIN vocab USING (idx) GROUP BY 1, 2)"""

RECORDS = f"WITH {REVIEWS_SQL},{RAW_SQL}"

WEEK = "week AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{d}')" for i, d in enumerate(WEEKDAYS, 1)) + ") t(day, weekday))"

HISTOGRAM = r"""
len AS (SELECT rating, len(regexp_extract_all(review_text, '\S+')) AS l FROM cl),
trim AS (SELECT * FROM len WHERE l <= (SELECT quantile_cont(l, 0.95) FROM len))"""

LENGTHS = "lv AS (SELECT seq, length(review_text) AS l, helpful_votes AS v FROM cl)"


def _extract() -> str:
    special = {
        "rating": "rating",
        "product_id": "product_id",
    }

    def value(c: str) -> str:
        text = rf"regexp_replace({special.get(c, c)}, '^\s+|\s+$', '', 'g')"
        return f"CASE WHEN contains({text}, chr(10)) THEN 'none' ELSE {text} END AS {c}"

    columns = ", ".join(value(c) for c in REVIEW_COLUMNS)
    return f"{RECORDS} SELECT {columns}, seq * 2 + turn AS seq FROM raw, (VALUES (0), (1)) t(turn)"


def _variants() -> str:
    t = "lower(tag)"

    def has(*words: str) -> str:
        return " AND ".join(f"contains({t}, '{w}')" for w in words)

    fields = {
        "category": f"{has('category')} AND NOT starts_with(tag, '</')",
        "reviewer_id": has("reviewer", "id"),
        "rating": has("rat"),
        "review_title": f"({has('review', 'title')}) OR {has('head')}",
        "review_text": has("text"),
        "attached_images": f"({has('attach', 'image')}) OR {has('pic')}",
        "product_id": f"{has('product', 'id')} AND NOT {has('parent')}",
        "parent_product_id": has("product", "id", "parent"),
        "review_timestamp": f"{has('time')} OR {has('date')}",
        "is_verified_purchase": has("verif"),
        "helpful_votes": f"{has('vote')} OR {has('like')}",
    }
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS field, tag, count(*) AS n FROM tags WHERE {rule} GROUP BY 2" for f, rule in fields.items()
    )
    return (
        f"{RECORDS},{tagged_sql()}, tags AS (SELECT unnest(regexp_extract_all(record, '{TAG_SQL}')) AS tag FROM rec) {parts}"
    )


def _hits() -> str:
    """Whether each field is found in each record, worked out from the table itself."""
    out = {f: f"seq % {d} = {r}" for f, d, r in LEFT_OUT}

    def hit(c: str) -> str:
        text = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
        return f"(NOT contains({text}, chr(10)) AND NOT ({out.get(c, 'false')})) AS {c}"

    columns = ", ".join(hit(c) for c in REVIEW_COLUMNS)
    return f"{RECORDS}, hit AS (SELECT {columns}, seq FROM raw, (VALUES (0), (1)) t(turn))"


def _per_field(template: str) -> str:
    return " UNION ALL ".join("SELECT " + template.format(f=f) + " FROM hit" for f in REVIEW_COLUMNS)


def _profile() -> str:
    types = {"rating": "double", "review_timestamp": "timestamp", "is_verified_purchase": "boolean"}
    types |= {"helpful_votes": "bigint", "seq": "bigint", "quality": "int", "toxic": "int"}
    columns = ["seq", *[c for c in REVIEW_COLUMNS], "quality", "toxic"]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{types.get(c, 'string')}' AS type, count({c}) AS filled, "
        f"count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER (CAST({c} AS VARCHAR) = 'none') AS sentinels FROM j"
        for c in columns
    )
    return f"WITH {REVIEWS_SQL}, j AS (SELECT rv.*, l.quality, l.toxic FROM rv LEFT JOIN labels l ON l.doc_id = rv.seq) {parts}"


POSITION = "row_number() OVER (PARTITION BY parent_product_id ORDER BY seq) - 1"

FAULTS = """
SELECT parent_product_id, 'rating_out_of_range' AS rule, 'warning' AS severity, count(*) AS n
  FROM std WHERE parent_product_id = 'src1' AND rating = '3.0' GROUP BY 1
UNION ALL SELECT parent_product_id, 'value_not_string', 'error', count(*)
  FROM std WHERE parent_product_id = 'src2' AND rating = '2.0' GROUP BY 1
UNION ALL SELECT parent_product_id, 'keys_missing', 'error', count(*)
  FROM std WHERE parent_product_id = 'src3' GROUP BY 1
UNION ALL SELECT parent_product_id, 'keys_extra', 'error', count(*)
  FROM std WHERE parent_product_id = 'src3' GROUP BY 1
UNION ALL SELECT parent_product_id, 'bad_timestamp', 'error', count(*)
  FROM std WHERE parent_product_id = 'src4' AND starts_with(review_timestamp, '2014-') GROUP BY 1
UNION ALL SELECT 'src5', 'reviews_missing', 'error', 1
UNION ALL SELECT 'src6', 'product_not_object', 'error', 1
UNION ALL SELECT 'src7', 'reviews_not_list', 'error', 1
UNION ALL SELECT 'src8', 'reviews_empty', 'warning', 1
UNION ALL SELECT NULL, 'not_loaded', 'error', 1
UNION ALL SELECT NULL, 'top_level_not_object', 'error', 1
UNION ALL SELECT 'src11', 'review_not_object', 'error', 1
UNION ALL SELECT parent_product_id, 'bad_rating', 'error', count(*)
  FROM std WHERE parent_product_id = 'src12' AND rating = '1.0' GROUP BY 1
UNION ALL SELECT parent_product_id, 'keys_extra', 'error', count(*)
  FROM std WHERE parent_product_id = 'src13' AND rating = '5.0' GROUP BY 1
UNION ALL SELECT 'src14', 'reviews_not_list', 'error', 1"""

NOT_LISTED = "('src5', 'src6', 'src7', 'src8', 'src9', 'src10', 'src14')"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["summary_counts"] = f"""{BASE} SELECT parent_product_id, count(*) AS review_count,
        count(*) FILTER (review_text <> 'none') AS review_text_count FROM std GROUP BY 1"""
    q["having_min_reviews"] = f"{BASE},{QUALIFIED} SELECT * FROM freq"
    q["semi_qualified"] = f"{BASE},{QUALIFIED} SELECT seq, parent_product_id, length(review_text) AS text_length FROM qual"
    q["clean_text"] = f"""WITH t AS (SELECT 'document' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'page', page_id, html FROM pages)
        SELECT kind, id, {_filled(clean_sql('text'))} AS cleaned,
          length(regexp_replace('☕<b>' || text || '</b>\U0001f603 ok\U0001f1e6', '{EMOJI_SQL}', '', 'g')) AS without_emoji,
          strlen(text) = length(text) AS ascii FROM t"""
    q["html_strip_pages"] = r"""SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text,
        length(regexp_replace(regexp_replace(html, '<.*?>', '', 'g'), '[^\x20-\x7F]+', '', 'g')) AS printable FROM pages"""
    q["standardise_fields"] = f"""WITH {REVIEWS_SQL}, odd AS (SELECT rv.* REPLACE (
          CASE WHEN seq % 17 = 0 THEN NULL WHEN seq % 19 = 0 THEN 4.5 ELSE rating END AS rating,
          CASE WHEN seq % 23 = 0 OR seq % 29 = 0 THEN NULL ELSE helpful_votes END AS helpful_votes,
          CASE WHEN seq % 31 = 0 OR seq % 41 = 0 THEN NULL ELSE review_timestamp END AS review_timestamp,
          CASE WHEN seq % 37 = 0 THEN '' ELSE review_title END AS review_title) FROM rv),
        {_standard('odd', 'std')} SELECT * FROM std"""
    q["drop_prefixed_columns"] = f"WITH {REVIEWS_SQL} SELECT parent_product_id, seq, rating FROM rv"
    q["dedup_rows"] = f"{BASE} SELECT category, parent_product_id, review_text, min(seq) AS seq FROM std GROUP BY 1, 2, 3"
    q["dedup_all_columns"] = f"""{BASE} SELECT min(seq) AS seq, parent_product_id, product_id, reviewer_id FROM (
        SELECT * FROM std UNION ALL SELECT std.* REPLACE (seq + 1099511627776 AS seq) FROM std)
        GROUP BY {', '.join(REVIEW_COLUMNS)}"""
    q["union_sources"] = f"""WITH {REVIEWS_SQL} SELECT parent_product_id, seq, rating,
        CASE WHEN seq % 3 = 2 THEN NULL ELSE helpful_votes END AS helpful_votes FROM rv"""
    q["verified_label"] = f"WITH {REVIEWS_SQL} SELECT seq, CASE WHEN is_verified_purchase THEN 'Yes' ELSE 'No' END AS verified FROM rv"

    q["extract_fields"] = _extract()
    q["tag_variants"] = _variants()
    q["match_counts"] = f"{_hits()} {_per_field(chr(39) + '{f}' + chr(39) + ' AS field, count(*) FILTER ({f}) AS hits, count(*) AS records')}"
    q["unmatched_records"] = f"{_hits()} {_per_field(chr(39) + '{f}' + chr(39) + ' AS field, count(*) FILTER (NOT {f}) AS unmatched')}"
    q["unmatched_preview"] = f"""{_hits()},{tagged_sql(True)}
        SELECT r.seq, r.record FROM rec r JOIN hit h ON h.seq = r.seq // 2 WHERE NOT h.review_text
        GROUP BY 1, 2 ORDER BY 1 LIMIT 3"""

    kept = f"[t for t in {_split('text')} if length(t) >= 3 AND t NOT IN ({STOP})]"
    q["tokens_by_doc"] = f"SELECT doc_id, array_to_string({kept}, ' ') AS tokens, len({kept}) AS n FROM documents"
    q["stopword_anti"] = f"""SELECT word, count(*) AS n FROM (SELECT unnest({_split('text')}) AS word FROM documents)
        WHERE word NOT IN ({STOP}) GROUP BY 1"""
    q["porter_stem"] = f"""WITH words AS (SELECT DISTINCT unnest({_split('text')}) AS word FROM documents),
        {stem_ctes('words')} SELECT word, stem FROM stems"""
    q["product_tokens"] = f"{BASE},{QUALIFIED},{TOKENS} SELECT pid AS parent_product_id, term, n FROM counts"
    q["doc_freq_band"] = f"{BASE},{QUALIFIED},{TOKENS} SELECT * FROM uni"
    q["bigram_freq"] = f"{BASE},{QUALIFIED},{TOKENS},{PAIRS} SELECT * FROM pairs"
    q["pmi_top200"] = f"{BASE},{QUALIFIED},{TOKENS},{PAIRS} SELECT term, n, n1, n2, round(pmi, 6) AS pmi FROM best"
    q["vocab_index"] = f"{BASE},{QUALIFIED},{TOKENS},{PAIRS} SELECT * FROM vocab"
    q["vocab_text"] = f"{BASE},{QUALIFIED},{TOKENS},{PAIRS} SELECT idx, term || ':' || idx AS line FROM vocab"
    q["count_vectors"] = f"{FULL} SELECT * FROM vec"
    q["vector_text"] = f"""{FULL} SELECT parent_product_id,
        parent_product_id || ',' || coalesce(string_agg(idx || ':' || n, ',' ORDER BY idx), '') AS line
        FROM (SELECT DISTINCT parent_product_id FROM qual) LEFT JOIN vec USING (parent_product_id) GROUP BY 1"""

    q["helpful_flag"] = f"""WITH {REVIEWS_SQL} SELECT parent_product_id, rating, helpful_votes >= 1 AS is_helpful, count(*) AS n
        FROM rv WHERE seq % 7 <> 0 AND seq % 9 <> 0 GROUP BY 1, 2, 3"""
    q["helpful_terms"] = f"{FULL},{HELPFUL} SELECT * FROM weighed"
    totals = "tot AS (SELECT idx, term, CAST(sum(n) AS BIGINT) AS n FROM vec JOIN vocab USING (idx) GROUP BY 1, 2)"
    q["term_totals"] = f"{FULL},{totals} SELECT * FROM tot"
    q["top10_terms"] = f"{FULL},{totals} SELECT * FROM tot ORDER BY n DESC, idx LIMIT 10"
    q["cloud_weights"] = f"""{FULL},{HELPFUL},
        largest AS (SELECT term, n, round(n / (SELECT max(n) FROM weighed), 6) AS weight FROM weighed ORDER BY n DESC, idx LIMIT 200)
        SELECT * FROM largest UNION ALL SELECT 'empty', 1, 1.0 WHERE NOT EXISTS (SELECT 1 FROM weighed)"""

    week = "SELECT CAST(day AS BIGINT) AS day, weekday, n FROM week LEFT JOIN c USING (weekday)"
    q["weekday_counts"] = f"""WITH {REVIEWS_SQL},{WEEK},
        c AS (SELECT dayname(review_timestamp) AS weekday, count(*) AS n FROM rv GROUP BY 1) {week}"""
    q["weekday_counts_events"] = f"""WITH {WEEK},
        c AS (SELECT dayname(ts) AS weekday, count(*) AS n FROM events GROUP BY 1) {week}"""
    q["yearly_counts"] = f"""WITH {REVIEWS_SQL} SELECT year(review_timestamp) AS year, count(*) AS n
        FROM rv WHERE seq % 10 <> 0 GROUP BY 1"""
    q["yearly_counts_orders"] = "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1"
    q["length_p95_by_rating"] = f"""WITH {REVIEWS_SQL},{CLEAN},{HISTOGRAM}
        SELECT rating, count(*) AS reviews, round(avg(l), 6) AS mean_length, quantile_cont(l, 0.5) AS median_length,
          min(l) AS min_length, max(l) AS max_length FROM trim GROUP BY 1"""
    q["length_density"] = f"""WITH {REVIEWS_SQL},{CLEAN},{HISTOGRAM},
        s AS (SELECT rating, count(*) AS c, min(l) AS low, max(l) AS high, stddev_samp(l) * pow(count(*), -0.2) AS w
              FROM trim GROUP BY 1 HAVING min(l) < max(l)),
        g AS (SELECT s.*, p AS point, low - 3 * w + p * (high - low + 6 * w) / 199 AS x FROM s, range(200) r(p))
        SELECT g.rating, point, round(x, 6) AS x,
          round(sum(exp(-0.5 * pow((x - l) / w, 2))) / (c * w * sqrt(2 * pi())), 6) AS density
        FROM g JOIN trim USING (rating) GROUP BY g.rating, point, x, c, w"""
    q["votes_by_length"] = f"""WITH {REVIEWS_SQL},{CLEAN},{LENGTHS} SELECT l // 500 * 500 AS from_length, count(*) AS reviews,
        round(avg(v), 6) AS mean_votes, quantile_cont(v, 0.5) AS median_votes, max(v) AS max_votes FROM lv GROUP BY 1"""
    q["length_votes_correlation"] = f"""WITH {REVIEWS_SQL},{CLEAN},{LENGTHS}
        SELECT count(*) AS reviews, round(corr(l, v), 6) AS correlation FROM lv"""
    q["length_and_votes"] = f"WITH {REVIEWS_SQL},{CLEAN},{LENGTHS} SELECT l AS review_length, v AS helpful_votes FROM lv"
    q["rating_share"] = f"""WITH {REVIEWS_SQL} SELECT rating, count(*) AS n,
        round(count(*) / (SELECT count(*) FROM rv), 6) AS share FROM rv GROUP BY 1"""
    q["overview_counts"] = f"WITH {REVIEWS_SQL} SELECT count(*) AS reviews, count(DISTINCT parent_product_id) AS products FROM rv"
    q["null_profile"] = _profile()

    q["nested_reviews"] = f"{BASE} SELECT parent_product_id, {POSITION} AS pos, product_id, rating, review_text FROM std"
    q["flatten_nested"] = f"{BASE} SELECT {', '.join(NESTED_KEYS)}, parent_product_id, {POSITION} AS seq FROM std"
    q["product_texts"] = f"{BASE} SELECT parent_product_id, review_text, {POSITION} AS seq FROM std"
    q["validate_nested"] = f"{BASE} {FAULTS}"
    q["validate_verdict"] = f"""{BASE}, f AS ({FAULTS})
        SELECT (SELECT count(DISTINCT parent_product_id) FROM std WHERE parent_product_id NOT IN ('src9', 'src10')) AS products,
          (SELECT count(*) FROM std WHERE parent_product_id NOT IN {NOT_LISTED}) + 1 AS reviews,
          CAST(sum(n) FILTER (severity = 'error') AS BIGINT) AS errors,
          CAST(sum(n) FILTER (severity = 'warning') AS BIGINT) AS warnings, false AS valid FROM f"""

    ranked = "SELECT parent_product_id, seq, product_id FROM std QUALIFY row_number() OVER (PARTITION BY parent_product_id ORDER BY seq) <= 2"
    q["preview_per_group"] = f"{BASE} {ranked}"
    q["preview_products"] = f"""{BASE} SELECT parent_product_id, seq, product_id FROM std
        WHERE parent_product_id IN (SELECT DISTINCT parent_product_id FROM std ORDER BY 1 LIMIT 2)
        QUALIFY row_number() OVER (PARTITION BY parent_product_id ORDER BY seq) <= 2"""
    q["first_rows"] = f"{BASE} SELECT seq, parent_product_id, reviewer_id FROM std ORDER BY seq LIMIT 5"
    q["random_sample"] = f"{BASE} SELECT seq, {', '.join(REVIEW_COLUMNS)} FROM std ORDER BY md5('7:' || seq), seq LIMIT 5"

    raw = f"WITH {REVIEWS_SQL},{RAW_SQL},{tagged_sql()}"
    q["tagged_files"] = f"{raw} SELECT CAST(length(record) AS BIGINT) AS length, count(*) AS n FROM rec GROUP BY 1"
    # Tags and line feeds around the body of each record, and the line feed after each row of two records.
    around = sum(len(a) + len(b) + 1 for a, b in RECORD_TAGS) + 1
    q["file_listing"] = f"""{raw} SELECT CAST(sum(strlen(record)) + {around} * count(*) // 2 AS BIGINT) AS bytes,
        true AS all_counted FROM rec"""
    q["first_record_file"] = f"{raw} SELECT record FROM rec ORDER BY seq LIMIT 1"
    q["summary_file"] = q["summary_counts"].split(" ORDER BY")[0]
    q["helpful_flag_file"] = f"""WITH {REVIEWS_SQL} SELECT parent_product_id, rating,
        CASE WHEN helpful_votes >= 1 THEN 'True' ELSE 'False' END AS is_helpful, count(*) AS n FROM rv GROUP BY 1, 2, 3"""
    q["stopword_file"] = q["stopword_anti"]
    q["vocabulary_file"] = q["vocab_index"]
    q["vector_file"] = q["count_vectors"]
    return q
