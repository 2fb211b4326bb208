"""Secret scan with multipart credential linking.

Strong spans (the base kinds ``assign``, ``access``, ``hex``) are always reported.  Weak parts - short
access identifiers, short assigned values, opaque strings of mixed characters, endpoints - are
interval-joined within scopes of ``scope`` characters and reported only beside what completes them:

* ``weak_access`` beside a secret (assign, hex, weak_assign, opaque);
* ``weak_assign`` and ``opaque`` beside an access identifier (access, weak_access);
* ``endpoint`` beside an access identifier and a secret.

Weak parts that overlap a strong span are dropped.  Patterns run once over each whole text; gaps and
lengths of the matches become rows, running sums give code-point places, and a range join on
(document, scope cell) links the parts.  All of it is built-in functions.

Nulls and edges: a null text is empty and has no spans; rows of equal text share their spans, whatever
their doc_id, and each row is returned once; a null doc_id stays null; an empty table gives no
rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 400
# Fixed values of the base kinds.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
# Weak parts.
OPAQUE = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]{0,60}[0-9])(?=[a-z0-9+/_=-]{0,60}[A-Z])(?=[A-Z0-9+/_=-]{0,60}[a-z])"
    r"[A-Za-z0-9+/_=-]{20,}"
)
ENDPOINT = r"(?:https?|s3|jdbc:[a-z]+|postgres|mysql|redis|amqp)://[^\x20\x09-\x0D\"'<>]+"
KINDS = ["assign", "access", "hex", "weak_assign", "weak_access", "opaque", "endpoint"]
BASE = KINDS[:3]
# What tells documents apart: equal texts have equal spans, so copies share one name and one scan's rows.
RID = "concat(length(text), ':', hex(xxhash64(text)), ':', crc32(encode(text, 'UTF-8')))"
ACCESS_KINDS, SECRET_KINDS = ["access", "weak_access"], ["assign", "hex", "weak_assign", "opaque"]


def quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def items(name: str, kind: str) -> str:
    """Matches as rows to be: kind or null where a match fails, order, gap before it, its length."""
    return (
        f"transform({name}, (x, i) -> named_struct('source', '{name}', 'kind', {kind}, 'at', i,"
        f" 'gap', length(get({name}_gaps, i)), 'size', length(x)))"
    )


def matches(docs: DataFrame) -> DataFrame:
    """Per distinct text with matches: the items of all patterns."""
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "opaque": OPAQUE, "endpoint": ENDPOINT}
    rows = docs.select(F.expr(RID).alias("rid"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.selectExpr(
        "rid",
        "text",
        *[f"regexp_extract_all(text, {quoted(p)}, 0) AS {n}" for n, p in patterns.items()],
        f"regexp_extract_all(text, {quoted(ASSIGN)}, 1) AS assigned",
    )
    rows = rows.selectExpr(
        "rid",
        *patterns,
        "assigned",
        *[
            f"CASE WHEN size({n}) > 0 THEN split(text, {quoted(p)}, -1) ELSE array() END AS {n}_gaps"
            for n, p in patterns.items()
        ],
    )
    kinds = {
        "assign": "CASE WHEN length(get(assigned, i)) >= 12 THEN 'assign'"
        " WHEN length(get(assigned, i)) >= 6 THEN 'weak_assign' END",
        "access": "CASE WHEN length(x) >= 18 THEN 'access' WHEN length(x) >= 16 THEN 'weak_access' END",
        "hex": "'hex'",
        "opaque": "'opaque'",
        "endpoint": "'endpoint'",
    }
    joined = ", ".join(items(n, kinds[n]) for n in patterns)
    rows = rows.selectExpr("rid", f"concat({joined}) AS items").filter("size(items) > 0")
    return rows.groupBy("rid").agg(F.first("items").alias("items"))


def located(found: DataFrame) -> DataFrame:
    """One row per passing match with its code-point interval."""
    rows = found.select("rid", F.explode("items").alias("item")).select("rid", "item.*")
    so_far = Window.partitionBy("rid", "source").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
    rows = rows.filter("kind IS NOT NULL")
    return rows.select("rid", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Strong spans and the weak ones that their complements confirm."""
    strong, weak = F.col("kind").isin(BASE), ~F.col("kind").isin(BASE)

    def cells(first, last):
        return F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope))).alias("cell")

    covered = spans.filter(strong).select(
        F.col("rid").alias("s_rid"), F.col("start").alias("s_start"), F.col("end").alias("s_end"),
        cells(F.col("start"), F.col("end") - 1),
    )
    parts = spans.filter(weak).select("*", cells(F.col("start"), F.col("end") - 1))
    overlap = (F.col("rid") == F.col("s_rid")) & (parts["cell"] == covered["cell"])
    overlap = overlap & (F.col("s_start") < F.col("end")) & (F.col("start") < F.col("s_end"))
    hidden = parts.join(covered, overlap, "left_semi").select("rid", "kind", "start").distinct()
    parts = spans.filter(weak).join(hidden, ["rid", "kind", "start"], "left_anti")

    others = spans.filter(strong).unionByName(parts)
    others = others.select(
        F.col("rid").alias("o_rid"), F.col("kind").alias("o_kind"), F.col("start").alias("o_start"),
        F.col("end").alias("o_end"), cells(F.col("start"), F.col("end") - 1),
    )
    near = parts.select("*", cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    within = (F.col("rid") == F.col("o_rid")) & (near["cell"] == others["cell"])
    within = within & (F.col("o_start") < F.col("end") + scope) & (F.col("start") - scope < F.col("o_end"))
    within = within & ~((F.col("o_kind") == F.col("kind")) & (F.col("o_start") == F.col("start")))
    # A part next to itself under another cell is met again; the maxima do not mind.
    beside = near.join(others, within).groupBy("rid", "kind", "start", "end").agg(
        F.max(F.col("o_kind").isin(ACCESS_KINDS)).alias("has_access"),
        F.max(F.col("o_kind").isin(SECRET_KINDS)).alias("has_secret"),
    )
    confirmed = (
        F.when(F.col("kind") == "weak_access", F.col("has_secret"))
        .when(F.col("kind") == "endpoint", F.col("has_access") & F.col("has_secret"))
        .otherwise(F.col("has_access"))
    )
    return spans.filter(strong).unionByName(beside.filter(confirmed).select(*spans.columns))


def span_lists(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """For each distinct document with spans: all of them by start, then kind."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = linked(located(matches(docs)), scope).withColumn("rank", order)
    return spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("s"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document its spans: array of (kind, start, end) by start, then kind."""
    rows = docs.select("doc_id", F.expr(RID).alias("rid")).join(span_lists(docs, scope), "rid", "left")
    spans = "transform(coalesce(s, array()), x -> struct(x.kind AS kind, x.start AS start, x.end AS end))"
    return rows.select("doc_id", F.expr(spans).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    text = "array_join(transform({0}, x -> concat_ws(':', x.kind, string(x.start), string(x.end))), ',')"
    base = ", ".join(f"'{k}'" for k in BASE)
    counts = [
        F.expr(f"CAST(size(filter(spans, x -> x.kind = '{k}')) AS long)").alias(f"n_{k}") for k in BASE
    ]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(text.format(f"filter(spans, x -> x.kind IN ({base}))")), 256).alias("base_sha256"),
        F.expr(text.format("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mask: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The documents, all columns kept, with every reported span replaced by ``mask``."""
    lists = span_lists(docs, scope)
    names = docs.columns
    rows = docs.withColumn("text", F.col("text").cast("string"))
    rows = rows.select(F.struct(*names).alias("row"), F.expr(RID).alias("rid")).join(lists, "rid", "left")
    cut = F.expr(
        "CASE WHEN s IS NULL THEN row.text ELSE aggregate(s, struct(0L AS at, '' AS out), (a, x) -> CASE"
        " WHEN x.start >= a.at THEN struct(x.end AS at,"
        f" concat(a.out, substring(row.text, int(a.at + 1), int(x.start - a.at)), '{mask}') AS out)"
        " ELSE struct(greatest(a.at, x.end) AS at, a.out AS out) END,"
        " a -> concat(a.out, substring(row.text, int(a.at + 1)))) END"
    )
    return rows.select(*[cut.alias(n) if n == "text" else F.col("row")[n].alias(n) for n in names])
