"""Field extraction from record text with many spellings of the tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.schema import MISSING, REVIEW_COLUMNS, SEQ

# Accepted tag names of each field, as patterns.
TAG_NAMES = {
    "category": r"category",
    "reviewer_id": r"reviewer[\s_]*id",
    "rating": r"rate|rating",
    "review_title": r"review[\s_]*title|heading",
    "review_text": r"review?[\s_]*text|text",
    "attached_images": r"attached[\s_]*images|pictures|pics",
    "product_id": r"product[\s_]*id",
    "parent_product_id": r"parent[\s_]*product[\s_]*id",
    "review_timestamp": r"review[\s_]*timestamp|timestamp|date|time",
    "is_verified_purchase": r"(?:is[\s_]*)?verified[\s_]*purchase",
    "helpful_votes": r"helpful[\s_]*votes?|votes?|likes",
}

# Fields whose closing tag may lack the slash.
SLASH_OPTIONAL = {"reviewer_id", "review_text", "product_id", "parent_product_id"}

# Fixed value: what a tag scan takes for a tag.
ANY_TAG = r"<\s*/?\s*[a-zA-Z0-9_ ]+\s*>"

# Words that place a tag (lower-cased) under a field.  Each entry lists
# alternatives; all words of an alternative must occur.
TAG_WORDS = {
    "category": [["category"]],
    "reviewer_id": [["reviewer", "id"]],
    "rating": [["rat"]],
    "review_title": [["review", "title"], ["head"]],
    "review_text": [["text"]],
    "attached_images": [["attach", "image"], ["pic"]],
    "product_id": [["product", "id"]],
    "parent_product_id": [["product", "id", "parent"]],
    "review_timestamp": [["time"], ["date"]],
    "is_verified_purchase": [["verif"]],
    "helpful_votes": [["vote"], ["like"]],
}


def field_pattern(field: str) -> str:
    """Regular expression of a field; group 1 is the value, which lies on one line.

    White space is taken in the Unicode sense, as are letter cases.
    """
    names = TAG_NAMES[field]
    if field == "category":
        opening, closing = r"<\s*/?category\s*>", r"<\s*//?category\s*>"
    else:
        slash = "/*" if field in SLASH_OPTIONAL else "/+"
        opening, closing = rf"<\s*(?:{names})\s*>", rf"<\s*{slash}\s*(?:{names})\s*>"
    return rf"(?iU){opening}\s*([^\n]*?)\s*{closing}"


# White space of the field patterns (Unicode's), for trimming.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _tag_pattern() -> str:
    """Opening and closing tags of all fields."""
    others = "|".join(names for field, names in TAG_NAMES.items() if field != "category")
    return rf"(?iU)<\s*(?:/{{0,2}}category|/*\s*(?:{others}))\s*>"


def _tag_names() -> dict[str, str]:
    """Names of tags, in small letters without blanks and underscores, and their fields."""
    found = {}
    for field, names in TAG_NAMES.items():
        for name in names.replace(r"[\s_]*", "").replace(r"(?:is)?", "").split("|"):
            found[name.replace("?", "")] = field
            if "?" in name:
                at = name.index("?")
                found[name[: at - 1] + name[at + 1 :]] = field
    found["isverifiedpurchase"] = "is_verified_purchase"
    return found


def field_values(records: DataFrame) -> DataFrame:
    """``records`` with ``found``: every pair of an opening and a closing tag of a field that has a value, in order.

    One pass finds all tags, one takes the text between them; fields are told apart on that short list.
    The value of an opening tag reaches to the next closing tag of its field, over other tags too, and lies on one line
    once white space at its ends is gone.  An entry has ``field``, ``start`` and ``end`` (places of its tags) and ``value``.
    """
    tag = F.lit(_tag_pattern())
    fields = F.create_map(*(F.lit(x) for item in _tag_names().items() for x in item))
    kept = [c for c in records.columns if c != "found"]
    scanned = records.select(
        *kept, F.regexp_extract_all("record", tag, 0).alias("tags"), F.split("record", _tag_pattern()).alias("gaps")
    )

    def told(t: Column) -> Column:
        slashes = F.length(t) - F.length(F.replace(t, F.lit("/")))
        # Letters fold as in a pattern without regard to case.
        name = F.regexp_replace(F.lower(F.upper(F.translate(t, "\u0130", "I"))), r"(?U)[<>/_\s]+", "")
        field = fields[name]
        free = field.isin(*SLASH_OPTIONAL)
        opens = slashes <= F.when(field == "category", 1).otherwise(0)
        return F.struct(field.alias("field"), opens.alias("opens"), ((slashes > 0) | free).alias("closes"))

    coded = scanned.select(*kept, "tags", "gaps", F.transform("tags", told).alias("coded"))
    n = F.size("coded")

    def pair(c: Column, i: Column) -> Column:
        following = F.get(F.col("coded"), i + 1)
        after = F.sequence(i + 2, n - 1)
        later = F.filter(after, lambda j: (F.get(F.col("coded"), j)["field"] == c["field"]) & F.get(F.col("coded"), j)["closes"])
        far = F.when(i + 2 < n, F.get(later, F.lit(0)))
        end = F.when((following["field"] == c["field"]) & following["closes"], i + 1).otherwise(far)
        between = F.transform(
            F.sequence(i + 1, end),
            lambda j: F.concat(F.get(F.col("gaps"), j), F.when(j < end, F.get(F.col("tags"), j)).otherwise("")),
        )
        text = F.when(end == i + 1, F.get(F.col("gaps"), i + 1)).when(end.isNotNull(), F.array_join(between, ""))
        value = F.btrim(text, F.lit(BLANKS))
        return F.when(
            c["opens"], F.struct(c["field"].alias("field"), i.alias("start"), end.alias("end"), value.alias("value"))
        )

    pairs = F.filter(F.transform("coded", pair), lambda p: p["value"].isNotNull() & ~F.contains(p["value"], F.lit("\n")))
    return coded.select(*kept, pairs.alias("found"))


def extract_fields(records: DataFrame, missing: str | None = None) -> DataFrame:
    """The eleven fields of each record as strings, taken record by record.

    A field without a match is null, or ``missing`` when given; of several matches the first counts.
    """

    def value(field: str) -> Column:
        first = F.get(F.filter("found", lambda p: p["field"] == field), F.lit(0))["value"]
        return (first if missing is None else F.coalesce(first, F.lit(missing))).alias(field)

    return field_values(records.select("record", SEQ)).select(*[value(c) for c in REVIEW_COLUMNS], SEQ)


def extract_or_missing(records: DataFrame) -> DataFrame:
    """Record-wise form with the sentinel for fields that are not there."""
    return extract_fields(records, MISSING)


def tags(records: DataFrame) -> DataFrame:
    """Every opening or closing tag of every record."""
    return records.select(F.explode(F.regexp_extract_all("record", F.lit(ANY_TAG), 0)).alias("tag"))


def _belongs(tag: Column, field: str) -> Column:
    lowered = F.lower(tag)
    hit = F.lit(False)
    for words in TAG_WORDS[field]:
        every = F.lit(True)
        for word in words:
            every = every & F.contains(lowered, F.lit(word))
        hit = hit | every
    if field == "category":
        hit = hit & ~F.startswith(tag, F.lit("</"))
    if field == "product_id":
        hit = hit & ~F.contains(lowered, F.lit("parent"))
    return hit


def tag_variants(records: DataFrame) -> DataFrame:
    """Spellings of the tags of each field with their number, in one pass.

    Tags are counted before they are assigned to fields, so the word tests run once per
    distinct spelling.
    """
    counted = tags(records).groupBy("tag").agg(F.count("*").alias("n"))
    fields = F.array(*[F.when(_belongs(F.col("tag"), f), F.lit(f)) for f in REVIEW_COLUMNS])
    return counted.select(F.explode(F.array_compact(fields)).alias("field"), "tag", "n")


def match_counts(records: DataFrame) -> DataFrame:
    """Hits of each field's pattern against the number of records.

    Matches of a field do not overlap: after one, the next begins behind its closing tag.
    """
    nothing = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n"))

    def step(so_far: Column, p: Column) -> Column:
        more = F.struct(p["end"].alias("end"), (so_far["n"] + 1).alias("n"))
        return F.when(p["start"] > so_far["end"], more).otherwise(so_far)

    def hits_of(field: str) -> Column:
        return F.aggregate(F.filter("found", lambda p: p["field"] == field), nothing, step)["n"]

    found = field_values(records.select("record"))
    hits = found.agg(F.count("*").alias("records"), *[F.sum(hits_of(f)).alias(f) for f in REVIEW_COLUMNS])
    return hits.unpivot("records", REVIEW_COLUMNS, "field", "hits").select("field", "hits", "records")


def unmatched(records: DataFrame, field: str) -> DataFrame:
    """Records in which the pattern of ``field`` finds nothing."""
    return records.filter(~F.regexp_like("record", F.lit(field_pattern(field))))


def unmatched_counts(records: DataFrame) -> DataFrame:
    """Number of records without a match, for every field in one pass."""
    fields = F.transform("found", lambda p: p["field"])
    found = field_values(records.select("record")).select(fields.alias("fields"))
    missing = found.agg(*[F.count_if(~F.array_contains("fields", f)).alias(f) for f in REVIEW_COLUMNS])
    return missing.unpivot([], REVIEW_COLUMNS, "field", "unmatched")


def first_unmatched(records: DataFrame, field: str, n: int = 3) -> DataFrame:
    return unmatched(records, field).orderBy(SEQ).limit(n)
