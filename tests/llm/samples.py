"""Small corpora for the tests of the numbered operators."""

import random

EN = "the and of tion ing er on an ea th he re nd ou st".split()
DE = "der und sch keit ung ich ein ver ge be ß ü äu tz pf".split()


def prose(rnd, n, parts=EN):
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if rnd.random() < 0.1 else "\n" if rnd.random() < 0.05 else "") for w in words)


def corpus(n=80, seed=3):
    """(doc_id, text, lang, source) with a hot source, copies and near copies."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = "de" if i % 4 == 0 else "en"
        text = prose(rnd, rnd.choice([3, 30, 90, 150]), DE if lang == "de" else EN)
        if i % 7 == 6:
            _, text, lang, _ = rows[rnd.randrange(len(rows))]
        elif i % 7 == 5:
            lang, words = rows[-1][2], rows[-1][1].split(" ")
            words[len(words) // 2] = "changed"
            text = " ".join(words).upper() if rnd.random() < 0.3 else " ".join(words)
        rows.append((i, text, lang, f"s{i % 5 if i % 3 else 0}"))
    return rows


def odd_rows(seed=5):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rnd = random.Random(seed)
    long = prose(rnd, 20_000)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, long, "en", None),
        (5, "same words here again", "en", "b"), (5, "same words here again", "en", "b"), (6, "same words here again", None, "b"),
        (7, "one", "de", "b"), (8, "é ü \U0001f600 ß", "de", "c"), (None, "without an id at all", "en", "c"), (9, "12 34 ++", None, None),
        (10, "x" * 50_000, "en", "a"), (5, "another text of document five", "en", "b"),
    ]


TYPES = "doc_id long, text string, lang string, source string"
#: Names that clash with columns made on the way.
EXTRA = ["n", "rep", "key", "start", "end", "spans", "score", "position", "slot", "words", "row", "_read", "parts", "label"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, TYPES).repartition(parts)


def with_extra(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(7) for name in EXTRA})
