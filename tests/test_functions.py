import pytest
from pyspark.sql import functions as F

from reviewmill.functions import clean, convert, porter
from reviewmill.functions import tokens as tk

STEMS = {
    "dry": "dri", "tied": "tie", "enjoy": "enjoy", "play": "play", "fly": "fli", "flies": "fli", "ties": "tie",
    "ability": "abil", "relational": "relat", "conditional": "condit", "hopefully": "hope", "technology": "technolog",
    "caresses": "caress", "ponies": "poni", "feed": "feed", "agreed": "agre", "plastered": "plaster", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "filing": "file",
    "sky": "sky", "skies": "sky", "dying": "die", "news": "news", "proceed": "proceed", "is": "is",
    "vietnamization": "vietnam", "adoption": "adopt", "controll": "control", "roll": "roll", "rate": "rate", "cease": "ceas",
}


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("word,expected", STEMS.items())
def test_stem(word, expected):
    assert porter.stem(word) == expected


def test_stem_column_matches_function(spark):
    words = list(STEMS) * 3 + [None]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", tk.stem_word("w").alias("s")).collect()
    assert all(r.s == (porter.stem(r.w) if r.w else None) for r in rows)


def test_tokens_in_order(spark):
    assert one(spark, "Don't buy 2 batteries", lambda x: tk.words(x)) == ["don", "t", "buy", "batteries"]
    assert one(spark, "Don't buy the batteries of it, batteries!", lambda x: tk.review_tokens(x, tk.STOPWORDS)) == [
        "don", "buy", "batteri", "batteri"]
    assert one(spark, "12 34", lambda x: tk.review_tokens(x, tk.STOPWORDS)) == []
    assert one(spark, None, lambda x: tk.review_tokens(x, tk.STOPWORDS)) is None
    assert one(spark, "abc de fgh", lambda x: tk.adjacent_pairs(tk.words(x))) == [("abc", "de"), ("de", "fgh")]
    assert one(spark, "abc", lambda x: tk.adjacent_pairs(tk.words(x))) == []
    assert one(spark, "12", lambda x: tk.adjacent_pairs(tk.words(x))) == []


def test_word_count(spark):
    assert one(spark, "  a b\n c ", tk.word_count) == 3
    assert one(spark, "", tk.word_count) == 0


@pytest.mark.parametrize(
    "text,expected",
    [("good<br>value", "goodvalue"), ("a\nb", "ab"), ("café \U0001f603", "caf"), ("<br/>", ""), ("a < b > c", "a  c"),
     ("a <b\n> c", "a <b> c"), ("漢字 ok", "ok"), (" x", "x")],
)
def test_clean(spark, text, expected):
    assert one(spark, text, clean.clean_review) == expected


def test_composed_cleaning_equals_single_steps(spark):
    text = "─ <i>x</i> \U0001f1e6\U0001f680 Ⓜ café"
    steps = one(spark, text, lambda x: F.trim(clean.strip_unprintable(clean.strip_emoji(clean.strip_html(x)))))
    assert steps == one(spark, text, clean.clean_review)
    assert one(spark, text, clean.strip_emoji) == " <i>x</i>   café"
    assert one(spark, text, clean.english_or_missing) == "none"


@pytest.mark.parametrize(
    "text,number", [("5", 5.0), (" 4.5 ", 4.5), ("1e2", 100.0), ("five", None), ("5d", None), ("", None), ("nan", None), (None, None)]
)
def test_numbers(spark, text, number):
    assert one(spark, text, convert.to_number) == number


def test_times_and_flags(spark):
    assert one(spark, "1588687728923", lambda x: convert.format_timestamp(convert.epoch_millis(x))) == "2020-05-05 14:08:48"
    assert one(spark, "1.588687728923E12", lambda x: convert.format_timestamp(convert.epoch_millis(x))) == "2020-05-05 14:08:48"
    assert one(spark, "x", convert.epoch_millis) is None
    for beyond in ("99999999999999999", "-99999999999999999", "9223372036855"):
        assert one(spark, beyond, convert.epoch_millis) is None
    assert one(spark, None, lambda x: convert.to_flag(x, missing=None)) is None
    assert one(spark, None, convert.to_flag) is False
    assert one(spark, " TRUE\t", convert.to_flag) is True
    assert one(spark, "yes", convert.to_flag) is False
    assert one(spark, None, convert.to_flag) is False
    assert one(spark, "2020–05–05 14:08:48", lambda x: convert.weekday_name(convert.parse_timestamp(x))) == "Tuesday"
    assert one(spark, "none", convert.parse_timestamp) is None
    assert [one(spark, v, lambda x: convert.filled(x)) for v in ("", None, "a", "\n")] == ["none", "none", "a", "\n"]


def test_drop_prefixed(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`X.1` int, aX int, X int")
    assert convert.drop_prefixed(df).columns == ["aX"]


def test_stems_of_a_published_vocabulary():
    from reviewmill.functions.porter import stem

    words = {"ability": "abil", "dry": "dri", "drying": "dri", "enjoyed": "enjoy", "tied": "tie", "flies": "fli", "yrs": "yr"}
    assert {w: stem(w) for w in words} == words
