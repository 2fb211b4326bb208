"""Files of one JSON object, cut anywhere, against a plain loader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import validate
from reviewmill.schema import NESTED_KEYS
from reviewmill.sources import json_object, nested

GOOD = {k: "x" for k in NESTED_KEYS} | {"rating": "4.0", "review_timestamp": "2020-05-05 14:08:48"}
TEXTS = ['say "hi" {now}', "}}}{{{", 'back\\slash \\" }', "[1,2]: {", "é 漢 \U0001f603", "line\nfeed\ttab", "", "plain words " * 20, ",:,:", '"']


def products(seed, n=12):
    """Products with and without reviews; keys and texts are full of marks."""
    rnd = random.Random(seed)
    found = {}
    for i in range(n):
        reviews = [GOOD | {"review_text": rnd.choice(TEXTS), "product_id": f"r{j}"} for j in range(rnd.choice([1, 2, 5, 40]))]
        found[f"p{i}{rnd.choice(['', '}', '{:,', chr(34), 'é'])}"] = {"reviews": reviews}
    return found


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def read(spark, folder, split=1 << 27, chunk=json_object.CHUNK_BYTES):
    """Documents by file."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = json_object.members(spark, str(folder), chunk).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    names = spark.read.format("binaryFile").load(str(folder)).select(F.xxhash64("_metadata.file_path").alias("file"), "path").collect()
    found = {r.file: (r.path.rsplit("/", 1)[1], []) for r in names}
    for r in rows:
        found[r.file][1].append(r.value)
    return dict(found.values())


def together(documents):
    """Documents of the reader as the products of one object."""
    parts = {}
    for text in documents:
        for key, content in json.loads(text).items():
            if isinstance(content, dict) and "chunk" in content:
                parts.setdefault(key, []).append((content["chunk"], content["reviews"]))
            else:
                assert key not in parts
                parts[key] = content
    return {k: {"reviews": [r for _, rs in sorted(v, key=lambda x: x[0]) for r in rs]} if isinstance(v, list) and v and isinstance(v[0], tuple) else v
            for k, v in parts.items()}


@pytest.mark.parametrize("split, chunk", [(1 << 27, 1 << 22), (3000, 50)])
def test_products_are_those_of_a_plain_loader(spark, tmp_path, split, chunk):
    shapes = {"a": {}, "b": [], "c": {"reviews": []}, "d": {"reviews": {}}, "e": {"reviews": None}, "f": 7, "g": {"other": [1, {"x": "}"}], "more": "{"}}
    texts = {}
    for i, indent in enumerate([2, None, 0]):
        text = json.dumps(products(i, 5) | (shapes if i == 1 else {}), ensure_ascii=i % 2 == 0, indent=indent)
        texts[f"{i}.json"] = text + ("\n" if i == 2 else "")
        write(tmp_path, f"{i}.json", texts[f"{i}.json"])
    found = read(spark, tmp_path, split, chunk)
    assert {name: together(documents) for name, documents in found.items()} == {name: json.loads(text) for name, text in texts.items()}


REPEATED = """{"p": {"reviews": [{"rating": "1", "rating": "2"}]}, "q": {"reviews": [{"rating": "3"}], "reviews": [{"rating": "4"}, {"rating": NaN}]},
 "p": {"reviews": [{"rating": "5", "x": -Infinity, "rating": "6"}, {"rating": "7"}]}, "r": {"reviews": [{"rating": "8"}]}, "\\u0071": {"reviews": [{"rating": "9"}]}}"""


@pytest.mark.parametrize("split, chunk", [(1 << 27, 1 << 22), (150, 1)])
def test_the_last_of_repeated_keys_counts(spark, tmp_path, split, chunk):
    write(tmp_path, "a.json", REPEATED)
    found = together(read(spark, tmp_path, split, chunk)["a.json"])
    plain = json.loads(REPEATED, parse_constant=lambda _: None)
    assert found == plain == {
        "p": {"reviews": [{"rating": "6", "x": None}, {"rating": "7"}]}, "r": {"reviews": [{"rating": "8"}]}, "q": {"reviews": [{"rating": "9"}]},
    }


NONE_WHOLE = [
    "no json", "{", '{"a":{"reviews":[{"rating":"1"}]}', '{"a":{"reviews":[{"rating":"1"}]}}}', '{"a":{"reviews":[{"rating":"1"}]}} x', '{"a" {}}',
    '{"a":{"reviews":[{"rating":"1"} {"rating":"2"}]}}', '{"a":{"reviews":[{"rating":"1"},]}}', '{"a":{"reviews":[{"rating" "1"}]}}', '{"a":{},,"b":{}}',
    '{a:{"reviews":[]}}', '{"a":{"reviews":[{"rating":"1"}]},}', '{"a":"open}', '{"a":{"reviews":[{"rating":"1"}]}}{"b":{}}', '"a":{}}', '{"a":{"b":[1,2}}',
]


@pytest.mark.parametrize("split, chunk", [(1 << 27, 1 << 22), (1 << 27, 1)])
def test_faulty_files_are_not_valid(spark, tmp_path, split, chunk):
    for i, text in enumerate(NONE_WHOLE):
        with pytest.raises(ValueError):
            json.loads(text)
        write(tmp_path, f"{i}.json", text)
    rows = [(name, v) for name, documents in read(spark, tmp_path, split, chunk).items() for v in documents]
    df = spark.createDataFrame(rows, "name string, value string")
    broken = {r.name for r in df.filter(F.try_parse_json("value").isNull()).collect()}
    assert broken == {f"{i}.json" for i in range(len(NONE_WHOLE))}
    assert "not_loaded" in {r.rule for r in validate.issues(df).collect()}


def test_a_list_is_no_object_and_an_empty_object_is_fine(spark, tmp_path):
    for name, text in (("l", " [1, {}]"), ("s", '"text"'), ("e", " {\n}\n")):
        write(tmp_path, name, text)
    rules = {}
    for name, documents in read(spark, tmp_path).items():
        rows = spark.createDataFrame([(v,) for v in documents], "value string")
        rules[name] = [r.rule for r in validate.issues(rows).collect()]
    assert rules == {"l": ["top_level_not_object"], "s": ["top_level_not_object"], "e": []}


def test_rules_and_reviews_are_those_of_the_whole_text(spark, tmp_path):
    faults = [
        GOOD, {k: v for k, v in GOOD.items() if k != "category"}, GOOD | {"stars": "1"}, GOOD | {"category": 1, "product_id": None},
        GOOD | {"review_timestamp": "2020/05/05"}, GOOD | {"rating": "five"}, GOOD | {"rating": "7"}, 5, "text", [1], None,
    ]
    text = json.dumps({"p": {"reviews": faults}, "q": {}, "r": {"reviews": None}, "s": [], "t": {"reviews": []}, "u": {"reviews": [GOOD]}}, indent=2)
    write(tmp_path, "a.json", text)
    whole = spark.createDataFrame([(text,)], "value string")
    parts = spark.createDataFrame([(v,) for v in read(spark, tmp_path, 400, 100)["a.json"]], "value string")
    order = lambda df: sorted((r.parent_product_id, r.rule, r.severity) for r in validate.issues(df).collect())
    assert order(parts) == order(whole)
    assert validate.verdict(parts).first() == validate.verdict(whole).first()


def test_a_large_text_is_valid(spark, tmp_path):
    """Beyond what one value may hold here: the files are cut a thousand times smaller."""
    big = {f"p{i}": {"reviews": [GOOD | {"product_id": f"r{j}"} for j in range(50)]} for i in range(40)}
    write(tmp_path, "a.json", json.dumps(big, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        documents = json_object.members(spark, str(tmp_path), 5000).select("value")
        assert validate.verify(documents)
        flat = nested.flatten(documents)
        assert flat.count() == 2000
        ids = [r.product_id for r in flat.filter("parent_product_id = 'p3'").orderBy("seq").collect()]
        assert ids == [f"r{j}" for j in range(50)]
        assert max(len(r.value) for r in documents.collect()) < 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
