import json
import random
import re

import pytest
from helpers import random_texts, token_list, write_workbook
from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.operators import nest, table, validate
from reviewmill.operators.ranges import running_totals
from reviewmill.plans import jobs
from reviewmill.schema import NESTED_KEYS, REVIEW_COLUMNS
from reviewmill.sinks import files
from reviewmill.sources import dictionaries, nested, tagged_text, workbook


def records(found):
    return [r.record for r in found.orderBy("path", "seq").collect()]


def text_tree(folder):
    (folder / "deep" / "er").mkdir(parents=True)
    (folder / "in_1.txt").write_text("<record>a\n1</record>junk<RECORD>b</Record>\n", encoding="utf-8")
    (folder / "deep" / "in_2.txt").write_text("<record>é</record>\n<record>open end", encoding="utf-8")
    (folder / "deep" / "er" / "in_3.txt").write_text(
        "</record>" + "".join(f"<record>{i} <record> x</record>\n" for i in range(500)) + "<record>last</record>",
        encoding="utf-8",
    )
    (folder / "other.txt").write_text("<record>no</record>")
    (folder / "in_4.csv").write_text("<record>no</record>")


def read_with(spark, folder, split, cores, pattern="in_*.txt"):
    """Records read with splits of ``split`` bytes, as many as ``cores`` cores would make."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.minPartitionNum", str(cores))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = tagged_text.read_records(spark, str(folder), pattern)
        rows = [(r.path.rsplit("/", 1)[1], r.seq, r.offset, r.record) for r in found.orderBy("seq").collect()]
    finally:
        for name in ("maxPartitionBytes", "minPartitionNum", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
    return rows


def plain_records(folder):
    """(file, offset, record) by path, from whole files."""
    found = []
    for path in sorted(folder.rglob("in_*.txt"), key=lambda p: p.as_uri()):
        for m in re.finditer(rb"(?is)<record>(.*?)</record>", path.read_bytes()):
            found.append((path.name, m.start(), m[1].decode()))
    return found


@pytest.mark.parametrize("split, cores", [(1 << 27, 1), (2000, 1), (300, 7)])
def test_tagged_text(spark, tmp_path, split, cores):
    text_tree(tmp_path)
    rows = read_with(spark, tmp_path, split, cores)
    by_file = {}
    for name, _, _, record in rows:
        by_file.setdefault(name, []).append(record)
    assert by_file["in_1.txt"] == ["a\n1", "b"]
    assert by_file["in_2.txt"] == ["é"]
    assert by_file["in_3.txt"] == [f"{i} <record> x" for i in range(500)] + ["last"]
    assert set(by_file) == {"in_1.txt", "in_2.txt", "in_3.txt"}
    assert [(n, o, r) for n, _, o, r in rows] == plain_records(tmp_path)
    assert [s - rows[0][1] for _, s, _, _ in rows] == list(range(len(rows)))


@pytest.mark.parametrize("seed", range(2))
def test_records_do_not_depend_on_splits(spark, tmp_path, seed):
    """Tags in any case, records longer than several splits, open ends, stray tags, text that is never closed."""
    rnd = random.Random(seed)
    closings = ["</record>", "</RECORD>", "</Record>"][:2] if seed < 1 else ["</rEcOrD>", "</RECORD>"]
    for i in range(4):
        parts = []
        for _ in range(rnd.randrange(0, 60)):
            parts.append(rnd.choice(["<record>", "<RECORD>", "<Record>", "junk ", "\r\n", "</p>", "<", "</", "é\n", "<record", "record>"]))
            parts.append("x" * rnd.choice([0, 3, 40, 700]))
            parts.append(rnd.choice([*closings, *closings, "", "</recor d>"]))
        (tmp_path / f"in_{i} b.txt").write_bytes("".join(parts).encode())
    (tmp_path / "in_8.txt").write_bytes(b"<record>" + b"never </closed " * 300)
    (tmp_path / "in_9.txt").write_bytes(b"")
    want = plain_records(tmp_path)
    first = read_with(spark, tmp_path, 1 << 27, 1)
    assert [(n.replace("%20", " "), o, r) for n, _, o, r in first] == want
    for split, cores in [(400, 3)]:
        assert read_with(spark, tmp_path, split, cores) == first


def test_invalid_bytes_do_not_stop_the_reader(spark, tmp_path):
    (tmp_path / "in_1.txt").write_bytes(b"<record>a\xff\xfe b</record><record>c</RECORD>")
    found = tagged_text.read_records(spark, str(tmp_path), "in_*.txt").orderBy("seq")
    assert [bytes(r[0]) for r in found.select(found.record.cast("binary")).collect()] == [b"a\xff\xfe b", b"c"]


def test_text_that_is_never_closed_is_not_brought_together(spark, tmp_path):
    (tmp_path / "in_1.txt").write_bytes(b"<record>ok</record><record>" + b"open </x " * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        pieces = spark.read.text(str(tmp_path), lineSep="</").select(
            F.lit(1).cast("long").alias("file"), "_metadata.file_block_start", F.col("value").cast("binary")
        )
        cut = session.stage(pieces.mapInArrow(tagged_text._cut, tagged_text.CUT), "cut")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert cut.filter(F.col("kind") == tagged_text.WITHOUT).count() > 10
    assert tagged_text._chained(cut).count() == 0


def test_running_totals(spark):
    rnd = random.Random(1)
    values = [(f"k{rnd.randrange(10)}", i, rnd.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(values, "a string, b int, range int")
    found = running_totals(df, ["a", "b"], {"range": "before"})
    total, want = 0, []
    for a, b, n in sorted(values):
        want.append((a, b, n, total))
        total += n
    assert found.columns == ["a", "b", "range", "before"]
    assert sorted(map(tuple, found.collect())) == want
    assert running_totals(df.limit(0), ["a", "b"], {"range": "before"}).count() == 0


def test_only_small_tables_are_sent(spark):
    copy = session.stage(spark.range(1000), "numbers")
    assert "ResolvedHint" in session.sent_if_small(copy)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in session.sent_if_small(copy, 10)._jdf.queryExecution().analyzed().toString()


def test_file_count_and_first_record(spark, tmp_path):
    text_tree(tmp_path)
    assert tagged_text.count_files(spark, str(tmp_path)).first().files == 2
    assert tagged_text.count_files(spark, str(tmp_path), "in_*.txt", recursive=True).first().files == 3
    found = tagged_text.read_records(spark, str(tmp_path), "in_1.txt")
    assert tagged_text.first_record(found).first().record == "a\n1"


def test_workbook(spark, tmp_path):
    header = ["X1", *REVIEW_COLUMNS]
    row = ["junk", "Cat", "u1", 4.5, "Title", "inline:Some text", None, "p1", "Q1", 1588687728923, True, 2]
    write_workbook(tmp_path / "a.xlsx", {"one": [header, row, row], "two": [header[:-1], [*row[:-2], False]]})
    rows = workbook.read_workbooks(spark, str(tmp_path))
    assert sorted(r.sheet for r in rows.collect()) == ["one", "one", "two"]
    typed = table.typed(workbook.workbook_reviews(rows)).orderBy("seq").collect()
    assert (typed[0].rating, typed[0].helpful_votes, typed[0].is_verified_purchase) == (4.5, 2, True)
    assert typed[0].review_text == "Some text" and typed[0].attached_images is None
    assert str(typed[0].review_timestamp) == "2020-05-05 14:08:48"
    assert (typed[2].helpful_votes, typed[2].is_verified_purchase) == (None, False)
    assert workbook.workbook_reviews(rows).columns == [*REVIEW_COLUMNS, "seq"]


def standard_rows(spark, n=300):
    rows = random_texts(n)
    df = spark.createDataFrame(rows, "parent_product_id string, seq long, review_text string")
    for c in REVIEW_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.concat(F.lit(c[0]), F.col("seq") % 7))
    return df.select(*REVIEW_COLUMNS, "seq")


@pytest.mark.parametrize("bits", [14, 3])
def test_nested_round_trip(spark, tmp_path, bits):
    df = standard_rows(spark)
    out = str(tmp_path / "nested")
    files.write_nested(df, out, chunk_bits=bits)
    flat = nested.flatten(nested.read_documents(spark, out))
    order = lambda d: [tuple(r[c] for c in REVIEW_COLUMNS) for r in d.orderBy("parent_product_id", "seq").collect()]
    assert order(flat) == order(df)
    assert flat.select("parent_product_id", "seq").distinct().count() == df.count()
    listed = nest.nest(df, bits)
    largest = listed.select(F.size("reviews").alias("n")).agg(F.max("n")).first()[0]
    places = df.select("parent_product_id", F.shiftright("seq", bits)).distinct().count()
    assert largest <= 1 << bits and listed.count() == places
    assert listed.filter("chunk is null").isEmpty()


def test_single_object_export(spark, tmp_path):
    df = standard_rows(spark, 40)
    files.export_single_object(df, str(tmp_path / "one"), chunk_bits=2)
    part = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "one").glob("part-*")))
    loaded = json.loads(part)
    assert sum(len(v["reviews"]) for v in loaded.values()) == 40
    (tmp_path / "whole.json").write_text(part, encoding="utf-8")
    assert set(loaded["p0"]["reviews"][0]) == set(NESTED_KEYS)
    assert nested.flatten(nested.read_documents(spark, str(tmp_path / "whole.json"), whole_file=True)).count() == 40
    files.export_single_object(df.limit(0), str(tmp_path / "none"))
    assert "".join(p.read_text() for p in (tmp_path / "none").glob("part-*")).strip() == "{}"


def test_missing_text_and_empty_list(spark):
    lines = [('{"p":{"reviews":[{"rating":"1"},{"review_text":"x"}]}}',), ('{"q":{"reviews":[]}}',), ('{"r":{}}',)]
    rows = nested.product_texts(spark.createDataFrame(lines, "value string")).collect()
    assert sorted(map(tuple, rows)) == [("p", "none", 0), ("p", "x", 1)]


def test_vocabulary_and_vector_files(spark, tmp_path):
    terms = spark.createDataFrame([("b_c", 1), ("a", 0)], "term string, idx long")
    files.write_vocabulary(terms, str(tmp_path / "v"))
    assert next((tmp_path / "v").glob("part-*")).read_text() == "a:0\nb_c:1\n"
    assert sorted(map(tuple, dictionaries.read_vocabulary(spark, str(tmp_path / "v")).collect())) == [("a", 0), ("b_c", 1)]
    counts = [("p", 1, 2), ("p", 0, 5), ("q", 10, 1), ("q", 9, 3)]
    long = spark.createDataFrame(counts, "parent_product_id string, idx long, n long")
    products = spark.createDataFrame([("p",), ("q",), ("q",), ("z",)], "parent_product_id string")
    files.write_vectors(long, products, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*")))
    assert sorted(text.split()) == ["p,0:5,1:2", "q,9:3,10:1", "z,"]
    assert sorted(map(tuple, dictionaries.read_vectors(spark, str(tmp_path / "c")).collect())) == sorted(counts)
    maps = {r.parent_product_id: r.counts for r in dictionaries.read_vector_maps(spark, str(tmp_path / "c")).collect()}
    assert maps == {"p": {0: 5, 1: 2}, "q": {9: 3, 10: 1}, "z": {}}
    (tmp_path / "odd.txt").write_text("p,0:1,junk,2:3\n")
    assert dictionaries.read_vectors(spark, str(tmp_path / "odd.txt")).count() == 2


def test_stopword_file(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nand\nthe\n")
    words = dictionaries.read_stopwords(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.word for r in words.collect()) == ["and", "the"]


def test_shared_folder_comes_from_the_session():
    class Context:
        def getCheckpointDir(self):
            return None

    class Conf:
        settings = {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}

        def get(self, key, default=None):
            return self.settings.get(key, default)

    class Session:
        conf, sparkContext = Conf(), Context()

    assert session.shared_folder(Session()) == "hdfs:///warehouse"
    Conf.settings["spark.checkpoint.dir"] = "hdfs:///shared"
    assert session.shared_folder(Session()) == "hdfs:///shared"


def test_scratch_is_released(spark):
    with session.Scratch(spark) as scratch:
        copy = scratch.stage(spark.range(3), "numbers")
        assert copy.count() == 3
        files_there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(scratch.folder).count()
    assert files_there > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(scratch.folder).count()


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([("p,1", 3, 2)], "parent_product_id string, review_count long, review_text_count long")
    files.write_summary(df, str(tmp_path / "s"))
    assert next((tmp_path / "s").glob("part-*")).read_text() == 'parent_product_id,review_count,review_text_count\n"p,1",3,2\n'
    flags = spark.createDataFrame([("p", 5.0, True)], "parent_product_id string, rating double, is_helpful boolean")
    files.write_helpful_flags(flags.coalesce(1), str(tmp_path / "f"))
    assert next((tmp_path / "f").glob("part-*")).read_text() == "parent_product_id,rating,is_helpful\np,5.0,True\n"


FAULTS = [
    ("no json", [(None, "not_loaded")]),
    ("[1]", [(None, "top_level_not_object")]),
    ('{"a":[]}', [("a", "product_not_object")]),
    ('{"a":{}}', [("a", "reviews_missing")]),
    ('{"a":{"reviews":null}}', [("a", "reviews_not_list")]),
    ('{"a":{"reviews":[]}}', [("a", "reviews_empty")]),
    ('{"a":{"reviews":[3]}}', [("a", "review_not_object")]),
    ("{}", []),
]


@pytest.mark.parametrize("text,expected", FAULTS)
def test_document_rules(spark, text, expected):
    found = validate.issues(spark.createDataFrame([(text,)], "value string")).collect()
    assert [(r.parent_product_id, r.rule) for r in found] == expected


GOOD = {k: "x" for k in NESTED_KEYS} | {"rating": "4.0", "review_timestamp": "2020-05-05 14:08:48"}

REVIEWS = [
    (GOOD, []),
    ({k: v for k, v in GOOD.items() if k != "category"}, ["keys_missing"]),
    (GOOD | {"stars": "1"}, ["keys_extra"]),
    (GOOD | {"category": 1, "product_id": None}, ["value_not_string", "value_not_string"]),
    (GOOD | {"review_timestamp": "2020/05/05"}, ["bad_timestamp"]),
    (GOOD | {"review_timestamp": "2020-02-30 00:00:00"}, ["bad_timestamp"]),
    (GOOD | {"review_timestamp": "2020-2-3 4:05:06"}, []),
    (GOOD | {"rating": "five"}, ["bad_rating"]),
    (GOOD | {"rating": "7"}, ["rating_out_of_range"]),
    (GOOD | {"rating": "nan"}, []),
    (GOOD | {"rating": 4.0}, ["value_not_string"]),
]


def test_review_rules(spark):
    text = json.dumps({"p": {"reviews": [r for r, _ in REVIEWS]}})
    documents = spark.createDataFrame([(text,)], "value string")
    found = {}
    for r in validate.issues(documents).collect():
        found.setdefault(r.review_idx, []).append(r.rule)
    assert found == {i: rules for i, (_, rules) in enumerate(REVIEWS) if rules}
    row = validate.verdict(documents).first()
    assert (row.products, row.reviews, row.errors, row.warnings, row.valid) == (1, len(REVIEWS), 8, 1, False)
    assert validate.verify(spark.createDataFrame([(json.dumps({"p": {"reviews": [GOOD]}}),)], "value string"))


def test_three_jobs_end_to_end(spark, tmp_path):
    """Raw files to summary and nested JSON, to vocabulary and vectors, to reports."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    texts = ["Strong glue, strong tape", "The tape broke quickly", "glue works and works", "none", "Strong <b>glue</b> again"]
    body = ""
    for i in range(60):
        body += (
            f"<record><category>C</category><reviewerID>u{i}</reviewerID><rate>{1 + i % 5}</rate><heading>t{i}</heading>"
            f"<text>{texts[i % 5]}</text><pics>[]</pics><productID>x{i}</productID><parentPRODUCTID>P{i % 3}</parentPRODUCTID>"
            f"<date>{1588687728923 + i * 86400000}</date><verified_purchase>true</verified_purchase><likes>{i % 2}</likes></record>\n"
        )
    (source / "part_1.txt").write_text(body)
    (source / "part_2.txt").write_text(body)  # every record twice
    row = ["c", "w", 5, "t", "workbook glue", None, "p", "P1", 1588687728923, False, 4]
    write_workbook(source / "book.xlsx", {"s": [REVIEW_COLUMNS, row]})

    reviews = jobs.ingest(spark, str(source))
    assert reviews.count() == 61
    assert reviews.orderBy("seq").first().reviewer_id == "w"  # workbook rows come first
    jobs.publish(reviews, str(out))
    summary = {r[0]: (int(r[1]), int(r[2])) for r in spark.read.option("header", True).csv(str(out / "summary")).collect()}
    assert summary == {"p0": (20, 16), "p1": (21, 17), "p2": (20, 16)}
    assert validate.verify(nested.read_documents(spark, str(out / "nested")))

    jobs.vectorise(spark, str(out / "nested"), str(out), min_reviews=10)
    reports = jobs.explore(spark, str(out / "nested"), str(out / "vocabulary"), str(out / "vectors"))
    assert tuple(reports["overview"].first()) == (61, 3)
    assert sum(r.n for r in reports["years"].collect()) == 61
    assert sum(r.n or 0 for r in reports["weekdays"].collect()) == 61
    glue = [r for r in reports["top_terms"].collect() if r.term == "workbook"]
    assert [r.n for r in glue] == [1]  # words in every product are above the band
    assert [(r.term, r.weight) for r in reports["cloud"].collect()] == [("workbook", 1.0)]
    assert token_list("workbook glue") == ["workbook", "glue"]
    for name, report in reports.items():
        assert report.count() > 0, name


def test_workbook_without_references_and_with_blank_flags(spark, tmp_path):
    import zipfile

    header = ["review_text", "is_verified_purchase", "rating"]
    rows = [header, ["glue", True, 4], ["tape", None, 5]]
    (tmp_path / "refs").mkdir()
    write_workbook(tmp_path / "refs" / "a.xlsx", {"s": rows})
    with zipfile.ZipFile(tmp_path / "refs" / "a.xlsx") as book:
        parts = {n: book.read(n).decode() for n in book.namelist()}
    sheet = re.sub(r' r="[A-Z]+[0-9]+"', "", parts["xl/worksheets/sheet1.xml"])
    # A cell left out needs an empty one in its place once references are gone.
    parts["xl/worksheets/sheet1.xml"] = sheet.replace("</c><c><v>5", "</c><c/><c><v>5")
    (tmp_path / "plain").mkdir()
    with zipfile.ZipFile(tmp_path / "plain" / "a.xlsx", "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    for folder in (tmp_path / "refs", tmp_path / "plain"):
        found = workbook.workbook_reviews(workbook.read_workbooks(spark, str(folder), "a.xlsx"))
        typed = table.typed(found, missing_flag=None).distinct().collect()
        flags = sorted((r.review_text, r.is_verified_purchase, r.rating) for r in typed if r.review_text)
        assert flags == [("glue", True, 4.0), ("tape", None, 5.0)]


def test_a_vector_line_is_split_once_and_not_for_every_item(spark, tmp_path):
    (tmp_path / "v.txt").write_text("p,0:2,3:1\nq,\n")
    found = dictionaries.read_vectors(spark, str(tmp_path / "v.txt"))
    assert sorted(map(tuple, found.collect())) == [("p", 0, 2), ("p", 3, 1)]
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[0]
    assert "split(trim(" not in above and "value#" not in above
