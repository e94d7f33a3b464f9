import json
import os

import pytest
from pyspark.sql import functions as F

from wordkin.functions import reviews as rules
from wordkin.functions import text as tx
from wordkin.operators import reports
from wordkin.operators import reviews as rv
from wordkin.plans.reviews import process_files, run_reviews
from wordkin.sinks import tables as sink
from wordkin.sources import products as src

FIELDS = "id long, text string, rating long, link string"


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([("good", 1), ("great", 1), ("bad", -1), ("awful", -1), ("écrit", 1)],
                                 "word string, polarity int")


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame(
        [("Ann", "PERSON"), ("Ann", "LOCATION"), ("Rome", "LOCATION"), ("Acme", "ORGANIZATION"), ("May", "DATE")],
        "word string, type string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, want", [
    ("One. Two two two! Three?", "Two two two!"),
    ("abc. xyz. de.", "abc."),                      # the first of equally long ones
    ("no mark at the end", "no mark at the end"),
    ("a\nb longer line. c", "a\nb longer line."),   # a line break does not end a sentence
    ("  \n\t ", None), ("", None), (None, None), ("...", None),
    ("  padded a.   \n x", "padded a."),
])
def test_longest_sentence(spark, text, want):
    assert one(spark, tx.longest_sentence(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("sentiment, color", [
    (-1, None), (0, "DARK_RED"), (1, "RED"), (2, "BLACK"), (3, "LIGHT_GREEN"), (4, "DARK_GREEN"), (5, None)])
def test_colors(spark, sentiment, color):
    assert one(spark, rules.color_of(F.lit(sentiment))) == color


def test_sarcasm_grid(spark):
    grid = spark.createDataFrame([(r, s) for r in (1, 2, 3, 4, 5, None) for s in range(5)], "r long, s int")
    got = {(x.r, x.s) for x in grid.where(rules.is_sarcastic(F.col("r"), F.col("s"))).collect()}
    assert got == {(r, s) for r in (1, 2) for s in (3, 4)} | {(r, s) for r in (4, 5) for s in (0, 1)}


def test_reviews_by_hand(spark, lexicon, gazetteer):
    texts = [
        (1, "Bad. A good and great and good book it was, good good!", 1, "a"),   # clamped at 4
        (2, "Awful bad bad. Good.", 5, "b"),                                      # clamped at 0
        (3, "Nothing to say here.", 3, "c"),
        (4, "", 5, "d"), (5, None, 5, "e"), (6, " \n", None, "f"),
        (7, "Ann met Acme in Rome in May. ann and Ann left Rome, ANN too.", 4, "g"),
        (8, "Écrit! Bon.", 1, None),
    ]
    reviews = spark.createDataFrame(texts, "id long, text string, rating long, link string")
    got = {r.id: (r.link, r.color, r.entities, r.is_sarcastic)
           for r in rv.process_reviews(reviews, ["id"], lexicon, gazetteer).collect()}
    assert got == {
        1: ("a", "DARK_GREEN", [], True),
        2: ("b", "DARK_RED", [], True),
        3: ("c", "BLACK", [], False),
        4: ("d", "DARK_RED", [], True), 5: ("e", "DARK_RED", [], True), 6: ("f", "DARK_RED", [], False),
        7: ("g", "BLACK", ["Ann", "Acme", "Rome", "Ann", "Rome"], False),
        8: (None, "LIGHT_GREEN", [], True),
    }


def test_one_scan_and_one_shuffle(spark, lexicon, gazetteer, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([(1, "Good.", 1, "a")], FIELDS).write.parquet(path)
    done = rv.process_reviews(spark.read.schema(FIELDS).parquet(path), ["id"], lexicon, gazetteer)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("hashpartitioning(id") == 1
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_the_same_without_broadcast(spark, lexicon, gazetteer):
    reviews = spark.createDataFrame([(i, f"Good Ann {i}. Bad day in Rome, good.", i % 5, str(i)) for i in range(50)], FIELDS)
    want = sorted(map(tuple, rv.process_reviews(reviews, ["id"], lexicon, gazetteer).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = rv.process_reviews(reviews, ["id"], lexicon, gazetteer, max_bytes=10)
        assert "Broadcast" not in done._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, done.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and len(got) == 50


def processed(spark, n=5, product="p", link="l"):
    rows = [(product, i, f"{link}{i}", "RED", ["Ann"] if i % 2 else [], i == 0) for i in range(n)]
    return spark.createDataFrame(rows, "product string, pos int, link string, color string, "
                                       "entities array<string>, is_sarcastic boolean").repartition(3)


def test_entries_keep_order_in_one_line(spark):
    whole = rv.collect_entries(processed(spark), ["product"]).collect()
    assert [r.product for r in whole] == ["p"]
    entries = json.loads(whole[0].line)["processedEntries"]
    assert entries[0] == {"link": "l0", "color": "RED", "namedEntities": [], "isSarcastic": True}
    assert [e["link"] for e in entries] == ["l0", "l1", "l2", "l3", "l4"]
    many = spark.range(100_001).selectExpr("'p' AS product", "id AS pos", "'l' AS link", "'RED' AS color",
                                           "array('Ann') AS entities", "false AS is_sarcastic")
    large = rv.collect_entries(many, ["product"]).collect()
    assert len(large) == 1 and len(json.loads(large[0].line)["processedEntries"]) == 100_001
    empty = spark.createDataFrame([("p",), ("q",)], "product string")
    lines = {r.product: r.line for r in rv.collect_entries(processed(spark), ["product"], products=empty).collect()}
    assert lines == {"p": whole[0].line, "q": '{"processedEntries":[]}'}


def test_product_json_keeps_null_fields(spark):
    from wordkin.schemas import PRODUCT

    df = spark.createDataFrame([("t", [("1", None, None, "x", None, None, None)])], PRODUCT)
    assert json.loads(rv.product_json(df).first().line) == {"title": "t", "reviews": [
        {"id": "1", "link": None, "title": None, "text": "x", "rating": None, "author": None, "date": None}]}


def test_html_escaping(spark):
    rows = processed(spark, 1, link='h?a=1&b="<x>"')
    escaped = reports.html_rows(rows, "product", ["pos"]).where("section = 1").first().html
    assert 'href="h?a=1&amp;b=&quot;&lt;x&gt;&quot;0"' in escaped
    raw = reports.html_rows(rows, "product", ["pos"], escape=False).where("section = 1").first().html
    assert raw == ('<div style="color: red;">\n<p>Link: <a href="h?a=1&b="<x>"0">h?a=1&b="<x>"0</a></p>\n'
                   "<p>Named Entities: []</p>\n<p>Sarcasm Detection: Sarcastic</p>\n</div>")


def test_html_report_in_order(spark, tmp_path):
    out = str(tmp_path / "html")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sink.write_html(processed(spark, 300).unionByName(processed(spark, 3, "q")), out, "product", ["pos"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for product, n in (("p", 300), ("q", 3)):
        folder = f"{out}/report={product}"
        files = sorted(f for f in os.listdir(folder) if f.endswith(".txt"))
        text = "".join(open(f"{folder}/{f}").read() for f in files)
        assert text.startswith("<html>\n<head>\n</head>\n<body>\n<div style") and text.endswith("</div>\n</body>\n</html>\n")
        links = [line.split('"')[1] for line in text.splitlines() if "Link:" in line]
        assert links == [f"l{i}" for i in range(n)]


def fragments(spark, *rows):
    return spark.createDataFrame(list(rows), "file_key string, fragment_no int, expected int, line string")


def test_only_complete_files_are_assembled(spark):
    got = rv.assemble_files(fragments(
        spark, ("a", 2, 2, "a2"), ("a", 1, 2, "a1"), ("a", 2, 2, "a2"), ("b", 1, 2, "b1"), ("b", 1, 2, "b1"), ("c", 1, 1, "c1")))
    assert [tuple(r) for r in got.orderBy("file_key", "fragment_no").collect()] == [
        ("a", 1, "a1"), ("a", 2, "a2"), ("c", 1, "c1")]


def test_the_last_delivery_counts(spark):
    rows = [("a", 1, 2, "new", 5), ("a", 1, 2, "old", 3), ("a", 2, 2, "x", 4), ("a", 2, 2, "y", 4), ("b", 1, 2, "b", 1)]
    df = spark.createDataFrame(rows, "file_key string, fragment_no int, expected int, line string, seq int")
    assert sorted(map(tuple, rv.assemble_files(df, "seq").collect())) == [("a", 1, "new"), ("a", 2, "y")]


def test_hot_file_gives_the_same(spark):
    rows = [("big", i, 400, f"x{i}") for i in range(1, 401)] + [(f"s{i}", 1, 1 + i % 2, "y") for i in range(30)]
    df = fragments(spark, *rows)
    want = sorted(map(tuple, rv.assemble_files(df).collect()))
    assert want == sorted(map(tuple, rv.assemble_files(df, rows_per_slice=5).collect()))
    assert len(want) == 400 + 15


def test_results_go_to_the_last_client(spark):
    requests = spark.createDataFrame([(1, 7, 3), (2, 8, 3), (3, 9, 4)], "seq long, client_key long, file_key long")
    results = spark.createDataFrame([(3, 1), (3, 2), (5, 1)], "file_key long, pos int")
    got = rv.route_results(results, requests, ["pos"])
    assert {(r.file_key, r.pos, r.client_key) for r in got.collect()} == {(3, 1, 8), (3, 2, 8)}


def test_work_keys(spark):
    df = spark.createDataFrame([("input c1 f9", "finished f9-12")], "a string, b string")
    row = df.select(*rules.request_parts(F.col("a")), *[c.alias(f"b{i}") for i, c in enumerate(rules.fragment_parts(F.col("b")))]).first()
    assert tuple(row) == ("input", "c1", "f9", "finished", "f9", 12)


# ---- files ----------------------------------------------------------------------------------

def product(title, *texts, link="l"):
    return json.dumps({"title": title, "reviews": [
        {"id": f"{title}{i}", "link": f"{link}-{title}-{i}", "title": "t", "text": t, "rating": 1, "author": "a",
         "date": "2024-01-01"} for i, t in enumerate(texts)]}, ensure_ascii=False)


def test_bad_line_in_the_middle(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text("\n".join([product("a", "x"), '{"title": "br', product("b", "y")]) + "\n")
    products = src.read_products(spark, str(path))
    assert [r.title for r in src.good_products(products).orderBy("line_id").collect()] == ["a", "b"]
    assert [r.line for r in src.quarantined_lines(products).collect()] == ['{"title": "br']


def test_charset_per_file(spark, tmp_path):
    (tmp_path / "utf.json").write_bytes((product("u", "é") + "\n").encode())
    (tmp_path / "latin one.json").write_bytes((product("k", "plain") + "\n" + product("l", "é\xa0ü") + "\n").encode("latin-1"))
    assert [r.file.rsplit("/", 1)[1] for r in src.files_not_utf8(src.read_lines(spark, str(tmp_path))).collect()] == ["latin%20one.json"]
    got = src.good_products(src.read_products(spark, str(tmp_path), charset_fallback=True))
    assert {(r.title, r.reviews[0].text) for r in got.collect()} == {("u", "é"), ("k", "plain"), ("l", "é\xa0ü")}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split_bytes", ["2000", "134217728"])
def test_kept_lines_are_numbered_across_splits(spark, tmp_path, split_bytes):
    """Bad and blank lines, in any split, leave no gap and no repeat."""
    for name, n in (("big", 3000), ("small", 30), ("bad", 0)):
        lines = []
        for i in range(n):
            lines += [product(str(i), "x" * (i % 50))] + ["{broken"] * (i % 7 == 3) + ["", " \t"] * (i % 11 == 5)
        (tmp_path / f"{name}.json").write_text("".join(line + "\n" for line in ["{first", "", *lines, "", "{last"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        for fallback in (False, True):
            products = src.good_products(src.read_products(spark, str(tmp_path), charset_fallback=fallback))
            assert (products.select("block").distinct().count() > 5) == (split_bytes == "2000")
            numbered = src.number_lines(products).select("file", "title", "fragment_no").collect()
            assert len(numbered) == 3030 and all(r.fragment_no == int(r.title) + 1 for r in numbered)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbers_run_through_a_folder(spark, tmp_path, small_splits):
    rows = spark.range(500).selectExpr("id % 3 AS file_key", "id div 3 + 1 AS fragment_no", "concat('line ', repeat('x', id % 90), id) AS line")
    sink.write_assembled(rows, str(tmp_path / "files"))
    back = src.read_assembled(spark, str(tmp_path / "files"))
    assert sorted(map(tuple, back.select(*rows.columns).collect())) == sorted((str(r.file_key), r.fragment_no, r.line) for r in rows.collect())


def test_many_inputs_in_one_scan(spark, tmp_path):
    outputs = {}
    for i in range(40):
        folder = tmp_path / "in" / f"set {i % 4}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.json").write_bytes((product(f"é{i}", "x") + "\n").encode("latin-1" if i % 5 == 0 else "utf-8"))
        if i % 4:
            outputs[str(folder / f"{i}.json")] = f"out{i}"
    # a folder above, written in another way, and a longer path below it; a pattern
    outputs |= {f"{tmp_path}/in/../in/": "rest", f"{tmp_path}/in/set 0/[1-3]?.json": "pattern"}
    rows = src.read_paired(spark, outputs, charset_fallback=True)
    got = {r.title: r.out for r in rows.collect()}
    assert got == {f"é{i}": (f"out{i}" if i % 4 else "pattern" if 10 <= i < 40 else "rest") for i in range(40)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] text") == 1 and "Union" not in plan
    with pytest.raises(FileNotFoundError):
        src.read_paired(spark, {str(tmp_path / "nothing"): "x"})


def test_files_to_reports(spark, tmp_path, lexicon, gazetteer):
    inputs = tmp_path / "in"
    inputs.mkdir()
    (inputs / "a.json").write_text(product("p", "Good.", "Bad.") + "\n" + product("q", "Ann!") + "\n")
    (inputs / "b.json").write_text(product("r", "Great, in Rome.") + "\n{broken\n" + product("s") + "\n")
    (inputs / "c.json").write_text(product("t") + "\n")
    out = str(tmp_path / "out")
    run_reviews(spark, {str(inputs / f"{f}.json"): n for f, n in zip("abc", ("one", "two", "none"))}, out, lexicon, gazetteer)
    assert [(r.out, r.line) for r in spark.read.parquet(f"{out}/quarantine").collect()] == [("two", "{broken")]
    frame = f"{out}/html/report=none"
    assert "html" in "".join(open(f"{frame}/{f}").read() for f in sorted(os.listdir(frame)) if f.endswith(".txt"))
    with pytest.raises(ValueError):
        run_reviews(spark, {"a": "one", "b": "one"}, out, lexicon, gazetteer)
    lines = {}
    for name in ("one", "two", "none"):
        folder = f"{out}/json/out={name}"
        text = "".join(open(f"{folder}/{f}").read() for f in sorted(os.listdir(folder)) if f.endswith(".txt"))
        lines[name] = [[(e["link"], e["color"], e["namedEntities"]) for e in json.loads(line)["processedEntries"]]
                       for line in text.splitlines()]
    assert lines == {
        "one": [[("l-p-0", "LIGHT_GREEN", []), ("l-p-1", "RED", [])], [("l-q-0", "BLACK", ["Ann"])]],
        "two": [[("l-r-0", "LIGHT_GREEN", ["Rome"])], []], "none": [[]]}
    assert sorted(os.listdir(f"{out}/html"))[-3:] == ["report=none", "report=one", "report=two"]


def test_places_give_the_input_order(spark, tmp_path, lexicon, gazetteer):
    path = tmp_path / "in.json"
    path.write_text("".join(product(str(i), "x.", "y.") + "\n" for i in range(200)))
    done = process_files(spark, str(path), lexicon, gazetteer).orderBy("file", "block", "line_id", "pos").collect()
    assert [r.link for r in done] == [f"l-{i}-{k}" for i in range(200) for k in range(2)]


def test_many_small_splits_are_few_tasks(spark):
    from wordkin.suite import queries

    assert queries._tasks_for(spark, 10) == spark.sparkContext.defaultParallelism
    assert queries._tasks_for(spark, 1_000_000) == 245
