import os

from wordkin.operators import ngrams as ng
from wordkin.sources import ngrams as src


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tokens_by_position(spark):
    got = ng.tokenise_lines(lines(spark, "a b\t1999\t7\t1", "  x\ty ", "", " \t", "a b c\t1999\t3\t1")).collect()
    assert [tuple(r) for r in got] == [
        ("a", "b", "1999", "7", 5), ("x", "y", None, None, 2), (None, None, None, None, 0),
        (None, None, None, None, 0), ("a", "b", "c", "1999", 6)]


def test_validity(spark):
    good = ng.parse_ngrams(lines(
        spark,
        "a b\t1999\t7\t1", "a b\t1999\t7",           # a fifth token is not needed; duplicates stay
        "a b\t0001\t0", "a b\t1999\t+5", "a b\t1999\t-0",
        "a b\t0000\t5", "a b\t199\t5", "a b\t19990\t5", "a b\t-199\t5", "a b\t19x9\t5",
        "a b\t1999\t-1", "a b\t1999\t5x", "a b\t1999\t99999999999999999999", "a b\t1999",
        "a b c\t1999\t5\t1",                          # three words: the year is out of place
        "a\t1999\t1234\t5",                           # one word: the count passes as a year
        "a\t1999\t12\t5"))
    assert rows(good) == sorted([
        ("a", "b", 1999, 7), ("a", "b", 1999, 7), ("a", "b", 1, 0), ("a", "b", 1999, 5), ("a", "b", 1999, 0),
        ("a", "1999", 1234, 5)])


def test_stop_words_either_side_exact_case_bag(spark):
    grams = spark.createDataFrame(
        [("the", "cat", 1900, 1), ("cat", "the", 1900, 1), ("The", "cat", 1900, 1), ("a", "b", 1900, 2), ("a", "b", 1900, 2)],
        "w1 string, w2 string, year int, match_count bigint")
    stop = spark.createDataFrame([("the",), ("the",), ("",)], "word string")
    assert rows(ng.drop_stop_words(grams, stop)) == [("The", "cat", 1900, 1), ("a", "b", 1900, 2), ("a", "b", 1900, 2)]


def test_window_and_rollup(spark):
    grams = spark.createDataFrame(
        [("a", "b", y, 1) for y in (1499, 1500, 1509, 1510, 2029, 2030)] + [("a", "b", 1500, 4)],
        "w1 string, w2 string, year int, match_count bigint")
    assert rows(ng.roll_up_decades(grams)) == [(1500, "a", "b", 6), (1510, "a", "b", 1), (2020, "a", "b", 1)]
    assert rows(ng.roll_up_decades(grams, start=1510, end=1519)) == [(1510, "a", "b", 1)]


def test_label(spark):
    got = spark.range(1).select(*[ng.decade_label(ng.decade_of(ng.F.lit(y))) for y in (1907, 195)]).first()
    assert tuple(got) == ("1900's", "0190's")


def test_text_scan_is_recursive_over_many_paths(spark, tmp_path):
    (tmp_path / "one" / "deep").mkdir(parents=True)
    (tmp_path / "two").mkdir()
    (tmp_path / "one" / "deep" / "x").write_text("a b\t1999\t1\t1\n")
    (tmp_path / "two" / "y").write_text("c d\t1999\t1\t1\n")
    got = src.read_text_lines(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert rows(ng.parse_ngrams(got)) == [("a", "b", 1999, 1), ("c", "d", 1999, 1)]


def test_sequence_scan_over_many_paths(spark, tmp_path):
    for name, word in (("one", "a"), ("two", "c")):
        spark.sparkContext.parallelize([(1 << 40, f"{word} b\t1999\t2\t1")], 1).saveAsNewAPIHadoopFile(
            str(tmp_path / name), "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
            "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
    got = src.read_sequence_lines(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert got.columns == ["value"]
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(ng.parse_ngrams(got)) == [("a", "b", 1999, 2), ("c", "b", 1999, 2)]


def test_stop_list_is_taken_as_it_stands(spark, tmp_path):
    path = tmp_path / "stop"
    path.write_text("the\n of\nThe\n")
    assert rows(src.read_stop_words(spark, str(path))) == [(" of",), ("The",), ("the",)]


def test_a_record_is_a_row_whatever_it_holds(spark, tmp_path):
    records = [(i, text) for i, text in enumerate(["one", "two\nlines\r\n", "", "é 日本", "x" * 300_000, "short after long", "\t \n"] * 40)]
    path = str(tmp_path / "records")
    spark.sparkContext.parallelize(records, 3).map(lambda r: ((1 << 33) + r[0], r[1])).saveAsNewAPIHadoopFile(
        path, "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
    before = set(os.listdir(tmp_path))
    rows = src.read_sequence_lines(spark, path)
    assert sorted(r.value for r in rows.collect()) == sorted(text for _, text in records)
    assert set(os.listdir(tmp_path)) == before and "MapIn" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_long_stop_list_is_filtered_first(spark, tmp_path):
    path = str(tmp_path / "grams")
    spark.range(30_000).selectExpr("concat('l', id % 5000) AS w1", "if(id % 97 = 0, null, concat('r', id % 3000)) AS w2", "1900 AS year", "id AS match_count").write.parquet(path)
    grams = spark.read.schema("w1 string, w2 string, year int, match_count long").parquet(path)
    stop = spark.range(4000).selectExpr("concat(if(id % 4 = 0, 'l', if(id % 4 = 1, 'r', 'other')), id) AS word").unionAll(spark.sql("SELECT 'l0' UNION ALL SELECT cast(null AS string)"))
    want = rows(ng.drop_stop_words(grams, stop).where("w2 is not null"))
    small = ng.drop_stop_words(grams, stop, max_bytes=10)
    assert rows(small.where("w2 is not null")) == want and small.where("w2 is null").count() == ng.drop_stop_words(grams, stop).where("w2 is null").count()
    assert rows(ng.drop_stop_words(grams, stop, max_bytes=10, filter_bytes=10).where("w2 is not null")) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ng.drop_stop_words(grams, stop, max_bytes=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # records that cannot be listed go from the scan to the result
    kept, rest = plan[plan.index("Union"):plan.index("SortMergeJoin")], plan[plan.index("SortMergeJoin"):]
    assert "hashpartitioning(w" not in kept and "FileScan" in kept and "hashpartitioning(w" in rest
    # few records but those that go are shuffled
    blocks = -(-4001 * ng.FILTER_BITS // ng.BLOCK_BITS)
    held = ng.word_filter(stop, blocks)
    marked = ng._with_filter(grams, "w1", held, blocks)
    listed = {f"l{i}" for i in range(0, 4000, 4)}
    flags = {(r.w1 in listed, r._maybe_w1) for r in marked.select("w1", "_maybe_w1").distinct().collect()}
    assert (True, False) not in flags
    wrong = marked.where("_maybe_w1").select("w1").distinct().collect()
    assert len([r for r in wrong if r.w1 not in listed]) < 0.1 * 4000


def test_sequence_files_are_written_without_python(spark, tmp_path, monkeypatch):
    from pyspark import RDD

    from wordkin.sinks.tables import write_sequence_lines

    values = ["a b\t1999\t7\t1", "", "two\nlines", "ü" * 300]
    keyed = spark.createDataFrame([((1 << 33) + i, v) for i, v in enumerate(values)], "k long, v string")
    monkeypatch.setattr(RDD, "saveAsNewAPIHadoopFile", None)
    write_sequence_lines(keyed, str(tmp_path / "s"))
    assert rows(src.read_sequence_lines(spark, str(tmp_path / "s"))) == sorted((v,) for v in values)
    # a reader of Hadoop's own finds keys of 64 bits
    assert sorted(spark.sparkContext.sequenceFile(str(tmp_path / "s")).collect()) == [((1 << 33) + i, v) for i, v in enumerate(values)]
