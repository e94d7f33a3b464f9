import math
import os
import random

import pytest
from pyspark.sql import functions as F

from wordkin.operators import collocations as co
from wordkin.operators.skew import hot_limit, number_within
from wordkin.plans.collocations import extract_collocations, find_collocations
from wordkin.sinks import tables as sink
from wordkin.storage import fingerprint, pin
from wordkin.suite import queries

PAIRS = "decade int, w1 string, w2 string, c bigint"


def pairs(spark, *values):
    return spark.createDataFrame(list(values), PAIRS)


def skewed(spark, hot=900, cold=40):
    """One left word and one right word with nearly all pairs."""
    rows = [(1900, "hot", f"w{i}", 1 + i % 7) for i in range(hot)]
    rows += [(1900, f"v{i}", "top", 1 + i % 5) for i in range(hot)]
    rows += [(1900 + 10 * (i % 3), f"l{i % 9}", f"r{i % 11}", 1 + i % 3) for i in range(cold)]
    return spark.createDataFrame(rows, PAIRS).groupBy("decade", "w1", "w2").agg(F.sum("c").alias("c"))


def by_hand(rows):
    """(decade, w1, w2) to (c, c1, c2, n, npmi)."""
    out = {}
    for decade, w1, w2, c in rows:
        same = [r for r in rows if r[0] == decade and r[3] > 0]
        if not c:
            continue
        c1 = sum(r[3] for r in same if r[1] == w1)
        c2 = sum(r[3] for r in same if r[2] == w2)
        n = 2 * sum(r[3] for r in same)
        score = (math.log(c) + math.log(n) - math.log(c1) - math.log(c2)) / -math.log(c / n)
        out[decade, w1, w2] = (c, c1, c2, n, score)
    return out


def scores(df):
    return {(r.decade, r.w1, r.w2): (r.c, r.c1, r.c2, r.n, r.npmi) for r in df.collect()}


def assert_same_scores(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key][:4] == value[:4]
        assert got[key][4] == pytest.approx(value[4], abs=1e-12)


def test_scores_by_hand(spark):
    rows = [(1900, "a", "b", 5), (1900, "a", "c", 1), (1900, "d", "b", 2), (1910, "a", "b", 3), (1900, "z", "b", 0)]
    assert_same_scores(scores(co.score_pairs(pairs(spark, *rows))), by_hand(rows))


def test_hot_keys_give_the_same_scores(spark):
    data = pin(skewed(spark), "skewed")
    want = by_hand([tuple(r) for r in data.select("decade", "w1", "w2", "c").collect()])
    assert_same_scores(scores(co.score_pairs(data)), want)
    assert_same_scores(scores(co.score_pairs(data, rows_per_slice=10)), want)


def as_records(data):
    """Every pair in as many records as it occurs, and one of a zero count."""
    rows = [(r.decade, r.w1, r.w2, 1) for r in data.collect() for _ in range(r.c)] + [(1900, "hot", "never", 0)]
    return data.sparkSession.createDataFrame(rows, PAIRS).repartition(5)


@pytest.mark.parametrize("rows_per_slice", [10, 100, 10 ** 6])
def test_pairs_are_counted_from_records(spark, rows_per_slice):
    data = pin(skewed(spark), "skewed")
    want = by_hand([tuple(r) for r in data.select("decade", "w1", "w2", "c").collect()])
    records = pin(as_records(data), "records")
    counted = pin(co.count_pairs(records, rows_per_slice), "counted")
    assert_same_scores(scores(co.score_counted(counted)), want)
    assert [(r.w1, r.w2) for r in counted.where("c = 0").collect()] == [("hot", "never")]
    found = find_collocations(records, -1.0, 1.0, rows_per_slice=rows_per_slice)
    assert {(r.decade, r.w1, r.w2): pytest.approx(r.npmi) for r in found.collect()} == {
        k: v[4] for k, v in want.items() if not v[0] == v[1] == v[2]}


@pytest.mark.parametrize("rows_per_slice", [10, 10 ** 6])
def test_sums_of_words_come_with_the_pairs(spark, rows_per_slice):
    odd = pairs(spark, (1900, None, "top", 5), (1900, "v1", None, 2), (1910, "l1", "r1", 0), (1990, "only", "zero", 0))
    records = pin(as_records(skewed(spark)).unionAll(odd), "records")
    told = co.survey(records, rows_per_slice)
    assert told.rows == records.count() and (told.crowded is None) == (rows_per_slice == 10 ** 6)
    assert sorted(map(tuple, told.sizes.collect())) == sorted(map(tuple, co.corpus_size(records.where("c > 0")).collect()))
    counted = pin(co.count_and_sum(records, told, told.sizes, rows_per_slice), "counted")
    assert counted.where("slice_sum is not null").isEmpty() == (rows_per_slice == 10 ** 6)
    want = co.score_totals(co.score_counted(counted, told.sizes))
    assert sorted(map(tuple, co.counted_totals(counted).collect())) == sorted(map(tuple, want.collect()))
    plain = co.count_pairs(records, rows_per_slice)
    assert sorted(map(repr, counted.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    # the words are not dealt again to be added up
    assert shuffles(co.count_and_sum(records, co.survey(records), told.sizes)) == 2


@pytest.mark.parametrize("rows_per_slice", [10, 10 ** 6])
def test_sums_of_scores_without_a_table_of_pairs(spark, rows_per_slice):
    odd = pairs(spark, (1900, None, "top", 5), (1900, "v1", None, 2), (1910, "l1", "r1", 0), (1990, "only", "zero", 0), (1980, "only", "one", 3))
    records = pin(as_records(skewed(spark)).unionAll(odd), "records")
    told = co.survey(records, rows_per_slice)
    assert (told.crowded is None) == (rows_per_slice == 10 ** 6)
    scored = pin(co.score_counted(pin(co.count_pairs(records), "counted")), "scored")
    want = co.score_totals(scored).join(co.score_totals(scored, "exact").withColumnRenamed("s", "s_exact"), "decade")
    want = sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, co.sum_scores(records, told, rows_per_slice).select("decade", "s", "s_exact").collect())) == want


def test_scores_that_are_read_once_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "pin", lambda df, label, **also: written.append(label) or pin(df, label, **also))
    for name in ("npmi_sum", "pmi", "npmi", "filter_abs", "filter_perfect"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert not written


def test_words_travel_in_one_column_and_come_back(spark):
    words = [None, "", "a", "1:", ":;", "-1;b", "é😀", " x\ty", "12"]
    rows = [(1900 + 10 * (i % 2), a, b, 1) for a in words for i, b in enumerate(words)]
    data = pairs(spark, *rows)
    for side in (1, 2):
        dealt = co._deal_by_word(data, 0, side)
        assert "_words" in dealt._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(repr, map(tuple, dealt.select(data.columns).collect()))) == sorted(map(repr, rows))
    assert shuffles(co.count_pairs(data)) == 2


def test_tasks_grow_in_number_and_not_in_size(spark, monkeypatch):
    records = pin(as_records(skewed(spark)), "records")
    monkeypatch.setattr(co, "ROWS_PER_TASK", 20)
    n_rows = records.count()
    assert n_rows > 20 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert co.count_left(records, n_rows=n_rows).rdd.getNumPartitions() == -(-n_rows // 20)


def test_words_that_are_null_count_and_have_no_score(spark):
    data = pin(pairs(spark, (1900, None, "b", 5), (1900, "a", "b", 2), (1900, "a", None, 1), (1900, "d", "c", 3)), "pairs")
    want = {(r.decade, r.w1, r.w2): tuple(r) for r in co.score_pairs(data).collect()}
    for slice_rows in (1, 10 ** 6):
        counted = pin(co.count_pairs(data, slice_rows), "counted")
        assert {(r.decade, r.w1, r.w2): tuple(r) for r in co.score_counted(counted).collect()} == want
    assert want[1900, "a", "b"][3:7] == (2, 3, 7, 22)


def shuffles(df):
    """Shuffles of the rows of a plan that is not adapted while it runs."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return plan.count("Exchange hashpartitioning")


def test_pairs_and_both_word_totals_take_two_shuffles(spark):
    records = pin(as_records(skewed(spark)), "records")
    assert shuffles(co.count_pairs(records)) == 2
    # and hot words are dealt by slices
    hot = co.count_left(records, co.find_crowded(records, 10), 10)
    assert "_slice" in hot._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows_per_slice", [10, 300, 10 ** 6])
def test_decade_folders_are_filled_by_one_shuffle(spark, tmp_path, rows_per_slice):
    data = pin(skewed(spark), "skewed")
    records = pin(as_records(data).where("c > 0"), "records")
    sink.write_decade_pairs(records, str(tmp_path / "d"), rows_per_slice=rows_per_slice)
    found = spark.read.schema("w1 string, w2 string, c bigint, decade int").parquet(str(tmp_path / "d")).select(data.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, data.collect()))
    files = [f for f in os.listdir(tmp_path / "d" / "decade=1900") if f.endswith(".parquet")]
    assert len(files) == 1 if rows_per_slice == 10 ** 6 else files
    assert shuffles(co.decade_slices(records)) == 1


def test_hot_rows_are_spread(spark):
    data = pin(skewed(spark), "skewed")
    joined = co.join_left_counts(data, co.left_marginal(data), hot_limit(data, 10))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Join LeftOuter" in line and "_slice" in line]
    # the slice is compared between the two sides, not with a constant
    assert keys and all(line.count("_slice#") == 2 for line in keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        executed = joined.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in executed.splitlines() if "hashpartitioning" in line and "_slice#" in line]
    assert len(shuffles) == 2
    assert "CartesianProduct" not in executed and "BroadcastNestedLoopJoin" not in executed


def test_unmatched_pairs_get_minus_one(spark):
    data = pairs(spark, (1900, "a", "b", 5), (1900, "x", "b", 1))
    left = co.left_marginal(data).where("w1 = 'a'")
    limit = hot_limit(data)
    assert {(r.w1, r.c1) for r in co.join_left_counts(data, left, limit).collect()} == {("a", 5)}
    kept = co.join_left_counts(data, left, limit, keep_unmatched=True)
    assert {(r.w1, r.c1) for r in kept.collect()} == {("a", 5), ("x", -1)}


def test_invariants(spark):
    data = pin(skewed(spark), "skewed")
    scored = co.score_pairs(data)
    assert scored.where("npmi > 1 + 1e-12 or npmi <= -1 or npmi is null").count() == 0
    sums = (data.groupBy("decade").agg(F.sum("c").alias("s")).join(co.corpus_size(data), "decade")
            .join(co.left_marginal(data).groupBy("decade").agg(F.sum("c1").alias("s1")), "decade")
            .join(co.right_marginal(data).groupBy("decade").agg(F.sum("c2").alias("s2")), "decade"))
    assert sums.where("n <> 2 * s or s1 <> s or s2 <> s").count() == 0


def test_one_pass_equals_three(spark):
    data = pin(skewed(spark), "skewed")
    got = {tuple(r) for r in co.marginals_in_one_pass(data).collect()}
    want = ({("n", r.decade, None, r.n) for r in co.corpus_size(data).collect()}
            | {("c1", r.decade, r.w1, r.c1) for r in co.left_marginal(data).collect()}
            | {("c2", r.decade, r.w2, r.c2) for r in co.right_marginal(data).collect()})
    assert got == want


def test_totals_cut_each_word_to_three_decimals(spark):
    scored = spark.createDataFrame(
        [(1900, "x", 0.5004), (1900, "x", 0.0003), (1900, "y", -0.0019), (1900, "z", 0.1 + 0.2)],
        "decade int, w2 string, npmi double")
    assert co.score_totals(scored).first().s == pytest.approx(0.5 - 0.001 + 0.3)
    assert co.score_totals(scored, "exact").first().s == pytest.approx(0.7988)
    with pytest.raises(ValueError):
        co.score_totals(scored, "other")


@pytest.mark.parametrize("total, passing", [(2.0, [0.4]), (0.0, [0.1, 0.4]), (-2.0, [-0.4])])
def test_relative_threshold(spark, total, passing):
    scored = spark.createDataFrame([(v, total) for v in (-0.4, 0.0, 0.1, 0.4)], "npmi double, s double")
    got = scored.where(co.passes_relative(F.col("npmi"), F.col("s"), 0.2)).collect()
    assert [r.npmi for r in got] == passing


def test_perfect_pairs_are_left_out(spark):
    data = pairs(spark, (1900, "ping", "pong", 7), (1900, "a", "b", 5), (1900, "a", "c", 1), (1900, "d", "c", 9),
                 (1910, "only", "pair", 3))
    got = {(r.decade, r.w1, r.w2) for r in find_collocations(data, 0.0, 1e9).collect()}
    # a decade with one pair: it is perfect, the decade has no result
    assert got == {(1900, "a", "b"), (1900, "d", "c")}
    literal = find_collocations(data, 0.0, 1e9, fp_perfect=True)
    assert literal.where("npmi >= 1.0").count() == 0


def test_all_in_one_order_and_resume(spark, tmp_path):
    grams = spark.createDataFrame(
        [("the", "cat", 1900, 9), ("a", "b", 1900, 5), ("a", "c", 1905, 1), ("d", "c", 1901, 4), ("d", "b", 1902, 1),
         ("e", "f", 1950, 1), ("e", "g", 1950, 3), ("h", "g", 1950, 2)],
        "w1 string, w2 string, year int, match_count bigint")
    stop = spark.createDataFrame([("the",)], "word string")
    work = str(tmp_path / "work")
    first = [tuple(r) for r in extract_collocations(grams, stop, -1.0, 1.0, work_dir=work).collect()]
    assert [r[0] for r in first] == sorted(r[0] for r in first)
    for decade in (1900, 1950):
        npmis = [r[3] for r in first if r[0] == decade]
        assert npmis == sorted(npmis, reverse=True) and npmis
    assert not any(r[1] == "the" for r in first)
    assert {"pairs", "scored", "sizes", "totals"} <= set(os.listdir(work))
    # the finished tables are taken up again, and other runs are refused
    again = extract_collocations(grams, stop, -1.0, 1.0, work_dir=work)
    assert [tuple(r) for r in again.collect()] == first
    for other in ({"start": 1950}, {"sum_mode": "exact"}, {"inputs": "elsewhere"}):
        with pytest.raises(ValueError):
            extract_collocations(grams, stop, -1.0, 1.0, work_dir=work, **other)
    for others in ((grams, stop.limit(0)), (grams.where("w1 <> 'e'"), stop), (grams.withColumn("match_count", grams.match_count + 1), stop)):
        with pytest.raises(ValueError):
            extract_collocations(*others, -1.0, 1.0, work_dir=work)


def test_a_run_belongs_to_its_files(spark, tmp_path):
    grams, work = str(tmp_path / "grams"), str(tmp_path / "work")
    rows = spark.createDataFrame([(1900, "a", "b", 5), (1900, "a", "c", 1), (1900, "d", "c", 4), (1900, "d", "b", 1)], PAIRS)
    rows.write.parquet(grams)
    read = lambda: spark.read.schema(rows.schema).parquet(grams)
    first = sorted(map(tuple, find_collocations(read(), -1.0, 1.0, work_dir=work).collect()))
    # the sizes are read by the job, not computed again
    spark.createDataFrame([(1900, 44)], "decade int, n long").coalesce(1).write.mode("overwrite").parquet(f"{work}/sizes")
    for name in ("scored", "totals"):
        os.rename(f"{work}/{name}", f"{work}/old-{name}")
    assert sorted(map(tuple, find_collocations(read(), -1.0, 1.0, work_dir=work).collect())) != first
    with pytest.raises(ValueError):
        find_collocations(read().where("c > 1"), -1.0, 1.0, work_dir=work)
    before = fingerprint(read())
    assert before == fingerprint(read())
    rows.limit(1).write.mode("append").parquet(grams)
    assert fingerprint(read()) != before
    with pytest.raises(ValueError):
        find_collocations(read(), -1.0, 1.0, work_dir=work)


def test_sums_of_scores_do_not_hang_on_their_order(spark):
    rng = random.Random(3)
    rows = [(1900 + 10 * (i % 2), f"w{i}", f"x{i % 40}", rng.uniform(-1, 1)) for i in range(4000)]
    scored = spark.createDataFrame(rows, "decade int, w1 string, w2 string, npmi double")
    sums = {mode: {tuple(sorted((r.decade, r.s.hex()) for r in co.score_totals(scored.repartition(n), mode).collect())) for n in (1, 7, 200)}
            for mode in ("exact", "truncated")}
    assert all(len(found) == 1 for found in sums.values())
    exact = {d: sum(round(s * 10 ** 9) for x, *_, s in rows if x == d) / 10 ** 9 for d in (1900, 1910)}
    assert dict((d, float.fromhex(s)) for d, s in sums["exact"].pop()) == exact
    words = {}
    for d, _, w2, s in rows:
        words[d, w2] = words.get((d, w2), 0) + round(s * 10 ** 9)
    cut = {d: sum(int(abs(u) // 10 ** 6) * (1 if u > 0 else -1) for (x, _), u in words.items() if x == d) / 1000 for d in (1900, 1910)}
    assert dict((d, float.fromhex(s)) for d, s in sums["truncated"].pop()) == cut


def test_rank_without_one_task_per_decade(spark):
    data = [(1900 + 10 * (i % 2), f"w{i:04d}", "x", (i * 37 % 11) / 11) for i in range(3000)]
    found = spark.createDataFrame(data, "decade int, w1 string, w2 string, npmi double").repartition(6)
    got = {(r.decade, r.w1): r["rank"] for r in co.rank_collocations(found).collect()}
    for decade in (1900, 1910):
        order = sorted((r for r in data if r[0] == decade), key=lambda r: (-r[3], r[1]))
        assert [got[decade, r[1]] for r in order] == list(range(1, len(order) + 1))


def test_numbering_spans_partitions(spark):
    rows = [("big", i) for i in range(5000)] + [(f"s{i % 40}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    numbered = number_within(df, ["g"], ["v"], "n")
    assert numbered.count() == 5400
    assert numbered.where("g = 'big' and n <> v + 1").count() == 0
    assert numbered.groupBy("g").agg((F.max("n") == F.count("*")).alias("ok"), F.countDistinct("n").alias("d"),
                                     F.count("*").alias("k")).where("not ok or d <> k").count() == 0


def test_written_decades_are_sorted_across_files(spark, tmp_path):
    data = [(1900 + 10 * (i % 20 == 0), f"w{i:04d}", "x", (i * 37 % 101) / 101) for i in range(4000)]
    found = spark.createDataFrame(data, "decade int, w1 string, w2 string, npmi double").repartition(7)
    out = str(tmp_path / "out")
    # small results would otherwise be merged into one file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sink.write_collocations(found, out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for decade in (1900, 1910):
        folder = f"{out}/decade={decade}"
        files = sorted(f for f in os.listdir(folder) if f.endswith(".txt"))
        if decade == 1900:
            assert len(files) > 1
        text = [line for f in files for line in open(f"{folder}/{f}").read().splitlines()]
        order = sorted((r for r in data if r[0] == decade), key=lambda r: (-r[3], r[1]))
        assert text == [f"{r[1]}\tx\tNPMI:{r[3]}" for r in order]


def test_decade_folders_are_pruned(spark, tmp_path):
    from wordkin.sources.ngrams import read_decades

    path = str(tmp_path / "d")
    sink.write_decades(pairs(spark, (1900, "a", "b", 1), (1910, "a", "b", 2), (1920, "a", "b", 3)), path)
    one = read_decades(spark, path, "w1 string, w2 string, c bigint, decade int", [1910])
    assert [r.c for r in one.collect()] == [2]
    assert "PartitionFilters: [decade" in one._jdf.queryExecution().executedPlan().toString().replace("isnotnull(decade", "decade")
