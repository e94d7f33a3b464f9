import datetime
import json
from collections import Counter

import pytest

from wordkin.storage import scratch_folder
from wordkin.streaming import commits
from wordkin.streaming import reviews as srv
from wordkin.streaming import work


@pytest.fixture(scope="module")
def lists(spark):
    return (spark.createDataFrame([("good", 1)], "word string, polarity int"),
            spark.createDataFrame([("Ann", "PERSON")], "word string, type string"))


def drop_in(folder, name, *titles):
    folder.mkdir(exist_ok=True)
    review = lambda t: {"id": t, "link": t, "title": "", "text": "Good Ann.", "rating": 1, "author": "", "date": ""}
    (folder / name).write_text("".join(json.dumps({"title": t, "reviews": [review(t)]}) + "\n" for t in titles))


def links(spark, out):
    return sorted(r.link for r in srv.read_published(spark, out).collect())


def run(spark, inputs, out, offsets, lists, **options):
    srv.stream_reviews(spark, str(inputs), out, offsets, *lists, availableNow=True, **options).awaitTermination()


def test_files_are_processed_as_they_arrive(spark, tmp_path, lists):
    inputs, out, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    drop_in(inputs, "a.json", "a1", "a2")
    run(spark, inputs, out, offsets, lists)
    assert links(spark, out) == ["a1", "a2"]
    drop_in(inputs, "b.json", "b1")
    (inputs / "bad.json").write_text('{"title": \n')
    run(spark, inputs, out, offsets, lists)
    run(spark, inputs, out, offsets, lists)
    assert links(spark, out) == ["a1", "a2", "b1"]
    assert {(r.color, r.is_sarcastic, tuple(r.entities)) for r in srv.read_published(spark, out).collect()} == {
        ("LIGHT_GREEN", True, ("Ann",))}


def test_character_sets_per_file(spark, tmp_path, lists):
    inputs, out, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    drop_in(inputs, "a.json", "a1")
    line = json.dumps({"title": "t", "reviews": [{"id": "1", "link": "\u00e9", "text": "Good."}]}, ensure_ascii=False)
    (inputs / "latin.json").write_bytes((line + "\n").encode("latin-1"))
    run(spark, inputs, out, offsets, lists, charset_fallback=True)
    assert links(spark, out) == ["a1", "\u00e9"]


@pytest.mark.parametrize("step", ["parsed", "quarantine", "processed", "manifest"])
def test_a_batch_that_fails_anywhere_leaves_nothing(spark, tmp_path, lists, step):
    inputs, out, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    for i in range(3):
        drop_in(inputs, f"{i}.json", f"t{i}")
    (inputs / "bad.json").write_text('{"title": \n')

    def fail(batch_id, at):
        if batch_id == 2 and at == step:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, inputs, out, offsets, lists, files_per_batch=1, probe=fail)
    seen = {r.batch_id for name in ("processed", "quarantine") for r in commits.read_published(spark, out, name).collect()}
    assert seen == {0, 1}
    run(spark, inputs, out, offsets, lists, files_per_batch=1)
    assert links(spark, out) == ["t0", "t1", "t2"]
    assert [r.line for r in srv.read_quarantined(spark, out).collect()] == ['{"title": ']


def test_a_published_batch_is_not_published_again(spark, tmp_path):
    out = str(tmp_path / "out")
    commits.publish(out, 4, {"a": spark.range(3), "b": spark.range(5)})
    commits.publish(out, 4, {"a": spark.range(30), "b": spark.range(50)})
    commits.publish(out, 11, {"a": spark.range(2), "b": spark.range(0)})
    assert sorted(map(tuple, commits.read_published(spark, out, "a").collect())) == [(0, 4), (0, 11), (1, 4), (1, 11), (2, 4)]
    assert commits.read_published(spark, out, "b").count() == 5


def test_a_batch_is_parsed_once(spark, tmp_path, lists, monkeypatch):
    calls = []
    monkeypatch.setattr(srv, "parse_product_lines", lambda lines, parse=srv.parse_product_lines: calls.append(1) or parse(lines))
    inputs, out = tmp_path / "in", str(tmp_path / "out")
    drop_in(inputs, "a.json", "a1")
    run(spark, inputs, out, str(tmp_path / "offsets"), lists, charset_fallback=True)
    assert len(calls) == 1 and "line STRING" not in str(srv.read_published(spark, out).schema)


@pytest.fixture
def few_partitions(spark):
    """A state store of two partitions: each has Python workers of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


REQUESTS = "client_key long, file_key long, ts timestamp"


def deliver(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def state_rows(spark, offsets, variable=None, operator=0):
    read = spark.read.format("statestore").option("operatorId", operator)
    return (read.option("stateVarName", variable) if variable else read).load(offsets).collect()


def test_requests_without_a_bound(spark, few_partitions):
    folder, out, offsets = (scratch_folder(spark, "req") for _ in range(3))
    for batch in ([(1, 1), (1, 1), (1, 2)], [(1, 1), (2, 1)]):
        deliver(spark, folder, batch, "client_key long, file_key long")
        unique = work.unique_requests_stream(spark.readStream.schema("client_key long, file_key long").parquet(folder))
        (unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets)
         .trigger(availableNow=True).start().awaitTermination())
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 1), (1, 2), (2, 1)]


def test_requests_leave_the_state_when_their_span_is_over(spark, few_partitions):
    day = lambda d, h=0: datetime.datetime(2024, 1, 1 + d, h)
    folder, out, offsets = (scratch_folder(spark, "req") for _ in range(3))
    deliveries = [
        [(1, 1, day(0)), (1, 1, day(0, 5)), (1, 2, day(0, 6)), (1, 1, day(1)), (None, 1, day(0)), (1, 1, None)],
        [(1, 2, day(0, 23)), (1, 1, day(9))],                      # a repeat in the span; then the watermark moves far on
        [(1, 1, day(0)), (1, 1, day(0)), (7, 7, day(0)), (1, 1, day(9, 3)), (1, 1, day(8, 23))],   # late; a repeat; in time, as the delay allows
    ]
    for rows in deliveries:
        deliver(spark, folder, rows, REQUESTS)
        stream = spark.readStream.schema(REQUESTS).parquet(folder)
        work.stream_requests(stream, out, offsets, "ts", 86_400, "2 days", availableNow=True).awaitTermination()
    epoch = datetime.datetime(1970, 1, 1)
    at = {int((day(d) - epoch).total_seconds() + 86_400) * 1000: d for d in range(12)}
    once = sorted((r.client_key, r.file_key, at[r.span_end]) for r in commits.read_published(spark, out, "requests").collect())
    assert once == [(1, 1, 0), (1, 1, 1), (1, 1, 8), (1, 1, 9), (1, 2, 0)]
    late = Counter()
    for r in commits.read_published(spark, out, "late").collect():
        late[r.client_key, r.file_key, at[r.span_end]] += r.n
    assert late == {(1, 1, 0): 2, (7, 7, 0): 1}
    # what is over is no state: of the five requests those of the last two spans are left
    operators = {r.operatorName: r.operatorId for r in spark.read.format("state-metadata").load(offsets).collect()}
    held = state_rows(spark, offsets, operator=operators["dedupe"])
    assert sorted(r.key.span_end.day for r in held) == [10, 11]


FRAGMENTS = "file_key string, fragment_no long, expected long"


def follow(spark, folder, out, offsets, **options):
    stream = spark.readStream.schema(FRAGMENTS).parquet(folder)
    work.stream_files(stream, out, offsets, availableNow=True, **options).awaitTermination()


def test_completeness_out_of_order_and_redelivered(spark, few_partitions):
    folder, out, offsets = (scratch_folder(spark, "files") for _ in range(3))
    n = work.BITMAP_BITS + 3
    big = [("big", i, n) for i in range(1, n + 1)]
    steps = [
        ([("a", 3, 3), ("a", 1, 3), ("b", 1, 2)] + big[100:], set()),
        ([("a", 1, 3), ("a", 3, 3), ("b", 1, 2)] + big[:99], set()),          # redelivered: nothing new
        ([("a", 2, 3), ("c", 1, 1)] + big[99:100], {("a", 3), ("c", 1), ("big", n)}),
        ([("a", 2, 3), ("a", 1, 3), ("b", 2, 2), ("b", 2, 2)], {("a", 3), ("c", 1), ("big", n), ("b", 2)}),
        ([("x", 1, None), ("x", None, 4), (None, 1, 1), ("x", 5, 4), ("x", 0, 4)], {("a", 3), ("c", 1), ("big", n), ("b", 2)}),
    ]
    for arriving, complete in steps:
        deliver(spark, folder, arriving, FRAGMENTS)
        follow(spark, folder, out, offsets)
        files = commits.read_published(spark, out, "files").collect()
        assert {(r.file_key, r.fragments) for r in files} == complete and len(files) == len(complete)
    assert len({r.batch_id for r in files}) == 2
    # a complete file keeps no bitmaps; rows that say nothing are told
    assert state_rows(spark, offsets, "bits") == [] and len(state_rows(spark, offsets, "file")) == 4
    aside = commits.read_published(spark, out, "aside").collect()
    assert {r.report for r in aside} == {"no fragment"} and len(aside) == 5


def test_state_of_files_ends_by_a_timer(spark, few_partitions):
    folder, out, offsets = (scratch_folder(spark, "files") for _ in range(3))
    day = lambda d: datetime.datetime(2024, 1, 1 + d)
    schema = f"{FRAGMENTS}, at timestamp"
    held = []
    for rows in ([("done", 1, 1, day(0)), ("open", 1, 2, day(0)), ("slow", 1, 2, day(0))], [("slow", 1, 2, day(2))], [("late", 1, 2, day(3))],
                 [("slow", 2, 2, day(5)), ("done", 1, 1, day(5))], [("other", 1, 2, day(20))]):
        deliver(spark, folder, rows, schema)
        stream = spark.readStream.schema(schema).parquet(folder)
        work.stream_files(stream, out, offsets, "at", 3 * 86_400_000, availableNow=True).awaitTermination()
        held.append(sorted(r.key.file_key for r in state_rows(spark, offsets, "file")))
    # a file that goes on stays; a fragment that comes again after its file was forgotten is forgotten as well
    assert held == [["done", "open", "slow"], ["done", "open", "slow"], ["late", "slow"], ["done", "late", "slow"], ["other"]]
    assert sorted(r.file_key for r in commits.read_published(spark, out, "files").collect()) == ["done", "done", "slow"]
    given_up = commits.read_published(spark, out, "aside").where("report = 'given up'").collect()
    assert sorted((r.file_key, r.fragments) for r in given_up) == [("late", 2), ("open", 2)]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    from wordkin.sources import products as psrc

    for i in range(60):
        (tmp_path / f"in{i}").mkdir()
        (tmp_path / f"in{i}" / "file").write_text('{"title":"t","reviews":[]}\n')
    tracker, key = spark.sparkContext.statusTracker(), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        lines = psrc.read_lines(spark, [str(tmp_path / f"in{i}") for i in range(60)])
        tasks = [tracker.getStageInfo(stage).numTasks for job in tracker.getJobIdsForGroup("listing") for stage in tracker.getJobInfo(job).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert lines.count() == 60 and spark.conf.get(key) == before
