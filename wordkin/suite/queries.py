"""The registered queries, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordkin import metrics
from wordkin.functions import reviews as rules
from wordkin.functions import scores
from wordkin.functions import text as tx
from wordkin.operators import collocations as co
from wordkin.operators import ngrams as ng
from wordkin.operators import reports
from wordkin.operators import reviews as rv
from wordkin.plans.collocations import extract_collocations, find_collocations, step_counts
from wordkin.plans.reviews import process_files, run_reviews
from wordkin.sinks import tables as sink
from wordkin.sources import ngrams as src
from wordkin.sources import products as psrc
from wordkin.storage import fingerprint, pin, scratch_folder
from wordkin.streaming import commits
from wordkin.streaming import reviews as srv
from wordkin.streaming import work
from wordkin.suite import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
PAIRS = "w1 string, w2 string, c bigint, decade int"


# ---- collocations ---------------------------------------------------------------------------

def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Records by decade without stop words. A pair may come several times; who needs pairs adds them up."""
    return ng.decade_records(ng.drop_stop_words(fx.ngram_records(spark, sf), fx.stop_words(spark, sf)))


def _counted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The pairs with the totals of both words and the sums behind S, a written table, and N per decade."""
    records = _records(spark, sf)
    told = co.survey(records)
    return pin(co.count_and_sum(records, told, told.sizes), "pairs", codec="zstd"), told.sizes


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """For who reads the scores once: no table of pairs is written, and the sums behind S are left out."""
    records = _records(spark, sf)
    told = co.survey(records)
    left = co.count_left(records, told.crowded, n_rows=told.rows)
    return co.score_counted(co.count_right(left, records, told.crowded, n_rows=told.rows), told.sizes)


def _scores_and_totals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    counted, sizes = _counted(spark, sf)
    return co.score_counted(counted, sizes), pin(co.counted_totals(counted), "totals")


def ngram_parse(spark, sf):
    return ng.tokenise_lines(fx.raw_lines(fx.ngrams(spark, sf)))


def ngram_validity(spark, sf):
    return ng.parse_ngrams(fx.raw_lines(fx.ngrams(spark, sf)))


def stopword_filter(spark, sf):
    """With the stop words as a list that was written, one per line."""
    path = scratch_folder(spark, "stop-list")
    fx.stop_words(spark, sf).write.text(path)
    return ng.drop_stop_words(fx.ngrams(spark, sf), src.read_stop_words(spark, path))


def decade_bucket(spark, sf):
    decade = ng.decade_of(F.col("year"))
    return fx.ngrams(spark, sf).select("w1", "w2", "year", decade.alias("decade"), ng.decade_label(decade).alias("label"))


def decade_window(spark, sf):
    return fx.ngrams(spark, sf).where(ng.in_window(F.col("year")))


def decade_rollup(spark, sf):
    return ng.roll_up_decades(fx.ngram_records(spark, sf))


def decade_partition_read(spark, sf):
    path = scratch_folder(spark, "decades")
    sink.write_decade_pairs(ng.decade_records(fx.ngram_records(spark, sf)), path)
    return src.read_decades(spark, path, PAIRS, [1900, 1950]).select("decade", "w1", "w2", "c")


def corpus_size(spark, sf):
    return co.corpus_size(_records(spark, sf))


def left_marginal(spark, sf):
    return co.left_marginal(_records(spark, sf)).select("decade", "w1", "c1")


def right_marginal(spark, sf):
    return co.right_marginal(_records(spark, sf)).select("decade", "w2", "c2")


def marginals_grouping_sets(spark, sf):
    return co.marginals_in_one_pass(_records(spark, sf))


def join_w1(spark, sf):
    records = _records(spark, sf)
    n_rows, _, crowded = co.survey(records)
    return co.count_left(records, crowded, n_rows=n_rows).select("decade", "w1", "w2", "c", "c1")


def join_w2(spark, sf):
    return co.count_pairs(_records(spark, sf)).select("decade", "w1", "w2", "c", "c1", "c2")


def pmi(spark, sf):
    probability = scores.joint_probability(F.col("c"), F.col("n"))
    return _scored(spark, sf).select("decade", "w1", "w2", F.round("pmi", 6).alias("pmi"),
                                     F.round(probability, 9).alias("p"))


def npmi(spark, sf):
    return _scored(spark, sf).select("decade", "w1", "w2", "c", "c1", "c2", "n", F.round("npmi", 6).alias("npmi"))


def npmi_sum(spark, sf):
    records = _records(spark, sf)
    return co.sum_scores(records, co.survey(records))


def filter_abs(spark, sf):
    scored = _scored(spark, sf).where(co.passes_absolute(F.col("npmi"), fx.MIN_NPMI))
    return scored.select("decade", "w1", "w2", F.round("npmi", 6).alias("npmi"))


def filter_rel(spark, sf):
    scored, totals = _scores_and_totals(spark, sf)
    passed = co.join_decades(scored, totals).where(co.passes_relative(F.col("npmi"), F.col("s"), fx.MIN_REL))
    return passed.select("decade", "w1", "w2", F.round("npmi", 6).alias("npmi"))


def filter_perfect(spark, sf):
    perfect = scores.is_perfect(F.col("c"), F.col("c1"), F.col("c2"))
    return _scored(spark, sf).where(~perfect).select("decade", "w1", "w2", F.round("npmi", 6).alias("npmi"))


def _rounded(found: DataFrame) -> DataFrame:
    """Scores to six digits, as the rank and the printed line must not hang on the last bits."""
    return found.withColumn("npmi", F.round("npmi", 6))


def extract(spark, sf):
    return _rounded(extract_collocations(fx.ngram_records(spark, sf), fx.stop_words(spark, sf), fx.MIN_NPMI, fx.MIN_REL))


def collocations_ranked(spark, sf):
    found = find_collocations(_records(spark, sf), fx.MIN_NPMI, fx.MIN_REL)
    return co.rank_collocations(_rounded(found)).select("decade", "rank", "w1", "w2", "npmi")


def format_collocation(spark, sf):
    found = find_collocations(_records(spark, sf), fx.MIN_NPMI, fx.MIN_REL)
    return co.format_collocations(found, digits=6)


def write_collocations(spark, sf):
    path = scratch_folder(spark, "collocations")
    found = find_collocations(_records(spark, sf), fx.MIN_NPMI, fx.MIN_REL)
    sink.write_collocations(found, path, digits=6)
    return spark.read.schema("value string, decade int").text(path).select("decade", F.col("value").alias("line"))


def resume_collocations(spark, sf):
    """The first run leaves its tables and figures; the second, with other thresholds, takes them up; a third, with other records, is refused."""
    work_dir, stop = scratch_folder(spark, "run"), fx.stop_words(spark, sf)
    options = {"ordered": False, "work_dir": work_dir}
    extract_collocations(fx.ngram_records(spark, sf), stop, 1.0, 1.0, **options)
    found = extract_collocations(fx.ngram_records(spark, sf), stop, fx.MIN_NPMI, fx.MIN_REL, **options)
    try:
        extract_collocations(fx.ngram_records(spark, sf).where("year <> 1900"), stop, fx.MIN_NPMI, fx.MIN_REL, **options)
    except ValueError as refused:
        if "holds another run" not in str(refused):
            raise
    else:
        raise AssertionError("a run with other records took up the tables")
    sizes = spark.read.schema("decade int, n bigint").parquet(f"{work_dir}/sizes")
    return _rounded(co.join_decades(found, sizes))


def stage_counts(spark, sf):
    """Rows of each step; those up to the kept records are counted while these are written, the others in their tables."""
    seen, work_dir = {}, scratch_folder(spark, "run")

    def counted(df, stage):
        if stage in ("lines", "valid", "kept"):
            df, seen[stage] = metrics.observe_rows(df, stage)
        # read twice from here, and long to compute
        return pin(df, "kept", codec="zstd") if stage == "kept" else df

    lines = fx.raw_lines(fx.ngrams(spark, sf))
    valid = counted(ng.parse_ngrams(counted(lines, "lines")), "valid")
    found = extract_collocations(valid, fx.stop_words(spark, sf), fx.MIN_NPMI, fx.MIN_REL, ordered=False, observe=counted,
                                 work_dir=work_dir, inputs=fingerprint(lines))
    counts = {stage: count.get["rows"] for stage, count in seen.items()} | step_counts(spark, work_dir)
    told = spark.createDataFrame(list(counts.items()), "stage string, rows bigint").where("stage <> 'scored'")
    return told.unionByName(metrics.count_stages({"found": found}))


def scan_text(spark, sf):
    path = scratch_folder(spark, "text")
    lines = fx.raw_lines(fx.ngrams(spark, sf)).withColumn("folder", F.ascii("value") % 3)
    lines.write.partitionBy("folder").text(f"{path}/corpus")
    return ng.parse_ngrams(src.read_text_lines(spark, path))


def scan_seqfile(spark, sf):
    """Every seventh record holds a line break and a second line, which does not make it two."""
    path = scratch_folder(spark, "sequence")
    second = F.when(F.crc32(F.col("value").cast("binary")) % 7 == 0, "\nnext line\t1999\t1\t1").otherwise("")
    lines = fx.raw_lines(fx.ngrams(spark, sf)).select(F.monotonically_increasing_id() + (1 << 33), F.concat("value", second))
    sink.write_sequence_lines(lines, path)
    return ng.parse_ngrams(src.read_sequence_lines(spark, path))


# ---- reviews --------------------------------------------------------------------------------

def _exploded(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews of the nested products, with the position in the product."""
    return rv.explode_reviews(fx.products(spark, sf), "product_id").withColumn("pos", F.col("pos").cast("bigint"))


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    return rv.process_reviews(_exploded(spark, sf), ["product_id", "pos"], fx.lexicon(spark), fx.gazetteer(spark))


def _shown(processed: DataFrame, *keys: str) -> DataFrame:
    return processed.select(*keys, "link", "color", rules.entity_text(F.col("entities")).alias("entities"), "is_sarcastic")


def explode_reviews(spark, sf):
    return _exploded(spark, sf)


def longest_sentence(spark, sf):
    return fx.reviews(spark, sf).select("product_id", "pos", tx.longest_sentence(F.col("text")).alias("sentence"))


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    return rv.annotate_reviews(fx.reviews(spark, sf), ["product_id", "pos"], lexicon=fx.lexicon(spark), carry=["rating"])


def sentiment_class(spark, sf):
    return _classes(spark, sf).select("product_id", "pos", "sentiment")


def color_map(spark, sf):
    return _classes(spark, sf).select("product_id", "pos", "sentiment", rules.color_of(F.col("sentiment")).alias("color"))


def sarcasm(spark, sf):
    flag = rules.is_sarcastic(F.col("rating"), F.col("sentiment"))
    return _classes(spark, sf).select("product_id", "pos", "rating", "sentiment", flag.alias("is_sarcastic"))


def named_entities(spark, sf):
    found = rv.annotate_reviews(fx.reviews(spark, sf), ["product_id", "pos"], gazetteer=fx.gazetteer(spark))
    return found.select("product_id", "pos", rules.entity_text(F.col("entities")).alias("entities"))


def process_reviews(spark, sf):
    return _shown(_processed(spark, sf), "product_id", "pos")


def processed_json(spark, sf):
    return rv.collect_entries(_processed(spark, sf), ["product_id"])


def reserialize_input(spark, sf):
    return rv.product_json(fx.products(spark, sf), "product_id")


def _reports(spark: SparkSession) -> DataFrame:
    """Five reports with reviews, and one without any."""
    return spark.createDataFrame([(f"f{i}",) for i in range(6)], "report string")


def render_html_rows(spark, sf):
    files = _processed(spark, sf).withColumn("name", F.concat(F.lit("f"), F.col("product_id") % 5))
    return reports.html_rows(files, "name", ["product_id", "pos"], reports=_reports(spark))


def write_html(spark, sf):
    path = scratch_folder(spark, "html")
    files = _processed(spark, sf).withColumn("name", F.concat(F.lit("f"), F.col("product_id") % 5))
    sink.write_html(files, path, "name", ["product_id", "pos"], reports=_reports(spark))
    return spark.read.schema("value string, report string").text(path).select("report", F.col("value").alias("line"))


@contextmanager
def _splits_of(spark: SparkSession, size: int):
    """Files are read in splits of ``size`` bytes, so that small ones have several."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: small splits, and how many of them a task reads where there are many: each task sends its figures to the driver
SPLIT_BYTES, SPLITS_PER_TASK = 4096, 4096


def _tasks_for(spark: SparkSession, splits: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-splits // SPLITS_PER_TASK))


def fragment_lines(spark, sf):
    """Lines of written files, a file per key, numbered by their places among the good ones. Bad and blank lines stand between them
    and at the ends; a file has several splits."""
    path = scratch_folder(spark, "files")
    lines = fx.product_lines(spark, sf).repartition("file_key").sortWithinPartitions("file_key", "product_id")
    beside = F.array(F.lit(""), F.lit("{"), F.concat(F.lit('{"title":'), "product_id"))
    several = F.concat(F.slice(beside, F.lit(1), (F.col("product_id") % 3 + 1).cast("int")), F.array("line"),
                       F.slice(beside, F.lit(1), (F.col("product_id") % 2).cast("int")))
    lines.select("file_key", F.explode(several).alias("line")).write.partitionBy("file_key").text(path)
    with _splits_of(spark, SPLIT_BYTES):
        good = psrc.good_products(psrc.read_products(spark, path))
        good = pin(good.coalesce(_tasks_for(spark, good.rdd.getNumPartitions())), "good-lines")
    numbered = psrc.number_lines(good)
    return numbered.select(F.regexp_extract("file", r"file_key=(\d+)", 1).cast("bigint").alias("file_key"),
                           F.substring("title", 2, 20).cast("bigint").alias("product_id"), "fragment_no")


def assemble_file(spark, sf):
    """Every fourth fragment comes twice; its later line counts. The files are written and read back, numbered by their lines."""
    again = F.when(F.col("fragment_no") % 4 == 2, 1).otherwise(0)
    delivered = fx.fragments(spark, sf).withColumn("seq", F.explode(F.sequence(F.lit(0), again)))
    path = scratch_folder(spark, "assembled")
    sink.write_assembled(rv.assemble_files(delivered.withColumn("line", F.concat("line", F.expr("repeat(' ', seq)"))), "seq"), path)
    return psrc.read_assembled(spark, path).select(F.col("file_key").cast("bigint").alias("file_key"), "fragment_no", "line")


def parse_request_key(spark, sf):
    task = rules.fragment_parts(F.col("task"))
    return fx.requests(spark, sf).select(
        "seq", *rules.request_parts(F.col("body")),
        task[0].alias("task_kind"), task[1].alias("task_file"), task[2].alias("fragment_no"))


def dedup_requests(spark, sf):
    return rv.unique_requests(fx.requests(spark, sf))


def route_results(spark, sf):
    results = fx.reviews(spark, sf).select((F.col("product_id") % 500).alias("file_key"), "product_id", "pos")
    return rv.route_results(results, fx.requests(spark, sf), ["product_id", "pos"])


def quarantine_bad_lines(spark, sf):
    damaged = F.when(F.col("product_id") % 9 == 4, F.concat(F.expr("left(line, length(line) - 1)"), F.lit(","))).otherwise(F.col("line"))
    lines = fx.product_lines(spark, sf).select(F.col("product_id").alias("line_no"), damaged.alias("line"))
    parsed = psrc.parse_product_lines(lines)
    good = psrc.good_products(parsed).select("line_no", F.lit(False).alias("is_bad"), F.col("title").alias("content"))
    bad = psrc.quarantined_lines(parsed).select("line_no", F.lit(True).alias("is_bad"), F.col("line").alias("content"))
    return good.unionByName(bad)


def _review_files(spark: SparkSession, sf: str, label: str) -> str:
    """Product lines as files, a folder per ``file_key``."""
    path = scratch_folder(spark, label)
    sink.write_json_lines(fx.product_lines(spark, sf), path, "file_key", ["product_id"])
    return path


def charset_fallback(spark, sf):
    path = scratch_folder(spark, "charsets")
    lines = fx.product_lines(spark, sf).withColumn("latin", F.col("file_key") % 2 == 1)
    # bytes of the other character set, passed through the text writer as they are
    latin = F.encode("line", "ISO-8859-1").cast("string")
    sink.write_json_lines(lines.withColumn("line", F.when(F.col("latin"), latin).otherwise(F.col("line"))),
                          path, "file_key", ["product_id"])
    products = psrc.good_products(psrc.read_products(spark, path, charset_fallback=True))
    return rv.explode_reviews(products).select("link", F.col("pos").cast("bigint").alias("pos"), "text")


def multi_file_outputs(spark, sf):
    """Four inputs, one of them without any product that has reviews; every eleventh product has none."""
    rows = fx.products(spark, sf).withColumn("reviews", F.when(
        (F.col("product_id") % 4 == 3) | (F.col("product_id") % 11 == 7), F.slice("reviews", 1, 0)).otherwise(F.col("reviews")))
    lines = rv.product_json(rows, "product_id").withColumn("file_key", F.col("product_id") % 4)
    path, out = scratch_folder(spark, "inputs"), scratch_folder(spark, "outputs")
    sink.write_json_lines(lines, path, "file_key", ["product_id"])
    outputs = {f"{path}/file_key={k}": f"report{k}" for k in range(4)}
    run_reviews(spark, outputs, out, fx.lexicon(spark), fx.gazetteer(spark))
    return spark.read.schema("value string, out string").text(f"{out}/json").select("out", F.col("value").alias("line"))


# ---- streams --------------------------------------------------------------------------------

def stream_process_reviews(spark, sf):
    path, out = _review_files(spark, sf, "arriving"), scratch_folder(spark, "published")
    query = srv.stream_reviews(spark, f"{path}/*", out, scratch_folder(spark, "offsets"), fx.lexicon(spark),
                               fx.gazetteer(spark), availableNow=True)
    query.awaitTermination()
    return _shown(srv.read_published(spark, out))


def stream_restart(spark, sf):
    """One run fails between the writes of a batch, the next ahead of its manifest; the third takes the batch up again."""
    path, out, offsets = _review_files(spark, sf, "arriving"), scratch_folder(spark, "published"), scratch_folder(spark, "offsets")
    lists = fx.lexicon(spark), fx.gazetteer(spark)
    for stop in ("processed", "manifest", None):
        def probe(batch_id: int, step: str, stop=stop) -> None:
            if step == stop:
                raise RuntimeError("stopped before publishing")

        try:
            srv.stream_reviews(spark, f"{path}/*", out, offsets, *lists, probe=probe, availableNow=True).awaitTermination()
        except Exception as error:
            if stop is None or "stopped before publishing" not in str(error):
                raise
    return _shown(srv.read_published(spark, out))


#: requests count once in so many seconds
SPAN_SECONDS = 5 * 86_400


def stream_dedup(spark, sf):
    """Requests in the order of time, in two deliveries, so that the watermark passes most spans; then those of the first two days
    again, which are late by then."""
    events = fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path, out, offsets = (scratch_folder(spark, label) for label in ("events", "requests", "offsets"))
    for which in ("ts < '2024-01-16'", "ts >= '2024-01-16'", "ts < '2024-01-03'"):
        events.where(which).write.mode("append").parquet(path)
        arriving = fx.with_request_columns(spark.readStream.schema(events.schema).parquet(path))
        work.stream_requests(arriving, out, offsets, "ts", SPAN_SECONDS, "5 days", availableNow=True).awaitTermination()
    columns = ["client_key", "file_key", "span_end"]
    once, late = (commits.read_published(spark, out, name).select(*columns, "n", F.lit(name).alias("kind")) for name in ("requests", "late"))
    return once.unionByName(late.groupBy(*columns, "kind").agg(F.sum("n").alias("n")))


def stream_assemble(spark, sf):
    """Fragments in several batches, some of them twice, some without an expected number."""
    arrived = fx.fragments(spark, sf).select("file_key", "fragment_no", "expected")
    again = F.when(F.col("fragment_no") % 3 == 0, 1).otherwise(0)
    nothing = F.when((F.col("copy") == 1) & (F.col("fragment_no") % 2 == 0), F.lit(None)).otherwise(F.col("expected"))
    path, out = scratch_folder(spark, "arrived"), scratch_folder(spark, "files")
    arrived = arrived.withColumn("copy", F.explode(F.sequence(F.lit(0), again))).withColumn("expected", nothing).drop("copy")
    arrived.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", 1).parquet(path)
    work.stream_files(stream, out, scratch_folder(spark, "offsets"), availableNow=True).awaitTermination()
    return commits.read_published(spark, out, "files").select("file_key", "fragments")


QUERIES: dict[str, Query] = {
    "extract_collocations": extract,
    **{query.__name__: query for query in (
        scan_seqfile, scan_text, ngram_parse, ngram_validity, stopword_filter, decade_bucket, decade_window,
        decade_rollup, decade_partition_read, corpus_size, left_marginal, right_marginal, marginals_grouping_sets,
        join_w1, join_w2, pmi, npmi, npmi_sum, filter_abs, filter_rel, filter_perfect, collocations_ranked,
        format_collocation, write_collocations, resume_collocations, stage_counts,
        explode_reviews, longest_sentence, sentiment_class, color_map, sarcasm, named_entities, process_reviews,
        processed_json, reserialize_input, render_html_rows, write_html, fragment_lines, assemble_file,
        parse_request_key, dedup_requests, route_results, quarantine_bad_lines, charset_fallback, multi_file_outputs,
        stream_process_reviews, stream_restart, stream_dedup, stream_assemble)},
}
