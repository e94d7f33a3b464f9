"""Inputs of the registered queries, derived from the given tables as whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordkin.operators.reviews import product_json
from wordkin.operators.skew import number_within
from wordkin.storage import pin

MIN_NPMI = 0.8137
MIN_REL = 0.00021

# fixed values: small word lists that occur in the texts
LEXICON = [("the", 1), ("and", 1), ("in", 1), ("of", -1), ("de", -1), ("la", -1)]
GAZETTEER = [("The", "PERSON"), ("Of", "LOCATION"), ("And", "ORGANIZATION"), ("De", "DATE")]

# a well-formed line, and how the first character of w1 picks the damage
RAW_LINE = """
case ascii(w1) % 10
  when 0 then concat(w1, '\t', year, '\t', match_count, '\t1')
  when 1 then concat(w1, ' ', w2, '\t', substr(cast(year as string), 1, 3), '\t', match_count, '\t1')
  when 2 then concat(w1, ' ', w2, '\t', year, '\t', match_count, 'x\t1')
  when 3 then concat(w1, ' ', w2, '\t', year, '\t-', match_count, '\t1')
  when 4 then concat(w1, ' ', w2, ' ', w1, '\t', year, '\t', match_count, '\t1')
  else concat(w1, ' ', w2, '\t', year, '\t', match_count, '\t1') end"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """A table of fewer splits than cores is spread before heavy work per row; large tables are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _word_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and the words ``w`` of each document."""
    documents = _spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    # exploding the one-element array keeps filters on the words above it, so that a text is split once
    return documents.select("doc_id", F.explode(F.array(F.array_remove(F.split("text", r"\s+"), ""))).alias("w"))


def _left_words() -> Column:
    return F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))


def ngram_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring words of the documents with a made-up year, a record each: ``w1, w2, year, match_count``."""
    right = F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0)))
    year = (F.lit(1480) + F.col("doc_id") * 7 % 560).cast("int")
    pairs = _word_lists(spark, sf_dir).select(
        year.alias("year"), F.explode(F.arrays_zip(_left_words().alias("w1"), right.alias("w2"))).alias("p"))
    return pairs.select("p.w1", "p.w2", "year", F.lit(1).cast("bigint").alias("match_count"))


def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records counted: a row for each pair and year."""
    return (ngram_records(spark, sf_dir).groupBy("w1", "w2", "year").agg(F.count("*").alias("match_count"))
            .select("w1", "w2", "year", "match_count"))


def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent left words of the 2-grams, written once. Each left word is one position in a
    text, so they are counted there, without forming the pairs."""
    words = _word_lists(spark, sf_dir).select(F.explode(_left_words()).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return pin(counted.orderBy(F.col("n").desc(), "word").limit(20).select("word"), "stop-words")


def raw_lines(grams: DataFrame) -> DataFrame:
    return grams.select(F.expr(RAW_LINE).alias("value"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("product_id"), F.col("turn").alias("pos"),
        F.concat(F.lit("https://example.org/r/"), "conv_id", F.lit("-"), "turn").alias("link"),
        "text", (F.lit(1) + (F.col("conv_id") + F.col("turn")) % 5).alias("rating"), F.col("role").alias("author"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product per conversation, its turns as reviews: ``product_id, title, reviews``."""
    review = F.struct(
        F.concat("product_id", F.lit("-"), "pos").alias("id"), "link",
        F.concat(F.lit("review "), "pos").alias("title"), "text", "rating", "author",
        F.concat(F.lit("2024-01-"), F.lpad((F.lit(1) + F.col("pos") % 28).cast("string"), 2, "0")).alias("date"))
    return (reviews(spark, sf_dir).groupBy("product_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", review.alias("review")))).alias("_r"))
            .select("product_id", F.concat(F.lit("p"), "product_id").alias("title"),
                    F.transform("_r", lambda r: r["review"]).alias("reviews")))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as JSON lines of files with seven products each: ``file_key, product_id, line``."""
    lines = product_json(products(spark, sf_dir), "product_id")
    return lines.withColumn("file_key", F.floor(F.col("product_id") / 7).cast("bigint"))


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``fragment_no``, the number of the line within its file."""
    return number_within(product_lines(spark, sf_dir), ["file_key"], ["product_id"], "fragment_no", "fragments")


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments that have arrived, some missing: ``file_key, fragment_no, expected, line``."""
    lines = numbered_lines(spark, sf_dir)
    expected = lines.groupBy("file_key").agg(F.max("fragment_no").alias("expected"))
    return (lines.join(expected, "file_key").where(F.col("product_id") % 13 != 5)
            .select("file_key", "fragment_no", "expected", "line"))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, polarity int")


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GAZETTEER, "word string, type string")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_request_columns(table(spark, sf_dir, "events"))


def with_request_columns(events: DataFrame) -> DataFrame:
    file_key = F.col("event_id") % 500
    return events.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("client_key"), file_key.alias("file_key"),
        F.concat(F.lit("input "), "user_id", F.lit(" "), file_key.cast("string")).alias("body"),
        F.concat(F.lit("task "), file_key.cast("string"), F.lit("-"), "user_id").alias("task"), "ts")
