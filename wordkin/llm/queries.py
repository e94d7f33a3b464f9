"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordkin.llm import audit, bpe, credentials, exact, language, lines, mixing, near, spelling, suffixes, topk, toxicity, urls

# fixed values: the rules that pages are judged by
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.drop_repeated_spans(_table(spark, sf_dir, "documents"), batches=2)
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_duplicates(_table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_with_digests(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.filter_urls(_table(spark, sf_dir, "pages"), rules)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_components(_table(spark, sf_dir, "documents"), size=2)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan_secrets(_table(spark, sf_dir, "documents"))
    counts = [credentials.count_of(F.col("found"), kind).alias(f"n_{kind}") for kind in (*credentials.BASE_KINDS, credentials.FORMAT)]
    base = credentials.spans_text(F.filter("found", lambda x: x["kind"] != credentials.FORMAT))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), credentials.spans_text(F.col("found")).alias("spans"))


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 6 over web pages, which have all kinds of evidence; the trigrams come from the documents."""
    return language.identify_pages(_table(spark, sf_dir, "pages"), language.fit_language(_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_exact_dedup, op3_mix_sources, op4_bpe, op5_url_filter, op6_language_id, op7_toxicity,
    op8_line_dedup, op9_exact_top_k, op10_minhash_near_dedup, op11_spelling_variants, op12_filter_audit, op13_secret_scan, page_languages)}
