"""A training corpus from raw documents: five stages, each a written table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordkin.llm.bpe import encode_documents
from wordkin.llm.exact import drop_duplicates
from wordkin.llm.language import keep_identified
from wordkin.llm.mixing import mix_documents
from wordkin.llm.near import keep_one_of_each
from wordkin.storage import pin


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language."""
    return keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return keep_one_of_each(docs, size=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""
    return encode_documents(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [("language ID", identify_languages), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
          ("mix", mix), ("BPE", encode)]

#: near copies and BPE are beyond SQL; the tests hold the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
