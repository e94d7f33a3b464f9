"""Readers of 2-gram corpora, stop lists and per-decade intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _listed(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of all text files below the paths, at any depth: ``value``."""
    return spark.read.option("recursiveFileLookup", True).text(_listed(paths))


def read_sequence_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records of Hadoop SequenceFiles (offset, text): ``value``, one row per record whatever it holds.

    The files are split at their sync markers and read by the JVM. A text record is a bean whose bytes and length become columns, so
    that no record passes through Python and none is copied to another file.
    """
    writable = spark._jvm.org.apache.hadoop.io
    kinds = writable.LongWritable().getClass(), writable.Text().getClass()
    records = spark.sparkContext._jsc.sequenceFile(",".join(_listed(paths)), *kinds).values()
    beans = DataFrame(spark._jsparkSession.createDataFrame(records, kinds[1]), spark)
    # the buffer of a record is longer than the record
    return beans.select(F.substring("bytes", F.lit(1), F.col("length")).cast("string").alias("value"))


def read_stop_words(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One word per line, taken as it stands: ``word``."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def read_decades(spark: SparkSession, path: str, schema: str, decades: Sequence[int] | None = None) -> DataFrame:
    """A table written by decade. Only the folders of the wanted ``decades`` are read."""
    table = spark.read.schema(schema).parquet(path)
    return table if decades is None else table.where(F.col("decade").isin(list(decades)))
