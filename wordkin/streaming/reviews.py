"""Continuous intake of review files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordkin.operators.reviews import explode_reviews, process_reviews
from wordkin.operators.skew import broadcast_if_small
from wordkin.sources.products import decode_latin, files_not_utf8, good_products, parse_product_lines, quarantined_lines
from wordkin.storage import few_listing_tasks, pin
from wordkin.streaming import commits

PLACE = ["file", "block", "line_id"]


def stream_reviews(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, lexicon: DataFrame,
                   gazetteer: DataFrame, files_per_batch: int = 1000, charset_fallback: bool = False,
                   probe: commits.Probe = None, **trigger) -> StreamingQuery:
    """Process review files as they arrive; :func:`read_published` and :func:`read_quarantined` read ``out_dir``.

    A micro-batch is parsed once, into a table that its two results are made from: the processed reviews and the lines that are
    not JSON. Both are published by one manifest, so a batch that fails anywhere leaves neither, and one that is run again
    after it was published changes nothing. ``probe(batch_id, step)`` is called ahead of each write: ``parsed``, ``quarantine``,
    ``processed``, ``manifest``. ``trigger`` is passed on; without it the query runs until it is stopped. The word lists are
    written once, as every batch reads them.
    """
    lexicon, gazetteer = pin(lexicon, "lexicon"), pin(gazetteer, "gazetteer")

    def run(batch: DataFrame, batch_id: int) -> None:
        if commits.is_published(batch.sparkSession, out_dir, batch_id):
            return
        lines = batch.withColumn("line_id", F.monotonically_increasing_id())
        if charset_fallback:
            # at most files_per_batch rows
            latin = pin(files_not_utf8(batch).withColumn("latin", F.lit(True)), "files-not-utf8")
            lines = decode_latin(lines.join(broadcast_if_small(latin), "file", "left"), F.col("latin")).drop("latin")
        if probe is not None:
            probe(batch_id, "parsed")
        parsed = pin(parse_product_lines(lines), "parsed-batch")
        done = process_reviews(explode_reviews(good_products(parsed), *PLACE), [*PLACE, "pos"], lexicon, gazetteer)
        commits.publish(out_dir, batch_id, {"quarantine": quarantined_lines(parsed), "processed": done}, probe)

    with few_listing_tasks(spark):
        arriving = (spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(in_dir)
                    .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                            F.col("_metadata.file_block_start").alias("block")))
        writer = arriving.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()


def read_published(spark: SparkSession, out_dir: str) -> DataFrame:
    """The processed reviews of all published batches."""
    return commits.read_published(spark, out_dir, "processed")


def read_quarantined(spark: SparkSession, out_dir: str) -> DataFrame:
    """The lines that were not JSON: ``file, block, line_id, line, batch_id``."""
    return commits.read_published(spark, out_dir, "quarantine")
