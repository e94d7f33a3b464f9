"""The whole review job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wordkin.operators.reviews import collect_entries, explode_reviews, process_reviews
from wordkin.sinks.tables import write_html, write_json_lines
from wordkin.sources.products import good_products, quarantined_lines, read_paired, read_products
from wordkin.storage import pin

PLACE = ["file", "block", "line_id"]


def process_files(spark: SparkSession, paths: str | Sequence[str], lexicon: DataFrame, gazetteer: DataFrame,
                  charset_fallback: bool = False) -> DataFrame:
    """Review files to ``file, block, line_id, pos, link, color, entities, is_sarcastic``.

    ``file, block, line_id, pos`` is the input order. Lines that are not JSON are left out; see
    ``quarantined_lines`` for them.
    """
    products = good_products(read_products(spark, paths, charset_fallback))
    return process_reviews(explode_reviews(products, *PLACE), [*PLACE, "pos"], lexicon, gazetteer)


def run_reviews(spark: SparkSession, outputs: dict[str, str], folder: str, lexicon: DataFrame, gazetteer: DataFrame,
                charset_fallback: bool = False, escape: bool = True) -> None:
    """Process the inputs of ``outputs`` (path of a file or folder, to output name) in one job.

    Writes ``<folder>/json/out=<name>``, ``<folder>/html/report=<name>`` and the table ``<folder>/quarantine`` (``out, file,
    block, line_id, line``) of lines that are not JSON. A product without reviews has a line without entries, an
    input without reviews a report of header and footer. The products and the processed reviews have several
    readers and are written once before.
    """
    if len(set(outputs.values())) < len(outputs):
        raise ValueError("each input needs an output name of its own")
    products = pin(read_paired(spark, outputs, charset_fallback), "products")
    quarantined_lines(products, "out").write.mode("overwrite").parquet(f"{folder}/quarantine")
    good = good_products(products)
    keys = ["out", *PLACE]
    processed = pin(process_reviews(explode_reviews(good, *keys), [*keys, "pos"], lexicon, gazetteer), "processed")
    lines = collect_entries(processed, keys, products=good)
    write_json_lines(lines, f"{folder}/json", "out", PLACE)
    reports = spark.createDataFrame([(name,) for name in outputs.values()], "report string")
    write_html(processed, f"{folder}/html", "out", [*PLACE, "pos"], escape, reports)
