"""The whole collocation job."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordkin.functions.scores import is_perfect
from wordkin.operators import collocations as co
from wordkin.operators.ngrams import FIRST_YEAR, LAST_YEAR, decade_records, drop_stop_words
from wordkin.sinks.tables import write_decade_figures
from wordkin.storage import check_run, digest, fingerprint, is_complete, pin, scratch_folder

Observe = Callable[[DataFrame, str], DataFrame] | None


def find_collocations(pairs: DataFrame, min_npmi: float, min_rel: float, sum_mode: str = "truncated",
                      fp_perfect: bool = False, work_dir: str | None = None, observe: Observe = None,
                      inputs: str | None = None, **skew) -> DataFrame:
    """From counts by decade to ``decade, w1, w2, npmi``, unsorted. ``pairs`` may hold a pair several times; its counts are added up.

    The pairs with both word totals are read by the sizes, the decade totals and the thresholds: they are written once, below the
    shared folder, and scored where they are read. With a ``work_dir`` they are written there, with their scores and the figures
    per decade, which the job reads back, and a run that is started again takes up
    the finished ones. A step belongs to what it was computed from: the pairs to the fingerprint of their input (``inputs``, or that of
    ``pairs``), the scores to the pairs' and the totals to the scores' and the sum mode. A folder that was begun with anything else is refused.
    ``observe(table, step)`` gets the tables of the steps before they run, and returns them, for instance with a count of their rows.
    """
    spark = pairs.sparkSession
    if work_dir:
        check_run(spark, f"{work_dir}/pairs-of", inputs=inputs or fingerprint(pairs), holds="pairs with word totals and sums")
        check_run(spark, f"{work_dir}/totals-of", sum_mode=sum_mode)
    watched = observe or (lambda table, step: table)
    path = f"{work_dir}/pairs" if work_dir else None
    at_sizes = f"{work_dir}/sizes" if work_dir else scratch_folder(spark, "sizes")
    if path and is_complete(spark, path):
        counted = spark.read.schema(co.COUNTED).parquet(path)
        sizes = _figures(co.corpus_size(counted.where(F.col("c") > 0)), at_sizes)
    else:
        told = co.survey(pairs, **skew)
        sizes = _figures(told.sizes, at_sizes)
        counted = pin(watched(co.count_and_sum(pairs, told, sizes, **skew), "pairs"), "pairs", work_dir, codec="zstd")
    scored = co.score_counted(counted, sizes).select(
        "decade", "w1", "w2", "npmi", is_perfect(F.col("c"), F.col("c1"), F.col("c2")).alias("perfect"))
    scored = watched(scored, "scored")
    if work_dir:
        scored = pin(scored, "scored", work_dir, codec="zstd")
    # a row per decade, which a sort of the result would compute twice
    totals = co.counted_totals(counted) if sum_mode == "truncated" else co.score_totals(scored, sum_mode)
    totals = _figures(totals, f"{work_dir}/totals" if work_dir else scratch_folder(spark, "totals"))
    found = co.filter_collocations(scored, totals, min_npmi, min_rel, F.col("perfect"), fp_perfect)
    return found.select("decade", "w1", "w2", "npmi")


def _figures(by_decade: DataFrame, path: str) -> DataFrame:
    """Per-decade figures as their file has them, which is written if it isn't there."""
    spark = by_decade.sparkSession
    if not is_complete(spark, path):
        write_decade_figures(by_decade, path)
    return spark.read.schema(by_decade.schema).parquet(path)


def step_counts(spark: SparkSession, work_dir: str) -> dict[str, int]:
    """Rows of the steps that a run has left in ``work_dir``: pairs, marginals (N, c(w1) and c(w2)), scored."""
    pairs, sizes, scored = (spark.read.parquet(f"{work_dir}/{name}") for name in ("pairs", "sizes", "scored"))
    words = [pairs.where(F.col("c") > 0).select("decade", word).distinct().count() for word in ("w1", "w2")]
    return {"pairs": pairs.count(), "marginals": sizes.count() + sum(words), "scored": scored.count()}


def extract_collocations(ngrams: DataFrame, stop_words: DataFrame, min_npmi: float, min_rel: float,
                         start: int = FIRST_YEAR, end: int = LAST_YEAR, ordered: bool = True,
                         observe: Observe = None, **options) -> DataFrame:
    """2-gram records to collocations, per decade, strongest first: ``decade, w1, w2, npmi``.

    ``ordered=False`` leaves the sorting to a writer that sorts itself. ``options`` are those of
    :func:`find_collocations`. A ``work_dir`` belongs to one input, stop list and window, which are told by the fingerprint of the
    records (or ``inputs``) and the rows of the list; a run with others is refused.
    """
    if options.get("work_dir"):
        options["inputs"] = json.dumps([options.get("inputs") or fingerprint(ngrams), digest(stop_words), start, end])
    kept = drop_stop_words(ngrams, stop_words)
    records = decade_records(observe(kept, "kept") if observe else kept, start, end)
    found = find_collocations(records, min_npmi, min_rel, observe=observe, **options)
    return co.sort_collocations(found) if ordered else found
