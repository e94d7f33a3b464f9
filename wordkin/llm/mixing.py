"""Mixing sources to target weights with hash-threshold histograms. DataFrame operations only.

Every document has a hash. A source that is to give ``target`` words of its ``source_size`` takes each of
its documents ``floor(target / source_size)`` times, and once more the documents whose hash lies below
the source's threshold. The threshold comes from a histogram of words by source and hash bucket: the
running sum says in which bucket the budget runs out, and only that bucket is split further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordkin.llm.kernels import own_prefix
from wordkin.operators.skew import broadcast_if_small, number_within
from wordkin.storage import pin

#: weights by the rank of the source, repeating, and the share of all words that is shared out
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEATS = 2

#: hash bits, and bits by which one level of the histogram splits a bucket
HASH_BITS = 60
LEVEL_BITS = 12

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def document_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the decimal id; rows with one id share it, null ids share another."""
    digits = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digits, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows, sources in code point order, null last.

    ``SHARE_PERCENT`` of all words go to the sources by weight; what a source would get beyond
    ``MAX_REPEATS`` times its size goes to the others by weight, until none is above.
    """
    spark = sizes.sparkSession
    # a row per source; the partial sums leave one row per task and source to shuffle
    totals = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("_null", F.col("source").isNull()))
    # null source: compared as an empty string after the null flag
    ranked = number_within(totals.withColumn("_name", F.coalesce("source", F.lit(""))), ["_null"], ["_name"], "_rank", "sources")
    named = ranked.where(~F.col("_null")).agg(F.count("*").alias("n")).first()["n"]
    rank = F.col("_rank") + F.when(F.col("_null"), F.lit(named)).otherwise(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = pin(ranked.select("source", "source_size", weight.alias("weight")), "source-weights")

    # the budget of one round is shared by the sources that are not at their limit yet; all sums are of whole numbers,
    # so that reruns agree to the last bit
    all_words = ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    per_weight, full_words, full_weight = None, 0, 0
    while True:
        limit = F.lit(False) if per_weight is None else F.col("weight") * F.lit(per_weight) >= MAX_REPEATS * F.col("source_size")
        full = ranked.agg(F.sum(F.when(limit, F.col("source_size"))).alias("words"), F.sum(F.when(limit, F.col("weight"))).alias("w"),
                          F.sum("weight").alias("all")).first()
        words, w = full["words"] or 0, full["w"] or 0
        if per_weight is not None and (words, w) == (full_words, full_weight):
            break
        full_words, full_weight = words, w
        left = (full["all"] or 0) - w
        if not left:
            per_weight = float("inf")
            break
        per_weight = (SHARE_PERCENT * all_words - 100 * MAX_REPEATS * words) / (100 * left)
    target = F.least(F.col("weight") * F.lit(per_weight), (MAX_REPEATS * F.col("source_size")).cast("double"))
    return ranked.select("source", "source_size", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target).alias("target"))


def _bucket(h: Column, level: int) -> Column:
    """The leading bits of the hash that tell buckets of this level apart."""
    return F.shiftright(h, HASH_BITS - LEVEL_BITS * (level + 1))


def hash_thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, limit``: documents of the source with a hash below ``limit`` have about ``budget`` words.

    ``sizes`` has ``source, h, size``, ``budgets`` has ``source, budget``. One level sums words by source
    and bucket; the bucket in which the budget runs out is the only one that the next level reads.
    At the last level a bucket is one hash value; it is taken if that comes nearer to the budget.
    """
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    # _prefix: the bucket of the level before; _below: words of all earlier buckets
    at = budgets.select(F.col("source").alias("_s"), "budget", F.lit(0).cast("bigint").alias("_prefix"), F.lit(0).cast("bigint").alias("_below"))
    levels = HASH_BITS // LEVEL_BITS
    for level in range(levels):
        at = broadcast_if_small(pin(at, f"thresholds-{level}"))
        before = F.lit(0).cast("bigint") if level == 0 else _bucket(F.col("h"), level - 1)
        inside = sizes.join(at, same("source", "_s") & (before == F.col("_prefix")))
        cells = inside.groupBy("_s", "budget", "_below", _bucket(F.col("h"), level).alias("bucket")).agg(F.sum("size").alias("words"))
        run = W.partitionBy("_s").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        cells = cells.withColumn("_to", F.col("_below") + F.sum("words").over(run))
        # the last bucket that begins within the budget
        inside_budget = F.col("_to") - F.col("words") <= F.col("budget")
        cut = cells.where(inside_budget).groupBy("_s", "budget").agg(
            F.max_by(F.struct("bucket", (F.col("_to") - F.col("words")).alias("below"), "words"), "bucket").alias("c"))
        at = cut.select("_s", "budget", F.col("c.bucket").alias("_prefix"), F.col("c.below").alias("_below"), F.col("c.words").alias("_words"))
        if level < levels - 1:
            at = at.drop("_words")
    nearer = F.col("_below") + F.col("_words") / 2 <= F.col("budget")
    return at.select(F.col("_s").alias("source"), (F.col("_prefix") + F.when(nearer, 1).otherwise(0)).alias("limit"))


def mix_sources(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every row of ``docs`` (``doc_id, source, text``).

    ``taken`` is ``size`` times the number of times the mix takes the document, which is at most
    ``MAX_REPEATS``. Null text has no words; null is a source like any other, ranked last; a source without words
    has the target 0. Rows with the same ``doc_id`` and source are taken together, as they share a hash.
    An empty table gives an empty result.
    """
    rows = pin(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id")).alias("h")),
               "document-sizes")
    targets = pin(source_targets(rows), "source-targets")
    times = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("bigint")
    budgets = targets.select("source", (F.col("target") - times * F.col("source_size")).alias("budget"))
    limits = hash_thresholds(rows.select("source", "h", "size"), budgets.where(F.col("budget") > 0))
    plan = targets.select("source", "source_size", "target", times.alias("_times")).alias("t").join(
        limits.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left").select(
        F.col("t.source").alias("_s"), "source_size", "target", "_times", F.coalesce("limit", F.lit(0)).alias("_limit"))
    plan = broadcast_if_small(pin(plan, "mix-plan"))
    extra = F.when(F.col("h") < F.col("_limit"), F.col("_times") + 1).otherwise(F.col("_times"))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * extra).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them, with the columns of ``docs``.

    The word counts are computed in one pass for the thresholds and once more here, so that no text is
    shuffled. A document without words is kept when its source or its hash lets it. Extra columns go along, whatever their names.
    """
    own = own_prefix(docs)
    rows = pin(docs.select("source", word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id")).alias("h")), "document-sizes")
    targets = pin(source_targets(rows), "source-targets")
    times = F.when(F.col("source_size") == 0, F.lit(1)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int")
    budgets = targets.select("source", (F.col("target") - times * F.col("source_size")).alias("budget"))
    limits = hash_thresholds(rows, budgets.where(F.col("budget") > 0))
    plan = targets.select("source", times.alias("_times")).alias("t").join(
        limits.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left").select(
        F.col("t.source").alias(f"{own}source"), F.col("_times").alias(f"{own}times"), F.coalesce("limit", F.lit(0)).alias(f"{own}limit"))
    plan = broadcast_if_small(pin(plan, "mix-plan"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    copies = F.col(f"{own}times") + F.when(document_hash(F.col("doc_id")) < F.col(f"{own}limit"), 1).otherwise(0)
    taken = docs.join(plan, docs["source"].eqNullSafe(F.col(f"{own}source"))).withColumn(f"{own}copies", copies.cast("int"))
    taken = taken.where(F.col(f"{own}copies") > 0)
    return taken.withColumn(f"{own}copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}copies")))).select(*names)
