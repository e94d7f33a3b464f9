"""Marginals, scores, thresholds and ranking of decade pair counts (``decade, w1, w2, c``).

Years have four digits, so there are at most 1000 decades: tables with one row per decade are
broadcast on that ground, after a check of their size.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordkin.functions import scores
from wordkin.operators.ngrams import decade_label
from wordkin.operators.skew import ROWS_PER_SLICE, broadcast_if_small, hot_limit, join_totals, number_within
from wordkin.storage import pin

MAX_DECADES = 1000

#: the table of :func:`count_and_sum`
COUNTED = "decade int, w1 string, w2 string, c bigint, c1 bigint, c2 bigint, word_sum bigint, slice_sum bigint"


def left_marginal(pairs: DataFrame) -> DataFrame:
    """c(w1) per decade; ``pairs1`` counts the pairs behind it."""
    return pairs.groupBy("decade", "w1").agg(F.sum("c").alias("c1"), F.count("*").alias("pairs1"))


def right_marginal(pairs: DataFrame) -> DataFrame:
    """c(w2) per decade; ``pairs2`` counts the pairs behind it."""
    return pairs.groupBy("decade", "w2").agg(F.sum("c").alias("c2"), F.count("*").alias("pairs2"))


def corpus_size(counts: DataFrame, count: str = "c") -> DataFrame:
    """N per decade: every pair counts for two words. Takes the pairs or, shorter, a marginal."""
    return counts.groupBy("decade").agg((F.sum(count) * 2).alias("n"))


def marginals_in_one_pass(pairs: DataFrame) -> DataFrame:
    """N, c(w1) and c(w2) from one scan: ``kind, decade, word, total``."""
    sets = [[F.col("decade")], [F.col("decade"), F.col("w1")], [F.col("decade"), F.col("w2")]]
    return (pairs.groupingSets(sets, "decade", "w1", "w2")
            .agg(F.sum("c").alias("total"), F.grouping("w1").alias("no_w1"), F.grouping("w2").alias("no_w2"))
            .select(F.when((F.col("no_w1") == 1) & (F.col("no_w2") == 1), "n")
                    .when(F.col("no_w2") == 1, "c1").otherwise("c2").alias("kind"),
                    "decade",
                    F.when(F.col("no_w1") == 0, F.col("w1")).when(F.col("no_w2") == 0, F.col("w2")).alias("word"),
                    F.when((F.col("no_w1") == 1) & (F.col("no_w2") == 1), F.col("total") * 2)
                    .otherwise(F.col("total")).alias("total")))


def join_left_counts(pairs: DataFrame, left: DataFrame, limit: float | None, keep_unmatched: bool = False) -> DataFrame:
    """Add c(w1). With ``keep_unmatched`` a pair without a count stays and gets -1."""
    joined = join_totals(pairs, left, ["decade", "w1"], ["w2"], "pairs1", "c1", limit, keep_unmatched)
    return joined.fillna(-1, ["c1"]) if keep_unmatched else joined


def join_right_counts(pairs: DataFrame, right: DataFrame, limit: float | None, keep_unmatched: bool = False) -> DataFrame:
    """Add c(w2). With ``keep_unmatched`` a pair without a count stays and gets -1."""
    joined = join_totals(pairs, right, ["decade", "w2"], ["w1"], "pairs2", "c2", limit, keep_unmatched)
    return joined.fillna(-1, ["c2"]) if keep_unmatched else joined


def join_decades(rows: DataFrame, by_decade: DataFrame) -> DataFrame:
    """Add per-decade figures, a written table; a decade without figures is left out."""
    return rows.join(broadcast_if_small(by_decade), "decade")


#: the words of a side are counted in so many buckets when hot ones are looked for
BUCKETS = 1 << 16


def _bucket(word: str) -> Column:
    return F.pmod(F.xxhash64("decade", word), F.lit(BUCKETS)).cast("int")


class Survey(NamedTuple):
    """What one pass over the records tells: how many there are, N per decade (a written table), and the buckets of words (``side`` 1 or
    2, ``bucket``) with more records than a slice, one of which holds any hot word; None if there are none, and so no hot words."""

    rows: int
    sizes: DataFrame
    crowded: DataFrame | None


def survey(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> Survey:
    sided = records.select(_bucket("w1").alias("b1"), _bucket("w2").alias("b2"), "decade", _positive().alias("c"))
    by = F.grouping_id()
    counted = sided.groupingSets([["b1"], ["b2"], ["decade"]], "b1", "b2", "decade").agg(
        by.alias("by"), F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"))
    # a bit for each column that a set leaves out: b1, b2, decade
    by_left, by_right, by_decade = 0b011, 0b101, 0b110
    told = pin(counted.where((F.col("n") > rows_per_slice) | (F.col("by") == by_decade)).select(
        F.col("by").cast("int").alias("by"), F.coalesce("b1", "b2").alias("bucket"), "decade", "n", "c"), "survey")
    decades = told.where(F.col("by") == by_decade)
    rows = decades.agg(F.sum("n").alias("n")).first()["n"] or 0
    crowded = told.where(F.col("by") != by_decade).select(F.when(F.col("by") == by_left, 1).otherwise(2).alias("side"), "bucket")
    sizes = decades.where("c is not null").select("decade", (F.col("c") * 2).alias("n"))
    return Survey(rows, sizes, None if crowded.isEmpty() else crowded)


#: records in a task that adds them up, so that it holds them in memory whatever the session's number of shuffle partitions
ROWS_PER_TASK = 1_000_000


def _deal(rows: DataFrame, n_rows: int, *keys: str | Column) -> DataFrame:
    """The rows dealt by the keys, to more tasks than the session has shuffle partitions if there are too many rows for those."""
    tasks = -(-n_rows // ROWS_PER_TASK)
    few = tasks <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(*keys) if few else rows.repartition(tasks, *keys)


def _deal_by_word(rows: DataFrame, n_rows: int, side: int) -> DataFrame:
    """The rows dealt by the word of one side and the decade. Both words travel in one column, which takes a quarter off the bytes: the
    length of the first, a sign that tells whether the other is null, and both. A first word that is null has the length -1."""
    word, other = f"w{side}", f"w{3 - side}"
    rest = [name for name in rows.columns if name not in (word, other)]
    head = F.coalesce(F.octet_length(word), F.lit(-1)).cast("string")
    sign = F.when(F.col(other).isNull(), ";").otherwise(":")
    joined = F.concat(head, sign, F.coalesce(word, F.lit("")), F.coalesce(other, F.lit("")))
    head = F.substring_index(F.substring_index("_words", ":", 1), ";", 1)
    at, length, octets = F.octet_length(head) + 1, head.cast("int"), F.col("_words").cast("binary")
    first = F.when(length >= 0, F.substring(octets, at + 1, length).cast("string"))
    second = F.when(F.substring("_words", at, F.lit(1)) == ":",
                    F.substring(octets, at + 1 + F.greatest(length, F.lit(0)), F.octet_length("_words")).cast("string"))
    dealt = _deal(rows.select(joined.alias("_words"), *rest), n_rows, first, "decade")
    return dealt.select(first.alias(word), second.alias(other), *rest)


def _in_crowd(records: DataFrame, crowded: DataFrame, side: int) -> DataFrame:
    """Add ``_crowd``: true for the records whose word of that side is in a crowded bucket."""
    held = F.broadcast(crowded.where(F.col("side") == side).select(F.col("bucket").alias("_bucket"), F.lit(True).alias("_crowd")))
    marked = records.join(held, _bucket(f"w{side}") == F.col("_bucket"), "left")
    return marked.withColumn("_crowd", F.coalesce("_crowd", F.lit(False))).drop("_bucket")


def _add_up(records: DataFrame, *also: str) -> DataFrame:
    return records.groupBy("w1", "decade", *also, "w2").agg(F.sum("c").alias("c"))


def _condensed(records: DataFrame, crowded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records, those of left words in crowded buckets added up to pairs, and these pairs, a written table."""
    marked = _in_crowd(records, crowded, 1)
    columns = ["decade", "w1", "w2", "c"]
    dense = pin(_add_up(marked.where("_crowd")).select(*columns), "dense-pairs")
    return marked.where("not _crowd").select(*columns).unionAll(dense), dense


def _positive() -> Column:
    """Only pairs that occur count for their words."""
    return F.when(F.col("c") > 0, F.col("c"))


def _hot_words(pairs: DataFrame, side: int, rows_per_slice: int) -> DataFrame:
    """Totals of the words of one side with more rows than a slice, and the number of their slices."""
    rows = F.count(F.lit(1))
    hot = (pairs.groupBy("decade", f"w{side}").agg(F.sum(_positive()).alias("_hot"), rows.alias("_rows"))
           .where(F.col("_rows") > rows_per_slice)
           .select("decade", f"w{side}", "_hot", F.ceil(F.col("_rows") / rows_per_slice).cast("int").alias("_slices")))
    return broadcast_if_small(pin(hot, "hot-words"))


def _spread(rows: DataFrame, hot: DataFrame, side: int, n_rows: int) -> DataFrame:
    """The rows dealt by the word of one side, those of a hot word over its slices by the other word."""
    other = F.pmod(F.xxhash64(f"w{3 - side}"), F.col("_slices")) + 1
    sliced = rows.join(hot, ["decade", f"w{side}"], "left").withColumn("_slice", F.coalesce(other, F.lit(0)).cast("int"))
    return _deal(sliced.drop("_slices"), n_rows, f"w{side}", "decade", "_slice")


#: one more than the largest number that the last bits of ``_hash`` hold
DECADE_SPAN = 1 << 16


def _word(side: int, *also: str) -> WindowSpec:
    """The pairs of a word, which lie in one partition. ``_hash`` of word and decade leads: the sort tells rows apart by eight bytes of
    their first key, which words share, and compares the rows themselves only where these are equal. Its last bits are the decade,
    so that the pairs of a word in all decades stay together, which makes shuffles and tables smaller."""
    return W.partitionBy("_hash", f"w{side}", "decade", *also)


def _with_total(rows: DataFrame, side: int, *also: str) -> DataFrame:
    """Add c of the word of one side, and ``_hash``. The total of a hot word is in ``_hot``, if there is such a column."""
    total = F.sum(_positive()).over(_word(side, *also))
    total = F.coalesce("_hot", total) if "_hot" in rows.columns else total
    leading = F.xxhash64(f"w{side}").bitwiseAND(F.lit(-DECADE_SPAN)).bitwiseOR(F.col("decade").cast("bigint").bitwiseAND(F.lit(DECADE_SPAN - 1)))
    return rows.withColumn("_hash", leading).withColumn(f"c{side}", total)


def count_left(records: DataFrame, crowded: DataFrame | None = None, rows_per_slice: int = ROWS_PER_SLICE, n_rows: int = 0) -> DataFrame:
    """Pairs with c(w1), from records that may give a pair several times: ``decade, w1, w2, c, c1``.

    The records, ``n_rows`` if that is known, are dealt by the left word, so that pairs and word totals come out of one shuffle. Records
    of words in ``crowded`` buckets are added up to pairs before, and pairs of hot words are spread.
    """
    if crowded is None:
        pairs = _with_total(_add_up(_deal_by_word(records, n_rows, 1)), 1)
    else:
        rows, dense = _condensed(records, crowded)
        spread = _spread(rows, _hot_words(dense, 1, rows_per_slice), 1, n_rows)
        pairs = _with_total(_add_up(spread, "_slice", "_hot"), 1, "_slice")
    return pairs.select("decade", "w1", "w2", "c", "c1")


def _dealt_by_right(pairs: DataFrame, records: DataFrame | None, crowded: DataFrame | None, rows_per_slice: int,
                    n_rows: int) -> tuple[DataFrame, list[str]]:
    """The pairs of :func:`count_left` dealt by the right word, those of hot words spread, and what tells the slices of a word apart."""
    if crowded is None:
        return _deal_by_word(pairs, n_rows, 2), []
    dense = _add_up(_in_crowd(records, crowded, 2).where("_crowd"))
    return _spread(pairs, _hot_words(dense, 2, rows_per_slice), 2, n_rows), ["_slice"]


def count_right(pairs: DataFrame, records: DataFrame | None = None, crowded: DataFrame | None = None,
                rows_per_slice: int = ROWS_PER_SLICE, n_rows: int = 0) -> DataFrame:
    """Add c(w2) to the pairs of :func:`count_left`. With ``crowded`` buckets the pairs of hot words are spread; their totals
    come from the ``records``."""
    dealt, also = _dealt_by_right(pairs, records, crowded, rows_per_slice, n_rows)
    return _with_total(dealt, 2, *also).select("decade", "w1", "w2", "c", "c1", "c2")


def find_crowded(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame | None:
    """The crowded buckets of :func:`survey`."""
    return survey(records, rows_per_slice).crowded


def count_pairs(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Pairs with the totals of both words, from records by decade: ``decade, w1, w2, c, c1, c2``.

    Two shuffles of the pairs, by the left and by the right word. The records are read once more before, to count
    them in buckets of words; only where a bucket holds more than a slice, hot words are looked for and spread.
    A pair with a zero count stays, and counts for no word.
    """
    n_rows, _, crowded = survey(records, rows_per_slice)
    return count_right(count_left(records, crowded, rows_per_slice, n_rows), records, crowded, rows_per_slice, n_rows)


def count_and_sum(records: DataFrame, told: Survey, sizes: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """As :func:`count_pairs`, with the sums of scores behind S, which need no shuffle of their own here: ``word_sum``, the thousandths
    of a right word, or ``slice_sum``, the units of a slice of a hot word. One row of the word or slice has it, the others null.
    ``told`` is the survey of the records, ``sizes`` N per decade, a written table."""
    left = count_left(records, told.crowded, rows_per_slice, told.rows)
    dealt, also = _dealt_by_right(left, records, told.crowded, rows_per_slice, told.rows)
    # also decades in which nothing is above zero
    counted = _with_total(dealt.join(broadcast_if_small(sizes), "decade", "left"), 2, *also)
    word = _word(2, *also)
    units = F.when(_has_score(), _units(scores.npmi(*map(F.col, ("c", "c1", "c2", "n")))))
    # the pairs of a word differ in the other one
    first = F.col("w1") == F.min("w1").over(word)
    summed = counted.withColumn("_sum", F.when(first, F.sum(units).over(word)))
    in_slices = F.col("_hot").isNotNull() if also else F.lit(False)
    return summed.select("decade", "w1", "w2", "c", "c1", "c2", F.when(~in_slices, _thousandths(F.col("_sum"))).alias("word_sum"),
                         F.when(in_slices, F.col("_sum")).alias("slice_sum"))


def counted_totals(counted: DataFrame) -> DataFrame:
    """S per decade, as :func:`score_totals` adds it up from the scores, out of the sums in the table of :func:`count_and_sum`."""
    # one group for all whole words of a decade, and one for each hot word
    by_word = (counted.where("word_sum is not null or slice_sum is not null")
               .groupBy("decade", F.when(F.col("slice_sum").isNotNull(), F.col("w2")).alias("w2"))
               .agg(F.sum("word_sum").alias("whole"), F.sum("slice_sum").alias("sliced")))
    of_word = F.coalesce("whole", _thousandths(F.col("sliced")))
    return by_word.groupBy("decade").agg((F.sum(of_word) / 1000).alias("s"))


def sum_scores(records: DataFrame, told: Survey, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """S per decade as :func:`score_totals` gives it in either mode, ``decade, s, s_exact``, where no pair is asked for: no table of
    pairs is written, and the second shuffle goes without left words. ``told`` is the survey of the records."""
    left = count_left(records, told.crowded, rows_per_slice, told.rows)
    if told.crowded is None:
        # a pair without a left word counts for its right word, and has no score
        slim = left.where(F.col("c") > 0).select("decade", F.col("w1").isNotNull().alias("w1_known"), "w2", "c", "c1")
        dealt, also = _deal(slim, told.rows, "w2", "decade"), []
    else:
        dealt, also = _dealt_by_right(left, records, told.crowded, rows_per_slice, told.rows)
        dealt = dealt.where(F.col("c") > 0).withColumn("w1_known", F.col("w1").isNotNull())
    scored = _with_total(join_decades(dealt, told.sizes), 2, *also).where(F.col("w1_known") & F.col("w2").isNotNull())
    units = _units(scores.npmi(*map(F.col, ("c", "c1", "c2", "n"))))
    by_word = scored.groupBy("w2", "decade", *also).agg(F.sum(units).alias("_sum"))
    if also:
        by_word = by_word.groupBy("w2", "decade").agg(F.sum("_sum").alias("_sum"))
    whole = F.sum(F.col("_sum").cast("decimal(19,0)"))
    return by_word.where("_sum is not null").groupBy("decade").agg(
        (F.sum(_thousandths(F.col("_sum"))) / 1000).alias("s"), (whole.cast("double") / SCORE_UNITS).alias("s_exact"))


def decade_slices(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Pairs by decade, ``decade, w1, w2, c``, each decade in as many partitions' shares as it has slices of records.

    One shuffle adds the pairs up and sizes the shares, for a writer with a folder per decade. Records of words that may be
    hot are added up before, so no pair's records come to one task.
    """
    crowded = find_crowded(records, rows_per_slice)
    rows = records if crowded is None else _condensed(records, crowded)[0]
    counted = records.groupBy("decade").agg(F.ceil(F.count(F.lit(1)) / rows_per_slice).cast("int").alias("_slices"))
    sliced = (rows.join(broadcast_if_small(pin(counted, "slices")), "decade")
              .withColumn("_slice", F.pmod(F.xxhash64("w1", "w2"), F.col("_slices")).cast("int")).drop("_slices"))
    return _add_up(sliced.repartition("decade", "_slice"), "_slice").select("decade", "w1", "w2", "c")


def _has_score() -> Column:
    return (F.col("c") > 0) & F.col("w1").isNotNull() & F.col("w2").isNotNull()


def score_counted(counted: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """As :func:`score_pairs`, from the pairs of :func:`count_pairs`, a written table."""
    # pairs without a left or right word count for N and for the other word, and have no score
    scored = counted.where(_has_score())
    if sizes is None:
        sizes = pin(corpus_size(counted.where(F.col("c") > 0)), "sizes")
    return _with_scores(join_decades(scored, sizes))


def _with_scores(joined: DataFrame) -> DataFrame:
    figures = [F.col(name) for name in ("c", "c1", "c2", "n")]
    return joined.select("decade", "w1", "w2", *figures,
                         scores.pmi(*figures).alias("pmi"), scores.npmi(*figures).alias("npmi"))


def score_pairs(pairs: DataFrame, left: DataFrame | None = None, right: DataFrame | None = None,
                sizes: DataFrame | None = None, **skew) -> DataFrame:
    """``decade, w1, w2, c, c1, c2, n, pmi, npmi``. Pairs with a zero count have no score and are dropped.

    The pairs are read several times: pass a written table. Marginals and sizes that were written already may be given.
    """
    counted = pairs.where(F.col("c") > 0)
    limit = hot_limit(pairs, **skew)
    # read twice where there may be hot words
    kept = (lambda table, label: table) if limit is None else pin
    left = kept(left_marginal(counted), "left-marginal") if left is None else left
    right = kept(right_marginal(counted), "right-marginal") if right is None else right
    joined = join_left_counts(counted, left, limit)
    joined = join_right_counts(joined, right, limit)
    return _with_scores(join_decades(joined, pin(corpus_size(counted), "sizes") if sizes is None else sizes))


#: sums of scores count in units of this size
SCORE_UNITS = 1_000_000_000


def _units(npmi: Column) -> Column:
    return F.round(npmi * SCORE_UNITS).cast("bigint")


def _thousandths(units: Column) -> Column:
    return F.call_function("div", units, F.lit(SCORE_UNITS // 1000))


def score_totals(scored: DataFrame, mode: str = "truncated") -> DataFrame:
    """S per decade, over all scored pairs.

    ``truncated`` cuts the sum of each right word to three decimals before adding up; ``exact`` adds the scores as they
    are. Scores are added as whole numbers of units of 1e-9, so that no order of adding changes a bit of the sum.
    """
    units = _units(F.col("npmi"))
    if mode == "exact":
        whole = F.sum(units.cast("decimal(19,0)"))
        return scored.groupBy("decade").agg((whole.cast("double") / SCORE_UNITS).alias("s"))
    if mode != "truncated":
        raise ValueError(f"unknown mode {mode!r}")
    by_word = scored.groupBy("decade", "w2").agg(F.sum(units).alias("s"))
    return by_word.groupBy("decade").agg((F.sum(_thousandths(F.col("s"))) / 1000).alias("s"))


def passes_absolute(npmi: Column, min_npmi: float) -> Column:
    return npmi >= min_npmi


def passes_relative(npmi: Column, total: Column, min_rel: float) -> Column:
    """``npmi / S >= min_rel``. A total of zero stands for an infinite ratio of the score's sign; a
    negative total turns the sign of the ratio."""
    return (F.when(total != 0, F.try_divide(npmi, total) >= min_rel)
            .otherwise(npmi > 0))


def filter_collocations(scored: DataFrame, totals: DataFrame, min_npmi: float, min_rel: float,
                        perfect: Column, fp_perfect: bool = False) -> DataFrame:
    """Pairs that pass either threshold and are not perfect.

    ``perfect`` is the exact test; ``fp_perfect`` puts the literal ``npmi < 1.0`` in its place.
    """
    imperfect = (F.col("npmi") < 1.0) if fp_perfect else ~perfect
    return (join_decades(scored.where(imperfect), totals)
            .where(passes_absolute(F.col("npmi"), min_npmi)
                   | passes_relative(F.col("npmi"), F.col("s"), min_rel)))


def strongest_first() -> list[Column]:
    return [F.col("npmi").desc(), F.col("w1"), F.col("w2")]


def sort_collocations(found: DataFrame) -> DataFrame:
    """Decades in order, strongest pairs first; equal scores by word."""
    return found.orderBy("decade", *strongest_first())


def rank_collocations(found: DataFrame) -> DataFrame:
    """Add ``rank``, from 1 in each decade, without bringing a decade into one task."""
    return number_within(found, ["decade"], strongest_first(), "rank", "ranked", max_groups=MAX_DECADES)


def collocation_line(digits: int | None = None) -> Column:
    """``w1 <tab> w2 <tab> NPMI:<score>``, the score in full or with a fixed number of decimals."""
    score = F.col("npmi").cast("string") if digits is None else F.format_string(f"%.{digits}f", F.round("npmi", digits))
    return F.concat_ws("\t", "w1", "w2", F.concat(F.lit("NPMI:"), score))


def format_collocations(found: DataFrame, digits: int | None = None) -> DataFrame:
    """``decade`` label and output line."""
    return found.select(decade_label(F.col("decade")).alias("decade"), collocation_line(digits).alias("line"))
