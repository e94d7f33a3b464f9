"""Spelling variants: words at one inserted, deleted or replaced letter, each led to its most frequent neighbour.

Two words at one error agree in one half, in front of the error or behind it. The search matches either half
exactly in a bidirectional FM-index of the delimited vocabulary, then extends it across the other half, allowing the one error
(:mod:`wordkin.llm.fmindex`). The vocabulary is indexed in blocks: words that agree in a half, and are equal in
length but for one letter, come to one block, so that no word is asked of every block. A pair is found
once, in the block of the half that ends before, or begins behind, the first letter at which its words differ.

A half that more than ``GROUP_ROWS`` words share, say a prefix that a third of the vocabulary has, is refined: the error lies in one half of
what is left, so the words are dealt again by what they share beside it, until groups are small or the place of the
error is known. Each word is in two more rows per level, and levels are the logarithm of the longest word's length.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.llm.fmindex import Vocabulary
from wordkin.llm.kernels import ship_package
from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

#: words shorter or rarer than this are no words of the vocabulary
MIN_LENGTH, MIN_COUNT = 5, 3
#: a word leads to a neighbour that is so many times as frequent
MIN_RATIO = 2
#: of runs whose checksum this divides one letter is left out
SLIP_EVERY = 97

#: rows of a block of the index, and of a group of words that stays together, at most about
BLOCK_ROWS = GROUP_ROWS = 32_768

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NEIGHBOURS = "word string, n_near bigint, best_n bigint, best string"


def with_slips(doc_id: Column, run: Column, every: int = SLIP_EVERY) -> Column:
    """``run``, or without one letter where ``every`` divides the checksum of ``<doc_id>:<run>``; a null id is empty."""
    checksum = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (checksum % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(checksum % every == 0, cut).otherwise(run)


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip_every: int = SLIP_EVERY) -> DataFrame:
    """``word, n``: the vocabulary of ``docs`` (``doc_id, text``), runs of letters with A-Z lower-cased, after slips."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text"), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))
    words = runs.select("doc_id", run.alias("run")).select(with_slips(F.col("doc_id"), F.col("run"), slip_every).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _with_key(rows: DataFrame) -> DataFrame:
    """Add what the words of one group share: the shorter length, the place of the error, the letters before and behind."""
    behind = F.right("word", F.greatest(F.col("shorter") - F.col("end"), F.lit(0)))
    return rows.withColumn("key", F.xxhash64("shorter", "begin", "end", F.substring("word", F.lit(1), F.col("begin")), behind))


def _divided(rows: DataFrame) -> DataFrame:
    """Each row twice: the words first differ behind the middle of ``begin`` to ``end``, or before it."""
    middle = F.floor((F.col("begin") + F.col("end")) / 2).cast("int")
    halves = F.inline(F.array(F.struct(middle.alias("begin"), F.col("end").alias("end"), F.lit(True).alias("to_right")),
                              F.struct(F.col("begin").alias("begin"), middle.alias("end"), F.lit(False).alias("to_right"))))
    return _with_key(rows.select("word", "n", "shorter", "same_length", halves))


def halves(words: DataFrame) -> DataFrame:
    """Each word of ``words`` (``word, n``) with either half, among words of its length and of one letter more or less."""
    length = F.length("word")
    roles = F.inline(F.array(F.struct(length.alias("shorter"), F.lit(True).alias("same_length")),
                             F.struct((length - 1).alias("shorter"), F.lit(False).alias("same_length"))))
    rows = words.select("word", "n", roles).where(F.col("shorter") > 0)
    return _divided(rows.withColumn("begin", F.lit(0)).withColumn("end", F.col("shorter") + 1))


def refined(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` with their large groups divided until each is small or has one place for the error left."""
    done = []
    while True:
        large = pin(rows.where(F.col("end") - F.col("begin") > 1).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
                    .where(F.col("rows") > group_rows).select("key"), "large-groups")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        large = broadcast_if_small(large)
        can_be = F.col("end") - F.col("begin") > 1
        done.append(pin(rows.join(large.withColumn("_large", F.lit(True)), "key", "left")
                        .where(F.col("_large").isNull() | ~can_be).drop("_large"), "small-groups"))
        rows = pin(_divided(rows.where(can_be).join(large, "key", "left_semi")), "divided-groups")


def _block_neighbours(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each word of a block: how many neighbours these rows find, and the best of them."""
    distinct = rows.drop_duplicates("word").sort_values("word", kind="stable")
    names, n = distinct["word"].to_numpy(), distinct["n"].to_numpy()
    number = pd.Series(np.arange(len(names)), index=names)
    asked = rows["word"].map(number).to_numpy()
    one, two = Vocabulary(names.tolist()).one_error(asked, *(rows[c].to_numpy() for c in ("same_length", "begin", "end", "to_right")))
    word, near = np.concatenate([one, two]), np.concatenate([two, one])
    order = np.lexsort((near, -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    return pd.DataFrame({"word": names[word[first]], "n_near": np.diff(first, append=len(word)), "best_n": n[near[first]], "best": names[near[first]]})


def neighbours(words: DataFrame, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``word, n_near, best, best_n`` of the words of the written table ``words`` (``word, n``) that have neighbours."""
    ship_package(words.sparkSession)
    rows = halves(words)
    n_rows = 4 * words.count()
    if n_rows > group_rows:
        rows = refined(rows, group_rows)
    blocks = max(1, -(-n_rows // block_rows))
    found = rows.groupBy(F.pmod("key", F.lit(blocks)).alias("block")).applyInPandas(_block_neighbours, _NEIGHBOURS)
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.rank")).alias("best_n")))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms`` (``word, form``, written): where the chain of forms ends. Chains double their step each round."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = pin(roots.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def group_spellings(words: DataFrame, ratio: int = MIN_RATIO, **blocks) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words`` (``word, n``, distinct words).

    ``form`` is the neighbour with the largest ``n``, of equal ones the first in code-point order, if its ``n`` is at least
    ``ratio`` times the word's; ``root`` is where the forms of forms end, the word itself without one.
    """
    words = pin(words.select("word", "n"), "vocabulary")
    near = neighbours(words, **blocks)
    is_form = F.col("best_n") >= F.col("n") * ratio
    spelled = pin(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "spelled")
    roots = last_forms(spelled.where(F.col("form").isNotNull()))
    return spelled.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """:func:`group_spellings` over the vocabulary of ``docs`` (``doc_id, text``).

    Null and empty texts have no words; texts are read whole, however long. Repeated rows count as often as they come, with the same
    slips. A null ``doc_id`` slips as an empty one. Ties between forms go by code points. Extra columns are not
    read. An empty table, or one without frequent words, has no rows.
    """
    return group_spellings(count_words(docs))
