"""Filter interaction audit: what each filter removes in every order in which the filters may be applied.

A document is a mask, one bit per filter that it fails. In lexicographic order all permutations that begin alike
are neighbours: the Lehmer code of a prefix gives the rank of the first one, and there are as many as the remaining filters can
be ordered. Whether a mask is kept, removed or removed earlier at a step depends on the first letters only, so each of these
covers intervals of ranks. The masks' counts are added where an interval begins and taken off where it ends; a
prefix sum over the ranks gives the totals of all orders at once, without looking at a document once per order.

Spark reduces the documents to counts per part and mask, at most ``2 ** filters`` rows per part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import ship_package
from wordkin.storage import pin

MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
#: the filters that look at one text, in the order of :func:`text_failures`, and the one that compares texts
TEXT_FILTERS, COPY_FILTER = "ABCD", "E"

_BLANKS = r"[\x20\x09-\x0D]+"
_MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
_KEPT, _REMOVED, _REDUNDANT, _UNIQUE, _GOOD, _TOXIC = range(len(_MEASURES))
_TOTALS = (f"part string, filter_order string, step int, {', '.join(f'{name} bigint' for name in _MEASURES)}, shapley bigint, "
           "filter string")


def text_failures(text: Column) -> list[Column]:
    """Whether a text has few words, repeats its words, has many capitals, holds a sign of markup; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, _BLANKS), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [F.size(words) < MIN_WORDS, F.size(F.array_distinct(words)) * 100 < F.size(words) * MIN_DISTINCT_PERCENT,
            capitals * 100 > F.length(text) * MAX_CAPITALS_PERCENT, text.rlike("[#$%&*|]")]


def prefixes(n: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
    """Every beginning of a permutation of ``n`` letters, with the ranks of the permutations that begin so (end exclusive)."""
    def grow(prefix: tuple[int, ...], rank: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
        size = factorial(n - len(prefix))
        if prefix:
            yield prefix, rank, rank + size
        unused = [letter for letter in range(n) if letter not in prefix]
        for digit, letter in enumerate(unused):  # digit: of the Lehmer code
            yield from grow((*prefix, letter), rank + digit * size // len(unused))
    return grow((), 0)


@cache
def intervals(mask: int, n: int) -> np.ndarray:
    """Rows of measure, step (from 0), begin and end: where the documents with this mask count."""
    found = []
    for prefix, begin, end in prefixes(n):
        step, fails = len(prefix) - 1, [mask >> letter & 1 for letter in prefix]
        if not any(fails):
            found.append((_KEPT, step, begin, end))
        elif fails[-1]:
            earlier = any(fails[:-1])
            found += [(measure, step, begin, end) for measure in ([_REDUNDANT] if earlier else [_REMOVED, _GOOD, _TOXIC])]
            if mask == 1 << prefix[-1]:
                found.append((_UNIQUE, step, begin, end))
    return np.array(found, np.int64).reshape(-1, 4)


@cache
def orders(n: int) -> np.ndarray:
    """The permutations of ``n`` letters by rank."""
    return np.array([prefix for prefix, _, _ in prefixes(n) if len(prefix) == n])


def totals_of_orders(masks: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals by measure, step and rank, and by letter what its filter removes in all orders.

    ``counts`` has a row per mask: all documents, good ones, toxic ones.
    """
    change = np.zeros((len(_MEASURES), n, factorial(n) + 1), np.int64)
    counted = np.array([0, 0, 0, 0, 1, 2])  # by measure: the column of counts
    for mask, row in zip(masks.tolist(), counts, strict=True):
        measure, step, begin, end = intervals(mask, n).T
        np.add.at(change, (measure, step, begin), row[counted[measure]])
        np.add.at(change, (measure, step, end), -row[counted[measure]])
    totals = change.cumsum(2)[:, :, :-1]
    shares = np.zeros(n, np.int64)
    np.add.at(shares, orders(n).T, totals[_REMOVED])
    return totals, shares


def _audit_part(part: tuple, cells: pd.DataFrame, letters: str) -> pd.DataFrame:
    n = len(letters)
    totals, shares = totals_of_orders(cells["mask"].to_numpy(), cells[["n", "good", "toxic"]].to_numpy().astype(np.int64), n)
    by_rank = orders(n)
    names = ["".join(letters[i] for i in order) for order in by_rank]
    out = {"part": part[0], "filter_order": np.repeat(names, n), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(names))}
    out |= {name: totals[i].T.ravel() for i, name in enumerate(_MEASURES)}
    out |= {"shapley": shares[by_rank].ravel(), "filter": np.array(list(letters))[by_rank].ravel()}
    return pd.DataFrame(out)


def count_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic`` of ``docs`` (``doc_id, text, lang``) and ``labels`` (``doc_id, quality, toxic``).

    Texts are compared by their SHA-256. A text's copies are counted before they meet, so that thousands of copies
    are a few rows; which of them has the smallest id comes from the counts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = sum(F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(text_failures(text)))
    # rows without an id have no label and are spread by their texts
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none "), F.hex("hash")))
    rows = (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("hash"))
            .groupBy(key.alias("key"), "doc_id", "part", "mask", "hash").agg(F.count(F.lit(1)).alias("n")))
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("string").alias("key"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    marked = [F.coalesce(F.col(name), F.lit(False)).alias(name) for name in ("good", "toxic")]
    rows = rows.join(marks, "key", "left").select("doc_id", "part", "mask", "hash", "n", *marked)
    has_id = F.col("doc_id").isNotNull()
    copies = pin(rows.groupBy("hash", "part", "mask", *marked).agg(
        F.sum("n").alias("n"), F.sum(F.when(has_id, 0).otherwise(F.col("n"))).alias("n_without_id"),
        F.min("doc_id").alias("first_id"), F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first")), "copies")
    firsts = copies.groupBy("hash").agg(F.min("first_id").alias("smallest"))
    is_first = F.coalesce(F.col("first_id") == F.col("smallest"), F.lit(False))
    n_first = F.col("n_without_id") + F.when(is_first, F.col("first.n")).otherwise(0)
    copy_bit = 1 << len(TEXT_FILTERS)
    cells = copies.join(firsts, "hash").select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), n_first.alias("n")),
        F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - n_first).alias("n")))))
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col(name), F.col("n")).otherwise(0)).alias(name) for name in ("good", "toxic")])


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part (value of ``lang``), order of the filters and step, with the counts of that step.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter, removed earlier), ``unique_fails`` (fail its
    filter only), ``good_lost`` and ``toxic_lost`` (removed by it, labelled so), ``shapley`` (removed by its filter in all orders).

    Null and empty texts are the same, short, text; a null ``lang`` is the empty part. A copy is a row whose text a row with a smaller
    ``doc_id`` has, in any part; rows with the same id and text are no copies of each other, and a row without id is a
    copy of none and has no label. A document with several labels is good or toxic if one of them says so. Texts are read whole,
    however long. Extra columns are not read. An empty table has no parts and no rows.
    """
    ship_package(docs.sparkSession)
    letters = TEXT_FILTERS + COPY_FILTER

    def run(part: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        return _audit_part(part, cells, letters)

    return count_masks(docs, labels).groupBy("part").applyInPandas(run, _TOTALS)
