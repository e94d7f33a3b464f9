"""Joins and numbering that hold at any size and when one key has a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordkin.storage import pin

# A key with more rows than a slice is hot: its rows go to as many tasks as it has slices. The size of a
# slice doesn't depend on the size of the data.
ROWS_PER_SLICE = 1_000_000

# word lists up to this size are broadcast
BROADCAST_BYTES = 64 << 20


def fits_broadcast(words: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a list, whose size is counted here, is small enough to be broadcast."""
    width = sum((F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 16 for name in words.columns), F.lit(16))
    size = words.agg(F.sum(width).alias("size")).first()["size"] or 0
    return size <= max_bytes


def broadcast_if_small(words: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a list for broadcast if its size, which is counted here, allows it.

    A larger list is left to a shuffled join. Pass a table, not a long computation: it is read once
    for the count.
    """
    return F.broadcast(words) if fits_broadcast(words, max_bytes) else words


def hot_limit(rows: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> float | None:
    """The number of rows above which a key is hot; None if the table is too small to have a hot key.

    Counts ``rows``, which for a written table without filters takes the file footers only.
    """
    return float(rows_per_slice) if rows.count() > rows_per_slice else None


def join_totals(rows: DataFrame, totals: DataFrame, keys: Sequence[str], spread: Sequence[str],
                n_rows: str, total: str, limit: float | None, keep_unmatched: bool = False) -> DataFrame:
    """Add to ``rows`` the column ``total`` of the ``totals`` row with the same keys.

    ``totals`` is unique on ``keys`` and its column ``n_rows`` says how many ``rows`` each key has. Rows of
    keys with more than ``limit`` rows get their total from the list of those hot keys, which is broadcast if its size
    allows it; in the shuffled join that serves all others they are spread by the hash of the ``spread`` columns.
    Totals come out of an aggregation, where Spark's own skew handling does not look.

    Rows without a total are dropped, or kept with a null total.
    """
    if limit is None:
        return rows.join(totals.select(*keys, total), list(keys), "left" if keep_unmatched else "inner")
    is_hot = F.col(n_rows) > limit
    hot = totals.where(is_hot).select(*keys, F.col(total).alias("_hot"), F.col(n_rows).alias("_hot_rows"))
    # beyond that size a shuffled join, which reads written tables on both sides, so that Spark may split its hot keys
    hot = broadcast_if_small(pin(hot, "hot-keys"))
    slices = F.pmod(F.xxhash64(*spread), F.ceil(F.col("_hot_rows") / limit)) + 1
    left = rows.join(hot, list(keys), "left").withColumn(
        "_slice", F.when(F.col("_hot_rows").isNull(), F.lit(0)).otherwise(slices.cast("int")))
    # the slice has to come from the data: Spark would take a constant out of the join keys, and with it
    # the spreading. Reading the same columns as the hot list, this side shares its shuffle.
    right = totals.select(*keys, F.when(is_hot, -1).otherwise(0).alias("_slice"), F.col(total).alias("_cold"))
    joined = (left.join(right, [*keys, "_slice"], "left").withColumn(total, F.coalesce("_hot", "_cold"))
              .drop("_slice", "_hot", "_hot_rows", "_cold"))
    return joined if keep_unmatched else joined.where(F.col(total).isNotNull())


def number_within(df: DataFrame, group: Sequence[str], order: Sequence, name: str, label: str = "numbered",
                  max_groups: int | None = None) -> DataFrame:
    """Add the 1-based position of each row within its group.

    ``group`` and ``order`` together must identify a row. Rows are range-partitioned by both, so a
    large group spans many tasks; positions come from the running ids of the sorted partitions
    and one small row per (group, partition). Give ``max_groups`` where the number of groups is
    bounded: the small rows are then broadcast, once their size is checked.
    """
    placed = pin(
        df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
          .withColumn("_id", F.monotonically_increasing_id()), label, codec="zstd")
    # the upper 31 bits of the id are the partition
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    runs = placed.groupBy(*group, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    if max_groups is not None:
        # sorted partitions: at most one run per partition plus one per group
        runs = broadcast_if_small(pin(runs, f"{label}-runs"))
    position = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return (placed.join(runs, [*group, "_part"])
            .withColumn(name, position)
            .drop("_id", "_part", "_first", "_before"))
