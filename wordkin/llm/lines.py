"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

The count table has, of each key, how many documents hold it and the smallest of them. The filter of a shard says of most keys of a new batch that
the index has never seen them: these are appended to the count table as they are. Only keys that a filter lets through are
looked up in it, and those that are found there are merged. A key is known to be repeated by its counts alone, so what the filters say
decides the result. Documents can be taken out again: the counts of their keys go down, and keys without documents leave the filters.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import mix64, ship_package
from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

MIN_KEY_LENGTH = 10

#: keys of a shard; with more of them the shards are split
SHARD_KEYS = 1 << 18
#: entries per bucket of a filter, bits of a fingerprint, and moves before a filter is doubled
SLOTS, PRINT_BITS, MAX_MOVES = 4, 16, 200

_U = np.uint64
_BLANK = " \t\n\x0b\f\r"
_KEY_UPPER, _KEY_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class CuckooFilter:
    """A set of 64-bit hashes that may answer yes for a hash it doesn't hold, never no for one it holds."""

    def __init__(self, capacity: int = 1024, table: np.ndarray | None = None):
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85)))))
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = _U(len(self.table) - 1)
        prints = ((hashes >> _U(64 - PRINT_BITS)) % _U((1 << PRINT_BITS) - 1) + _U(1)).astype(np.uint16)
        one = hashes & mask
        return prints, one.astype(np.int64), ((one ^ mix64(prints.astype(_U))) & mask).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(hashes)
        return (self.table[one] == prints[:, None]).any(1) | (self.table[two] == prints[:, None]).any(1)

    def add(self, hashes: np.ndarray) -> bool:
        """False if some hash found no place; the filter must then be rebuilt larger."""
        prints, one, two = self._places(hashes)
        # first come, first served, all rows at a time, while they find a free slot in their buckets
        left = np.arange(len(hashes))
        for places in (one, two) * SLOTS:
            if not len(left):
                return True
            at = places[left]
            first = np.unique(at, return_index=True)[1]
            row, bucket = left[first], at[first]
            free = self.table[bucket] == 0
            has = free.any(1)
            self.table[bucket[has], free[has].argmax(1)] = prints[row[has]]
            left = np.setdiff1d(left, row[has], assume_unique=True)
        mask = len(self.table) - 1
        jump = mix64(np.arange(1 << PRINT_BITS, dtype=_U))
        for row in left:
            mark, bucket = int(prints[row]), int(one[row])
            for move in range(MAX_MOVES):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
                slot = (mark + move) % SLOTS
                mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
                bucket = (bucket ^ int(jump[mark])) & mask
            else:
                return False
        return True

    def remove(self, hashes: np.ndarray) -> None:
        """Only for hashes that were added."""
        for mark, *places in zip(*(x.tolist() for x in self._places(hashes)), strict=True):
            for bucket in places:
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break

    @classmethod
    def of(cls, hashes: np.ndarray, capacity: int = 1024) -> CuckooFilter:
        capacity = max(capacity, len(hashes))
        while not (made := cls(capacity)).add(hashes):
            capacity *= 2
        return made


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANK)), _KEY_UPPER, _KEY_LOWER)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_references(docs: DataFrame) -> DataFrame:
    """``key, doc_id, at``: a reference per line, with the line's key as its SHA-256 and its place in the text.

    Lines with keys shorter than ``MIN_KEY_LENGTH`` code points have none. Rows with one ``doc_id`` count as
    one document; a null ``doc_id`` counts as the largest.
    """
    lines = docs.select(_doc(F.col("doc_id")).alias("doc_id"), F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("at", "line"))
    return lines.where(F.length("line") >= MIN_KEY_LENGTH).select(F.unhex(F.sha2("line", 256)).alias("key"), "doc_id", "at")


def _doc(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit((1 << 63) - 1))


def _shard(h: Column, shards: int) -> Column:
    return F.pmod(F.shiftright(h, 20), F.lit(shards)).cast("int")


_FILTERS = "shard int, filter binary"
_KEYS = "key binary, h bigint, n_docs bigint, first_doc bigint"


def _hashes(table: pd.DataFrame) -> np.ndarray:
    return table["h"].to_numpy().astype(np.int64).view(_U) if len(table) else np.empty(0, _U)


def _load(filters: pd.DataFrame, shard_keys: int) -> CuckooFilter:
    if not len(filters):
        return CuckooFilter(shard_keys)
    return CuckooFilter(table=np.frombuffer(filters["filter"].iloc[0], np.uint16).reshape(-1, SLOTS).copy())


def _store(shard: tuple, held: CuckooFilter | None) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard[0]], "filter": [None if held is None else held.table.tobytes()]})


class LineIndex:
    """How many documents hold each key, and the smallest of them, with a cuckoo filter per shard of the keys.

    All state is in written tables: ``references`` (``key, doc_id, at``) and ``counts`` (``key, h, n_docs, first_doc``), a part per batch, and
    ``filters`` (``shard, filter``). ``insert`` and ``delete`` write new tables and never change old ones. A key has a row in the count
    part of each batch that held it, the later ones with the sum of all before. A shard has a share of the hash range; shards are split, and
    their filters built anew from the count table, before they have more than ``shard_keys`` keys.
    """

    def __init__(self, spark, shard_keys: int = SHARD_KEYS):
        ship_package(spark)
        self.shards, self.shard_keys, self.n_keys = 1, shard_keys, 0
        self.references: list[DataFrame] = []
        self.counts: list[DataFrame] = []
        self.filters = pin(spark.createDataFrame([], _FILTERS), "line-filters")
        #: of the last batch: keys that the filters let through to the count table, and how many of them were there
        self.asked, self.found = 0, 0

    def _by_shard(self, keys: DataFrame, run, schema: str) -> DataFrame:
        shard = _shard(F.col("h"), self.shards).alias("shard")
        return keys.withColumn("shard", shard).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(run, schema)

    def _asked_for(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``maybe``: whether the filters may hold them."""
        size = self.shard_keys

        def look_up(shard: tuple, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            return new.drop(columns="shard").assign(maybe=_load(old, size).contains(_hashes(new)))

        return self._by_shard(keys, look_up, f"{_KEYS}, maybe boolean")

    def _add(self, keys: DataFrame, n: int) -> None:
        """Put ``n`` keys, which are in the count table by now, into the filters."""
        size = self.shard_keys

        def add(shard: tuple, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            held = _load(old, size)
            return _store(shard, held if held.add(_hashes(new)) else None)

        self.n_keys += n
        if self.n_keys > self.shards * size:
            return self._split()
        self.filters = pin(self._by_shard(keys.select("h"), add, _FILTERS), "line-filters")
        if not self.filters.where("filter IS NULL").isEmpty():
            self._split()

    def _split(self, room: int = 0) -> None:
        """More shards, for all keys and ``room`` more, with filters of the keys of the count table."""
        self.shards *= 2
        while self.shards * self.shard_keys < self.n_keys + room:
            self.shards *= 2
        size, shards = self.shard_keys, self.shards

        def build(table: pd.DataFrame) -> pd.DataFrame:
            return _store((int(table["shard"].iloc[0]),), CuckooFilter.of(_hashes(table), size))

        keys = self.current().select(_shard(F.col("h"), shards).alias("shard"), "h")
        self.filters = pin(keys.groupBy("shard").applyInPandas(build, _FILTERS), "line-filters")

    def current(self, only: DataFrame | None = None) -> DataFrame:
        """The count table, a row per key; ``only`` of the keys in that table."""
        parts = reduce(DataFrame.unionByName, self.counts)
        if only is not None:
            parts = parts.join(only, "key", "left_semi")
        # counts of later batches are larger, their smallest documents smaller or the same
        return parts.groupBy("key").agg(F.first("h").alias("h"), F.max("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))

    def insert(self, references: DataFrame) -> None:
        """Add the written ``line_references`` of documents that the index doesn't hold yet."""
        batch = pin(_counted(references), "line-batch")
        n = batch.count()
        self.references.append(references)
        if not self.counts:
            self.counts.append(batch)
            return self._add(batch, n)
        if self.n_keys + n > self.shards * self.shard_keys:
            self._split(n)
        marked = pin(self._asked_for(batch), "line-marked")
        asked = marked.where("maybe").drop("maybe")
        # only keys that the filters may hold are looked up in the count table
        known = self.current(broadcast_if_small(pin(asked.select("key"), "line-asked")))
        known = pin(known.select("key", F.col("n_docs").alias("_n"), F.col("first_doc").alias("_first")), "line-known")
        merged = asked.join(broadcast_if_small(known), "key", "left").select(
            "key", "h", (F.col("n_docs") + F.coalesce("_n", F.lit(0))).alias("n_docs"), F.least("first_doc", "_first").alias("first_doc"),
            F.col("_n").isNull().alias("new"))
        fresh = marked.where(~F.col("maybe")).drop("maybe").withColumn("new", F.lit(True))
        part = pin(fresh.unionByName(merged), "line-counts")
        self.asked, self.found = asked.count(), known.count()
        self.counts.append(part.drop("new"))
        self._add(part.where("new"), n - self.found)

    def delete(self, doc_ids: DataFrame) -> None:
        """Take out all references of the documents in ``doc_ids`` (``doc_id``)."""
        gone = pin(doc_ids.select(_doc(F.col("doc_id")).alias("doc_id")).distinct(), "line-deleted")
        before = reduce(DataFrame.unionByName, self.references)
        touched = pin(before.join(gone, "doc_id", "left_semi").select("key").distinct(), "line-touched")
        after = pin(before.join(gone, "doc_id", "left_anti"), "line-references")
        # the keys of the documents are counted again, all others stay as they are
        again = pin(_counted(after.join(touched, "key", "left_semi")), "line-again")
        others = pin(self.current().join(touched, "key", "left_anti"), "line-others")
        size = self.shard_keys

        def remove(shard: tuple, lost: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            held = _load(old, size)
            held.remove(_hashes(lost))
            return _store(shard, held)

        lost = touched.join(again, "key", "left_anti").select(F.xxhash64("key").alias("h"))
        self.filters = pin(self._by_shard(lost, remove, _FILTERS), "line-filters")
        self.references, self.counts = [after], [others, again]
        self.n_keys = others.count() + again.count()

    def repeated(self) -> DataFrame:
        """``key, keep_doc``: keys of at least two documents, and the smallest of those."""
        return (reduce(DataFrame.unionByName, self.counts).where("n_docs > 1").groupBy("key")
                .agg(F.min("first_doc").alias("keep_doc")))


def _counted(references: DataFrame) -> DataFrame:
    """``key, h, n_docs, first_doc`` of some references. A key of very many documents is a few rows when it meets itself."""
    return (references.select("key", "doc_id").distinct().groupBy("key")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
            .select("key", F.xxhash64("key").alias("h"), "n_docs", "first_doc"))


def drop_repeated_lines(docs: DataFrame, batches: int = 2) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every row of ``docs`` (``doc_id, text``), ``text`` being what is left.

    ``docs`` goes into a ``LineIndex`` in ``batches`` parts of about equal size. A document loses each line whose
    key another document with a smaller id has. Null and empty texts have one empty line; a document that loses
    all lines has an empty text. Rows with one ``doc_id`` are one document: a line they share stays in each.
    Extra columns are not read.
    """
    rows = docs.select("doc_id", "text")
    references = pin(line_references(rows).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")), "line-references")
    index = LineIndex(docs.sparkSession)
    for batch in range(batches):
        index.insert(references.where(F.col("batch") == batch).drop("batch"))
    repeated = broadcast_if_small(pin(index.repeated(), "repeated-lines"))
    # a row per document that loses lines, with their places
    drops = (references.join(repeated, "key").where(F.col("doc_id") != F.col("keep_doc"))
             .groupBy("doc_id").agg(F.collect_set("at").alias("_drop")))
    drops = broadcast_if_small(pin(drops, "dropped-lines").withColumnRenamed("doc_id", "_doc"))
    # the places that stay are found by hashing, not by search in the list
    lines = split_lines(F.col("text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    left = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda at: F.get("_lines", at)), "\n"))
    done = rows.join(drops, _doc(F.col("doc_id")) == F.col("_doc"), "left").withColumn("_lines", lines)
    return done.select("doc_id", F.size("_lines").cast("bigint").alias("n_lines"),
                       F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"), F.coalesce(left, F.lit("")).alias("text"))
