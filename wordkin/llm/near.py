"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

One pass hashes each shingle once into a bin; the smallest hash of each bin is the sketch, and empty bins borrow
from a bin that universal hashing picks, until it is a full one. Texts with a band of bins in common share a
bucket. A round takes as many candidate pairs from a bucket as it has members: all of them with its centre, the member that
shares most buckets with others. Candidates are confirmed on the full shingle sets. Buckets whose members
are still apart after a few rounds are finished exactly, all members against all, without a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import mix64, own_prefix, seeded, ship_package, words
from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

#: similarity in percent from which texts are linked, and words in a shingle
PERCENT = 80
#: bands and bins per band: at a similarity of 0.8, 32 bands of 5 miss a pair with probability (1 - 0.8**5)**32 = 3e-6
BANDS, BAND_BINS = 32, 5
BINS = BANDS * BAND_BINS
#: hashed tries of densification before the next full bin is taken
TRIES = 64
#: pairs of one centre that a task verifies at most before the centre's rows are split
SLICE_PAIRS = 512
#: rounds of stars at most before what is left of a bucket is compared member by member
STAR_ROUNDS = 3
#: members on either side of a tile of a bucket that is finished, and shingles of its residents: a bucket with more has several tiles
TILE_ROWS, SLICE_SHINGLES = 2048, 1 << 20

_U = np.uint64
_EMPTY = np.uint32(0xFFFFFFFF)
_PROBE = (seeded(BINS * TRIES, 11) % _U(BINS)).astype(np.int64).reshape(TRIES, BINS)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row, and the row and hash of each distinct shingle, ascending by both.

    A shingle is ``size`` words in order; a text with fewer words is one shingle, one without words none.
    """
    for first, last, rows, hashes in words(column):
        n = last - first
        counts = np.bincount(rows, minlength=n)
        full = rows[size - 1:] == rows[:len(rows) - size + 1] if len(rows) >= size else np.empty(0, bool)
        at = np.flatnonzero(full)
        with np.errstate(over="ignore"):
            out = np.zeros(len(at), _U)
            for k in range(size):
                out = mix64(out * _U(0x9E3779B97F4A7C15) + hashes[at + k])
            at_rows = rows[at]
            short = np.flatnonzero((counts > 0) & (counts < size))
            if len(short):
                begin = np.searchsorted(rows, short)
                whole = np.zeros(len(short), _U)
                for k in range(size - 1):
                    more = counts[short] > k
                    whole[more] = mix64(whole[more] * _U(0x9E3779B97F4A7C15) + hashes[begin[more] + k])
                # apart from full shingles, whatever their hashes
                out, at_rows = np.concatenate([out, mix64(whole ^ _U(0xA5A5))]), np.concatenate([at_rows, short])
        order = np.lexsort((out, at_rows))
        out, at_rows = out[order], at_rows[order]
        fresh = np.ones(len(out), bool)
        fresh[1:] = (out[1:] != out[:-1]) | (at_rows[1:] != at_rows[:-1])
        yield first, last, at_rows[fresh], out[fresh]


def sketch(rows: np.ndarray, shingles: np.ndarray, n: int) -> np.ndarray:
    """Band hashes (n, BANDS) of ``n`` shingle sets; sets without shingles get zeros."""
    hashes = mix64(shingles ^ _U(0x5851F42D4C957F2D))
    bins = ((hashes >> _U(32)) * _U(BINS) >> _U(32)).astype(np.int64)
    low = (hashes & _U(0xFFFFFFFE)).astype(np.uint32)
    table = np.full(n * BINS, _EMPTY, np.uint32)
    cell = rows * BINS + bins
    order = np.argsort((cell.astype(_U) << _U(32)) | low, kind="stable")
    cell, low = cell[order], low[order]
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    table[cell[first]] = low[first]
    table = table.reshape(n, BINS)
    full = table != _EMPTY
    some = full.any(1)
    dense = table.copy()
    row, empty = np.nonzero(~full & some[:, None])
    for probe in _PROBE:
        if not len(row):
            break
        source = probe[empty]
        hit = full[row, source]
        dense[row[hit], empty[hit]] = table[row[hit], source[hit]]
        row, empty = row[~hit], empty[~hit]
    if len(row):
        # the next full bin to the right, around the end
        twice = np.concatenate([full, full], 1)
        ahead = np.where(twice, np.arange(2 * BINS), 4 * BINS)
        ahead = np.minimum.accumulate(ahead[:, ::-1], 1)[:, ::-1]
        dense[row, empty] = table[row, ahead[row, empty] % BINS]
    with np.errstate(over="ignore"):
        bands = np.zeros((n, BANDS), _U)
        parts = dense.reshape(n, BANDS, BAND_BINS).astype(_U)
        for k in range(BAND_BINS):
            bands = mix64(bands * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
        bands = mix64(bands ^ seeded(BANDS, 13)[None, :])
    bands[~some] = 0
    return bands


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, rows, shingles in shingle_sets(batch.column(1), size):
                n = last - first
                counts = np.bincount(rows, minlength=n)
                bands = sketch(rows, shingles, n)
                # two sums over the set: equal sets have equal prints
                with np.errstate(over="ignore"):
                    ends = np.concatenate([[0], np.cumsum(counts)])
                    prints = []
                    for seed in (101, 202):
                        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix64(shingles ^ seeded(1, seed)[0]))])
                        prints.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, BANDS, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[counts > 0].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(counts), pa.array(prints[0]), pa.array(prints[1]), lists],
                                                 ["doc_id", "n_shingles", "one", "two", "bands"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, rows, shingles in shingle_sets(batch.column(1), size):
                cuts = np.searchsorted(rows, np.arange(last - first + 1))
                blobs = [shingles[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(blobs, pa.binary())], ["id", "shingles"])

    return run


def _verify(percent: int):
    """Rows sorted by centre, each centre's own set first: the pairs that are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = [], []
            for i, blob in enumerate(batch.column(2)):
                shingles = np.frombuffer(blob.as_buffer(), _U)
                if b[i] is None:
                    centre, own = a[i], shingles.copy()
                    continue
                if a[i] != centre:
                    raise AssertionError("a centre's set comes before its pairs")
                few, many = (own, shingles) if len(own) < len(shingles) else (shingles, own)
                if 100 * len(few) < percent * len(many):
                    continue
                at = np.searchsorted(many, few)
                both = int((many[np.minimum(at, len(many) - 1)] == few).sum())
                if 100 * both >= percent * (len(few) + len(many) - both):
                    left.append(a[i])
                    right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def confirm_links(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``pairs`` (``a, b``) whose sets in ``sets`` (``id, shingles``) have ``percent`` of their union in common.

    A centre ``a`` with many pairs is verified in slices, each with a copy of its set.
    """
    degrees = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLICE_PAIRS).cast("int").alias("slices"))
    degrees = pin(degrees, "star-sizes")
    centres = degrees.join(sets, degrees["a"] == sets["id"]).select(
        "a", F.lit(None).cast("bigint").alias("b"), "shingles", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    sliced = pairs.join(broadcast_if_small(degrees), "a").withColumn("slice", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int")).drop("slices")
    members = sliced.join(sets, F.col("b") == F.col("id")).select("a", "b", "shingles", "slice")
    rows = centres.unionByName(members).repartition("a", "slice").sortWithinPartitions("a", "slice", F.col("b").asc_nulls_first())
    return rows.select("a", "b", "shingles").mapInArrow(_verify(percent), "a bigint, b bigint")


class _Residents:
    """Shingle sets in one sorted list, so that another set is compared with all of them at once."""

    def __init__(self):
        self.ids: list[int] = []
        self.roots: list[int] = []
        self.sets: list[np.ndarray] = []
        self.sizes = None
        self.above: dict[int, int] = {}

    def _sort(self) -> None:
        self.sizes = np.array([len(x) for x in self.sets], np.int64)
        every = np.concatenate(self.sets)
        order = np.argsort(every, kind="stable")
        self.every, self.owners = every[order], np.repeat(np.arange(len(self.sets), dtype=np.int32), self.sizes)[order]
        self.sets = []

    def _top(self, root: int) -> int:
        while (up := self.above.get(root, root)) != root:
            self.above[root] = root = self.above.get(up, up)
        return root

    def links(self, root: int, shingles: np.ndarray, percent: int) -> list[int]:
        """Residents similar to a set, one for each component that it joins with its own ``root``."""
        if not self.ids:
            return []
        if self.sizes is None:
            self._sort()
        low, high = np.searchsorted(self.every, shingles), np.searchsorted(self.every, shingles, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        both = np.bincount(self.owners[at], minlength=len(self.sizes))
        joined = []
        for k in np.flatnonzero(100 * both >= percent * (len(shingles) + self.sizes - both)):
            one, two = self._top(root), self._top(self.roots[k])
            if one != two:
                self.above[one] = two
                joined.append(self.ids[k])
        return joined


def _compare(percent: int):
    """Rows sorted by bucket and slice, residents first: links that join components, one for each join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, _Residents()
        for batch in batches:
            left, right = [], []
            keys = zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
            for (bucket, part, guest, id_, root), blob in zip(keys, batch.column(5), strict=True):
                shingles = np.frombuffer(blob.as_buffer(), _U)
                if (bucket, part) != group:
                    group, held = (bucket, part), _Residents()
                if guest:
                    found = held.links(root, shingles, percent)
                    left += [id_] * len(found)
                    right += found
                else:
                    held.ids.append(id_)
                    held.roots.append(root)
                    held.sets.append(shingles.copy())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _open_buckets(grouped: DataFrame) -> DataFrame:
    """``bucket, top, n, n_out, volume`` of buckets (``bucket, id, n_shingles, root``) in several components.

    ``top`` is the component with most members, ``n_out`` the number of members outside it.
    """
    parts = grouped.groupBy("bucket", "root").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("v"))
    found = parts.groupBy("bucket").agg(F.max_by("root", F.struct("m", -F.col("root"))).alias("top"), F.sum("m").alias("n"),
                                        (F.sum("m") - F.max("m")).alias("n_out"), F.sum("v").alias("volume"))
    return found.where("n_out > 0")


def finish_buckets(grouped: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` that join all components that similar members of a bucket lie in.

    ``grouped`` (``bucket, id, n_shingles, root, top, n, n_out, volume``) has the members of open buckets. Members outside the component
    ``top`` are compared with all members of the bucket, tile by tile: a tile has about ``TILE_ROWS`` of the one and of the other, so what a
    task holds does not grow with the bucket. A pair within one component is left out.
    """
    rows = tile_members(grouped).join(sets, "id").select("bucket", "slice", "guest", "id", "root", "shingles")
    rows = rows.repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "guest")
    return rows.mapInArrow(_compare(percent), "a bigint, b bigint").distinct()


def tile_members(grouped: DataFrame) -> DataFrame:
    """``bucket, slice, guest, id, root``: each member of a bucket in the tiles of its row, or as a guest in those of its column.

    For ``n`` members that are all apart these are ``n * n / 1024`` rows, not ``n * n``.
    """
    rows_of = lambda n: F.greatest(F.lit(1.0), F.ceil(n / TILE_ROWS))
    across = F.greatest(rows_of(F.col("n")), F.ceil(F.col("volume") / SLICE_SHINGLES)).cast("int")
    tiled = grouped.withColumn("across", across).withColumn("down", rows_of(F.col("n_out")).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    one_of = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    residents = tiled.select("bucket", one_of(F.col("across")).alias("x"), every(F.col("down")).alias("y"), F.lit(0).alias("guest"), "id", "root")
    guests = tiled.where("root <> top").select("bucket", every(F.col("across")).alias("x"), one_of(F.col("down")).alias("y"), F.lit(1).alias("guest"), "id", "root")
    tile = F.col("x").cast("bigint") * (1 << 31) + F.col("y")
    return residents.unionByName(guests).select("bucket", tile.alias("slice"), "guest", "id", "root")


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``id, root`` of every id in ``links`` (``a, b``): the smallest id of its component.

    Each round an id takes the smallest root among its neighbours, and then its root's root, so that long
    chains halve; rounds go on until nothing changes.
    """
    both = pin(links.select(F.col("a").alias("id"), F.col("b").alias("near")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("near"))).distinct(), "links")
    roots = pin(both.groupBy("id").agg(F.min("near").alias("root")).select("id", F.least("id", "root").alias("root")), "roots")
    while True:
        nearest = both.join(roots.select(F.col("id").alias("near"), F.col("root").alias("_r")), "near").groupBy("id").agg(F.min("_r").alias("_n"))
        step = roots.join(nearest, "id").select("id", "root", F.least("root", "_n").alias("_s"))
        jump = roots.select(F.col("id").alias("_s"), F.col("root").alias("_j"))
        step = pin(step.join(jump, "_s", "left").select("id", F.col("root").alias("_old"), F.least("_s", F.coalesce("_j", "_s")).alias("root")), "roots")
        roots = step.select("id", "root")
        if step.where(F.col("_old") != F.col("root")).isEmpty():
            return roots


def near_links(texts: DataFrame, size: int, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Classes and links of ``texts`` (``doc_id`` bigint, unique, and ``text``).

    Returns ``doc_id, n_shingles, rep``, where ``rep`` is the smallest ``doc_id`` with the same shingle set, and the confirmed
    links ``a, b`` between such representatives, which join all that similar members of a bucket lie in. After the first
    stars, buckets whose other members are still in several components get further stars, each around a new centre, until
    a round links nothing more or ``STAR_ROUNDS`` are done; the members left are then compared with each other.
    """
    ship_package(texts.sparkSession)
    rows = texts.select("doc_id", "text")
    sketches = pin(rows.mapInArrow(_sketches(size), "doc_id bigint, n_shingles bigint, one bigint, two bigint, bands array<bigint>"), "sketches")
    same = sketches.where("n_shingles > 0").groupBy("n_shingles", "one", "two").agg(F.min("doc_id").alias("rep"))
    same = pin(same, "equal-sets")
    classes = sketches.select("doc_id", "n_shingles", "one", "two").join(same, ["n_shingles", "one", "two"], "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    classes = pin(classes, "set-classes")
    reps = sketches.select("doc_id", "n_shingles", "bands").join(same.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    members = reps.select(F.col("doc_id").alias("id"), "n_shingles", F.explode("bands").alias("bucket"))
    crowded = pin(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = pin(members.join(broadcast_if_small(crowded), "bucket"), "bucket-members")
    popular = pin(members.groupBy("id").agg(F.sum(F.col("n") - 1).alias("popularity")), "popularity")
    members = pin(members.join(broadcast_if_small(popular), "id").select("bucket", "id", "n_shingles", "popularity"), "bucket-members")
    # only texts that share a bucket are read again for their full sets
    ids = broadcast_if_small(popular.select("id"))
    sets = pin(rows.join(ids, rows["doc_id"] == ids["id"], "left_semi").mapInArrow(_sets(size), "id bigint, shingles binary"), "shingle-sets")

    links, tried, grouped = None, None, members.withColumn("root", F.col("id")).withColumn("top", F.lit(None).cast("bigint"))
    for turn in range(STAR_ROUNDS):
        # from the second round on, the most popular member outside the largest component
        rank = F.struct(F.when(F.col("root") == F.col("top"), F.lit(-1)).otherwise(F.col("popularity")), -F.col("id"))
        centres = grouped.groupBy("bucket").agg(F.max_by(F.struct("id", "root"), rank).alias("c")).select(
            "bucket", F.col("c.id").alias("_centre"), F.col("c.root").alias("_centre_root"))
        starred = grouped.join(broadcast_if_small(pin(centres, "centres")), "bucket")
        pairs = starred.where(F.col("root") != F.col("_centre_root")).select(F.col("_centre").alias("a"), F.col("id").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = pin(pairs, "candidates")
        found = pin(confirm_links(pairs, sets, percent), "links")
        more = not found.isEmpty()
        links = found if links is None else links.unionByName(found)
        tried = pairs if tried is None else tried.unionByName(pairs)
        roots = smallest_reachable(links)
        # a centre has met all of its bucket and leaves it; a bucket is open while those left are in several components
        rest = starred.where(F.col("id") != F.col("_centre")).select("bucket", "id", "n_shingles", "popularity")
        rest = pin(rest.join(broadcast_if_small(roots), "id", "left").withColumn("root", F.coalesce("root", "id")), "bucket-rest")
        grouped = pin(rest.join(broadcast_if_small(pin(_open_buckets(rest), "open-buckets")), "bucket"), "open-members")
        if grouped.isEmpty():
            return classes, links
        if turn and not more:
            break
    return classes, links.unionByName(pin(finish_buckets(grouped, sets, percent), "links"))


def near_components(docs: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every distinct ``doc_id`` of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest ``doc_id`` that links lead to, and that document is kept. Texts without words are
    linked with nothing. Rows that share a ``doc_id`` must share their text; one of them counts. Rows without
    an id take no part.
    """
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    classes, links = near_links(texts, size, percent)
    roots = smallest_reachable(links)
    roots = broadcast_if_small(pin(roots.select(F.col("id").alias("rep"), "root"), "components"))
    done = classes.join(roots, "rep", "left").select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    return done.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies of a document with a smaller id; all columns kept.

    Rows without an id stay. Extra columns go along, whatever their names.
    """
    gone = f"{own_prefix(docs)}gone"
    copies = near_components(docs, size, percent).where(~F.col("kept")).select(F.col("doc_id").alias(gone))
    return docs.join(broadcast_if_small(pin(copies, "near-copies")), docs["doc_id"] == F.col(gone), "left_anti")
