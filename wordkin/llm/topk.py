"""Exact top-k by inner product with a pivot-distance index.

Vectors are lifted to one length, so that the largest inner products are the smallest distances. The index
keys a vector by its nearest pivot and its distance to it; the vectors of a pivot fall into rings of
about equal counts. A query at distance D from a pivot is at least ``max(D - hi, lo - D)`` away from
all vectors of the ring ``lo..hi``. Queries first read the rings nearest to them, and then those whose bound their
k-th best score doesn't exclude.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordkin.llm.kernels import ship_package
from wordkin.storage import pin

PIVOTS, RINGS = 16, 8
#: vectors that the pivots are chosen from: those with the smallest hashes of their ids
PIVOT_SAMPLE = 2000
#: vectors in a block of the index, and queries read against a block at a time
BLOCK, QUERIES = 2048, 256
#: relative room for rounding in the bounds
SLACK = 1e-9


def scaled(embedding: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down; null for vectors with null or non-finite components."""
    whole = F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(F.coalesce(good, F.lit(False)), whole)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    flat, offsets = np.asarray(column.flatten()), column.offsets.to_numpy() - column.offsets[0].as_py()
    out = np.zeros((len(column), dim), np.int64)
    sizes = np.diff(offsets)
    if len(flat) == len(column) * dim and (sizes == dim).all():
        return flat.reshape(len(column), dim).astype(np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1], sizes)] = flat
    return out


def _pivots(vectors: DataFrame, dim: int, pivots: int) -> np.ndarray:
    """Far-apart vectors of a bounded sample, each the farthest from those before it."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("v").toArrow().column("v").combine_chunks()
    sample = np.unique(_matrix(rows, dim), axis=0).astype(float)
    if not len(sample):
        return np.zeros((1, dim))
    picked = [0]
    away = np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(pivots, len(sample)):
        picked.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def _distances(x: np.ndarray, pivots: np.ndarray, lift: np.ndarray) -> np.ndarray:
    """Distances (rows, pivots); ``lift``: the squared extra component of each row, against 0 of the pivots."""
    squared = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T + lift[:, None]
    return np.sqrt(np.maximum(squared, 0))


def build_index(vectors: DataFrame, dim: int, pivots: np.ndarray, length2: float, rings: int) -> DataFrame:
    """Blocks of vectors: ``pivot, ring, lo, hi, ids, matrix``, ``lo`` and ``hi`` being the block's own distances.

    ``vectors`` has ``vec_id, v``. Sorted by pivot, distance and id, so that any number of equal vectors spreads over blocks.
    """
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim).astype(float)
            away = _distances(x, pivots, length2 - (x * x).sum(1))
            near = away.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(x)), near])],
                                             ["vec_id", "v", "pivot", "away"])

    keyed = pin(vectors.select("vec_id", "v").mapInArrow(key, "vec_id bigint, v array<bigint>, pivot int, away double"), "pivot-keys")
    # ring borders: a few numbers for each of the pivots
    borders = {r["pivot"]: r["q"] for r in keyed.groupBy("pivot").agg(
        F.percentile_approx("away", [i / rings for i in range(1, rings)], 1000).alias("q")).collect()}
    cuts = {p: np.asarray(q) for p, q in borders.items()}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def block(where, rows):
            ids, away, x = (np.concatenate(c) for c in zip(*rows, strict=True))
            return pa.RecordBatch.from_pydict({"pivot": pa.array([where[0]], pa.int32()), "ring": pa.array([where[1]], pa.int32()), "lo": [float(away.min())],
                                               "hi": [float(away.max())], "n": [len(ids)], "ids": [ids.tobytes()], "matrix": [x.tobytes()]})

        for batch in batches:
            ids, away = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            near, x = batch.column(2).to_numpy(), _matrix(batch.column(1), dim)
            ring = np.zeros(len(ids), np.int64)
            for p in np.unique(near):
                ring[near == p] = np.searchsorted(cuts[int(p)], away[near == p], "right")
            for where in sorted(set(zip(near.tolist(), ring.tolist(), strict=True))):
                mine = np.flatnonzero((near == where[0]) & (ring == where[1]))
                for at in range(0, len(mine), BLOCK):
                    some = mine[at:at + BLOCK]
                    rows = held.setdefault(where, [])
                    rows.append((ids[some], away[some], x[some]))
                    if sum(len(r[0]) for r in rows) >= BLOCK:
                        yield block(where, held.pop(where))
        for where, rows in held.items():
            yield block(where, rows)

    sorted_rows = keyed.repartitionByRange("pivot", "away", "vec_id").sortWithinPartitions("pivot", "away", "vec_id")
    return pin(sorted_rows.mapInArrow(pack, "pivot int, ring int, lo double, hi double, n bigint, ids binary, matrix binary"), "pivot-index")


def _product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; as floating point where no sum can leave its whole numbers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2 ** 53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q @ x.T


def _read_blocks(dim: int, k: int):
    """Each row is some queries and one block: the block's best for each of the queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = np.frombuffer(row["q_ids"], np.int64)
                q = np.frombuffer(row["q_matrix"], np.int64).reshape(-1, dim)
                ids, x = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["matrix"], np.int64).reshape(-1, dim)
                scores = _product(q, x)
                out_q, out_v, out_s = [], [], []
                for i, query in enumerate(wanted):
                    # one row of the query's own is left out; ties by id
                    other = np.flatnonzero(ids != query)
                    s = scores[i, other]
                    if len(s) > k:
                        least = np.partition(s, len(s) - k)[len(s) - k]
                        other, s = other[s >= least], s[s >= least]
                    best = np.lexsort((ids[other], -s))[:k]
                    out_q.append(np.full(len(best), query))
                    out_v.append(ids[other][best])
                    out_s.append(s[best])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (out_q, out_v, out_s)], ["query_id", "vec_id", "score"])

    return run


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best per query; each task keeps its own ``k`` before the shuffle."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, pivots: int = PIVOTS, rings: int = RINGS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query with all other rows.

    ``vectors`` has ``vec_id, embedding``; rows for which ``queries`` holds are queries, and all rows but those with the
    query's own id are candidates. Components are multiplied by ``scale`` and rounded down first. Vectors that
    are null, hold null or non-finite components or have a null id take no part; shorter ones are filled up with zeros.
    Ties go to the smaller id. A query whose bounds exclude nothing reads all blocks, in groups of queries
    and blocks.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    clean = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled(F.col("embedding"), scale).alias("v"), queries.alias("is_query"))
    clean = pin(clean.where(F.col("v").isNotNull()), "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    size = clean.agg(F.max(F.size("v")).alias("dim"), F.max(squares).alias("length2")).first()
    if size["dim"] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim, length2 = max(1, size["dim"]), float(size["length2"])
    points = _pivots(clean, dim, pivots)
    blocks = build_index(clean, dim, points, length2, rings)
    # at most PIVOTS * RINGS rings
    ring = blocks.groupBy("pivot", "ring").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).orderBy("pivot", "ring").collect()
    ring_of = np.array([[r["pivot"], r["ring"]] for r in ring])
    lo, hi, counts = (np.array([r[c] for r in ring], float) for c in ("lo", "hi", "n"))

    asked = clean.where("is_query").dropDuplicates(["vec_id"]).select("vec_id", "v")

    def plan(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, QUERIES):
                    part = batch.slice(at, QUERIES)
                    ids, q = part.column(0).to_numpy(), _matrix(part.column(1), dim)
                    x = q.astype(float)
                    to = _distances(x, points, np.zeros(len(x)))[:, ring_of[:, 0]]
                    # the queries' extra component is 0, as the pivots'
                    bound = np.maximum(0, np.maximum(to - hi, lo - to))
                    upper = ((x * x).sum(1)[:, None] + length2 - bound ** 2) / 2
                    order = np.argsort(bound, 1, kind="stable")
                    # the nearest rings, until they hold k others
                    before = np.cumsum(counts[order], 1) - counts[order]
                    start = np.zeros(bound.shape, bool)
                    np.put_along_axis(start, order, before < k + 1, 1)
                    if first:
                        needed = start
                    else:
                        least = part.column(2).to_numpy(zero_copy_only=False).astype(float)
                        least = np.where(np.isnan(least), -np.inf, least)
                        room = SLACK * (length2 + (x * x).sum(1))[:, None] + 1
                        needed = (upper + room >= least[:, None]) & ~start
                    for r in range(len(ring)):
                        mine = needed[:, r]
                        if mine.any():
                            yield pa.RecordBatch.from_pydict({"pivot": pa.array([ring_of[r, 0]], pa.int32()), "ring": pa.array([ring_of[r, 1]], pa.int32()),
                                                              "q_ids": [ids[mine].tobytes()], "q_matrix": [q[mine].tobytes()]})

        return run

    schema = "pivot int, ring int, q_ids binary, q_matrix binary"

    def read(plans: DataFrame) -> DataFrame:
        rows = plans.join(blocks.select("pivot", "ring", "ids", "matrix"), ["pivot", "ring"]).select("q_ids", "q_matrix", "ids", "matrix")
        return rows.mapInArrow(_read_blocks(dim, k), "query_id bigint, vec_id bigint, score bigint")

    near = pin(_best(read(asked.mapInArrow(plan(True), schema)), k).drop("rank"), "nearest-rings")
    least = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    rest = asked.join(least, asked["vec_id"] == least["query_id"], "left").select("vec_id", "v", "least")
    far = read(rest.mapInArrow(plan(False), schema))
    return _best(near.unionByName(far), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
