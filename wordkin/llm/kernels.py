"""Hashing of whole columns of texts with numpy, for use inside tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_U = np.uint64

#: texts are hashed in pieces of about so many bytes, which bounds the memory of a task
PIECE_BYTES = 1 << 18


#: rows that go to a Python worker at a time: whole texts may be long
ARROW_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Bound what goes to Python workers at a time, and let workers on this machine import this package."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, ARROW_ROWS)
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH") or os.environ.get("PYTHONPATH")) if x)


def own_prefix(df: DataFrame) -> str:
    """What the columns begin with that an operator adds to ``df`` for a while: no column of ``df`` does."""
    prefix = "_"
    while any(name.lower().startswith(prefix) for name in df.columns):
        prefix += "_"
    return prefix


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed) * _U(0xD1342543DE82EF95))


_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = seeded(256, 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 4096)
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        have = np.cumprod(have)
        if size <= 4 * PIECE_BYTES:
            _powers[key] = have
    return have[:n]


class SpanHasher:
    """64-bit hashes of any spans of one byte array; equal spans have equal hashes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sum = np.zeros(n + 1, dtype=_U)
        np.cumsum(_BYTE[data] * _power(_INVERSE, n), out=self._sum[1:])
        self._up = _power(_BASE, n + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sum[end] - self._sum[start]) * self._up[start]
        return mix64(raw ^ ((end - start).astype(_U) * _U(0x9E3779B97F4A7C15)))

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` bytes."""
        raw = (self._sum[width:] - self._sum[:-width]) * self._up[:len(self._sum) - width]
        return mix64(raw)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and where each row begins; null rows are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def row_groups(at: np.ndarray, piece: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``piece`` bytes together, or of one longer row."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + piece, "right")) - 1)
        last = min(last, n)
        yield first, last
        first = last


def runs(solid: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of marked bytes; ``begins``: where rows begin, which ends a run."""
    n = len(solid)
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[begins] = True
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | fresh[:n]))
    after = np.empty(n, dtype=bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | fresh[1:])) + 1
    return starts, ends


def _spans_of_words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run without ASCII white space."""
    return runs(~_SPACE[data], begins)


def _stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, strip: str) -> tuple[np.ndarray, np.ndarray]:
    """The spans without the ASCII characters ``strip`` at their ends; spans of nothing else stay as they are."""
    other = np.ones(256, dtype=bool)
    other[list(strip.encode())] = False
    kept = np.concatenate([[0], np.cumsum(other[data])])
    some = kept[ends] > kept[starts]
    at = np.flatnonzero(other[data])
    if len(at):
        begin = at[np.minimum(kept[starts], len(at) - 1)]
        end = at[np.maximum(kept[ends] - 1, 0)] + 1
        starts, ends = np.where(some, begin, starts), np.where(some, end, ends)
    return starts, ends


def words(column: pa.Array, piece: int = PIECE_BYTES, strip: str = "") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For groups of rows: first row, last row (exclusive), and for each word, in order, its row (from the first) and hash.

    Words are runs without ASCII white space, A-Z lower-cased. A long text is cut between words, so that
    its hashes are all of it that is held at once.
    """
    data, at = text_bytes(column)
    for first, last in row_groups(at, piece):
        lo, hi = int(at[first]), int(at[last])
        if hi - lo <= piece or last - first > 1:
            part = _LOWER[data[lo:hi]]
            if not len(part):
                yield first, last, np.empty(0, np.int64), np.empty(0, _U)
                continue
            starts, ends = _spans_of_words(part, at[first:last] - lo)
            if strip:
                starts, ends = _stripped(part, starts, ends, strip)
            rows = np.searchsorted(at[first:last + 1] - lo, starts, "right") - 1
            yield first, last, rows, SpanHasher(part).spans(starts, ends)
        else:
            hashes = []
            while lo < hi:
                stop = lo + piece
                while stop < hi and not _SPACE[data[stop]]:
                    room = data[stop:min(hi, stop + piece)]
                    gap = np.flatnonzero(_SPACE[room])
                    stop += int(gap[0]) if len(gap) else len(room)
                part = _LOWER[data[lo:min(stop, hi)]]
                starts, ends = _spans_of_words(part, np.zeros(1, np.int64))
                if strip:
                    starts, ends = _stripped(part, starts, ends, strip)
                hashes.append(SpanHasher(part).spans(starts, ends))
                lo = stop
            found = np.concatenate(hashes)
            yield first, last, np.zeros(len(found), np.int64), found
