"""Streams of work messages: request de-duplication and file completeness.

State that has to end by itself is kept by ``transformWithState``: each key has values of its own and a timer that removes them.
Rows are combined within their input batches first, so that a key with a large share of all rows brings few to its state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wordkin.storage import pin
from wordkin.streaming import commits

# the processors go to workers whole: those need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: fragments of one bitmap
BITMAP_BITS = 32768
#: how long a file is remembered after its last fragment came, or after it was complete
KEEP_MS = 7 * 24 * 3600 * 1000


# ---- requests -------------------------------------------------------------------------------

def unique_requests_stream(requests: DataFrame) -> DataFrame:
    """Drop requests seen before: ``client_key, file_key``. A request is remembered for ever, so the state grows with their number."""
    keys = ["client_key", "file_key"]
    return requests.select(*keys).dropDuplicates(keys)


class _LateRows(StatefulProcessor):
    """Passes on the requests of spans that the watermark has passed. Keeps no state; its keys only spread the rows."""

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            late = part[part["span_end"] <= timerValues.getCurrentWatermarkInMs()]
            if len(late):
                counted = late.groupby(["client_key", "file_key", "span_end"], as_index=False).size().rename(columns={"size": "n"})
                yield counted.assign(late=True)[["client_key", "file_key", "span_end", "late", "n"]]

    def close(self) -> None:
        pass


#: tasks that look for late requests
LATE_PARTS = 64


def requests_once_per_span(requests: DataFrame, arrival: str, span_seconds: int, delay: str) -> DataFrame:
    """Each request once in each span of time: ``client_key, file_key, span_end, late, n``.

    Time is cut into spans of ``span_seconds`` from the epoch on. The first request of a client for a file in a span gives a row with
    ``late`` false and ``n`` 1; further ones are dropped. A span is over when a request of a span that ends ``delay`` later was seen in an earlier batch. Then
    the state of its requests is removed, and requests that still come for it are told apart as ``late``, ``n`` of them in each
    row: whether they repeat one is no longer known. Rows without a key or arrival are left out.

    Both parts of the result see one watermark, that of the batch, so every row of a known span goes to the one or the other.
    """
    span_ms = span_seconds * 1000
    end = F.timestamp_millis((F.floor(F.unix_millis(F.col(arrival).cast("timestamp")) / span_ms) + 1) * span_ms)
    keys = ["client_key", "file_key"]
    rows = requests.select(*keys, end.alias("span_end")).dropna().withWatermark("span_end", delay)
    millis = F.unix_millis("span_end").alias("span_end")
    once = rows.dropDuplicates([*keys, "span_end"]).select(*keys, millis, F.lit(False).alias("late"), F.lit(1).cast("bigint").alias("n"))
    client, file = (requests.schema[name].dataType.simpleString() for name in keys)
    # without the watermark column, so that late rows are not dropped ahead
    late = (rows.select(*keys, millis, F.pmod(F.xxhash64(*keys, "span_end"), F.lit(LATE_PARTS)).alias("part")).groupBy("part")
            .transformWithStateInPandas(_LateRows(), f"client_key {client}, file_key {file}, span_end bigint, late boolean, n bigint", "Append", "EventTime"))
    return once.unionByName(late)


@contextmanager
def _rocks_db(spark: SparkSession) -> Iterator[None]:
    """Streams that are started meanwhile keep their state in RocksDB, which ``transformWithState`` needs, whatever the session has set."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stream_requests(requests: DataFrame, out_dir: str, checkpoint: str, arrival: str, span_seconds: int, delay: str,
                    **trigger) -> StreamingQuery:
    """Follow a stream of requests; ``commits.read_published`` reads its tables ``requests`` and, the late ones, ``late``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not commits.is_published(batch.sparkSession, out_dir, batch_id):
            commits.publish(out_dir, batch_id, _in_two(batch, "late", "requests", "late"))

    once = requests_once_per_span(requests, arrival, span_seconds, delay)
    writer = once.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint)
    with _rocks_db(requests.sparkSession):
        return (writer.trigger(**trigger) if trigger else writer).start()


def _in_two(batch: DataFrame, flag: str, without: str, having: str) -> dict[str, DataFrame]:
    """The rows of a batch by a flag. Pinned first: reading a batch twice would run its state twice."""
    rows = pin(batch, "batch")
    return {without: rows.where(~F.col(flag)).drop(flag), having: rows.where(F.col(flag)).drop(flag)}


# ---- fragments ------------------------------------------------------------------------------

def _bitmaps(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fragments of one input batch as bitmaps; rows that say nothing about a file's completeness go on by themselves."""
    for part in parts:
        number, expected = part["fragment_no"], part["expected"]
        good = part["file_key"].notna() & number.notna() & expected.notna() & (number >= 1) & (number <= expected)
        aside = part[~good]
        if len(aside):
            yield pd.DataFrame({"file_key": aside["file_key"], "bucket": -1, "bits": b"", "fragment_no": aside["fragment_no"].astype("Int64"),
                                "expected": aside["expected"].astype("Int64"), "at": aside["at"]})
        kept = part[good]
        at = kept["fragment_no"].to_numpy().astype(np.int64) - 1
        for (file, bucket), rows in kept.assign(bucket=at // BITMAP_BITS, bit=at % BITMAP_BITS).groupby(["file_key", "bucket"], sort=False):
            yield pd.DataFrame({"file_key": [file], "bucket": [bucket], "bits": [_packed(rows["bit"].to_numpy())],
                                "fragment_no": pd.array([None], "Int64"), "expected": pd.array([rows["expected"].max()], "Int64"),
                                "at": [rows["at"].max()]})


def _packed(places: np.ndarray) -> bytes:
    bits = np.zeros(int(places.max()) + 1, np.uint8)
    bits[places] = 1
    return np.packbits(bits).tobytes()


def _joined(one: bytes, two: bytes) -> bytes:
    short, long = sorted((one, two), key=len)
    bits = np.frombuffer(long, np.uint8).copy()
    bits[:len(short)] |= np.frombuffer(short, np.uint8)
    return bits.tobytes()


def _ones(bits: bytes) -> int:
    return int.from_bytes(bits, "big").bit_count()


class _FileProgress(StatefulProcessor):
    """State per file: a map of bitmaps of the fragments that have come, their number, and whether the file was reported."""

    def __init__(self, keep_ms: int):
        self._keep_ms = keep_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._bits = handle.getMapState("bits", "bucket bigint", "bits binary")
        self._file = handle.getValueState("file", "expected bigint, arrived bigint, done boolean, expires bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        expected, arrived, done, expires = self._file.get() if self._file.exists() else (0, 0, False, 0)
        seen, now = False, timerValues.getCurrentWatermarkInMs()
        for part in rows:
            aside = part[part["bucket"] < 0]
            if len(aside):
                yield _report(key[0], aside["expected"], aside["fragment_no"], "no fragment")
            for row in part[part["bucket"] >= 0].itertuples():
                seen, now = True, max(now, int(row.at))
                if done:
                    continue
                bucket = (int(row.bucket),)
                old = self._bits.getValue(bucket)[0] if self._bits.containsKey(bucket) else b""
                new = _joined(old, row.bits)
                arrived += _ones(new) - _ones(old)
                expected = max(expected, int(row.expected))
                self._bits.updateValue(bucket, (new,))
        if not seen:
            return
        if not done and arrived == expected:
            # the bitmaps are full; what is left says so until the timer ends
            done = True
            self._bits.clear()
            yield _report(key[0], [expected], [None], "complete")
        # a timer per file, moved on only when half of its time is over
        if expires < now + self._keep_ms // 2:
            if expires:
                self._handle.deleteTimer(expires)
            expires = now + self._keep_ms
            self._handle.registerTimer(expires)
        self._file.update((expected, arrived, done, expires))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expected, _, done, _ = self._file.get()
        self._bits.clear()
        self._file.clear()
        if not done:
            yield _report(key[0], [expected], [None], "given up")

    def close(self) -> None:
        pass


def _report(file, expected, number, what: str) -> pd.DataFrame:
    return pd.DataFrame({"file_key": file, "fragments": pd.array(expected, "Int64"), "fragment_no": pd.array(number, "Int64"), "report": what})


def file_reports(fragments: DataFrame, arrival: str | None = None, keep_ms: int = KEEP_MS) -> DataFrame:
    """What a stream of ``file_key, fragment_no`` (from 1), ``expected`` says of its files: ``file_key, fragments, fragment_no, report``.

    ``complete``, once, when the last gap of a file closes. ``given up`` when no fragment of an unfinished file came for ``keep_ms``. ``no fragment`` for each
    row without a key, a number or an expected number, or with a number outside 1 to the expected one; such rows change nothing.

    A file's fragments are kept as bitmaps of 32768 each. A fragment that comes again changes no bit; one that comes after the file was
    complete finds that noted, for ``keep_ms``. Whatever state a file has is removed by its timer, also that of a fragment that comes later still.
    Time is the ``arrival`` column, or without it the time of the batch; it moves on as rows arrive. Of differing expected numbers the
    largest counts.
    """
    arrived = F.current_timestamp() if arrival is None else F.coalesce(F.col(arrival).cast("timestamp"), F.current_timestamp())
    # the watermark column goes no further: no fragment is too late to count
    rows = fragments.withColumn("_arrived", arrived).withWatermark("_arrived", "0 seconds").select(
        "file_key", F.col("fragment_no").cast("bigint"), F.col("expected").cast("bigint"), F.unix_millis("_arrived").alias("at"))
    kind = fragments.schema["file_key"].dataType.simpleString()
    bitmaps = rows.mapInPandas(_bitmaps, f"file_key {kind}, bucket bigint, bits binary, fragment_no bigint, expected bigint, at bigint")
    return bitmaps.groupBy("file_key").transformWithStateInPandas(
        _FileProgress(keep_ms), f"file_key {kind}, fragments bigint, fragment_no bigint, report string", "Append", "EventTime")


def stream_files(fragments: DataFrame, out_dir: str, checkpoint: str, arrival: str | None = None, keep_ms: int = KEEP_MS,
                 **trigger) -> StreamingQuery:
    """Follow a stream of fragments; ``commits.read_published`` reads its tables ``files`` (``file_key, fragments``: complete ones, with
    the batch in which the last gap closed) and ``aside`` (all other reports)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not commits.is_published(batch.sparkSession, out_dir, batch_id):
            tables = _in_two(batch.withColumn("_aside", F.col("report") != "complete"), "_aside", "files", "aside")
            commits.publish(out_dir, batch_id, {**tables, "files": tables["files"].select("file_key", "fragments")})

    writer = file_reports(fragments, arrival, keep_ms).writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint)
    with _rocks_db(fragments.sparkSession):
        return (writer.trigger(**trigger) if trigger else writer).start()
