"""Exact dedup by an exchange of Golomb-coded fingerprints.

Chunks of rows send each owner of a range of fingerprints the sorted distinct fingerprints of that range,
Golomb-coded. The owner answers with a bitmap of those that another chunk sent as well. Only the texts of
such suspects, and of those seen twice in one chunk, are shuffled and compared byte by byte.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import own_prefix, ship_package
from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

#: rows whose fingerprints make up one packet
CHUNK_ROWS = 1 << 16
#: rows of a table for each owner, at most about
OWNER_ROWS = 1 << 20

_U = np.uint64


def golomb_encode(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as a Golomb-Rice code: the gaps' low bits, then their quotients in unary."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values, prepend=values[0])
    mean = float(values[-1] - values[0]) / n
    low = int(max(0.0, np.floor(np.log2(mean)))) if mean >= 1 else 0
    low = min(low, 62)
    rest = gaps & _U((1 << low) - 1)
    bits = np.empty((n, low), dtype=np.uint8)
    for i in range(low):
        bits[:, i] = (rest >> _U(i)) & _U(1)
    quotients = (gaps >> _U(low)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    return np.array([n, low], dtype="<i8").tobytes() + values[:1].tobytes() + np.packbits(bits.ravel()).tobytes() + np.packbits(unary).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, _U)
    n, low = (int(x) for x in np.frombuffer(blob[:16], "<i8"))
    size = (n * low + 7) // 8
    bits = np.unpackbits(np.frombuffer(blob[24:24 + size], np.uint8))[:n * low].reshape(n, low)
    rest = np.zeros(n, _U)
    for i in range(low):
        rest |= bits[:, i].astype(_U) << _U(i)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(blob[24 + size:], np.uint8)))[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    return np.frombuffer(blob[16:24], _U)[0] + np.cumsum((quotients.astype(_U) << _U(low)) | rest)


def _owner_of(prints: np.ndarray, owners: int) -> np.ndarray:
    """Owners hold equal ranges of the fingerprints."""
    return ((prints >> _U(32)) * _U(owners) >> _U(32)).astype(np.int64)


def _packets(owners: int):
    schema = pa.schema([("chunk", pa.string()), ("again", pa.binary()),
                        ("sent", pa.list_(pa.struct([("owner", pa.int32()), ("blob", pa.binary())])))])

    def packet(prints: np.ndarray) -> pa.RecordBatch:
        values, counts = np.unique(prints, return_counts=True)
        owner = _owner_of(values, owners)
        cuts = np.searchsorted(owner, np.arange(owners + 1))
        sent = [{"owner": o, "blob": golomb_encode(values[a:b])} for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.RecordBatch.from_pydict({"chunk": [uuid.uuid4().hex], "again": [golomb_encode(values[counts > 1])], "sent": [sent]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(_U))
            rows += len(held[-1])
            while rows >= CHUNK_ROWS:
                prints = np.concatenate(held)
                yield packet(prints[:CHUNK_ROWS])
                held, rows = [prints[CHUNK_ROWS:]], rows - CHUNK_ROWS
        if rows:
            yield packet(np.concatenate(held))

    return run


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: which of the fingerprints a chunk sent came from another chunk as well."""
    sent = [golomb_decode(blob) for blob in messages["blob"]]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    shared = values[counts > 1]
    bitmaps = []
    for prints in sent:
        at = np.minimum(np.searchsorted(shared, prints), max(len(shared) - 1, 0))
        hit = shared[at] == prints if len(shared) else np.zeros(len(prints), bool)
        bitmaps.append(np.packbits(hit).tobytes())
    return pd.DataFrame({"chunk": messages["chunk"], "owner": messages["owner"], "bitmap": bitmaps})


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("fp", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            found = [golomb_decode(row["again"])]
            blobs = {x["owner"]: x["blob"] for x in row["sent"]}
            for answer in row["answers"] or []:
                prints = golomb_decode(blobs[answer["owner"]])
                found.append(prints[np.unpackbits(np.frombuffer(answer["bitmap"], np.uint8))[:len(prints)].astype(bool)])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], schema=schema)


def suspect_fingerprints(prints: DataFrame, owners: int | None = None) -> DataFrame:
    """``fp`` of every 64-bit fingerprint that occurs in more than one row of ``prints`` (``fp``)."""
    spark = prints.sparkSession
    ship_package(spark)
    if owners is None:
        # what one owner gets at a time does not grow with the table
        owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-prints.count() // OWNER_ROWS))
    packets = pin(prints.select("fp").mapInArrow(
        _packets(owners), "chunk string, again binary, sent array<struct<owner int, blob binary>>"), "fingerprint-packets")
    # an owner gets an equal share of the hash range, and a fingerprint once per chunk at most
    messages = packets.select("chunk", F.explode("sent").alias("m")).select("chunk", "m.owner", "m.blob")
    answers = messages.groupBy("owner").applyInPandas(_answer, "chunk string, owner int, bitmap binary")
    # one bit per row of the chunk comes back
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("owner", "bitmap")).alias("answers"))
    return packets.join(answers, "chunk", "left").select("again", "sent", "answers").mapInArrow(_suspects, "fp bigint").distinct()


def equal_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, text_sha256, keep_id, group_size`` of every row of ``docs`` (``doc_id, text``).

    Null counts as empty. Of equal texts the largest ``doc_id`` is ``keep_id``, and ``group_size`` counts rows, so
    repeated rows count each; a null ``doc_id`` never is ``keep_id`` beside another.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("fp"))
    suspects = broadcast_if_small(pin(suspect_fingerprints(rows), "suspects"))
    # the texts themselves are the key: equal fingerprints of different texts end up apart
    classes = (rows.join(suspects, "fp", "left_semi").groupBy("fp", "text")
               .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
               .select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    classes = broadcast_if_small(pin(classes, "equal-texts"))
    own = docs.select("doc_id", F.xxhash64(text).alias("fp"), F.sha2(text, 256).alias("text_sha256"))
    return own.join(classes.withColumn("_found", F.lit(True)), ["fp", "text_sha256"], "left").select(
        "doc_id", "fp", "text_sha256", F.when(F.col("_found"), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"))


def mark_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Rows with the same ``doc_id`` and text are kept or dropped together. An empty table gives an empty result.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return equal_texts(docs).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose text a row with a larger ``doc_id`` has; all columns kept.

    The dropped ids come from ``equal_texts``. Repeated rows (one ``doc_id`` and text) stay once.
    """
    text, names, own = F.coalesce(F.col("text"), F.lit("")), docs.columns, own_prefix(docs)
    fp, was_null = f"{own}fp", f"{own}null"
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("fp"))
    suspects = broadcast_if_small(pin(suspect_fingerprints(rows), "suspects")).withColumnRenamed("fp", fp)
    marked = docs.withColumn(fp, F.xxhash64(text))
    others = [F.col(f"`{c}`") for c in names if c != "text"]
    # a struct of all columns but the text, which is the key
    best = marked.join(suspects, fp, "left_semi").groupBy(fp, text.alias("_text")).agg(
        F.max_by(F.struct(*others, F.col("text").isNull().alias(was_null)), F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("_row"))
    kept = best.select(*[F.when(~F.col("_row")[was_null], F.col("_text")).alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in names])
    return marked.join(suspects, fp, "left_anti").select(*[F.col(f"`{c}`") for c in names]).unionByName(kept)
