"""Secret scans: fixed patterns, and formats that are learned from what the patterns find.

The patterns' finds are labelled credentials. Of each kind a probabilistic automaton is inferred (:mod:`wordkin.llm.automata`), and
one of ordinary tokens. Then every candidate, a run of 12 or more characters that keys are made of, is
scored: the logarithm of how much likelier the likeliest credential format makes it than ordinary text does. Those above a margin are
reported beside the patterns' finds, which are always kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.llm.automata import Automaton, infer
from wordkin.llm.kernels import row_groups, runs, ship_package, text_bytes
from wordkin.storage import pin

# fixed values: the patterns of the base kinds, in their order, and the least length of what counts
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
BASE_KINDS = ("assign", "access", "hex")
#: the kind of spans that a learned format finds
FORMAT = "format"

#: the formats are learned from the rows with the smallest hashes of their ids, at most so many
TRAIN_ROWS = 20_000
#: and from so many different strings of a kind at most, those with the smallest hashes, none longer than this
TRAIN_STRINGS, TRAIN_LENGTH = 5000, 256
#: characters that a candidate has at least
MIN_CANDIDATE = 12
#: a candidate is reported if a credential format makes it more likely than ordinary text by this factor, as a logarithm
MARGIN = 16.0

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
_FOUND = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """``start, kind, end, value`` of the patterns' finds, by start and, where several start, in the order of the kinds.

    A pattern's matches are taken from the left and don't overlap, also where one is too short to count.
    """
    found = [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return [(start, BASE_KINDS[kind], end, value) for start, kind, end, value in sorted(found)]


def candidates(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all candidates in the bytes of some rows, which begin at ``begins``."""
    starts, ends = runs(_TOKEN[data], begins)
    long = ends - starts >= MIN_CANDIDATE
    return starts[long], ends[long]


class Formats:
    """The learned automata: one of ordinary tokens and one of each kind of credential."""

    def __init__(self, credentials: dict[str, list[bytes]], ordinary: list[bytes]):
        self.kinds: dict[str, Automaton] = {kind: infer(strings, strict=True) for kind, strings in sorted(credentials.items()) if strings}
        self.ordinary = infer(ordinary)

    def score(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """By how much the likeliest credential format is likelier than ordinary text, as a logarithm."""
        if not self.kinds or not len(starts):
            return np.full(len(starts), -np.inf)
        best = np.max([format.score(data, starts, ends) for format in self.kinds.values()], axis=0)
        return best - self.ordinary.score(data, starts, ends)


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[str]]]:
    """Groups of rows: first and last row (exclusive), their bytes, where each begins, and their texts."""
    data, at = text_bytes(column)
    for first, last in row_groups(at):
        lo, hi = int(at[first]), int(at[last])
        yield first, last, data[lo:hi], at[first:last] - lo, [t or "" for t in column.slice(first, last - first).to_pylist()]


def _train_rows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """``kind, rank, value``: the strings of this task with the smallest hashes, of each kind."""
    held: dict[str, set[bytes]] = {}

    def keep(kind: str, values: set[bytes], size: int) -> None:
        mine = held.setdefault(kind, set())
        mine |= values
        if len(mine) > size:
            held[kind] = set(nsmallest(most, mine, key=_rank))

    for batch in batches:
        for first, last, data, begins, texts in _pieces(batch.column(0)):
            hidden = np.zeros(len(data) + 1, np.int64)
            for row, text in enumerate(texts):
                for start, kind, end, value in base_spans(text):
                    if len(value) <= TRAIN_LENGTH:
                        keep(kind, {value.encode()}, 2 * most)
                    from_byte = begins[row] + len(text[:start].encode())
                    hidden[from_byte] += 1
                    hidden[from_byte + len(text[start:end].encode())] -= 1
            covered = np.concatenate([[0], np.cumsum(hidden.cumsum() > 0)])
            starts, ends = candidates(data, begins)
            plain = (covered[ends] == covered[starts]) & (ends - starts <= TRAIN_LENGTH)
            whole = data.tobytes()
            keep("", {whole[a:b] for a, b in zip(starts[plain].tolist(), ends[plain].tolist(), strict=True)}, 4 * most)
    rows = [(kind, _rank(value)[0], value.decode()) for kind, values in held.items() for value in nsmallest(most, values, key=_rank)]
    types = {"kind": pa.string(), "rank": pa.int64(), "value": pa.string()}
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types.values())], list(types))


def _rank(value: bytes) -> tuple[int, bytes]:
    return xxhash.xxh64_intdigest(value) >> 1, value


def fit_formats(docs: DataFrame, train_rows: int = TRAIN_ROWS, train_strings: int = TRAIN_STRINGS) -> Formats:
    """The formats of the credentials in up to ``train_rows`` rows of ``docs`` (``doc_id, text``).

    Whole texts are read in tasks; each sends at most ``train_strings`` different strings of a kind, and as many of all
    tasks come to the driver, so copies of a document count once. The result is the same for any order of the rows. Rows without an id are not
    used. Without credentials there are no formats.
    """
    ship_package(docs.sparkSession)
    chosen = (docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
    emitted = pin(texts.mapInArrow(lambda batches: _train_rows(batches, train_strings), "kind string, rank bigint, value string"), "train-strings")
    least = [emitted.where(F.col("kind") == kind).distinct().orderBy("rank", "value").limit(train_strings) for kind in ("", *BASE_KINDS)]
    strings: dict[str, list[bytes]] = {}
    for row in reduce(DataFrame.unionByName, least).collect():
        strings.setdefault(row.kind, []).append(row.value.encode())
    return Formats({kind: strings.get(kind, []) for kind in BASE_KINDS}, strings.get("", []))


def find_secrets(docs: DataFrame, formats: Formats, margin: float = MARGIN) -> DataFrame:
    """``doc_id, found`` of every row of ``docs`` (``doc_id, text``); ``found``: ``kind, start, end, score`` of each secret.

    Places are code points, ``end`` exclusive, sorted by start and then kind: ``assign``, ``access``, ``hex`` for the patterns, whose ``score`` is
    null, and ``format`` for candidates above the margin that touch no find of a pattern. Null and empty texts have no finds. Texts are read
    whole, however long; repeated rows have the same finds. Extra columns are not read; an empty table has no rows.
    """
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(formats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[tuple]] = []
            for _, _, data, begins, texts in _pieces(batch.column(1)):
                starts, ends = candidates(data, begins)
                score = model.value.score(data, starts, ends)
                over = score > margin
                learned = _places(data, begins, starts[over], ends[over], score[over])
                for row, text in enumerate(texts):
                    base = [(start, end, kind, None) for start, kind, end, _ in base_spans(text)]
                    added = [x for x in learned.get(row, ()) if all(x[1] <= start or end <= x[0] for start, end, _, _ in base)]
                    found.append([{"kind": kind, "start": start, "end": end, "score": points}
                                  for start, end, kind, points in (sorted([*base, *added], key=lambda x: x[0]) if added else base)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _TYPE)], ["doc_id", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found {_FOUND}")


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _places(data: np.ndarray, begins: np.ndarray, starts: np.ndarray, ends: np.ndarray, score: np.ndarray) -> dict[int, list[tuple]]:
    """By row: start and end in code points, the kind and the score."""
    out: dict[int, list[tuple]] = {}
    if len(starts):
        rows = np.searchsorted(begins, starts, "right") - 1
        points = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
        for row, start, end, value in zip(rows.tolist(), starts, ends, score.tolist(), strict=True):
            zero = points[begins[row]]
            out.setdefault(row, []).append((int(points[start] - zero), int(points[end] - zero), FORMAT, value))
    return out


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("bigint")


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of all finds, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan_secrets(docs: DataFrame, train_rows: int = TRAIN_ROWS, margin: float = MARGIN) -> DataFrame:
    """:func:`find_secrets` with the formats of ``docs`` themselves."""
    return find_secrets(docs, fit_formats(docs, train_rows), margin)
