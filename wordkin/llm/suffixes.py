"""Exact substring dedup with a logarithmic family of sparse suffix arrays.

Only suffixes that begin at anchors are indexed. The anchor of a window of ``length`` bytes is the leftmost of the
``SEED``-byte substrings with the smallest hash in it, so that equal windows have their anchors at the same place and
two equal windows are found through two suffixes with an equal beginning. Consecutive windows with one anchor
form a run. A level of the family is an array of (suffix, run) entries, sorted by suffix, with counts. A new batch
gets an array of its own, which is merge-scanned against all levels; two levels of one size are
merged into one of the next.

Windows of a run that occurs twice as a whole are repeated. Of other runs whose suffix occurs elsewhere, the ends of
repeated passages, the windows are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import SpanHasher, mix64, row_groups, ship_package, text_bytes
from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

#: bytes of a window, and of the beginning of a suffix that is compared in the arrays
LENGTH, SEED = 200, 64
BATCHES = 4

_U = np.uint64


#: windows that are hashed at a time; their places take the low bits of a hash
PIECE_BITS = 18


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each stretch of ``width`` hashes, the place of its leftmost smallest one."""
    places = _U((1 << PIECE_BITS + 1) - 1)
    low, size = (hashes & ~places) | np.arange(len(hashes), dtype=_U), 1
    n = len(hashes) - width + 1
    # smallest of 1, 2, 4, ... places, and then of two overlapping stretches
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return (np.minimum(low[:n], low[width - size:width - size + n]) & places).astype(np.int64)


def text_runs(data: np.ndarray, at: np.ndarray, length: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of the texts in ``data``: text, first window, number of windows, suffix hash, run hash.

    The bytes are read in pieces, whatever the length of a text; a run that a piece cuts is two runs.
    """
    for lo in range(0, len(data) - length + 1, 1 << PIECE_BITS):
        part = data[lo:lo + (1 << PIECE_BITS) + length - 1]
        hasher = SpanHasher(part)
        seeds = hasher.windows(seed)
        anchor = _anchors(seeds, length - seed + 1)
        # windows that lie in one text
        inside = np.ones(len(anchor), bool)
        for border in at[np.searchsorted(at, lo, "right"):np.searchsorted(at, lo + len(part), "left")].tolist():
            inside[max(0, border - lo - length + 1):border - lo] = False
        new = np.empty(len(anchor), bool)
        new[0] = True
        np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
        new[1:] |= ~inside[:-1]
        begin = np.flatnonzero(new & inside)
        if not len(begin):
            continue
        stop = np.flatnonzero(inside & np.concatenate([new[1:] | ~inside[1:], [True]])) + 1
        where = anchor[begin]
        with np.errstate(over="ignore"):
            run = mix64(hasher.spans(begin, stop - 1 + length) ^ ((where - begin).astype(_U) * _U(0x9E3779B97F4A7C15)))
        row = np.searchsorted(at, begin + lo, "right") - 1
        yield row, begin + lo - at[row], stop - begin, seeds[where], run


def _emit_runs(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, first, size, suffix, whole in text_runs(*text_bytes(batch.column(1)), length, seed):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row]), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(suffix.view(np.int64)), pa.array(whole.view(np.int64))],
                    ["row", "first", "size", "suffix", "run"])

    return run


def text_key(*columns: Column) -> Column:
    """One number for a row's id and text; repeated rows share it, and all that is found out about it."""
    return F.xxhash64(*columns)


def find_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``row, first, size, suffix, run`` of every run in ``docs`` (``doc_id, text``)."""
    ship_package(docs.sparkSession)
    texts = docs.select(text_key("doc_id", "text").alias("row"), "text")
    return texts.mapInArrow(_emit_runs(length, seed), "row bigint, first int, size int, suffix bigint, run bigint")


class SuffixArrays:
    """The family: levels of written arrays ``suffix, run, n`` sorted by suffix, no two of them of one rank.

    ``add`` takes a new batch's runs, scans its array against all levels, and says which suffixes were met
    again. All of an array's rows of one suffix are one per different run, so that a passage with any number of copies
    is a single row.
    """

    def __init__(self):
        self.levels: dict[int, DataFrame] = {}
        self.met: list[DataFrame] = []

    @staticmethod
    def _array(rows: DataFrame) -> DataFrame:
        return pin(rows.groupBy("suffix", "run").agg(F.sum("n").alias("n")).sortWithinPartitions("suffix", "run"), "suffix-array")

    def add(self, runs: DataFrame) -> DataFrame:
        """``suffix`` of each suffix of the batch that occurs twice in it or in an older one."""
        array = self._array(runs.select("suffix", "run", F.lit(1).cast("bigint").alias("n")))
        within = array.groupBy("suffix").agg(F.sum("n").alias("n")).where("n > 1").select("suffix")
        across = [array.select("suffix").join(level.select("suffix"), "suffix", "left_semi") for level in self.levels.values()]
        met = pin(reduce(DataFrame.unionByName, [within, *across]).distinct(), "met-suffixes")
        self.met.append(met)
        rank = 0
        while rank in self.levels:
            array = self._array(array.unionByName(self.levels.pop(rank)))
            rank += 1
        self.levels[rank] = array
        return met

    def repeated(self) -> DataFrame:
        """``run, suffix, n, m``: the different runs of all suffixes that were met again, with their numbers of
        occurrences, and of different runs of the suffix."""
        every = reduce(DataFrame.unionByName, self.levels.values()).groupBy("suffix", "run").agg(F.sum("n").alias("n"))
        met = reduce(DataFrame.unionByName, self.met).distinct()
        found = pin(every.join(pin(met, "all-met-suffixes"), "suffix"), "repeated-runs")
        variants = pin(found.groupBy("suffix").agg(F.count("*").alias("m")), "run-variants")
        return found.join(variants, "suffix").select("run", "suffix", "n", "m")


#: different runs of one suffix whose windows a task compares; the windows of others are compared by a shuffle
VARIANTS = 512
#: runs whose windows are compared at a time
CHUNK_RUNS = 2_000


def _window_hashes(texts: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Run and hash of each window of runs given as their bytes."""
    hashes = SpanHasher(texts).windows(length)
    begin = np.arange(len(hashes))
    run = np.searchsorted(at, begin, "right") - 1
    whole = begin + length <= at[run + 1]
    return run[whole], hashes[whole]


def _slice_edges(length: int):
    """Of each text, the bytes of the runs listed with it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            out = {k: [] for k in ("row", "first", "suffix", "m", "bytes")}
            for i, (key, edges) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for e in edges:
                    lo = int(at[i]) + e["first"]
                    out["row"].append(key)
                    out["first"].append(e["first"])
                    out["suffix"].append(e["suffix"])
                    out["m"].append(e["m"])
                    out["bytes"].append(data[lo:lo + e["size"] + length - 1].tobytes())
            yield pa.RecordBatch.from_pydict(out, pa.schema([("row", pa.int64()), ("first", pa.int32()), ("suffix", pa.int64()), ("m", pa.int64()), ("bytes", pa.binary())]))

    return run


def _compare(length: int):
    """Rows sorted by suffix: stretches of windows that occur in another run of the suffix as well."""
    def chunk(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        suffix = table.column("suffix").to_numpy().view(_U)
        data, at = text_bytes(table.column("bytes"))
        run, hashes = _window_hashes(data, at, length)
        # windows with one anchor and different places of it are different, so the hash need not know the place
        with np.errstate(over="ignore"):
            keyed = mix64(hashes ^ (suffix[run] * _U(0x9E3779B97F4A7C15)))
        _, number, counts = np.unique(keyed, return_inverse=True, return_counts=True)
        window = np.arange(len(run)) - np.searchsorted(run, run)
        again = counts[number] > 1
        run, window = run[again], window[again]
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (window[1:] != window[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(run)]])[:len(begin)] - 1
        first = table.column("first").to_numpy()[run[begin]] + window[begin] if len(begin) else np.empty(0, np.int64)
        size = window[end] - window[begin] + 1
        rows = table.column("row").to_numpy()[run[begin]] if len(begin) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int64)), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))], ["row", "first", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            suffix = batch.column("suffix").to_numpy()
            # chunks end where a suffix ends
            borders = np.flatnonzero(suffix[1:] != suffix[:-1]) + 1
            if held and len(suffix) and held[-1].column("suffix")[-1].as_py() != suffix[0] and sum(b.num_rows for b in held) >= CHUNK_RUNS:
                yield chunk(held)
                held = []
            while batch.num_rows - at > CHUNK_RUNS:
                later = borders[borders >= at + CHUNK_RUNS]
                if not len(later):
                    break
                stop = int(later[0])
                yield chunk([*held, batch.slice(at, stop - at)])
                held, at = [], stop
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield chunk(held)

    return run


#: neighbouring windows of a hot suffix that have a core, the bytes they all contain
BLOCK = 8


def _windows_by_core(texts: np.ndarray, at: np.ndarray, suffix: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of each window of runs given as their bytes and suffix: run, hash, core's place, core's hash.

    Blocks of windows are counted from the anchor, the first place of the suffix in a run, so that equal windows have equal cores.
    """
    hasher, block = SpanHasher(texts), min(BLOCK, length)
    seeds = hasher.windows(seed)
    place = np.arange(len(seeds))
    run = np.searchsorted(at, place, "right") - 1
    found = np.flatnonzero((seeds == suffix[run]) & (place + seed <= at[run + 1]))
    anchor = found[np.unique(run[found], return_index=True)[1]]
    hashes = hasher.windows(length)
    window = np.arange(len(hashes))
    run = np.searchsorted(at, window, "right") - 1
    whole = window + length <= at[run + 1]
    run, window = run[whole], window[whole]
    core = anchor[run] - (anchor[run] - window) // block * block
    return run, hashes[whole], core, hasher.spans(core, core + length - block + 1)


def _tally(suffix: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """``suffix, h, n``: the different hashes of each suffix, and how often they are there."""
    order = np.lexsort((hashes, suffix))
    suffix, hashes = suffix[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (suffix[1:] != suffix[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    counts = np.diff(np.concatenate([begin, [len(hashes)]]))
    return pa.RecordBatch.from_arrays([pa.array(suffix[begin]), pa.array(hashes[begin].view(np.int64)), pa.array(counts)], ["suffix", "h", "n"])


def _count_cores(length: int, seed: int):
    """The different cores of each suffix, with the numbers of blocks that have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            suffix = batch.column("suffix").to_numpy()
            run, _, core, hashes = _windows_by_core(*text_bytes(batch.column("bytes")), suffix.view(_U), length, seed)
            new = np.ones(len(run), bool)
            new[1:] = (run[1:] != run[:-1]) | (core[1:] != core[:-1])
            yield _tally(suffix[run[new]], hashes[new])

    return run


def _count_windows(length: int, seed: int):
    """The different windows of each suffix whose core is in the list beside it, with the numbers of runs that have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            suffix, lists = batch.column("suffix").to_numpy(), batch.column("again")
            run, hashes, _, cores = _windows_by_core(*text_bytes(batch.column("bytes")), suffix.view(_U), length, seed)
            kept = np.zeros(len(run), bool)
            edges = np.searchsorted(run, np.arange(batch.num_rows + 1)).tolist()
            for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                kept[lo:hi] = np.isin(cores[lo:hi], lists[i].values.to_numpy().view(_U))
            yield _tally(suffix[run[kept]], hashes[kept])

    return run


def _mark_windows(length: int):
    """Stretches of a run's windows that are in the list beside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, lists = [[], [], []], batch.column("again")
            for i, (row, first, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "first", "bytes")), strict=True)):
                hashes = SpanHasher(np.frombuffer(text, np.uint8)).windows(length).view(np.int64)
                hit = np.concatenate([[False], np.isin(hashes, lists[i].values.to_numpy()), [False]])
                edges = np.flatnonzero(hit[1:] != hit[:-1])
                for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    for column, value in zip(out, (row, first + begin, end - begin), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["row", "first", "size"])

    return run


#: repeated hashes in one row of a hot suffix's list, about
LISTED = 4096


def _repeated_lists(counts: DataFrame, label: str) -> DataFrame:
    """``suffix, again``: of ``counts`` (``suffix, h, n``) the hashes that are there twice, in rows of bounded size."""
    again = pin(counts.groupBy("suffix", "h").agg(F.sum("n").alias("n")).where("n > 1").select("suffix", "h"), label)
    parts = again.groupBy("suffix").agg(F.ceil(F.count("*") / LISTED).alias("parts"))
    lists = again.join(parts, "suffix").groupBy("suffix", F.pmod(F.xxhash64("h"), "parts").alias("part")).agg(F.collect_list("h").alias("again"))
    return pin(lists.select("suffix", "again"), f"{label}-lists")


def compare_windows(edges: DataFrame, length: int, seed: int, variants: int = VARIANTS) -> DataFrame:
    """``row, first, size``: stretches of windows of ``edges`` (``row, first, suffix, m, bytes``) that another one has too."""
    schema, counted = "row bigint, first int, size int", "suffix bigint, h bigint, n bigint"
    few = edges.where(F.col("m") <= variants).select("row", "first", "suffix", "bytes")
    found = few.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(_compare(length), schema)
    # a suffix with very many different runs: its windows are counted wherever they are, and the list of the
    # repeated ones goes to its runs. A window is repeated only if its core is, so cores, a row per block of windows, come
    # first, and only windows with a repeated core are counted
    many = edges.where(F.col("m") > variants).select("row", "first", "suffix", "bytes")
    cores = _repeated_lists(many.mapInArrow(_count_cores(length, seed), counted), "hot-cores")
    windows = many.join(cores, "suffix").select("suffix", "bytes", "again").mapInArrow(_count_windows(length, seed), counted)
    marked = many.join(_repeated_lists(windows, "hot-windows"), "suffix").select("row", "first", "bytes", "again").mapInArrow(_mark_windows(length), schema)
    return found.unionByName(marked)


def _merge_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for runs in batch.column(1):
                flat = runs.values
                begin, size = flat.field("first").to_numpy().astype(np.int64), flat.field("size").to_numpy()
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], (begin + size + length - 1)[order]
                reach = np.maximum.accumulate(end)
                new = np.concatenate([[True], begin[1:] > reach[:-1]])
                at = np.flatnonzero(new)
                last = np.concatenate([at[1:], [len(begin)]]) - 1
                spans.append([{"begin": b, "end": e} for b, e in zip(begin[at].tolist(), reach[last].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))], ["row", "spans"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, batches: int = BATCHES, variants: int = VARIANTS) -> DataFrame:
    """``row, spans``: of each ``text_key`` with any, the maximal spans of bytes covered by windows that occur elsewhere too."""
    runs = pin(find_runs(docs, length, seed), "runs")
    family = SuffixArrays()
    for batch in range(batches):
        family.add(runs if batches == 1 else runs.where(F.pmod("row", F.lit(batches)) == batch))
    # both grow with the corpus: plain joins, which skew handling may split
    repeated = pin(family.repeated(), "repeated-runs-of-all")
    found = pin(runs.select("row", "first", "size", "run").join(repeated, "run"), "found-runs")
    whole = found.where("n > 1")
    # one place of each repeated run stands for all in the comparison with the ends of passages
    stand = whole.where("m > 1").groupBy("run").agg(F.min(F.struct("row", "first", "size", "suffix", "m")).alias("r")).select("r.*")
    edges = found.where("n = 1 and m > 1").select("row", "first", "size", "suffix", "m").unionByName(stand)
    edges = pin(edges.groupBy("row").agg(F.collect_list(F.struct("first", "size", "suffix", "m")).alias("edges")).withColumnRenamed("row", "_row"), "edges")
    texts = docs.select(text_key("doc_id", "text").alias("row"), "text").join(broadcast_if_small(edges), F.col("row") == F.col("_row"))
    sliced = texts.select("row", "text", "edges").mapInArrow(_slice_edges(length), "row bigint, first int, suffix bigint, m bigint, bytes binary")
    ends = compare_windows(pin(sliced, "edge-bytes"), length, seed, variants)
    every = whole.select("row", "first", "size").unionByName(ends)
    return every.groupBy("row").agg(F.collect_list(F.struct("first", "size")).alias("runs")).mapInArrow(
        _merge_spans(length), "row bigint, spans array<struct<begin:bigint,end:bigint>>")


def drop_repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, batches: int = BATCHES, variants: int = VARIANTS) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row of ``docs`` (``doc_id, text``): spans of bytes that go, and the bytes that stay.

    A byte goes if it is in a string of ``length`` bytes that also starts anywhere else in the UTF-8 bytes of
    ``docs``, the same text included; matches do not reach from one text into another. Null counts as empty.
    A repeated row is another occurrence. An empty table gives an empty result. The strings are compared
    by 64-bit hashes.
    """
    spans = pin(repeated_spans(docs, length, seed, batches, variants).withColumnRenamed("row", "_row"), "repeated-spans")
    rows = docs.select("doc_id", text_key("doc_id", "text").alias("row"), "text").join(broadcast_if_small(spans), F.col("row") == F.col("_row"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            kept = []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                text, place, parts = data[at[i]:at[i + 1]], 0, []
                for span in spans or ():
                    parts.append(text[place:span["begin"]])
                    place = span["end"]
                kept.append(np.concatenate([*parts, text[place:]]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), batch.column(2), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "spans").mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
