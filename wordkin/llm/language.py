"""Language ID by fusing evidence in Bayes' rule.

``log P(l | row) = text + declared + suffix + host prior``, up to a constant. The text's part comes from byte
trigrams. What a declared language or an address suffix is worth, and what a host writes in, is counted over
all rows by the language that the text alone speaks for; a host's prior is smoothed towards its site's, and that
towards the whole corpus. One more language, ``und``, makes all trigrams equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import PIECE_BYTES, own_prefix, row_groups, ship_package, text_bytes
from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

#: labelled rows that the trigrams are counted on at most
TRAIN_ROWS = 4000
GRAM_BITS = 15
#: trigrams overlap and depend on each other; their sum counts a third
TEMPER = 1 / 3
#: weight of a parent's prior, in rows
SMOOTHING = 10.0
UNKNOWN = "und"
#: a row is rejected when no language but und, or none with this probability, is found
MIN_POSTERIOR = 0.5

_DIGITS = np.arange(256, dtype=np.uint8)
_DIGITS[65:91] += 32
_DIGITS[48:58] = 48


@dataclass
class LanguageModel:
    languages: list[str]  # the last is UNKNOWN
    logs: np.ndarray  # (languages, 1 << GRAM_BITS)


def _grams(data: np.ndarray) -> np.ndarray:
    b = _DIGITS[data].astype(np.uint32)
    return (((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)


def _text_scores(column: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods (rows, languages) and numbers of letters; a long text is summed up piece by piece."""
    data, at = text_bytes(column)
    n = len(at) - 1
    scores, letters = np.zeros((n, len(model.languages))), np.zeros(n, np.int64)
    piece = PIECE_BYTES
    for first, last in row_groups(at):
        for lo in range(int(at[first]), max(int(at[last]), int(at[first]) + 1), piece):
            hi = min(int(at[last]), lo + piece)
            part = data[lo:min(int(at[last]), hi + 2)]
            begins = np.clip(at[first:last] - lo, 0, hi - lo)
            ends = np.clip(at[first + 1:last + 1] - lo, 0, hi - lo)
            own = data[lo:hi]
            is_letter = ((own | 32) >= 97) & ((own | 32) <= 122) | (own >= 128)
            total = np.concatenate([[0], np.cumsum(is_letter)])
            letters[first:last] += total[ends] - total[begins]
            if len(part) < 3:
                continue
            grams = _grams(part)
            # trigrams that begin in this piece and end in their text
            stop = np.minimum(np.minimum(ends, at[first + 1:last + 1] - lo - 2), len(grams))
            stop = np.maximum(stop, np.minimum(begins, len(grams)))
            begin = np.minimum(begins, len(grams))
            for k in range(len(model.languages)):
                sums = np.concatenate([[0.0], np.cumsum(model.logs[k][grams])])
                scores[first:last, k] += sums[stop] - sums[begin]
    return scores, letters


def fit_language(docs: DataFrame, label: str = "lang", train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Trigram counts by ``label``, from up to ``train_rows`` rows of ``docs`` (``doc_id, text``) that have one.

    Only the counts, summed up by language and trigram, come to the driver: ``1 << GRAM_BITS`` rows per language at most,
    however many tasks read the sample.
    """
    ship_package(docs.sparkSession)
    chosen = (docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col(label).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_rows))
    ids = F.broadcast(chosen.select("doc_id").distinct())
    sample = docs.join(ids, "doc_id", "left_semi").where(F.col(label).isNotNull()).select(F.col(label).alias("label"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for i, name in enumerate(batch.column(0).to_pylist()):
                if at[i + 1] - at[i] >= 3:
                    counts[name] = counts.get(name, 0) + np.bincount(_grams(data[at[i]:at[i + 1]]), minlength=1 << GRAM_BITS)
        for name, found in counts.items():
            grams = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int32)),
                                              pa.array(found[grams].astype(np.int64))], ["label", "gram", "n"])

    found = sample.mapInArrow(run, "label string, gram int, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n")).toArrow()
    labels = found["label"].to_pylist()
    names = sorted(set(labels))
    place = {name: k for k, name in enumerate(names)}
    table = np.zeros((len(names), 1 << GRAM_BITS))
    table[np.array([place[x] for x in labels], np.int64), found["gram"].to_numpy()] = found["n"].to_numpy()
    counts = dict(zip(names, table, strict=True))
    rows = [np.log((counts[n] + 0.05) / (counts[n] + 0.05).sum()) for n in names]
    rows.append(np.full(1 << GRAM_BITS, -GRAM_BITS * np.log(2)))
    return LanguageModel([*names, UNKNOWN], np.stack(rows))


def site_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def identify_language(rows: DataFrame, model: LanguageModel, key: str = "doc_id", declared: str | None = None, host: str | None = None) -> DataFrame:
    """``key, lang, posterior, accepted`` of every row of ``rows`` (``key, text``, and the columns named).

    ``declared`` is a language tag such as a page's markup has, of which the primary part counts; ``host`` gives
    the address suffix and the host prior. A missing value is a value like any other. A text without letters is
    ``und`` and not accepted; of equally likely languages the first by name is taken. Null and empty texts have no letters, long ones are
    read whole. Repeated rows are judged alike and count each in the priors. Further columns are not read; an empty table has no rows.
    """
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = model.languages
    tag = F.lit(None).cast("string") if declared is None else F.lower(F.regexp_extract(F.col(declared), "^[A-Za-z]*", 0))
    place = F.lit(None).cast("string") if host is None else F.lower(F.col(host).cast("string"))
    plain = rows.select(F.col(key), F.coalesce(tag, F.lit("")).alias("tag"), F.coalesce(place, F.lit("")).alias("host"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, letters = _text_scores(batch.column(3), shared.value)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(scores) + 1, dtype=np.int32) * len(names)), pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(letters), lists], [key, "tag", "host", "letters", "text"])

    kind = rows.schema[key].dataType.simpleString()
    scored = pin(plain.mapInArrow(run, f"`{key}` {kind}, tag string, host string, letters bigint, text array<double>"), "language-scores")
    scored = scored.withColumn("suffix", F.when(F.col("host").contains("."), F.substring_index("host", ".", -1)).otherwise(F.lit("")))
    seen = scored.where("letters > 0").withColumn("first", F.array_position("text", F.array_max("text")).cast("int") - 1)

    def counts(*by: str) -> DataFrame:
        """Rows by first language; partial sums, so that a host with most rows is one row per task to shuffle."""
        return seen.groupBy(*by).agg(F.array(*[F.count(F.when(F.col("first") == k, 1)).cast("double") for k in range(len(names))]).alias("n"))

    whole = seen.agg(F.array(*[F.count(F.when(F.col("first") == k, 1)).cast("double") for k in range(len(names))]).alias("n")).first()["n"]
    base = [(n + 1.0) / (sum(whole) + len(names)) for n in whole]
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    smooth = lambda n, parent: F.zip_with(n, parent, lambda x, p: (x + SMOOTHING * p) / (total(n) + SMOOTHING))
    worth = lambda n: F.zip_with(n, F.array(*map(F.lit, whole)), lambda x, w: F.log((x + 1.0) / (w + SMOOTHING)))

    hosts = counts("host").withColumn("site", site_of(F.col("host")))
    sites = hosts.groupBy("site").agg(F.array(*[F.sum(F.col("n")[k]) for k in range(len(names))]).alias("m"))
    priors = hosts.join(sites, "site").select(
        "host", F.transform(smooth(F.col("n"), smooth(F.col("m"), F.array(*map(F.lit, base)))), lambda p: F.log(p)).alias("prior"))
    tables = [("host", priors, "prior"), ("tag", counts("tag").select("tag", worth(F.col("n")).alias("of_tag")), "of_tag"),
              ("suffix", counts("suffix").select("suffix", worth(F.col("n")).alias("of_suffix")), "of_suffix")]
    judged = scored
    for column, table, _ in tables:
        judged = judged.join(broadcast_if_small(pin(table, f"language-{column}")), column, "left")
    none = F.array(*[F.lit(0.0)] * len(names))
    add = lambda a, b: F.zip_with(a, F.coalesce(b, none), lambda x, y: x + y)
    fused = F.transform("text", lambda x: x * F.lit(TEMPER))
    for _, _, value in tables:
        fused = add(fused, F.col(value))
    judged = judged.withColumn("_fused", fused)
    best = F.array_max("_fused")
    odds = F.aggregate(F.transform("_fused", lambda x: F.exp(x - best)), F.lit(0.0), lambda s, x: s + x)
    found = F.element_at(F.array(*map(F.lit, names)), F.array_position("_fused", best).cast("int"))
    lang = F.when(F.col("letters") == 0, F.lit(UNKNOWN)).otherwise(found)
    judged = judged.select(F.col(key), lang.alias("lang"), F.when(F.col("letters") == 0, F.lit(1.0)).otherwise(1 / odds).alias("posterior"))
    return judged.withColumn("accepted", (F.col("lang") != UNKNOWN) & (F.col("posterior") >= MIN_POSTERIOR))


def identify_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, posterior, accepted`` of every row of ``docs`` (``doc_id, text, lang, source``).

    The trigrams are learned from rows whose ``lang`` is given, which is no evidence beyond that; a document's
    source stands for its host. An empty table gives an empty result.
    """
    return identify_language(docs, fit_language(docs), host="source")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with an accepted language, all columns kept.

    A ``doc_id`` goes when all its rows are rejected. Extra columns go along, whatever their names.
    """
    gone = f"{own_prefix(docs)}gone"
    judged = identify_documents(docs)
    out = judged.groupBy("doc_id").agg(F.max("accepted").alias("some")).where(~F.col("some")).select(F.col("doc_id").alias(gone))
    out = broadcast_if_small(pin(out, "language-rejected"))
    return docs.join(out, docs["doc_id"].eqNullSafe(F.col(gone)), "left_anti")


def page_text(html: Column) -> Column:
    """The text of a page, without scripts, styles, comments and tags. A script, style or comment that is never closed goes to the end.

    No part of a page is looked at once per tag, so the work goes with its length.
    """
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>", " ")
    return F.coalesce(bare, F.lit(""))


def identify_pages(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """``page_id, lang, posterior, accepted`` of every row of ``pages`` (``page_id, url, html``), with all evidence."""
    rows = pages.select("page_id", F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1).alias("declared"),
                        F.regexp_extract("url", r"://([^/?#:]*)", 1).alias("host"), page_text(F.col("html")).alias("text"))
    return identify_language(rows, model, key="page_id", declared="declared", host="host")
