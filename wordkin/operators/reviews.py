"""Reviews: sentiment, entities, processed records and how they are put back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.functions import reviews as rules
from wordkin.functions import text as tx
from wordkin.operators.skew import BROADCAST_BYTES, fits_broadcast, hot_limit, join_totals
from wordkin.storage import pin


def explode_reviews(products: DataFrame, *keep: str) -> DataFrame:
    """One row per review with its position in the product, from 0; columns ``keep`` go along."""
    return (products.select(*keep, F.posexplode("reviews").alias("pos", "review"))
            .select(*keep, "pos", "review.*"))


def _dictionary(lexicon: DataFrame | None, gazetteer: DataFrame | None) -> DataFrame:
    """Both word lists as ``kind, word, polarity``; a gazetteer word counts once."""
    parts = []
    if lexicon is not None:
        parts.append(lexicon.select(F.lit("opinion").alias("kind"), "word", F.col("polarity").cast("bigint")))
    if gazetteer is not None:
        names = gazetteer.where(F.col("type").isin(rules.ENTITY_TYPES)).select("word").distinct()
        parts.append(names.select(F.lit("name").alias("kind"), "word", F.lit(0).cast("bigint").alias("polarity")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def annotate_reviews(reviews: DataFrame, keys: Sequence[str], lexicon: DataFrame | None = None,
                     gazetteer: DataFrame | None = None, carry: Sequence[str] = (),
                     max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per review: ``keys``, the ``carry`` columns, ``sentiment`` (with a lexicon) and ``entities``
    (with a gazetteer).

    One scan and one shuffle, while the dictionary can be broadcast. A review becomes an anchor row, which carries its columns, and a row per
    word; words outside the dictionary are gone before the shuffle, and a review's rows lie together,
    so the partial aggregation leaves about one row per review to send. The dictionary is broadcast up
    to ``max_bytes``; beyond, the words are shuffled to it, with skew splitting for frequent ones, and the reviews are read a second
    time for their own rows, which stay out of that join.
    """
    kept = F.struct(*[F.col(name) for name in carry], F.lit(True).alias("_present"))
    reviews = reviews.withColumn("_sentence", tx.longest_sentence(F.col("text")))

    def event(kind: str, at: Column, word: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), word.alias("word"))

    lists = [F.array(event("review", F.lit(-1), F.lit(None).cast("string")))]
    no_words = F.array().cast("array<string>")
    if lexicon is not None:
        lists.append(F.transform(F.coalesce(tx.opinion_words(F.col("_sentence")), no_words),
                                 lambda word, i: event("opinion", i, word)))
    if gazetteer is not None:
        lists.append(F.transform(F.coalesce(tx.name_words(F.col("text")), no_words),
                                 lambda word, i: event("name", i, word)))
    exploded = reviews.select(*keys, *carry, F.col("_sentence").isNotNull().alias("_has_sentence"),
                              F.explode(F.concat(*lists)).alias("event"))
    is_anchor = F.col("event.kind") == "review"
    dictionary = _dictionary(lexicon, gazetteer)
    rows = exploded.select(*keys, "event.*", F.when(is_anchor, kept).alias("_kept"), "_has_sentence")
    if fits_broadcast(dictionary, max_bytes):
        hits = (rows.join(F.broadcast(dictionary), ["kind", "word"], "left")
                .where((F.col("kind") == "review") | F.col("polarity").isNotNull()))
    else:
        # anchors have no word and would all meet in one task of a shuffled join
        anchors = reviews.select(*keys, F.lit("review").alias("kind"), F.lit(None).cast("string").alias("word"), F.lit(-1).alias("at"),
                                 kept.alias("_kept"), F.col("_sentence").isNotNull().alias("_has_sentence"),
                                 F.lit(None).cast("bigint").alias("polarity"))
        words = rows.where("word is not null").join(dictionary, ["kind", "word"])
        hits = words.select(*anchors.columns).unionByName(anchors)

    figures = [F.first("_kept", ignorenulls=True).alias("_kept")]
    if lexicon is not None:
        figures += [F.sum(F.when(F.col("kind") == "opinion", F.col("polarity"))).alias("_polarity"),
                    F.max("_has_sentence").alias("_has_sentence")]
    if gazetteer is not None:
        figures.append(F.collect_list(F.when(F.col("kind") == "name", F.struct("at", "word"))).alias("_names"))
    columns = [*keys, *[F.col(f"_kept.{name}").alias(name) for name in carry]]
    if lexicon is not None:
        polarity = F.coalesce(F.col("_polarity"), F.lit(0))
        clamped = F.greatest(F.lit(-2), F.least(F.lit(2), polarity)) + 2
        columns.append(F.when(F.col("_has_sentence"), clamped).otherwise(F.lit(0)).cast("int").alias("sentiment"))
    if gazetteer is not None:
        columns.append(F.transform(F.array_sort("_names"), lambda hit: hit["word"]).alias("entities"))
    return hits.groupBy(*keys).agg(*figures).select(*columns)


def process_reviews(reviews: DataFrame, keys: Sequence[str], lexicon: DataFrame, gazetteer: DataFrame,
                    max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``keys, link, color, entities, is_sarcastic`` of each review. ``keys`` identify a review."""
    found = annotate_reviews(reviews, keys, lexicon, gazetteer, carry=["link", "rating"], max_bytes=max_bytes)
    return found.select(*keys, "link", rules.color_of(F.col("sentiment")).alias("color"), "entities",
                        rules.is_sarcastic(F.col("rating"), F.col("sentiment")).alias("is_sarcastic"))


def entry_of() -> Column:
    """A processed review as it stands in the JSON output."""
    return F.struct(F.col("link").alias("link"), F.col("color").alias("color"),
                    F.col("entities").alias("namedEntities"), F.col("is_sarcastic").alias("isSarcastic"))


def collect_entries(processed: DataFrame, keys: Sequence[str], pos: str = "pos",
                    products: DataFrame | None = None) -> DataFrame:
    """Processed reviews back into one JSON line per product: ``keys, line``, reviews in order.

    A product came as one row and goes as one row, so its line is as bounded as its input was. ``products``
    (``keys``) adds a line without entries for products that have no reviews.
    """
    entry = F.struct(F.col(pos).alias("at"), entry_of().alias("entry"))
    rows = processed.select(*keys, entry.alias("_entry"))
    if products is not None:
        rows = rows.unionByName(products.select(*keys, F.lit(None).cast(rows.schema["_entry"].dataType).alias("_entry")))
    # nulls, which stand for the product itself, are not collected
    return (rows.groupBy(*keys).agg(F.array_sort(F.collect_list("_entry")).alias("_e"))
            .select(*keys,
                    F.to_json(F.struct(F.transform("_e", lambda e: e["entry"]).alias("processedEntries")),
                              {"ignoreNullFields": "false"}).alias("line")))


def product_json(products: DataFrame, *keep: str) -> DataFrame:
    """Each product as a JSON line again, null fields included."""
    return products.select(*keep, F.to_json(F.struct("title", "reviews"), {"ignoreNullFields": "false"}).alias("line"))


def assemble_files(fragments: DataFrame, arrival: str | None = None, **skew) -> DataFrame:
    """Rows of the files whose fragments have all arrived: ``file_key, fragment_no, line``.

    ``fragments`` has ``file_key, fragment_no, expected, line``. Of a fragment that was delivered several times the line with
    the highest ``arrival`` counts, of equal ones or without that column the greatest line.
    Order by file and fragment number, or range-partition by them, to write the assembled files.
    """
    place = ["file_key", "fragment_no"]
    last = F.max(F.struct(*([arrival] if arrival else []), "line")).alias("_last")
    once = fragments.groupBy(*place).agg(last, F.max("expected").alias("expected"))
    # written once: counting reads the keys alone, without the lines
    once = pin(once.select(*place, "expected", F.col("_last.line").alias("line")), "arrived-fragments")
    files = once.groupBy("file_key").agg(F.count("*").alias("n"), F.max("expected").alias("_expected"))
    complete = files.where(F.col("n") == F.col("_expected"))
    return (join_totals(once.select(*place, "line"), complete, ["file_key"], ["fragment_no"], "n", "_expected",
                        hot_limit(once, **skew))
            .select(*place, "line"))


def unique_requests(requests: DataFrame) -> DataFrame:
    """Each request of a client for a file once."""
    return requests.select("client_key", "file_key").distinct()


def route_results(results: DataFrame, requests: DataFrame, spread: Sequence[str], order: str = "seq",
                  **skew) -> DataFrame:
    """Add to each result the client that asked for its file last (highest ``order``).

    ``spread`` are columns that tell the results of one file apart.
    """
    clients = requests.groupBy("file_key").agg(F.max_by("client_key", order).alias("client_key"))
    per_file = results.groupBy("file_key").agg(F.count("*").alias("_rows"))
    return join_totals(results, clients.join(per_file, "file_key"), ["file_key"], spread, "_rows", "client_key",
                       hot_limit(results, **skew))
