"""2-gram records: parsing, validity, stop words, decades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.functions.text import words
from wordkin.operators.skew import BROADCAST_BYTES, fits_broadcast
from wordkin.storage import pin

# fixed values: the decade window
FIRST_YEAR = 1500
LAST_YEAR = 2029


def tokenise_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The first four tokens of each line, by position, and how many there are."""
    # exploding the one-element array keeps filters on the tokens above it: pushed below, every one of
    # them would split the line again
    token = lines.select(F.explode(F.array(words(F.col(column)))).alias("t"))
    blank = F.get("t", 0) == ""
    return token.select(F.when(~blank, F.get("t", 0)).alias("w1"), F.get("t", 1).alias("w2"),
                        F.get("t", 2).alias("year_token"), F.get("t", 3).alias("count_token"),
                        F.when(blank, 0).otherwise(F.size("t")).alias("n_tokens"))


def valid_ngrams(tokens: DataFrame) -> DataFrame:
    """Keep well-formed records and type them: a four-digit year above 0, a count of 0 or more.

    Duplicates stay: the decade rollup adds them up.
    """
    year = F.col("year_token").try_cast("int")
    count = F.col("count_token").try_cast("bigint")
    return (tokens
            .where((F.col("n_tokens") >= 4) & F.col("year_token").rlike("^[0-9]{4}$") & (year > 0)
                   & F.col("count_token").rlike("^[+-]?[0-9]+$") & (count >= 0))
            .select("w1", "w2", year.alias("year"), count.alias("match_count")))


def parse_ngrams(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines to ``w1, w2, year, match_count``; broken lines are dropped."""
    return valid_ngrams(tokenise_lines(lines, column))


#: a stop list of so many words is a condition in the plan
FEW_WORDS = 1000

#: bits of a word filter per word, and bits of one of its rows
FILTER_BITS, BLOCK_BITS = 32, 4096


def _place(word: Column, blocks: int) -> tuple[Column, Column]:
    """The row of a filter and the bit in it that stand for a word."""
    place = F.pmod(F.xxhash64(word), F.lit(blocks * BLOCK_BITS))
    return F.floor(place / BLOCK_BITS), (place % BLOCK_BITS).cast("int")


def word_filter(words: DataFrame, blocks: int) -> DataFrame:
    """A Bloom filter with one hash of the column ``word``: ``block, bits``, at most ``blocks`` rows of 512 bytes."""
    block, bit = _place(F.col("word"), blocks)
    whole = words.where("word is not null").groupBy(block.alias("block")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    return whole.select("block", F.substring("bits", 1, BLOCK_BITS // 8).alias("bits"))


def _with_filter(rows: DataFrame, name: str, held: DataFrame, blocks: int) -> DataFrame:
    """Add ``_maybe_<name>``: false if the word of that column is not in the filter."""
    block, bit = _place(F.col(name), blocks)
    octet = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.coalesce(F.getbit(octet, bit % 8) == 1, F.lit(False))
    filtered = F.broadcast(held.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    return rows.join(filtered, block == F.col("_block"), "left").withColumn(f"_maybe_{name}", known).drop("_block", "_bits")


def drop_stop_words(ngrams: DataFrame, stop_words: DataFrame, max_bytes: int = BROADCAST_BYTES, filter_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Drop records with a listed word on either side; exact case, duplicates kept.

    A list of up to 1000 words becomes a condition on the records, a longer one is broadcast up to ``max_bytes``. Beyond, a filter of it is, up to ``filter_bytes``, 4 bytes a word: records with no word that
    may be listed are kept as they are, and only the others, few besides those that go, are shuffled to the anti joins. The records are
    then read twice. A list too long for that is joined by shuffling all records, with skew splitting.
    """
    words = stop_words.select("word")
    if fits_broadcast(words, max_bytes):
        few = words.where("word is not null").limit(FEW_WORDS + 1).collect()
        if len(few) <= FEW_WORDS:
            # a condition costs less than half of a join per record; a word that is null is not listed
            listed = [F.coalesce(F.col(name).isin([row["word"] for row in few]), F.lit(False)) for name in ("w1", "w2")]
            return ngrams.where(~listed[0] & ~listed[1])
        return _without(ngrams, F.broadcast(words))
    blocks = max(1, -(-words.count() * FILTER_BITS // BLOCK_BITS))
    if blocks * BLOCK_BITS // 8 > filter_bytes:
        return _without(ngrams, words)
    held = pin(word_filter(words, blocks), "word-filter")
    marked = _with_filter(_with_filter(ngrams, "w1", held, blocks), "w2", held, blocks)
    maybe = F.col("_maybe_w1") | F.col("_maybe_w2")
    return (marked.where(~maybe).select(*ngrams.columns)
            .unionAll(_without(marked.where(maybe).select(*ngrams.columns), words)))


def _without(ngrams: DataFrame, stop: DataFrame) -> DataFrame:
    return (ngrams.join(stop.withColumnRenamed("word", "w1"), "w1", "left_anti")
            .join(stop.withColumnRenamed("word", "w2"), "w2", "left_anti").select(*ngrams.columns))


def decade_of(year: Column) -> Column:
    return (year - year % 10).cast("int")


def decade_label(decade: Column) -> Column:
    return F.concat(F.lpad(decade.cast("string"), 4, "0"), F.lit("'s"))


def in_window(year: Column, start: int = FIRST_YEAR, end: int = LAST_YEAR) -> Column:
    return year.between(start, end)


def decade_records(ngrams: DataFrame, start: int = FIRST_YEAR, end: int = LAST_YEAR) -> DataFrame:
    """The records of the window by decade, not added up: ``decade, w1, w2, c``. Sums over them are those over the pairs."""
    return ngrams.where(in_window(F.col("year"), start, end)).select(
        decade_of(F.col("year")).alias("decade"), "w1", "w2", F.col("match_count").alias("c"))


def roll_up_decades(ngrams: DataFrame, start: int = FIRST_YEAR, end: int = LAST_YEAR) -> DataFrame:
    """Pair counts by decade over the window: ``decade, w1, w2, c``."""
    return decade_records(ngrams, start, end).groupBy("decade", "w1", "w2").agg(F.sum("c").alias("c"))
