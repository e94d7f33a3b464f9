"""Text expressions. They stay in the JVM and see whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: token and sentence patterns, white space
BLANKS = " \t\n\r\f"
SENTENCE = r"[^.!?]+[.!?]*"
LETTERS = r"[\p{L}]+"
LETTERS_AND_DIGITS = r"[\p{L}0-9]+"


def words(text: Column, at_most: int = -1) -> Column:
    """Split on runs of white space. With ``at_most`` the last element holds the rest."""
    return F.split(F.trim(text, F.lit(BLANKS)), f"[{BLANKS}]+", at_most)


def sentences(text: Column) -> Column:
    """Sentences with their closing marks, in order. A line break does not end a sentence."""
    cut = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(cut, lambda s: F.trim(s, F.lit(BLANKS))), lambda s: s != "")


def longest_sentence(text: Column) -> Column:
    """The longest sentence, the first of equally long ones. NULL for an empty or null text."""
    ranked = F.transform(
        sentences(text),
        lambda s, i: F.struct(F.length(s).alias("length"), (-i).alias("place"), s.alias("sentence")))
    return F.array_max(ranked)["sentence"]


def opinion_words(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(LETTERS), F.lit(0))


def name_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LETTERS_AND_DIGITS), F.lit(0))


def escape_html(text: Column) -> Column:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text
