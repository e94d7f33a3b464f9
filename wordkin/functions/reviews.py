"""Review rules: colour, sarcasm, report text, work keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordkin.functions.text import escape_html

# fixed values: sentiment classes 0 to 4, and the entity types that are reported
COLORS = ["DARK_RED", "RED", "BLACK", "LIGHT_GREEN", "DARK_GREEN"]
ENTITY_TYPES = ["LOCATION", "ORGANIZATION", "PERSON"]

# fixed values: the report's frame
HTML_HEADER = "<html>\n<head>\n</head>\n<body>"
HTML_FOOTER = "</body>\n</html>"


def color_of(sentiment: Column) -> Column:
    """Colour name of a sentiment class; NULL outside 0 to 4."""
    return F.get(F.array(*map(F.lit, COLORS)), F.when(sentiment.between(0, 4), sentiment.cast("int")))


def is_sarcastic(rating: Column, sentiment: Column) -> Column:
    """The rating contradicts the sentiment. Without a rating nothing is contradicted."""
    clash = ((sentiment >= 3) & (rating <= 2)) | ((sentiment <= 1) & (rating >= 4))
    return F.coalesce(clash, F.lit(False))


def css_color(color: Column) -> Column:
    return F.replace(F.lower(color), F.lit("_"), F.lit(""))


def entity_text(entities: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(entities, ", "), F.lit("]"))


def html_block(link: Column, color: Column, entities: Column, sarcastic: Column, escape: bool = True) -> Column:
    """One review of the report, without a closing line break. Null parts print as empty."""
    guard = escape_html if escape else (lambda text: text)
    link = F.coalesce(guard(link), F.lit(""))
    # fixed values: the tags and words of a block
    return F.concat(
        F.lit('<div style="color: '), F.coalesce(css_color(color), F.lit("")), F.lit(';">\n'),
        F.lit('<p>Link: <a href="'), link, F.lit('">'), link, F.lit("</a></p>\n"),
        F.lit("<p>Named Entities: "), guard(entity_text(F.coalesce(entities, F.array().cast("array<string>")))),
        F.lit("</p>\n<p>Sarcasm Detection: "),
        F.when(sarcastic, "Sarcastic").otherwise("Not Sarcastic"), F.lit("</p>\n</div>"))


def request_parts(body: Column) -> list[Column]:
    """``input <client> <file>`` into its three parts."""
    part = F.split(body, " ")
    return [F.get(part, 0).alias("kind"), F.get(part, 1).alias("client_key"), F.get(part, 2).alias("file_key")]


def fragment_parts(body: Column) -> list[Column]:
    """``task <file>-<n>`` or ``finished <file>-<n>`` into kind, file and fragment number."""
    part = F.split(body, " ")
    key = F.split(F.get(part, 1), "-")
    return [F.get(part, 0).alias("kind"), F.get(key, 0).alias("file_key"),
            F.get(key, 1).try_cast("int").alias("fragment_no")]
