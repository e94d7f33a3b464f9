"""HTML report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordkin.functions.reviews import HTML_FOOTER, HTML_HEADER, html_block


def html_rows(processed: DataFrame, report: str, order: Sequence[str], escape: bool = True,
              reports: DataFrame | None = None) -> DataFrame:
    """``report, section, <order>, html``: header (section 0), a block per review (1), footer (2).

    ``reports`` (``report``) has a row per report to write, with or without reviews; without it the reports are
    those of the reviews, for which these are read twice.
    """
    block = html_block(F.col("link"), F.col("color"), F.col("entities"), F.col("is_sarcastic"), escape)
    body = processed.select(F.col(report).alias("report"), F.lit(1).alias("section"), *order, block.alias("html"))
    frame = F.explode(F.array(F.struct(F.lit(0).alias("section"), F.lit(HTML_HEADER).alias("html")),
                              F.struct(F.lit(2).alias("section"), F.lit(HTML_FOOTER).alias("html"))))
    nothing = [F.lit(None).cast(processed.schema[name].dataType).alias(name) for name in order]
    named = body.select("report").distinct() if reports is None else reports.select("report")
    frames = (named.select("report", frame.alias("f"))
              .select("report", "f.section", *nothing, "f.html"))
    return body.unionByName(frames)
