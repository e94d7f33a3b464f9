"""Writers. Files hold contiguous, sorted ranges; no writer brings an output into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordkin.operators.collocations import collocation_line, decade_slices, strongest_first
from wordkin.operators.reports import html_rows


def write_decades(table: DataFrame, path: str) -> None:
    """Parquet with a folder per decade. The rebalancing sizes the files: small decades share a
    task, large ones are split over several."""
    table.hint("rebalance", "decade").write.mode("overwrite").partitionBy("decade").parquet(path)


def write_decade_pairs(records: DataFrame, path: str, **sizing) -> None:
    """Records by decade as pairs, added up by the shuffle that also sizes the files, in a folder per decade."""
    decade_slices(records, **sizing).write.mode("overwrite").partitionBy("decade").parquet(path)


def write_sequence_lines(lines: DataFrame, path: str) -> None:
    """Hadoop SequenceFiles (offset, text) of a long and a string column, neither of them null. The JVM writes them: no record
    passes through Python. ``sources.ngrams.read_sequence_lines`` reads them back."""
    jvm = lines.sparkSession._jvm
    kinds, writable, tag = jvm.org.apache.spark.sql.Encoders, jvm.org.apache.spark.WritableFactory, jvm.scala.reflect.ClassTag
    typed = getattr(lines.toDF("_1", "_2")._jdf, "as")(kinds.tuple(kinds.LONG(), kinds.STRING()))
    classes = [tag.apply(jvm.java.lang.Class.forName(f"java.lang.{name}")) for name in ("Long", "String")]
    records = jvm.org.apache.spark.rdd.RDD.rddToSequenceFileRDDFunctions(
        typed.rdd(), *classes, writable.longWritableFactory(), writable.stringWritableFactory())
    # not compressed
    records.saveAsSequenceFile(path, getattr(records, "saveAsSequenceFile$default$2")())


def write_ordered_text(rows: DataFrame, path: str, folder: str, order: Sequence[Column], line: str) -> None:
    """Text files below ``folder=<value>``, ``order`` kept along the file names.

    Rows are range-partitioned by folder and order, so a large folder gets several files, each the
    continuation of the one before.
    """
    if rows.schema[folder].dataType.typeName() == "string":
        # not nullable: the writer then takes the sorted rows as they come, without sorting again
        rows = rows.withColumn(folder, F.coalesce(F.col(folder), F.lit("")))
    keys = [F.col(folder), *order]
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(folder, line)
     .write.mode("overwrite").partitionBy(folder).text(path))


def write_collocations(found: DataFrame, path: str, digits: int | None = None) -> None:
    """``w1 <tab> w2 <tab> NPMI:<score>``, a folder per decade, strongest first."""
    write_ordered_text(found.withColumn("line", collocation_line(digits)), path, "decade", strongest_first(), "line")


def write_decade_figures(figures: DataFrame, path: str) -> None:
    """Per-decade figures (N or S), at most 1000 rows."""
    figures.coalesce(1).write.mode("overwrite").parquet(path)


def write_json_lines(lines: DataFrame, path: str, folder: str, order: Sequence[str], line: str = "line") -> None:
    """JSON result lines, a folder per input file, in input order."""
    write_ordered_text(lines, path, folder, [F.col(name) for name in order], line)


def write_assembled(rows: DataFrame, path: str) -> None:
    """Assembled files (``file_key, fragment_no, line``): a folder per file, its lines in the order of their numbers along
    the file names. ``sources.products.read_assembled`` reads them back."""
    write_ordered_text(rows, path, "file_key", [F.col("fragment_no")], "line")


def write_html(processed: DataFrame, path: str, report: str, order: Sequence[str], escape: bool = True,
               reports: DataFrame | None = None) -> None:
    """A report per value of the ``report`` column: header, one block per review in input order, footer.
    Link and entities are escaped; ``escape=False`` writes them as they are. ``reports`` (``report``) names all
    reports, also those without reviews."""
    rows = html_rows(processed, report, order, escape, reports)
    write_ordered_text(rows, path, "report", [F.col("section"), *[F.col(name) for name in order]], "html")
