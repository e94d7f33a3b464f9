"""Readers of review files: one JSON product per line, its reviews nested."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordkin.functions.text import BLANKS
from wordkin.operators.skew import broadcast_if_small
from wordkin.schemas import CORRUPT, PRODUCT_OR_CORRUPT
from wordkin.storage import few_listing_tasks, pin


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of all files below the paths, at any depth, with their place: ``line, file, block, line_id``. Order by the
    last three for file order."""
    with few_listing_tasks(spark):
        text = spark.read.option("recursiveFileLookup", True).text(paths if isinstance(paths, str) else list(paths))
    return text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_id"))


def files_not_utf8(lines: DataFrame) -> DataFrame:
    """Files with a line that is not valid UTF-8: ``file``. The lines hold the bytes as read."""
    return lines.where(~F.is_valid_utf8("line")).select("file").distinct()


def decode_latin(lines: DataFrame, is_latin: Column) -> DataFrame:
    """Take the bytes of the lines marked by ``is_latin`` as ISO-8859-1."""
    decoded = F.decode(F.col("line").cast("binary"), "ISO-8859-1")
    return lines.withColumn("line", F.when(is_latin, decoded).otherwise(F.col("line")))


def read_products(spark: SparkSession, paths: str | Sequence[str], charset_fallback: bool = False) -> DataFrame:
    """Product lines: ``file, block, line_id, title, reviews, _corrupt_record``.

    With ``charset_fallback`` a file that is not valid UTF-8 throughout is read as ISO-8859-1. That takes
    one more pass over the lines; the names of such files are joined by their size, never collected.
    """
    lines = read_lines(spark, paths)
    if charset_fallback:
        latin = pin(files_not_utf8(lines), "files-not-utf8").withColumn("_latin", F.lit(True))
        lines = decode_latin(lines.join(broadcast_if_small(latin), "file", "left"), F.col("_latin")).drop("_latin")
    return parse_product_lines(lines)


def good_products(products: DataFrame) -> DataFrame:
    return products.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined_lines(products: DataFrame, *keep: str) -> DataFrame:
    """Lines that are not a JSON object, with their place. Good lines after a bad one are kept apart from them."""
    places = [name for name in ("file", "block", "line_id", "line_no") if name in products.columns]
    return products.where(F.col(CORRUPT).isNotNull()).select(*keep, *places, F.col(CORRUPT).alias("line"))


def parse_product_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """The lines of ``column`` as products; other columns stay. Blank lines are skipped.

    A line that is not valid JSON gets its text in ``_corrupt_record``.
    """
    parsed = F.from_json(F.col(column), PRODUCT_OR_CORRUPT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    others = [name for name in lines.columns if name != column]
    # inlined rather than selected: filters on the fields stay above, where the line is already parsed
    return lines.where(F.trim(column, F.lit(BLANKS)) != "").select(*others, F.inline(F.array(parsed)))


def number_lines(lines: DataFrame, group: str = "file", name: str = "fragment_no") -> DataFrame:
    """Add ``name``, the 1-based number of the row among the rows of its ``group``, in the order of files and lines.

    Only rows that are there count: lines dropped before, as blank or bad ones, leave no gap. A row's number is its rank
    among the rows of its split plus the rows of the splits before. A split is no larger than
    ``spark.sql.files.maxPartitionBytes``, so no file, and no folder of files, is brought into one task.
    """
    split = W.partitionBy("file", "block")
    ranked = pin(lines.withColumn("_rank", F.row_number().over(split.orderBy("line_id"))), "ranked-lines")
    splits = ranked.groupBy(*dict.fromkeys([group, "file", "block"])).agg(F.count("*").alias("_rows"))
    before = W.partitionBy(group).orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # a row per split
    splits = broadcast_if_small(pin(splits, "splits"))
    return (ranked.join(splits, ["file", "block"]).withColumn(name, F.col("_before") + F.col("_rank"))
            .drop(*{"file", "block", "line_id"} - {group}, "_rank", "_before"))


def read_assembled(spark: SparkSession, path: str) -> DataFrame:
    """``file_key, fragment_no, line`` of the folders that ``sinks.tables.write_assembled`` has written."""
    key = F.regexp_extract("file", "/file_key=([^/]*)/", 1)
    return number_lines(read_lines(spark, path).withColumn("file_key", F.url_decode(key)), "file_key")


def input_files(spark: SparkSession, outputs: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """``file, out`` of all files below the inputs of ``outputs`` (path of a file or folder, or a pattern of such, to output name),
    and the inputs that hold them all.

    A file below several inputs belongs to the one with the longest path. The files are listed, not read.
    """
    conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    found = {}
    for given, out in outputs.items():
        system = hadoop.Path(given).getFileSystem(conf)
        matches = system.globStatus(hadoop.Path(given))
        if not matches:
            raise FileNotFoundError(given)
        found |= {system.makeQualified(match.getPath()).toString().rstrip("/"): out for match in matches}
    roots: list[str] = []
    for path in sorted(f"{path}/" for path in found):
        if not roots or not path.startswith(roots[-1]):
            roots.append(path)
    roots = [root.rstrip("/") for root in roots]
    # as the names of the files read are written
    named = [(hadoop.Path(path).toUri().toString(), out) for path, out in found.items()]
    inputs = broadcast_if_small(spark.createDataFrame(named, "above string, out string"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots).select(F.col("_metadata.file_path").alias("file"))
    # every folder above a file, and the file itself
    steps = F.split("file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    longest = F.max_by("out", F.length("above"))
    return files.select("file", F.explode(above).alias("above")).join(inputs, "above").groupBy("file").agg(longest.alias("out")), roots


def read_paired(spark: SparkSession, outputs: dict[str, str], charset_fallback: bool = False) -> DataFrame:
    """Product lines of all inputs of ``outputs`` (see :func:`input_files`), with the output's name as ``out``.

    One read of all inputs, however many, and with ``charset_fallback`` one more of their lines.
    """
    files, roots = input_files(spark, outputs)
    files = pin(files, "input-files")
    lines = read_lines(spark, roots)
    if charset_fallback:
        latin = files_not_utf8(lines).withColumn("latin", F.lit(True))
        files = pin(files.join(latin, "file", "left"), "input-files")
    lines = lines.join(broadcast_if_small(files), "file")
    if charset_fallback:
        lines = decode_latin(lines, F.coalesce("latin", F.lit(False))).drop("latin")
    return parse_product_lines(lines)
