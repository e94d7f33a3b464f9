"""Shared scratch space: where jobs cut their lineage with a written table."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder the cluster shares through ``spark.checkpoint.dir``.

    Only a session in one process on one machine goes without that setting: its folder lies in the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def few_listing_tasks(spark: SparkSession, per_core: int = 4) -> Iterator[None]:
    """Spark lists folders in a task each, up to thousands, and each task costs the driver time and memory. Here they are shared
    by a few tasks per core. A stream that starts here keeps to this."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = int(spark.conf.get(key))
    spark.conf.set(key, min(before, per_core * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A writer has finished this folder."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def pin(df: DataFrame, label: str, work_dir: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and go on from the written table.

    Used where a result has several readers: the readers get column pruning, later stages do not
    depend on the shuffle files of earlier ones, and a lost executor costs no recomputation. In a
    ``work_dir`` a table that an earlier run has finished is taken as it is. ``codec`` compresses otherwise than
    the session does.
    """
    spark = df.sparkSession
    path = f"{work_dir.rstrip('/')}/{label}" if work_dir else scratch_folder(spark, label)
    if not (work_dir and is_complete(spark, path)):
        df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def check_run(spark: SparkSession, work_dir: str, **settings) -> None:
    """Note what a run in ``work_dir`` was started with; refuse a folder that was started with anything else."""
    path = f"{work_dir.rstrip('/')}/run"
    want = json.dumps(settings, sort_keys=True, default=str)
    if not is_complete(spark, path):
        spark.createDataFrame([(want,)], "settings string").coalesce(1).write.mode("overwrite").json(path)
        return
    have = spark.read.schema("settings string").json(path).first()["settings"]
    if have != want:
        raise ValueError(f"{work_dir} holds another run: {have}, not {want}")


def digest(df: DataFrame) -> str:
    """A number for the rows of a table, whatever their order."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}/{row['h']}"


def files_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A number for the names, lengths and times of the files below some paths. They are listed, on Spark, and not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return digest(files.select("path", "length", "modificationTime"))


def fingerprint(df: DataFrame) -> str:
    """What a result depends on: the files it is read from, and how it is computed from them.

    A result that doesn't come from files alone, such as one of rows given by the program, is told by its rows, which takes
    a pass over them.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    from_files = all(leaves.apply(i).getClass().getSimpleName() == "LogicalRelation" for i in range(leaves.size()))
    files = df.inputFiles() if from_files else []
    if not files:
        return f"rows {digest(df)}"
    shape = re.sub(r"#\d+L?", "", plan.canonicalized().toString())
    # the names come encoded, and are read as paths
    return f"files {files_fingerprint(df.sparkSession, [unquote(name) for name in files])} {hashlib.sha256(shape.encode()).hexdigest()[:16]}"
