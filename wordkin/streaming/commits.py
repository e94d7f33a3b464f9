"""One commit per micro-batch: several tables become visible together, by a manifest written last."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordkin.storage import is_complete

_MANIFEST = "name string, path string, batch_id bigint"

#: called as ``probe(batch_id, step)`` ahead of each write of a batch
Probe = Callable[[int, str], None] | None


def manifest_folder(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/manifests/{batch_id}"


def is_published(spark: SparkSession, folder: str, batch_id: int) -> bool:
    return is_complete(spark, manifest_folder(folder, batch_id))


def publish(folder: str, batch_id: int, tables: dict[str, DataFrame], probe: Probe = None) -> None:
    """Write ``tables`` below ``folder`` and then, as the one step that counts, the manifest that says where.

    Every attempt writes new folders, so what a failed one left is never read; a batch whose manifest is
    there was published and is not written again.
    """
    spark = next(iter(tables.values())).sparkSession
    if is_published(spark, folder, batch_id):
        return
    rows = []
    for name, table in tables.items():
        if probe is not None:
            probe(batch_id, name)
        path = f"{name}/{batch_id}-{uuid.uuid4().hex}"
        table.write.parquet(f"{folder.rstrip('/')}/{path}")
        rows.append((name, path, batch_id))
    if probe is not None:
        probe(batch_id, "manifest")
    (spark.createDataFrame(rows, _MANIFEST).coalesce(1)
     .write.mode("overwrite").json(manifest_folder(folder, batch_id)))


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of table ``name`` of all published batches, with their ``batch_id``. At least one batch must be published.

    The manifests, a row per batch and table, name the folders; folders without a manifest are leftovers of failed attempts.
    """
    folder = folder.rstrip("/")
    listed = spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(f"{folder}/manifests")
    paths = [f"{folder}/{row.path}" for row in listed.where(F.col("name") == name).orderBy("batch_id").collect()]
    in_path = F.regexp_extract("_metadata.file_path", rf"/{name}/(\d+)-", 1)
    table = spark.read.parquet(*paths)
    return table.select("*", in_path.cast("bigint").alias("batch_id"))
