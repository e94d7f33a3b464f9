"""Spark session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # join the totals by hashing, where each of their partitions is seen to be small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # review annotation aggregates one small group per review; the default of 128 groups
    # would send every task to the sort-based path
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(name: str = "wordkin", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` are further Spark options, dots as ``__``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
