"""Row counts per step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass while the job runs, for monitoring. Rows that pass twice count twice: in a
    repeated task, and below a global sort, which first samples its input."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def count_stages(stages: dict[str, DataFrame]) -> DataFrame:
    """Exact counts, ``stage, rows``."""
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")
               for stage, df in stages.items()]
    return reduce(DataFrame.unionByName, counted)
