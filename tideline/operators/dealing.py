"""How rows are dealt to tasks where a task's memory goes with its share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by key, in as many partitions as the session has for its shuffles.

    Adaptive execution merges the partitions of a shuffle up to 64 MB as packed, and sorts and hash tables over these held
    15 times as much in one task. A number that is named stays as it is, so a task holds its part of the rows only.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
