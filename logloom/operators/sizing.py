"""Broadcasts behind a check of their size, and rows dealt to all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a few numbers or words each that are sent to every task: some 10 MB at most.
FEW = 200_000


def small(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df``, to be broadcast if a count shows at most ``most`` rows; else joins shuffle both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key``: a file of one row group is one task, whatever its rows cost, and its rows are then many tasks'."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)  # a stated number: narrow rows would be put together again


#: Rows of a few numbers that one task sorts at once.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to one task per ``TASK_ROWS`` of so many ``rows``, and no fewer than usual: tasks then get more, not larger."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(usual, -(-rows // TASK_ROWS)), *keys)
