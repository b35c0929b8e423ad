"""Tasks of bounded size."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame

ROWS_PER_TASK = 250_000
LEAST_ROWS = 25_000


def spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Deal a frame of about ``rows`` rows out by ``keys``: more rows make more tasks, not larger ones.

    Adaptive execution merges shuffle partitions by their compressed bytes. Rows that pack well take twenty times as much in
    a sort or a hash table, so the memory of such a task grows with the table until a partition has the advised size. Few
    rows are dealt to the cores, ``LEAST_ROWS`` to a task. Steps that need rows of equal ``keys`` together shuffle no more.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(ceil(rows / ROWS_PER_TASK), min(cores, ceil(rows / LEAST_ROWS)), 1)
    return df.repartition(tasks, *keys)
