"""Join sides of known size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 100_000


def is_small(side: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Whether a join side has at most ``max_rows`` rows. Counting stops one row past the limit."""
    return side.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(side: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast a join side after counting that it has at most ``max_rows`` rows.

    A larger side is returned as it is, for a shuffled join. Spark's own size estimate multiplies
    the sizes of joined inputs, so it can miss a tiny side and then shuffle the fact table on a
    key of few values.
    """
    return F.broadcast(side) if is_small(side, max_rows) else side
