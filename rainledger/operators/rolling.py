"""Rolling sums over a fixed number of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """Add ``name: (value, rows)`` sums over the current row and the ``rows - 1`` before it.

    Counts rows, not days: a gap in the series stretches the window, and the first rows of a
    series hold partial sums. All sums share one shuffle and one sort.
    """
    series = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumns(
        {name: F.sum(value).over(series.rowsBetween(1 - rows, 0)) for name, (value, rows) in sums.items()}
    )
