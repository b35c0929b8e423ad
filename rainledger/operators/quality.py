"""Checks that stop a load before bad rows reach the next layer.

``grain_violations`` and ``null_profile`` return tables; the ``assert_`` forms raise.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


class QualityError(ValueError):
    """A table broke a rule it must keep."""


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    repeated = grain_violations(df, keys).count()
    if repeated:
        raise QualityError(f"{name}: {repeated} values of ({', '.join(keys)}) occur more than once")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs per column, one output row per column, in a single pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    arms = [F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(c).alias("nulls")) for c in columns]
    return counts.select(F.inline(F.array(*arms)))


def assert_not_all_null(df: DataFrame, column: str, name: str = "table") -> int:
    """Raise when every row lacks the measure; warn about and return the number that do."""
    seen = null_profile(df, [column]).first()
    if seen["nulls"] == seen["rows"]:
        raise QualityError(f"{name}: {column} is NULL in all {seen['rows']} rows")
    if seen["nulls"]:
        log.warning("%s: %s is NULL in %d of %d rows", name, column, seen["nulls"], seen["rows"])
    return seen["nulls"]


def assert_no_nulls(df: DataFrame, columns: Sequence[str], name: str = "table") -> None:
    bad = [r["column_name"] for r in null_profile(df, columns).collect() if r["nulls"]]
    if bad:
        raise QualityError(f"{name}: NULL in required columns {bad}")


def assert_not_empty(df: DataFrame, name: str = "table") -> None:
    if df.isEmpty():
        raise QualityError(f"{name}: no rows")


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, one output row per table."""
    if not tables:
        raise QualityError("no tables to count")
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
