"""Row identity and column names shared by the operators.

Every operator works on a frame with ``_id``: a long, unique, in the order of the given id. Where the ids
are unique and not null, ``_id`` is the id itself. Otherwise rows that repeat an id, or have none, count
as documents of their own: they are ordered by (id, text), null ids last, equal rows in any order, and
numbered in a written table, so that a retried task sees the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.staging import stage

ROW = "_id"


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", *others: str) -> DataFrame:
    """``_id``, the key, the text and the ``others`` of every row; no other column is kept, so none can clash."""
    narrow = docs.select(F.col(key).cast("long").alias(key), text, *others)
    repeats = narrow.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).limit(1).count()
    if not repeats:
        return narrow.withColumn(ROW, F.col(key))
    order = [F.col(key).asc_nulls_last(), F.col(text)]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered.withColumn(ROW, F.monotonically_increasing_id()), "llm-rows")


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def carried(docs: DataFrame) -> DataFrame:
    """``identified`` documents with their other columns, whatever their names, in one struct ``_rest``."""
    rest = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c != "text"]
    return identified(docs.select("doc_id", "text", F.struct(*rest).alias("_rest")), "doc_id", "text", "_rest")


def restored(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` from rows with ``_rest`` and a text."""
    plain = rows.select(F.col(text).alias("text"), F.col("_rest"))
    return plain.select(*[plain["text"] if c == "text" else plain["_rest"].getField(c).alias(c) for c in docs.columns])
