"""Proportional stratified interleaving: every shard holds every source in the proportion of the whole.

Rows of a source are put in a seeded random order; a row's fractional rank there is ``(rank from 0 + phase) / rows of the
source``, where the phase between 0 and 1 comes from a seeded hash of the source. Sorting all rows by it interleaves the
sources evenly, and cutting that order into equal runs gives shards whose counts differ by one at most and whose mixtures match.
The phases keep many sources of one row, or of equal counts, from having one fraction.

Both global ranks come from counts: a row's bucket (of the seeded hash, then of the fractional rank)
is counted over all rows, running sums of the small counts give each bucket's first rank (in two
levels, so that no task sums all buckets), and only rows of one bucket are sorted together. So a hot source is spread over all
buckets. Column expressions only.

Null sources are a stratum of their own, null texts are empty (size 8). Rows that repeat an id, or have none, are rows of
their own (see ``rows``), so every row gets one place. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.staging import stage
from .rows import ROW, identified

#: Rows that are sorted together, about; and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 2048, 1024
#: Buckets whose running sum is taken in one task.
RUN = 4096
#: Steps of a phase.
PHASES = 1 << 40


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """The rank from 0 of every row in its group, in the order of bucket, then ``order``."""
    counts = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumn("_run", F.floor(F.col(bucket) / RUN))
    earlier = lambda *keys: Window.partitionBy(*group, *keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda *keys: F.coalesce(F.sum("_rows").over(earlier(*keys)), F.lit(0))
    runs = counts.groupBy(*group, "_run").agg(F.sum("_rows").alias("_rows"))
    runs = runs.select(*group, "_run", before("_run").alias("_runs"))
    firsts = (
        counts.withColumn("_before", before("_run", bucket))
        .join(runs, [*group, "_run"])
        .select(*group, bucket, (F.col("_runs") + F.col("_before")).alias("_first"))
    )
    own = Window.partitionBy(*group, bucket).orderBy(*order)
    return (
        rows.withColumn("_own", F.row_number().over(own) - 1)
        .join(firsts, [*group, bucket])
        .withColumn(name, F.col("_first") + F.col("_own"))
        .drop("_first", "_own")
    )


def shard_documents(docs: DataFrame, shards: int, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, text_crc32, ``shard`` and ``slot`` (the place in the shard, from 0) of every row.

    ``docs`` gives the first four. The order depends on the seed and the ids alone. Counts of shards differ by one at most, and a
    shard's count of any source differs from its share by less than one, plus that source's part of all rows times the number of
    sources.
    """
    rows = identified(docs, "doc_id", "text_crc32", "source", "size")
    total = rows.count()
    buckets = max(LEAST_BUCKETS, total // BUCKET_ROWS)
    shuffled = F.md5(F.concat(F.lit(seed + ":"), F.col(ROW).cast("string")))
    part = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long")
    keyed = (
        rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        .withColumn("_order", shuffled)
        .withColumn("_bucket", F.floor(part * buckets / F.lit(1 << 32)))
    )
    ranked = _ranked(keyed, ["_source"], "_bucket", ["_order", ROW], "_rank")
    sizes = keyed.groupBy("_source").agg(F.count(F.lit(1)).alias("_size"))
    phase = F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(PHASES)) + F.lit(0.5)
    # The fraction in 2**-53 steps: one exact order for rows of all sources, ties by source and id.
    placed = (
        ranked.join(sizes, "_source")
        .withColumn("_fraction", (F.col("_rank") + phase / PHASES) / F.col("_size"))
        .withColumn("_bucket", F.floor(F.col("_fraction") * buckets))
        .withColumn("_all", F.lit(0))
    )
    placed = stage(placed, "llm-fractions")
    # One row per bucket meets in the running sum.
    whole = _ranked(placed, ["_all"], "_bucket", ["_fraction", "_source", ROW], "_place")
    shard = F.floor(F.col("_place") * shards / F.lit(max(total, 1)))
    first = F.ceil(F.col("shard") * F.lit(total) / shards)
    return (
        whole.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("_place") - first).cast("long"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
