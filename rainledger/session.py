"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and zone-free timestamps must not move with the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: merges small shuffle partitions, splits skewed ones, and turns a
    # join into a broadcast only after the real size of its side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a skewed join be split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the library's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
