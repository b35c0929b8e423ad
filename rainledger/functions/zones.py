"""Time-zone removal at the ingest boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_timezones(df: DataFrame) -> DataFrame:
    """Turn every zone-aware timestamp column into its wall-clock time in the session's zone."""
    aware = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("timestamp_ntz") for name in aware}) if aware else df
