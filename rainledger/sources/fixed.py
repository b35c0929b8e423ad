"""Small fixed tables and frames made from a list."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two weather data sets and the reach of each.
DATASETS = ["forecast", "archive"]
ARCHIVE_DAYS_BACK = 364
FORECAST_DAYS = 14

# Monitored locations.
LOCATION_SCHEMA = (
    "location_key string, location_name string, province string, island string, "
    "latitude double, longitude double, peatland_flag boolean"
)
LOCATIONS = [
    ("jakarta", "jakarta", "DKI Jakarta", "Java", -6.2088, 106.8456, False),
    ("surabaya", "surabaya", "Jawa Timur", "Java", -7.2575, 112.7521, False),
    ("bandung", "bandung", "Jawa Barat", "Java", -6.9175, 107.6191, False),
    ("semarang", "semarang", "Jawa Tengah", "Java", -6.9667, 110.4167, False),
    ("yogyakarta", "yogyakarta", "DI Yogyakarta", "Java", -7.7956, 110.3695, False),
    ("medan", "medan", "Sumatra Utara", "Sumatra", 3.5952, 98.6722, False),
    ("palembang", "palembang", "Sumatra Selatan", "Sumatra", -2.9909, 104.7560, False),
    ("pekanbaru", "pekanbaru", "Riau", "Sumatra", 0.5071, 101.4478, True),
    ("palangkaraya", "palangkaraya", "Kalimantan Tengah", "Kalimantan", -2.2096, 113.9200, True),
    ("samarinda", "samarinda", "Kalimantan Timur", "Kalimantan", -0.5022, 117.1536, True),
    ("makassar", "makassar", "Sulawesi Selatan", "Sulawesi", -5.1477, 119.4327, False),
    ("manado", "manado", "Sulawesi Utara", "Sulawesi", 1.4748, 124.8421, False),
    ("jayapura", "jayapura", "Papua", "Papua", -2.5912, 140.6631, False),
    ("kupang", "kupang", "Nusa Tenggara Timur", "Nusa Tenggara", -10.1772, 123.6070, False),
    ("mataram", "mataram", "Nusa Tenggara Barat", "Nusa Tenggara", -8.5833, 116.1167, False),
]

# The sample orders every region gets, as (order_id, amount).
SAMPLE_ORDERS = [(1, 100), (2, 250), (3, 75), (4, 300), (5, 150)]


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A relation from literal rows; an Arrow table gives it an exact size for join planning."""
    declared = T.StructType.fromDDL(schema)
    columns = [pa.array(values) for values in zip(*rows)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, declared.names), declared)


def locations(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, LOCATIONS, LOCATION_SCHEMA)


def ingest_plan(places: DataFrame, as_of: str, datasets: Sequence[str] = DATASETS) -> DataFrame:
    """One request per data set and location, with its dates or its forecast length.

    Each location row is repeated per data set in place; there is no join to shuffle.
    """
    day = F.lit(as_of).cast("date")
    archive = F.col("dataset") == "archive"
    return places.select(F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"), "*").select(
        "dataset",
        "location_key",
        "latitude",
        "longitude",
        F.when(archive, F.date_sub(day, ARCHIVE_DAYS_BACK)).alias("start_date"),
        F.when(archive, day).alias("end_date"),
        F.when(~archive, FORECAST_DAYS).alias("forecast_days"),
    )


def regional_orders(regions: DataFrame) -> DataFrame:
    """The sample orders for each row of ``regions(region)``."""
    orders = [F.struct(F.lit(i).alias("order_id"), F.lit(a).alias("amount")) for i, a in SAMPLE_ORDERS]
    return regions.select("region", F.inline(F.array(*orders)))
