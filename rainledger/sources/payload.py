"""Weather API payloads: parallel daily arrays become one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# API variable -> column of the landed record.
DAILY_VARIABLES = {
    "temperature_2m_max": "temperature_2m_max_c",
    "temperature_2m_min": "temperature_2m_min_c",
    "precipitation_sum": "precipitation_sum_mm",
    "relative_humidity_2m_min": "relative_humidity_min_pct",
    "wind_speed_10m_max": "wind_speed_10m_max_kmh",
    "et0_fao_evapotranspiration": "evapotranspiration_mm",
    "soil_moisture_0_to_7cm_mean": "soil_moisture_avg",
}

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in DAILY_VARIABLES]
            ),
        )
    ]
)

RECORD_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("dataset", "location", "province", "island")]
    + [T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude")]
    + [T.StructField("peatland_flag", T.BooleanType()), T.StructField("date", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in [*DAILY_VARIABLES.values(), "temperature_2m_mean_c"]]
)


def payloads_without_days(raw: DataFrame) -> DataFrame:
    """Data set and location of each payload that will give no rows."""
    days = F.from_json("body", PAYLOAD_SCHEMA)["daily"]["time"]
    return raw.where(F.coalesce(F.size(days), F.lit(0)) <= 0).select("dataset", "location_key")


def payload_profile(raw: DataFrame) -> DataFrame:
    """Per payload: its days, the variables it lacks, those with another number of values than days, and whether it is
    corrupt (``corrupt`` 1: a body that is no JSON object of that shape; an absent or empty one is not)."""
    marked = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("body", marked, {"columnNameOfCorruptRecord": "_corrupt"})
    daily = parsed["daily"]
    days = F.coalesce(F.size(daily["time"]), F.lit(0))
    sizes = [F.size(daily[v]) for v in DAILY_VARIABLES]
    counted = lambda tests: sum((t.cast("int") for t in tests), F.lit(0))
    return raw.select(
        "dataset",
        "location_key",
        F.greatest(days, F.lit(0)).alias("days"),
        counted([F.coalesce(s, F.lit(-1)) < 0 for s in sizes]).alias("absent"),
        counted([F.coalesce((s >= 0) & (s != days), F.lit(False)) for s in sizes]).alias("uneven"),
        parsed["_corrupt"].isNotNull().cast("int").alias("corrupt"),
    )


def _observed(located: DataFrame, seen: Observation) -> DataFrame:
    """Counts payloads while they are flattened, and names those that give no rows: one name per data set and location."""
    name = F.concat_ws("/", "dataset", "location_key")
    named = lambda when: F.sort_array(F.collect_set(F.when(when, name)))
    return located.observe(
        seen,
        F.count(F.lit(1)).alias("payloads"),
        named(F.coalesce(F.size("daily.time"), F.lit(0)) <= 0).alias("without_days"),
        named(F.col("location_name").isNull()).alias("unknown_places"),
    )


def flatten_daily_payload(raw: DataFrame, places: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Landed records from ``raw(dataset, location_key, body)`` and the location table.

    ``seen`` gets, from the one job that writes the result, the number of payloads and the names of those without days or of
    an unknown location.

    A variable that is absent or shorter than ``time`` gives NULL (see ``payload_profile``); a payload without
    days gives no rows; a body that is not JSON ends the job. Locations are joined while there is still one row per payload.
    """
    body = F.from_json("body", PAYLOAD_SCHEMA, {"mode": "FAILFAST"})["daily"].alias("daily")
    located = raw.select("dataset", "location_key", body).join(places, "location_key", "left")
    located = (_observed(located, seen) if seen else located).where(F.col("location_name").isNotNull())
    days = F.coalesce(F.col("daily.time"), F.array().cast("array<string>"))
    series = [
        F.slice(F.coalesce(F.col(f"daily.{v}"), F.array().cast("array<double>")), 1, F.size(days)).alias(c)
        for v, c in DAILY_VARIABLES.items()
    ]
    place = [F.col("location_name").alias("location"), "province", "island", "latitude", "longitude", "peatland_flag"]
    aligned = located.select("dataset", *place, days.alias("date"), *series)
    rows = aligned.select(
        *RECORD_SCHEMA.fieldNames()[:7], F.inline(F.arrays_zip("date", *DAILY_VARIABLES.values()))
    )
    mean = F.bround((F.col("temperature_2m_max_c") + F.col("temperature_2m_min_c")) / 2, 3)
    return rows.withColumn("temperature_2m_mean_c", mean)
