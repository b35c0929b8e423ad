"""Weather risk: a daily star schema with crop, drought, fire and mitigation scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clamp, date_key, exact_mean, flag_points, ladder, month_name, risk_level, season
from ..operators.joins import broadcast_if_small
from ..operators.ranking import keep_first, surrogate_key
from ..operators.rolling import rolling_sums
from ..operators.spread import spread

CLIMATE_EVENT = "El Nino"
#: The column that the stored risk facts are laid out by: YYYYMM of the date key.
MONTH = "month_key"

# Points by measure, as (comparison, (cut, points), ...); the first rule that holds wins.
HEAT = "temperature_2m_max_c"
SOIL = "soil_moisture_avg"
CROP_STRESS = {
    HEAT: (">=", [(38, 40), (35, 30), (33, 20), (31, 10)]),
    SOIL: ("<=", [(0.10, 35), (0.15, 25), (0.20, 15), (0.25, 8)]),
    "evapotranspiration_mm": (">=", [(8, 25), (6, 18), (4, 10), (2, 5)]),
}
DROUGHT = {
    "precipitation_30d_mm": ("<", [(30, 25), (60, 18), (100, 10), (150, 5)]),
    HEAT: (">=", [(38, 25), (35, 18), (33, 10), (31, 5)]),
    SOIL: ("<=", [(0.10, 25), (0.15, 18), (0.20, 10), (0.25, 5)]),
    "evapotranspiration_30d_mm": (">=", [(200, 25), (150, 18), (100, 10), (60, 5)]),
}
FIRE = {
    HEAT: (">=", [(38, 20), (35, 15), (33, 10), (31, 5)]),
    "relative_humidity_min_pct": ("<=", [(30, 20), (40, 15), (50, 10), (60, 5)]),
    "wind_speed_10m_max_kmh": (">=", [(30, 15), (25, 11), (20, 7), (15, 3)]),
}
FIRE_DROUGHT_SHARE = "0.4"
PEATLAND_POINTS = 5
ACTIONS = [
    (75, "Evacuation prep & fire patrol"),
    (50, "Water allocation & public warning"),
    (25, "Monitor & early warning"),
]
NO_ACTION = "Routine monitoring"

PLACE_COLUMNS = ["location", "province", "island", "latitude", "longitude", "peatland_flag"]
WEATHER_COLUMNS = [
    "date_key",
    "location_key",
    "temperature_2m_mean_c",
    "temperature_2m_max_c",
    "precipitation_sum_mm",
    "relative_humidity_min_pct",
    "wind_speed_10m_max_kmh",
    "soil_moisture_avg",
    "evapotranspiration_mm",
    "crop_stress_score",
]
DROUGHT_COLUMNS = [
    "date_key",
    "location_key",
    "precipitation_7d_mm",
    "precipitation_30d_mm",
    "soil_moisture_avg",
    "evapotranspiration_30d_mm",
    "drought_risk_score",
    "drought_risk_level",
]
FIRE_COLUMNS = [
    "date_key",
    "location_key",
    "drought_risk_score",
    "temperature_2m_max_c",
    "relative_humidity_min_pct",
    "wind_speed_10m_max_kmh",
    "precipitation_7d_mm",
    "peatland_flag",
    "fire_risk_score",
    "fire_risk_level",
]
MITIGATION_COLUMNS = [
    "date_key",
    "location_key",
    "drought_risk_score",
    "fire_risk_score",
    "mitigation_priority_score",
    "recommended_action",
]


def _points(scheme: Mapping[str, tuple]) -> Column:
    parts = [ladder(F.col(measure), comparison, rules, 0) for measure, (comparison, rules) in scheme.items()]
    return sum(parts[1:], parts[0])


# --- bronze -------------------------------------------------------------------------------------


def build_bronze(records: DataFrame, rows: int | None = None) -> DataFrame:
    """One record per date and location: archive before forecast, then the newest file.

    Archive wins even where its measures are NULL. ``records`` may carry ``ts``, the landing time. With the number of
    ``rows``, or a bound of it, tasks are of bounded size.
    """
    records = records if rows is None else spread(records, ["date", "location"], rows)
    order = [F.col("dataset").asc_nulls_last()]
    if "ts" in records.columns:
        order.append(F.col("ts").desc_nulls_last())
    return keep_first(records, ["date", "location"], order).drop("ts")


# --- dimensions ---------------------------------------------------------------------------------


def dim_date(bronze: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """The calendar of the days that occur, with the climate event of each.

    ``events(climate_event, first_day, last_day)`` is the calendar of events, both days included; of several on one day
    the one that began last counts (then by name), and a day without one has NULL. Without a calendar every day belongs
    to the one event that the plan was made for.
    """
    day = F.col("full_date")
    days = bronze.select(F.col("date").cast("date").alias("full_date")).distinct()
    if events is None:
        named = days.withColumn("climate_event", F.lit(CLIMATE_EVENT))
    else:
        named = days.join(broadcast_if_small(event_days(events)), "full_date", "left")
    return named.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        season(day).alias("season_indonesia"),
        "climate_event",
    )


def event_days(events: DataFrame) -> DataFrame:
    """One row per day of the events: a join of equal days instead of one between ranges."""
    days = F.explode(F.sequence(F.col("first_day").cast("date"), F.col("last_day").cast("date"))).alias("full_date")
    spread = events.where(F.col("first_day") <= F.col("last_day")).select(days, "climate_event", F.col("first_day").alias("_begun"))
    return keep_first(spread, ["full_date"], [F.col("_begun").desc(), F.col("climate_event")]).drop("_begun")


def dim_location(bronze: DataFrame) -> DataFrame:
    """Locations numbered by name. Facts join by name, so check that names are unique."""
    keyed = surrogate_key(bronze.select(*PLACE_COLUMNS).distinct(), ["location"], "location_key")
    return keyed.select("location_key", F.col("location").alias("location_name"), *PLACE_COLUMNS[1:])


# --- facts --------------------------------------------------------------------------------------


def weather_fact(bronze: DataFrame, dates: DataFrame, places: DataFrame) -> DataFrame:
    """Daily measures with crop stress; grain: location x day.

    The few dates are broadcast, never shuffled: a shuffle by date would make one group per day.
    """
    return (
        bronze.withColumn("full_date", F.col("date").cast("date"))
        .join(broadcast_if_small(dates.select("full_date", "date_key")), "full_date")
        .join(places.select("location_key", F.col("location_name").alias("location")), "location")
        .withColumn("crop_stress_score", clamp(_points(CROP_STRESS)))
        .select(*WEATHER_COLUMNS)
    )


def _with_drought(weather: DataFrame, rows: int | None = None) -> DataFrame:
    summed = rolling_sums(
        weather if rows is None else spread(weather, ["location_key"], rows),
        ["location_key"],
        ["date_key"],
        {
            "precipitation_7d_mm": ("precipitation_sum_mm", 7),
            "precipitation_30d_mm": ("precipitation_sum_mm", 30),
            "evapotranspiration_30d_mm": ("evapotranspiration_mm", 30),
        },
    )
    scored = summed.withColumn("drought_risk_score", clamp(_points(DROUGHT)))
    return scored.withColumn("drought_risk_level", risk_level(F.col("drought_risk_score")))


def _with_fire(rows: DataFrame) -> DataFrame:
    share = F.col("drought_risk_score") * F.lit(FIRE_DROUGHT_SHARE).cast("decimal(1,1)")
    score = clamp(share + _points(FIRE) + flag_points(F.col("peatland_flag"), PEATLAND_POINTS))
    scored = rows.withColumn("fire_risk_score", score.cast("decimal(5,1)"))
    return scored.withColumn("fire_risk_level", risk_level(F.col("fire_risk_score")))


def drought_risk(weather: DataFrame, rows: int | None = None) -> DataFrame:
    """A location's window holds one row per day, so no window exceeds the calendar; ``rows`` bounds a task's locations."""
    return _with_drought(weather, rows).select(*DROUGHT_COLUMNS)


def fire_risk(drought: DataFrame, weather: DataFrame, places: DataFrame) -> DataFrame:
    """Fire risk from two stored facts and the location table."""
    measures = weather.select("date_key", "location_key", HEAT, "relative_humidity_min_pct", "wind_speed_10m_max_kmh")
    joined = drought.join(measures, ["date_key", "location_key"]).join(
        places.select("location_key", "peatland_flag"), "location_key"
    )
    return _with_fire(joined).select(*FIRE_COLUMNS)


def mitigation(fire: DataFrame) -> DataFrame:
    score = F.greatest("drought_risk_score", "fire_risk_score").cast("decimal(5,1)")
    ranked = fire.withColumn("mitigation_priority_score", score)
    action = ladder(F.col("mitigation_priority_score"), ">=", ACTIONS, NO_ACTION)
    return ranked.withColumn("recommended_action", action).select(*MITIGATION_COLUMNS)


def daily_risk(weather: DataFrame, places: DataFrame, rows: int | None = None) -> DataFrame:
    """Weather, drought and fire columns together, in one pass over the weather fact of about ``rows`` rows.

    Equal to joining the two stored facts again on their shared grain, without that join.
    """
    flags = places.select("location_key", "peatland_flag")
    return _with_fire(_with_drought(weather, rows).join(flags, "location_key"))


# --- gold ---------------------------------------------------------------------------------------


def month_key() -> Column:
    return F.expr("date_key div 100").cast("int")


def _star(fact: DataFrame, places: DataFrame, dates: DataFrame) -> DataFrame:
    """A fact with the names of its places and days.

    A fact laid out by month is also joined by month, so that only the months of ``dates`` are read: the chosen days are
    broadcast, and their months prune the folders at run time.
    """
    named = places.select("location_key", "province", "location_name", F.col("peatland_flag").alias("_peatland"))
    if MONTH in fact.columns:
        days = broadcast_if_small(dates.select("date_key", "full_date", month_key().alias(MONTH)))
        return fact.join(days, ["date_key", MONTH]).join(named, "location_key").drop(MONTH)
    days = broadcast_if_small(dates.select("date_key", "full_date"))
    return fact.join(named, "location_key").join(days, "date_key")


def gold_drought(drought: DataFrame, places: DataFrame, dates: DataFrame) -> DataFrame:
    """Scores are summed by the facts' own keys, before the names are joined; location names are unique."""
    daily = drought.groupBy("location_key", "date_key").agg(
        F.avg("drought_risk_score").alias("avg_drought_risk"), F.max("drought_risk_score").alias("peak_drought_risk")
    )
    columns = ["full_date", "province", "location_name", "avg_drought_risk", "peak_drought_risk"]
    return _star(daily, places, dates).select(*columns)


def gold_trend(weather: DataFrame, places: DataFrame, dates: DataFrame) -> DataFrame:
    return _trend(_star(weather, places, dates))


def _trend(star: DataFrame) -> DataFrame:
    return star.groupBy("full_date", "province").agg(
        exact_mean(F.col("precipitation_sum_mm")).alias("avg_rainfall_mm"),
        exact_mean(F.col("temperature_2m_mean_c")).alias("avg_temperature_c"),
    )


def gold_fire(fire: DataFrame, places: DataFrame, dates: DataFrame) -> DataFrame:
    daily = fire.groupBy("location_key", "date_key").agg(
        exact_mean(F.col("fire_risk_score")).alias("avg_fire_risk"), F.max("fire_risk_score").alias("peak_fire_risk")
    )
    columns = ["full_date", "province", "location_name", "peatland_flag", "avg_fire_risk", "peak_fire_risk"]
    return _star(daily, places, dates).withColumnRenamed("_peatland", "peatland_flag").select(*columns)


def gold_mitigation(fact: DataFrame, places: DataFrame, dates: DataFrame) -> DataFrame:
    columns = ["full_date", "province", "location_name", "mitigation_priority_score", "recommended_action"]
    return _star(fact, places, dates).select(*columns)


# --- insights -----------------------------------------------------------------------------------


def drought_ranking(drought: DataFrame, places: DataFrame, dates: DataFrame, start: str, end: str) -> DataFrame:
    """Mean and peak drought score per location between two days, worst peak first."""
    return (
        _star(drought, places, _between(dates, start, end))
        .groupBy("province", "location_name")
        .agg(
            F.avg("drought_risk_score").alias("avg_drought_risk"),
            F.max("drought_risk_score").alias("peak_drought_risk"),
        )
        .orderBy(F.col("peak_drought_risk").desc_nulls_last(), "province", "location_name")
    )


def fire_ranking(fire: DataFrame, places: DataFrame, dates: DataFrame, start: str, end: str) -> DataFrame:
    """Peak fire score per location between two days, worst first."""
    return (
        _star(fire, places, _between(dates, start, end))
        .groupBy("province", "location_name")
        .agg(F.max("fire_risk_score").alias("peak_fire_risk"))
        .orderBy(F.col("peak_fire_risk").desc_nulls_last(), "province", "location_name")
    )


def _between(dates: DataFrame, start: str, end: str) -> DataFrame:
    return dates.where(F.col("full_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def climate_trend(weather: DataFrame, places: DataFrame, dates: DataFrame, event: str = CLIMATE_EVENT) -> DataFrame:
    """Rain and temperature per day and province during a climate event."""
    during = dates.where(F.col("climate_event") == event)
    return _trend(_star(weather, places, during)).orderBy("full_date", "province")


def mitigation_periods(fact: DataFrame, places: DataFrame, dates: DataFrame, min_score: int = 75) -> DataFrame:
    """Days and places at or above a priority, by day and then most urgent first."""
    urgent = fact.where(F.col("mitigation_priority_score") >= min_score)
    order = ["full_date", F.col("mitigation_priority_score").desc_nulls_last(), "province", "location_name"]
    return gold_mitigation(urgent, places, dates).orderBy(*order)


def top_risk(fact: DataFrame, places: DataFrame, score: str, k: int = 5) -> DataFrame:
    """The ``k`` locations with the highest peak score."""
    peaks = fact.groupBy("location_key").agg(F.max(score).alias("_peak"))
    return (
        peaks.join(places.select("location_key", "province", "location_name"), "location_key")
        .groupBy("province", "location_name")
        .agg(F.max("_peak").alias("peak"))
        .orderBy(F.col("peak").desc_nulls_last(), "province", "location_name")
        .limit(k)
    )
