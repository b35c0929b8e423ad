"""Questions to a period: months pruned, events of a calendar, and reports in their own order."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from rainledger.operators import with_position
from rainledger.plans import runs, weather
from rainledger.sinks import read_table, shared_folder
from workbench.registry import QUERIES
from conftest import SMALL
from test_sources import record, records

EVENTS = "climate_event string, first_day date, last_day date"


def daily(spark, first, days, places=("jakarta", "medan")):
    start = dt.date.fromisoformat(first)
    rows = [
        record(location=place, province="P", island="I", peatland_flag=False, latitude=0.0, longitude=0.0)
        | {"date": str(start + dt.timedelta(n)), "temperature_2m_max_c": 30.0 + n % 9, "precipitation_sum_mm": float(n % 5)}
        for place in places
        for n in range(days)
    ]
    return records(spark, rows)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("store"))
    runs.weather_tables(daily(spark, "2025-01-01", 300), store)
    return lambda name: read_table(spark, store, "silver", name)




@pytest.mark.parametrize(
    "fact, rank", [("fact_drought_risk_daily", weather.drought_ranking), ("fact_fire_risk_daily", weather.fire_ranking)]
)
def test_rankings_read_their_months_only(stored, fact, rank):
    args = stored("dim_location"), stored("dim_date"), "2025-03-10", "2025-04-20"
    ranked = rank(stored(fact), *args)
    wanted = [tuple(r) for r in rank(stored(fact).drop(weather.MONTH), *args).collect()]
    assert [tuple(r) for r in ranked.collect()] == wanted and len(wanted) == 2
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "Window" not in plan
    pruned = [line for line in plan.split("\n") if "FileScan" in line and "month_key" in line]
    assert pruned and all(re.search(r"PartitionFilters: \[.*month_key.*dynamicpruning", line) for line in pruned)


def test_months_hold_all_days(stored):
    fact = stored("fact_drought_risk_daily")
    assert fact.count() == 600 and fact.where(F.expr("date_key div 100 <> month_key")).isEmpty()
    assert {r[0] for r in fact.select(weather.MONTH).distinct().collect()} == {202501 + n for n in range(10)}


def test_events_of_a_calendar(spark):
    bronze = weather.build_bronze(daily(spark, "2025-01-01", 40))
    rows = [("A", "2025-01-03", "2025-01-20"), ("B", "2025-01-15", "2025-01-25"), ("C", "2025-01-15", "2025-01-16")]
    rows += [("never", "2025-03-01", "2025-02-01"), ("open", "2025-01-01", None)]
    events = spark.createDataFrame([(n, *map(lambda d: d and dt.date.fromisoformat(d), r)) for n, *r in rows], EVENTS)
    found = {str(r["full_date"])[5:]: r["climate_event"] for r in weather.dim_date(bronze, events).collect()}
    assert len(found) == 40
    assert [found[d] for d in ("01-02", "01-03", "01-14", "01-15", "01-25", "01-26")] == [None, "A", "A", "B", "B", None]
    # Without a calendar every day belongs to the one event.
    assert {r["climate_event"] for r in weather.dim_date(bronze).collect()} == {weather.CLIMATE_EVENT}


def test_the_trend_of_an_event_drops_other_days(spark):
    bronze = weather.build_bronze(daily(spark, "2025-01-01", 30))
    day = dt.date.fromisoformat
    events = spark.createDataFrame([("A", day("2025-01-03"), day("2025-01-05")), ("B", day("2025-01-10"), day("2025-01-11"))], EVENTS)
    dates, places = weather.dim_date(bronze, events), weather.dim_location(bronze)
    facts = weather.weather_fact(bronze, dates, places)
    for event, days in (("A", [3, 4, 5]), ("B", [10, 11]), ("C", [])):
        rows = weather.climate_trend(facts, places, dates, event).collect()
        assert [r["full_date"].day for r in rows] == days


def test_positions_follow_the_order_of_the_rows(spark):
    df = spark.range(1000).repartition(7).select("id", (F.col("id") % 10).alias("m"))
    placed = with_position(df.orderBy(F.col("m").desc(), "id")).collect()
    wanted = sorted(range(1000), key=lambda i: (-(i % 10), i))
    assert [r["id"] for r in sorted(placed, key=lambda r: r["position"])] == wanted
    assert [r["position"] for r in sorted(placed, key=lambda r: r["position"])] == list(range(1, 1001))
    assert with_position(df.limit(0).orderBy("id")).count() == 0


def test_each_question_stores_its_own_fact(spark):
    """What a question costs must not depend on the one before it."""
    folder = shared_folder(spark)
    kept = lambda: {p for p in glob.glob(f"{folder.removeprefix('file://')}/store-*")}
    for name, fact in (("insight_drought_rank", "drought"), ("insight_fire_rank", "fire"), ("insight_drought_rank", "drought")):
        before = kept()
        assert not QUERIES[name](spark, SMALL).isEmpty()
        (store,) = kept() - before
        assert sorted(os.listdir(f"{store}/silver")) == ["dim_date", "dim_location", f"fact_{fact}_risk_daily"]
